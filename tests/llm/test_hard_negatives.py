from __future__ import annotations

import math
import random

import numpy as np
import pytest
from compare import compare, open_tables
from conftest import SF_SMALL

from gridledger.llm.hard_negatives import AnchorBlock, hard_negatives, spanning_tree
from gridledger.llm.oracles import build_oracles
from gridledger.llm.queries import build_queries

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, anchor int, rank string"


def brute(rows, every=100):
    usable = []
    for i, v, label, *_ in rows:
        if None in (i, label) or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = []
    for a, label, v in usable:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in usable if i != a and len(w) == len(v)]
        for p, pid, _ in sorted(s for s in scored if s[2] == label)[:5]:
            near = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(a, pid, n, i, -p, -s) for n, (s, i, _) in enumerate(near, 1)]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "r", 1, "k") for r in rows], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in hard_negatives(df, **options).collect())
    assert got == brute(rows, options.get("every", 100))
    return got


def clustered(n, seed, dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.randrange(4)) for i in range(n)]


def test_query_equals_sql(spark):
    with open_tables(SF_SMALL) as con:
        assert compare(spark, con, "op13", build_queries()["op13_hard_negatives"], build_oracles()["op13_hard_negatives"], SF_SMALL) > 0


def test_equals_brute_force_in_many_chunks(spark):
    assert check(spark, clustered(500, 1), every=9, block=8, chunk_bytes=1)


def test_odd_rows(spark):
    rows = clustered(150, 2, dims=3)
    rows += [(300, [0.5, 0.5, 0.5], 1)] * 3 + [(301, [0.5, 0.5, 0.5], 2)] * 9 + [(302, [0.5, 0.5, 0.5], 1)] * 9
    rows += [(400, None, 1), (500, [1.0, None, 0.0], 1), (600, [1.0, float("nan"), 0.0], 1), (700, [float("inf"), 0.0, 0.0], 1)]
    rows += [(800, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (900, [0.0, 0.0, 0.0], 3), (1000, [], 1), (1001, [], 1), (1002, [], 2)]
    rows += [(1100, [1.0, 2.0], 1), (1101, [1.0, 2.0], 1), (1102, [1.0, 1.9], 5), (-100, [-0.3, 0.2, 0.7], 1)]
    # Products beyond what doubles hold exactly.
    rows += [(1200, [3e6, 2.0, -7e5], 6), (1201, [3e6, 1.0, 0.0], 6), (1202, [3e6, 1.0, 0.5], 7), (1203, [2.9e6, 5.0, 1.0], 8)]
    assert check(spark, rows, block=4)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(100, [1.0, 0.0], 1)] + [(i, [1.0, 0.0], 1 if i % 2 else 2) for i in range(201, 260) if i % 7]
    got = check(spark, rows)
    assert [r[3] for r in got if r[1] == 201] == [i for i in range(202, 260, 2) if i % 7][:5]


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [1.0], 1)]], ids=["empty", "no anchor", "alone"])
def test_nothing_to_find(spark, rows):
    assert check(spark, rows) == []


def test_tree_is_minimal_and_bounds_spare_scores():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 200
    points = np.floor(np.repeat(centres, 50, 0) + rng.normal(size=(400, 16)) * 2)
    order, parent, edge = spanning_tree(points[::10])
    assert sorted(order) == list(range(40)) and all(p < i for i, p in enumerate(parent))
    gaps = np.linalg.norm(points[::10][:, None] - points[::10][None], axis=2)
    linked, total = {0}, 0.0
    while len(linked) < 40:
        out = [j for j in range(40) if j not in linked]
        d, j = min((gaps[i, j], j) for i in linked for j in out)
        total, linked = total + d, linked | {j}
    assert abs(edge.sum() - total) < 1e-6

    ids, labels = np.arange(400), np.arange(400) % 3
    top = int((points @ points.T).max())
    own = [[(top // 2, top)]] * 40
    tree = AnchorBlock(ids[::10], ids[::10], labels[::10], points[::10], own, False, 5)
    tree.meet(ids, labels, points)
    assert tree.pairs == 400 * 40 and tree.scored < tree.pairs / 3
    want = []
    for a in ids[::10]:
        s = sorted((-int(points[a] @ points[b]), b) for b in ids if labels[a] != labels[b] and top // 2 <= points[a] @ points[b] <= top)[:5]
        want += [(a, 0, b, -score) for score, b in s]
    assert sorted(tree.found()) == sorted(want)
