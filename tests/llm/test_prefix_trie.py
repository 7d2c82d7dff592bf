from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import compare, open_tables
from conftest import SF_SMALL

from gridledger.llm.oracles import build_oracles
from gridledger.llm.prefix_trie import prefix_trie
from gridledger.llm.queries import build_queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, depth int, conv string"


def mark(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}:{text}".encode()).digest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0, mark(role, text)), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        last = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * last
        ends = ",".join(str(c) for c in sorted(members[node]) if len(rebuilt[c]) == len(node))
        out.append(
            (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
             leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def check(spark, rows, parts):
    df = spark.createDataFrame([(*r, "k", 1, "c")[:7] for r in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in prefix_trie(df, parts).collect()), key=str) == brute(rows)


def test_query_equals_sql(spark):
    with open_tables(SF_SMALL) as con:
        assert compare(spark, con, "op11", build_queries()["op11_prefix_trie"], build_oracles()["op11_prefix_trie"], SF_SMALL) > 0


def test_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for c in rng.sample(range(400), 90):
        # Few texts and a common start, so that paths meet at many depths.
        n = rng.choice([1, 2, 3, 5, 9, 14])
        rows += [(c, t, "user" if t % 2 else "assistant", "start" if t < 3 else rng.choice("ab")) for t in range(n)]
    rows += [(c, t, "user", f"same {t}") for c in (500, 501, 502, 505, 515) for t in range(30)]
    rows += [(1000, t, "user", f"long {t}") for t in range(700)]
    rows += [(2001, 0, None, None), (2001, None, "user", "é"), (2001, None, "a", ""), (2001, 4, "", ""), (2001, 4, "", "")]
    rows += [(None, 1, "user", "nobody"), (3003, 1, "x", "shorter than what it would lend")]
    check(spark, rows, 5)


def test_snapshots_of_one_conversation(spark):
    # Every conversation is a prefix of the next, so each node is shared and one conversation ends there.
    rows = [(5 * c, t, "user", f"t{t}") for c in range(1, 13) for t in range(c)]
    check(spark, rows, 3)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")]], ids=["empty", "nobody"])
def test_no_conversations(spark, rows):
    assert prefix_trie(spark.createDataFrame([(*r, "k", 1, "c") for r in rows], SCHEMA)).collect() == []
