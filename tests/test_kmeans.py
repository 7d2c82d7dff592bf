from __future__ import annotations

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gridledger import schemas
from gridledger.functions.artefacts import artefacts
from gridledger.functions.grid import merged_ranges
from gridledger.operators import assign_centres, clustering, kmeans
from gridledger.operators.clustering import PlacedPoints, nearest_centre


def brute_kmeans(points, seeds, max_iter=6, tol=1):
    centres = sorted(seeds)
    rounds = []
    for n in range(max_iter):
        groups = {}
        for x, y in points:
            best = min(centres, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2, c[0]))
            groups.setdefault(best, []).append((x, y))
        new = []
        for c in centres:
            if c in groups:
                g = groups[c]
                x, y = int(sum(p[0] for p in g) / len(g)), int(sum(p[1] for p in g) / len(g))
                moved = (x - c[1]) ** 2 + (y - c[2]) ** 2 >= tol * tol
                new.append((n, c[0], x, y, "CHANGED" if moved else "UNCHANGED"))
        rounds.append(new)
        if not any(s[4] == "CHANGED" for s in new):
            break
        centres = [s[1:4] for s in new]
    return rounds


def run(spark, points, seeds, **options):
    got = kmeans(
        spark.createDataFrame(points, schemas.POINTS).repartition(5),
        spark.createDataFrame(seeds, schemas.CENTRES),
        history=True,
        **options,
    )
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("k", [1, 2, 5, 32, 40])
def test_equals_brute_force(spark, k):
    rng = random.Random(k)
    points = [(rng.randint(-500, 500), rng.randint(-500, 500)) for _ in range(400)] + [(7, 7)] * 200
    seeds = [(i * 3, rng.randint(-500, 500), rng.randint(-500, 500)) for i in range(k)]
    want = brute_kmeans(points, seeds)
    assert run(spark, points, seeds) == sorted(s for r in want for s in r)
    final = kmeans(
        spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(seeds, schemas.CENTRES)
    )
    assert sorted(tuple(r) for r in final.collect()) == sorted(s[1:] for s in want[-1])


def test_ties_go_to_the_lowest_index_and_empty_clusters_vanish(spark):
    points = [(0, 0), (10, 0), (5, 0)]
    seeds = [(2, 10, 0), (1, 0, 0), (0, 1000, 1000)]
    got = run(spark, points, seeds, max_iter=1)
    assert got == [(0, 1, 2, 0, "CHANGED"), (0, 2, 10, 0, "UNCHANGED")]


def test_same_place_twice(spark):
    assert run(spark, [(4, 4)], [(0, 4, 4), (1, 4, 4)]) == [(0, 0, 4, 4, "UNCHANGED")]


def test_tolerance_and_cap(spark):
    points, seeds = [(0, 0), (4, 0)], [(0, 0, 0)]
    assert run(spark, points, seeds, tol=3) == [(0, 0, 2, 0, "UNCHANGED")]
    assert [r[4] for r in run(spark, points, seeds)] == ["CHANGED", "UNCHANGED"]
    assert len(run(spark, points, seeds, max_iter=1)) == 1


def test_partitioning_does_not_matter(spark):
    rng = random.Random(1)
    points = [(rng.randint(1, 99), rng.randint(1, 99)) for _ in range(300)]
    seeds = spark.createDataFrame([(i, 10 * i, 50) for i in range(8)], schemas.CENTRES)
    df = spark.createDataFrame(points, schemas.POINTS)
    results = [sorted(kmeans(df.repartition(n), seeds).collect()) for n in (1, 7)]
    assert results[0] == results[1]


@pytest.mark.parametrize("far", [0, 10**7, 2 * 10**9])
@pytest.mark.parametrize("k", [3, 40])
def test_nearest_is_exact_far_from_the_origin(spark, far, k):
    rng = random.Random(far + k)
    centres = [Row(idx=i, x=far + rng.randint(-40, 40), y=-far + rng.randint(-40, 40)) for i in range(k)]
    points = [(far + rng.randint(-50, 50), -far + rng.randint(-50, 50)) for _ in range(60)]
    df = spark.createDataFrame(points, schemas.POINTS)
    got = df.select("x", "y", nearest_centre("x", "y", centres).alias("place")).collect()
    for r in got:
        want = min(range(k), key=lambda i: ((r.x - centres[i]["x"]) ** 2 + (r.y - centres[i]["y"]) ** 2, i))
        assert r.place == want


def test_bad_seeds(spark):
    points = spark.createDataFrame([(1, 1)], schemas.POINTS)
    for seeds in ([], [(0, 1, 1), (0, 2, 2)], [(0, None, 1)]):
        with pytest.raises(ValueError):
            kmeans(points, spark.createDataFrame(seeds, schemas.CENTRES))
    with pytest.raises(ValueError):
        kmeans(points, spark.createDataFrame([(0, 1, 1)], schemas.CENTRES), max_iter=0)


def test_no_points(spark):
    empty = spark.createDataFrame([], schemas.POINTS)
    assert kmeans(empty, spark.createDataFrame([(0, 1, 1)], schemas.CENTRES)).collect() == []


def by_hand(points, centres, rounds):
    centres = {i: (x, y) for i, x, y in centres}
    for _ in range(rounds):
        groups = {}
        for x, y in points:
            best = min(centres, key=lambda i: ((x - centres[i][0]) ** 2 + (y - centres[i][1]) ** 2, i))
            groups.setdefault(best, []).append((x, y))
        new = {i: tuple(int(sum(p[c] for p in g) / len(g)) for c in (0, 1)) for i, g in groups.items()}
        moved = {i: new[i] != centres[i] for i in new}
        centres = new
        if not any(moved.values()):
            break
    return sorted((i, *centres[i], "CHANGED" if moved[i] else "UNCHANGED") for i in centres)


@pytest.mark.parametrize("broadcast", [0, 1 << 20], ids=["shuffle", "broadcast"])
@pytest.mark.parametrize("far", [1, 20_000_000])
def test_cells_give_the_same_centres(spark, far, broadcast):
    rng = random.Random(far)
    points = [(far * rng.randint(-99, 99), far * rng.randint(-40, 90)) for _ in range(400)] + [(far * 3, far * 3)] * 200
    seeds = [(i, far * rng.randint(-99, 99), far * rng.randint(-99, 99)) for i in range(120)]
    seeds += [(900, *seeds[5][1:]), (901, *seeds[5][1:])]
    df, centres = spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(seeds, schemas.CENTRES)
    got = kmeans(df, centres, max_iter=3, literal_centres=20, broadcast_bytes=broadcast)
    assert sorted(tuple(r) for r in got.collect()) == by_hand(points, seeds, 3)
    history = kmeans(df, centres, max_iter=2, literal_centres=20, history=True)
    assert sorted(history.collect()) == sorted(kmeans(df, centres, max_iter=2, history=True).collect())
    for bad in ([(i, 1, 1) for i in range(9)] + [(0, 2, 2)], [(i, None, 1) for i in range(9)]):
        with pytest.raises(ValueError):
            kmeans(df, spark.createDataFrame(bad, schemas.CENTRES), literal_centres=5)


def test_there_is_no_limit_on_seeds(spark):
    seeds = spark.range(12_000).selectExpr("cast(id as int) as idx", "cast(id % 120 * 10 as int) as x", "cast(id div 120 * 10 as int) as y")
    points = seeds.selectExpr("x + 3 as x", "y - 2 as y")
    got = kmeans(points, seeds, max_iter=1)
    assert got.count() == 12_000
    assert got.join(seeds.selectExpr("idx", "x + 3 as ex", "y - 2 as ey"), "idx").where("x <> ex or y <> ey").isEmpty()


def test_rounds_that_reuse_cells_give_the_same_centres(spark):
    rng = random.Random(7)
    points = [(rng.randint(-500, 500), rng.randint(0, 900)) for _ in range(3000)] + [(77, 77)] * 1500 + [(None, 3)]
    seeds = [(i, rng.randint(-500, 500), rng.randint(0, 900)) for i in range(7)] + [(90, 77, 77)]
    df, centres = spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(seeds, schemas.CENTRES)
    for broadcast in (0, 1 << 20):
        got = kmeans(df, centres, history=True, reuse_points=0, broadcast_bytes=broadcast)
        assert sorted(got.collect()) == sorted(kmeans(df, centres, history=True).collect())
    assert kmeans(df.limit(0), centres, reuse_points=0).collect() == []


def scanned(spark, df, column):
    """Rows that the scans of a column's table put out, by the metrics of the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for n in range(leaves.size()):
        node = leaves.apply(n)
        while "QueryStage" in node.nodeName():
            inner = node.plan().collectLeaves()
            node = inner.apply(0)
        if node.nodeName().startswith("Scan parquet") and column in node.output().mkString(","):
            total += node.metrics().apply("numOutputRows").value()
    return total


def test_rounds_read_few_points(spark):
    rng = random.Random(3)
    middles = [(9000 * i, 9000 * j) for i in range(4) for j in range(4)]
    points = [(x + rng.randint(-900, 900), y + rng.randint(-900, 900)) for x, y in middles for _ in range(5000)]
    df = spark.createDataFrame(points, schemas.POINTS).repartition(8)
    centres = [Row(idx=i, x=x, y=y) for i, (x, y) in enumerate(middles)]
    with artefacts(spark):
        placed = PlacedPoints(df, cell_points=4)
        owned, rest = placed.border(centres, 1 << 20)
        assert rest.count() == 0 and owned.agg({"n": "sum"}).first()[0] == len(points)
        # One more centre inside a cloud: only that cloud has a border, and other row groups are skipped.
        split = centres + [Row(idx=99, x=100, y=50)]
        owned, rest = placed.border(split, 1 << 20)
        assert 0 < rest.count() < len(points) / 50
        assert owned.agg({"n": "sum"}).first()[0] + rest.count() == len(points)
        assert scanned(spark, rest, "x#") < len(points) / 4
        assert "PushedFilters: [" in rest._jdf.queryExecution().executedPlan().toString() and "cell" in str(rest.schema)


@pytest.mark.parametrize("literal", [0, 1000], ids=["cells", "literals"])
def test_assignments_equal_brute_force(spark, literal):
    rng = random.Random(12)
    points = [(rng.randint(-99, 99), rng.randint(-99, 99), i) for i in range(400)] + [(5, 5, 1)] * 200 + [(None, 1, 0)]
    seeds = [(i, rng.randint(-99, 99), rng.randint(-99, 99)) for i in range(40, 0, -1)] + [(77, 5, 5), (70, 5, 5)]
    df = spark.createDataFrame(points, "x int, y int, level int").withColumn("near_centres", F.lit("n"))
    got = assign_centres(df, spark.createDataFrame(seeds, schemas.CENTRES), literal_centres=literal)
    assert got.columns == ["x", "y", "level", "near_centres", "idx", "dist2"]
    want = []
    for x, y, level in points:
        if x is not None:
            d, idx = min(((x - a) ** 2 + (y - b) ** 2, i) for i, a, b in seeds)
            want.append((x, y, level, "n", idx, d))
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    for bad in (df.withColumn("idx", F.lit(1)), df.withColumn("dist2", F.lit(1))):
        with pytest.raises(ValueError):
            assign_centres(bad, spark.createDataFrame(seeds, schemas.CENTRES))
    with pytest.raises(ValueError):
        assign_centres(df, spark.createDataFrame([], schemas.CENTRES))


def test_ranges_cover_their_keys():
    assert merged_ranges([], 4) == [] and merged_ranges([5, 3, 4, 9], 4) == [(3, 5), (9, 9)]
    assert merged_ranges([1, 10, 12, 40], 2) == [(1, 12), (40, 40)] and merged_ranges([1, 10], 1) == [(1, 10)]


def test_few_candidates_are_compared_without_lists(spark, monkeypatch):
    monkeypatch.setattr(clustering, "_assigned_by_lists", None)
    rng = random.Random(4)
    points = spark.createDataFrame([(rng.randint(-500, 500), rng.randint(-500, 500)) for _ in range(800)], schemas.POINTS)
    seeds = spark.createDataFrame([(i * 3, rng.randint(-500, 500), rng.randint(-500, 500)) for i in range(60)], "idx int, x int, y int")
    by_cells, literal = (sorted(map(tuple, kmeans(points, seeds, max_iter=3, literal_centres=n).collect())) for n in (0, 100))
    assert by_cells == literal


def test_more_candidates_than_columns(spark):
    # All on one circle round the origin, whose cell keeps every one of them.
    ring = [(x, y) for x in range(-19, 20) for y in range(-19, 20) if x * x + y * y == 325]
    assert len(ring) == 24
    centres = spark.createDataFrame([(50 - i, x, y) for i, (x, y) in enumerate(ring)], "idx int, x int, y int")
    points = [(x, y) for x in range(-6, 7) for y in range(-6, 7)]
    got = sorted(tuple(r) for r in assign_centres(spark.createDataFrame(points, schemas.POINTS), centres, literal_centres=0).collect())
    assert got == sorted((x, y, *min(((x - a) ** 2 + (y - b) ** 2, 50 - i) for i, (a, b) in enumerate(ring))[::-1]) for x, y in points)


def test_a_round_searches_once_for_each_point(spark, monkeypatch):
    labels, keep = [], clustering.stored

    def noted(df, label, **options):
        labels.append(label)
        return keep(df, label, **options)

    monkeypatch.setattr(clustering, "stored", noted)
    points = spark.createDataFrame([(0, 0), (9, 9)], schemas.POINTS)
    seeds = spark.createDataFrame([(0, 1, 1), (1, 8, 8)], "idx int, x int, y int")
    assert sorted(map(tuple, kmeans(points, seeds, max_iter=1, literal_centres=0).collect())) == [(0, 0, 0, "CHANGED"), (1, 9, 9, "CHANGED")]
    # The join with the old centres reads sums, not the search.
    assert labels.index("sums") < labels.index("centres")


def test_cells_with_many_candidates_are_cut_several_times_at_once(spark, monkeypatch):
    written = []

    def counted(df, label, **options):
        written.append(label)
        return stored(df, label, **options)

    stored = clustering.stored
    monkeypatch.setattr(clustering, "stored", counted)
    rng = random.Random(12)
    seeds = [(i, rng.randrange(4096), rng.randrange(4096)) for i in range(2500)]
    points = [(rng.randrange(4096), rng.randrange(4096)) for _ in range(300)]
    told = assign_centres(spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(seeds, schemas.CENTRES), literal_centres=0).collect()
    # Cut by cut it would be eight.
    assert written.count("open-cells") <= 6
    assert sorted((row.x, row.y, row.idx, row.dist2) for row in told) == sorted(
        (x, y, i, d) for x, y in points for d, i in [min(((x - a) ** 2 + (y - b) ** 2, i) for i, a, b in seeds)]
    )


def test_levels_of_cells_are_shared_by_tasks(spark):
    rng = random.Random(13)
    seeds = [(i, rng.randrange(65536), rng.randrange(65536)) for i in range(20_000)]
    with artefacts(spark):
        cells = clustering.candidate_cells(spark.createDataFrame(seeds, schemas.CENTRES).selectExpr("idx", "x", "y"), (0, 0), 16)
        files = cells.inputFiles()
    assert len(files) > 3 * 8  # before: one a level
