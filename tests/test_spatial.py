from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from gridledger import schemas
from gridledger.operators import distance_outliers, spatial, spatial_join


def brute_join(points, rects, window=None):
    return Counter(
        (i, x, y)
        for x, y in points
        for i, rx, ry, w, h in rects
        if rx <= x <= rx + w and ry <= y <= ry + h
        and (window is None or (window[0] <= x <= window[2] and window[1] <= y <= window[3]))
    )


def brute_outliers(points, r, k):
    return Counter(
        p
        for i, p in enumerate(points)
        if sum(1 for j, q in enumerate(points)
               if i != j and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= r * r) < k
    )


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema).repartition(3)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def scene():
    rng = random.Random(7)
    points = [(rng.randint(-120, 120), rng.randint(-120, 120)) for _ in range(700)]
    # A third of all points are copies of one.
    points += [(50, 50)] * 350
    rects = [
        (f"r{i}", rng.randint(-130, 120), rng.randint(-130, 120), rng.randint(0, 9), rng.randint(0, 30))
        for i in range(150)
    ]
    rects += [("huge", -120, -120, 240, 240), ("wide", -100, 3, 180, 0), ("dot", 50, 50, 0, 0)]
    # and a third of the rectangles cover it.
    rects += [(f"hot{i}", 49, 45, 2, 8) for i in range(70)]
    return points, rects


@pytest.mark.parametrize("cell", [None, 1, 7, 50, (5, 64), 1000])
@pytest.mark.parametrize("limit", [0, 40_000, 1 << 26], ids=["shuffle", "some", "broadcast"])
def test_join_equals_brute_force(spark, scene, cell, limit):
    points, rects = scene
    got = spatial_join(
        frame(spark, points, schemas.POINTS),
        frame(spark, rects, schemas.RECTANGLES),
        cell=cell,
        broadcast_bytes=limit,
    )
    assert bag(got) == brute_join(points, rects)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_window_is_closed(spark, scene, limit):
    points, rects = scene
    window = (-20, -30, 50, 50)
    got = spatial_join(
        frame(spark, points, schemas.POINTS),
        frame(spark, rects, schemas.RECTANGLES),
        window=window,
        broadcast_bytes=limit,
    )
    assert bag(got) == brute_join(points, rects, window)


def test_edges_boundaries_and_straddling_boxes(spark):
    points = [(0, 0), (50, 50), (49, 50), (100, 100), (53, 60), (-1, -1), (-50, -51)]
    rects = [("a", 48, 48, 5, 12), ("b", 0, 0, 50, 50), ("c", -50, -60, 49, 59), ("d", 100, 100, 0, 0)]
    for limit in (0, 1 << 26):
        got = spatial_join(
            frame(spark, points, schemas.POINTS), frame(spark, rects, schemas.RECTANGLES),
            cell=50, broadcast_bytes=limit,
        )
        assert bag(got) == brute_join(points, rects)


def test_empty_sides_and_inside_out_boxes(spark):
    points = frame(spark, [(1, 1)], schemas.POINTS)
    nothing = spark.createDataFrame([], schemas.RECTANGLES)
    inside_out = frame(spark, [("a", 5, 5, -10, -10)], schemas.RECTANGLES)
    assert spatial_join(points, nothing).collect() == []
    assert spatial_join(points, inside_out).collect() == []
    assert spatial_join(spark.createDataFrame([], schemas.POINTS), inside_out).collect() == []
    with pytest.raises(ValueError):
        spatial_join(points, frame(spark, [("a", 1, 1, 1, 1)], schemas.RECTANGLES), cell=0)


@pytest.mark.parametrize("r", [1, 2, 3, 7, 10, 50])
@pytest.mark.parametrize("k", [0, 1, 3, 12])
def test_outliers_equal_brute_force(spark, r, k, monkeypatch):
    rng = random.Random(r * 100 + k)
    points = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(300)]
    points += [(3, 4)] * 150 + [(55, -55)] * 2
    want = brute_outliers(points, r, k)
    monkeypatch.setattr(spatial, "_RARE", 1.0)
    for limit in (0, 1 << 26):
        got = distance_outliers(frame(spark, points, schemas.POINTS), r, k, broadcast_bytes=limit)
        assert bag(got) == want


def test_outliers_distance_is_inclusive_and_copies_count(spark):
    pair = frame(spark, [(0, 0), (3, 4)], schemas.POINTS)
    assert bag(distance_outliers(pair, 5, 1)) == Counter()
    assert sum(bag(distance_outliers(pair, 4, 1)).values()) == 2
    copies = frame(spark, [(9, 9)] * 3, schemas.POINTS)
    assert bag(distance_outliers(copies, 1, 2)) == Counter()
    assert bag(distance_outliers(copies, 1, 3)) == Counter({(9, 9): 3})


def test_outliers_need_a_radius(spark):
    with pytest.raises(ValueError):
        distance_outliers(frame(spark, [(0, 0)], schemas.POINTS), 0, 1)


def test_outliers_shrink_with_r_and_grow_with_k(spark):
    rng = random.Random(11)
    points = frame(spark, [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(400)], schemas.POINTS)
    by_r = [set(bag(distance_outliers(points, r, 3))) for r in (5, 15, 40)]
    assert by_r[0] >= by_r[1] >= by_r[2]
    by_k = [set(bag(distance_outliers(points, 15, k))) for k in (1, 3, 6)]
    assert by_k[0] <= by_k[1] <= by_k[2]


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_large_rectangles_are_joined_by_half_cells(spark, limit):
    # Fewer points tested in vain: two by two halves where one cell would be as large as the rectangle.
    assert spatial._halved([(4, 32), (128, 8), (1024, 64)], (2, 2)) == ([(4, 32), (64, 8), (512, 32)], [4, 6, 9])
    assert spatial._halved([(128, 128)], (100, 2)) == ([(128, 64)], [6])
    rng = random.Random(3)
    points = [(rng.randint(-900, 900), rng.randint(-900, 900)) for _ in range(500)]
    rects = [(f"r{i}", rng.randint(-1000, 800), rng.randint(-1000, 800), *rng.choice([(100, 100), (900, 3), (7, 900), (2, 9)])) for i in range(120)]
    got = spatial_join(frame(spark, points, schemas.POINTS), frame(spark, rects, schemas.RECTANGLES), broadcast_bytes=limit)
    assert bag(got) == brute_join(points, rects)


def aggregates(df):
    return df._jdf.queryExecution().sparkPlan().toString().count("Aggregate")


def test_copies_are_collapsed_before_a_shuffle_only_where_it_pays(spark, monkeypatch):
    rng = random.Random(5)
    rects = [(f"r{i}", rng.randint(0, 300), rng.randint(0, 300), rng.randint(0, 9), rng.randint(0, 30)) for i in range(200)]
    apart = [(i * 37 % 401, i * 53 % 397) for i in range(900)]
    again = apart[:150] * 5 + [(None, 1)]
    monkeypatch.setattr(spatial, "_COUNTED", 1)
    monkeypatch.setattr(spatial, "_FEW", 0)
    for points, crowd, collapsed in [(apart, 1 << 18, False), (again, 1 << 18, True), (apart, 10, True)]:
        got = spatial_join(
            frame(spark, points, schemas.POINTS), frame(spark, rects, schemas.RECTANGLES), broadcast_bytes=0, crowd=crowd
        )
        # Distinct points took one more shuffle and an aggregate, whatever they were.
        assert (aggregates(got) > 0) == collapsed
        assert bag(got) == brute_join([p for p in points if p[0] is not None], rects)


def test_a_pile_is_written_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_COPIES", 4)
    points = [(5, 5)] * 70 + [(6, 5)] * 4 + [(90, 90), (-3, 7)]
    rects = [("a", 0, 0, 9, 9), ("b", 5, 5, 0, 0), ("c", -5, 0, 200, 200)]
    got = spatial_join(frame(spark, points, schemas.POINTS), frame(spark, rects, schemas.RECTANGLES), broadcast_bytes=0, crowd=10)
    assert bag(got) == brute_join(points, rects)


def test_cells_shrink_with_the_density_of_points():
    small = [Row(bw=3, bh=5, n=1000)]
    assert spatial._refined((8, 32), (2, 2), small, 0.01) == (8, 32)
    dense = spatial._refined((8, 32), (2, 2), small, 4.0)
    assert dense[0] < 8 and dense[1] < 32
    assert spatial._refined((8, 32), (8, 20), small, 4.0) == (8, 32)
    large = [Row(bw=10, bh=10, n=1000)]
    # However dense, a rectangle is not copied to more than about 16 cells.
    assert spatial._refined((1024, 1024), (2, 2), large, 1000.0) == (256, 256)


def test_small_cells_of_dense_points_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_TESTS", 0)
    monkeypatch.setattr(spatial, "_FEW", 0)
    rng = random.Random(8)
    points = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(800)]
    rects = [(f"r{i}", rng.randint(-70, 60), rng.randint(-70, 60), *rng.choice([(6, 19), (0, 0), (60, 3), (30, 30)])) for i in range(100)]
    for crowd in (10, 1 << 18):
        got = spatial_join(frame(spark, points, schemas.POINTS), frame(spark, rects, schemas.RECTANGLES), broadcast_bytes=0, crowd=crowd)
        assert bag(got) == brute_join(points, rects)


def rows_shuffled(plan):
    """Rows written by the shuffles of an executed plan, reused ones once."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif plan.nodeName().endswith("QueryStage"):
        below = [plan.plan()]
    else:
        children = plan.children()
        below = [children.apply(i) for i in range(children.size())]
    metrics = plan.metrics()
    own = metrics.apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(map(rows_shuffled, below))


def mixed_scene(rng, n_points, n_rects, span):
    points = [(rng.randint(-span, span), rng.randint(-span, span)) for _ in range(n_points)]
    shapes = [(100, 100), (900, 3), (7, 900), (2, 9), (5, 17), (0, 0), (1, 1)]
    rects = [(f"r{i}", rng.randint(-span - 50, span), rng.randint(-span - 50, span), *rng.choice(shapes)) for i in range(n_rects)]
    return points, rects


def test_a_large_join_shuffles_points_once_and_hardly_copies_rectangles(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_FEW", 0)
    monkeypatch.setattr(spatial, "_SHUFFLED", 0, raising=False)
    points, rects = mixed_scene(random.Random(21), 30_000, 3_000, 1500)
    points, rects = spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(rects, schemas.RECTANGLES)
    got = spatial_join(points, rects, broadcast_bytes=0)
    boxes = rects.selectExpr("x as x1", "y as y1", "x + w as x2", "y + h as y2")
    assert len(got.collect()) == points.join(boxes, F.expr("x between x1 and x2 and y between y1 and y2")).count()
    # Points went to every level, and a rectangle to up to 16 cells.
    assert rows_shuffled(got._jdf.queryExecution().executedPlan()) <= 1.3 * 30_000 + 3 * 3_000


@pytest.mark.parametrize("collapse", [True, False], ids=["collapsed", "apart"])
@pytest.mark.parametrize("point", [0, 4000], ids=["levels apart", "levels merged"])
@pytest.mark.parametrize("leaf", [4, 4096])
def test_join_by_tiles_equals_brute_force(spark, monkeypatch, collapse, point, leaf):
    monkeypatch.setattr(spatial, "_SHUFFLED", 0, raising=False)
    monkeypatch.setattr(spatial, "_POINT", point, raising=False)
    monkeypatch.setattr(spatial, "_LEAF", leaf, raising=False)
    monkeypatch.setattr(spatial, "_COPIES", 4)
    if not collapse:
        monkeypatch.setattr(spatial, "_FEW", 0)
        monkeypatch.setattr(spatial, "_REPEATED", 1000)
    points, rects = mixed_scene(random.Random(leaf + point), 600, 150, 1000)
    points += [(50, 50)] * 70 + [(-3, 7)] * 4 + [(-2, 7)] * 5 + [(2**31 - 1, -(2**31)), (-(2**31), 2**31 - 1)]
    rects += [("dot", 50, 50, 0, 0), ("all", -(2**31), -(2**31), 2**31 - 1, 2**31 - 1), ("end", 2**31 - 9, -(2**31), 9, 9), ("twice", 1, 1, 60, 60), ("twice", 1, 1, 60, 60)]
    gaps = [(None, 1), (1, None)]
    got = spatial_join(
        frame(spark, points + gaps, schemas.POINTS),
        frame(spark, [*rects, ("none", None, 1, 5, 5), (None, 40, 40, 20, 20)], schemas.RECTANGLES),
        broadcast_bytes=0,
    )
    assert bag(got) == brute_join(points, [*rects, (None, 40, 40, 20, 20)])


def test_leaves_are_shared_where_points_are_many():
    many = spatial._Seen(False, 2.0, 2.0, 2e8)
    levels = [[Row(bw=3, bh=5, n=30_000_000)], [Row(bw=10, bh=5, n=6_000_000)], [Row(bw=3, bh=10, n=6_000_000)]]
    (classes, leaf, tile), = spatial._leaves(levels, (2, 2), many)
    assert len(classes) == 3 and leaf[0] * leaf[1] * 2 <= spatial._LEAF
    assert tile[0] * tile[1] <= spatial._LEAVES * leaf[0] * leaf[1]
    assert spatial._copies(classes, tile) <= 3 * 42_000_000
    # Where they are few, leaves grow until they hold some, and stay within the bits of a code.
    rare = spatial._Seen(False, 1e-12, 1e-12, 2e8)
    for _, leaf, tile in spatial._leaves(levels, (2, 2), rare):
        assert max(leaf) <= 2**26 and leaf[0] * leaf[1] > 2**20


def test_levels_too_large_to_broadcast_are_joined_by_tiles(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_FEW", 0)
    monkeypatch.setattr(spatial, "_SHUFFLED", 0, raising=False)
    points, rects = mixed_scene(random.Random(4), 20_000, 700, 1500)
    # Two more levels, which are few and broadcast, beside those that are not.
    rects += [(f"b{i}", 40 * i, -30 * i, 30_000, 4) for i in range(40)] + [(f"c{i}", 30 * i, -40 * i, 4, 30_000) for i in range(40)]
    points, rects = spark.createDataFrame(points, schemas.POINTS), spark.createDataFrame(rects, schemas.RECTANGLES)
    got = spatial_join(points, rects, broadcast_bytes=50_000)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    boxes = rects.selectExpr("rectId", "x as x1", "y as y1", "x + w as x2", "y + h as y2")
    want = points.join(boxes, F.expr("x between x1 and x2 and y between y1 and y2")).select("rectId", "x", "y")
    assert bag(got) == bag(want)
    # Points went to each of the levels that were not broadcast, and rectangles to up to 16 cells.
    assert rows_shuffled(got._jdf.queryExecution().executedPlan()) <= 1.3 * 20_000 + 3 * 700
