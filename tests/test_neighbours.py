from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest

from gridledger import schemas
from gridledger.operators import distance_outliers, neighbour_counts, neighbours


def brute(points, r):
    spots = Counter(points)
    return sorted(
        (x, y, m, sum(n for (a, b), n in spots.items() if (a - x) ** 2 + (b - y) ** 2 <= r * r) - 1) for (x, y), m in spots.items()
    )


def found(spark, points, r, **options):
    df = spark.createDataFrame(points, schemas.POINTS)
    return sorted(tuple(row) for row in neighbour_counts(df, r, **options).collect())


@pytest.mark.parametrize(("r", "pairs"), [(0, 4096), (1, 4), (7, 16), (13, 1), (40, 64), (300, 4096)])
def test_counts_equal_brute_force(spark, r, pairs):
    rng = random.Random(r)
    points = [(rng.randint(-60, 60), rng.randint(-60, 60)) for _ in range(500)]
    # A third of all points at one place, and ends of circles.
    points += [(3, 4)] * 250 + [(3 + r, 4), (3, 4 - r), (3 + r + 1, 4)]
    assert found(spark, points, r, pairs=pairs) == brute(points, r)


def test_a_cell_with_a_third_of_all_points_is_refined(spark):
    rng = random.Random(8)
    points = [(rng.randint(0, 63), rng.randint(0, 63)) for _ in range(700)]
    points += [(rng.randint(-3000, 3000), rng.randint(-3000, 3000)) for _ in range(1400)]
    assert found(spark, points, 50, pairs=100) == brute(points, 50)


def test_far_ends_of_the_plane(spark):
    ends = (-(2**31), 2**31 - 1)
    points = [(x, y) for x in ends for y in ends] * 3 + [(2**31 - 4, 2**31 - 4), (-(2**31) + 2, -(2**31))]
    assert found(spark, points, 6, pairs=1) == brute(points, 6)


def test_nulls_empties_and_bad_radius(spark):
    assert found(spark, [], 5) == []
    assert found(spark, [(None, 1), (1, None), (1, 1)], 5) == [(1, 1, 1, 0)]
    for r in (-1, 2**29):
        with pytest.raises(ValueError):
            found(spark, [(1, 1)], r)


def test_outliers_are_the_points_with_few_neighbours(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(600)], schemas.POINTS)
    few = [r for r in neighbour_counts(df, 20).collect() if r.neighbours < 4]
    assert sorted((r.x, r.y) for r in few for _ in range(r.copies)) == sorted(tuple(r) for r in distance_outliers(df, 20, 4).collect())


@pytest.mark.parametrize("r", [0, 1, 7, 40])
def test_dense_tiles_are_counted_without_pairs(spark, r, monkeypatch):
    def pairs(*_):
        raise AssertionError("pairs of points")

    monkeypatch.setattr(neighbours, "_compared", pairs)
    rng = random.Random(r)
    # Half of all places of a square on the corner of four tiles, so that each has enough of them.
    points = [(rng.randint(-70, 69), rng.randint(-70, 69)) for _ in range(20_000)] + [(3, 4)] * 700
    assert found(spark, points, r) == brute(points, r)


def test_a_wide_radius_over_dense_tiles_takes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_compared", None)
    monkeypatch.setattr(neighbours, "_SPARSE", 1 << 40)
    rng = random.Random(5)
    points = [(rng.randint(-1500, 1500), rng.randint(-300, 900)) for _ in range(900)]
    points += [(0, 0), (400, 0), (0, 401), (-400, 0), (240, 320), (2**31 - 1, -(2**31))]
    assert found(spark, points, 400, pairs=256) == brute(points, 400)


@pytest.mark.parametrize("r", [5, 90, 400])
def test_dense_tiles_beside_sparse_ones(spark, r):
    rng = random.Random(r)
    points = [(rng.randint(500, 570), rng.randint(-100, 100)) for _ in range(9000)]
    points += [(rng.randint(-900, 1900), rng.randint(-900, 900)) for _ in range(400)]
    assert found(spark, points, r, pairs=100) == brute(points, r)


@pytest.mark.parametrize("gathered", [0, 2])
@pytest.mark.parametrize("copies", [1, 2**33])
def test_a_tile_is_counted_whole_in_one_array(gathered, copies, monkeypatch):
    monkeypatch.setattr(neighbours, "_GATHERED", gathered)
    rng = random.Random(6)
    r, side = 9, 40
    width = side + 2 * r
    spots = {(rng.randrange(width), rng.randrange(width)): copies * rng.randint(1, 3) for _ in range(900)}
    places = [x * (width + 1) + y + 1 for x, y in spots]
    n = len(places)
    tile = pa.table({"tx": [3] * n, "ty": [-2] * n, "place": pa.array(places, pa.int32()), "m": pa.array(spots.values(), pa.int64())})
    inner = [(x, y) for x, y in spots if r <= x < r + side and r <= y < r + side]
    told = neighbours._tile_counts(r, side)(tile).to_pylist()
    assert [(row["tx"], row["ty"], row["place"], row["m"], row["within"]) for row in told] == [
        (3, -2, x * (width + 1) + y + 1, spots[x, y], sum(m for (a, b), m in spots.items() if (a - x) ** 2 + (b - y) ** 2 <= r * r)) for x, y in inner
    ]


def test_positions_of_dense_tiles_are_no_rows_for_each_column(spark):
    df = spark.createDataFrame([(x, y, 1) for x in range(30) for y in range(30)], "x long, y long, m long")
    counted = neighbours._by_totals(df, df.selectExpr("0L as tx", "0L as ty").distinct(), 400, 1024, 1)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan
    # Margins only: one for each coordinate.
    assert plan.count("Generate explode") == 2
    assert sorted(map(tuple, counted.collect())) == [(x, y, 1, 899) for x in range(30) for y in range(30)]
