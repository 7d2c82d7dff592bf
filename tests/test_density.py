from __future__ import annotations

import random
from collections import Counter

import pytest

from gridledger import schemas
from gridledger.operators import (
    grid_cell_counts,
    relative_density,
    top_dense_cells,
    top_dense_neighbors,
)


def brute_density(points, cell, extent):
    n = -(-extent // cell)
    counts = Counter(
        ((y - 1) // cell, (x - 1) // cell) for x, y in points if 1 <= x <= extent and 1 <= y <= extent
    )
    out = {}
    for (r, c), m in counts.items():
        around = [counts[q] for dr in (-1, 0, 1) for dc in (-1, 0, 1)
                  if (dr, dc) != (0, 0) and (q := (r + dr, c + dc)) in counts]
        mean = sum(around) / len(around) if around else None
        out[r * n + c] = (m, mean, m / mean if around else None)
    return out


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    spread = [(rng.randint(-5, 125), rng.randint(-5, 125)) for _ in range(400)]
    return spread + [(33, 47)] * 200


@pytest.mark.parametrize(("cell", "extent"), [(20, 100), (20, 110), (7, 120), (1, 30), (500, 100)])
def test_density_equals_brute_force(spark, points, cell, extent):
    df = spark.createDataFrame(points, schemas.POINTS)
    want = brute_density(points, cell, extent)
    got = {r.cell_id: (r.cell_count, r.neighbor_avg, r.I_X) for r in relative_density(df, cell, extent).collect()}
    assert got == want
    counts = grid_cell_counts(df, cell, extent).collect()
    n = -(-extent // cell)
    assert {r.cell_id: r.cell_count for r in counts} == {c: v[0] for c, v in want.items()}
    assert all(r.cell_id == r.row * n + r.col for r in counts)
    assert sum(r.cell_count for r in counts) == sum(
        1 for x, y in points if 1 <= x <= extent and 1 <= y <= extent
    )


def test_edges_do_not_wrap(spark):
    # Last column of one row and first column of the next are neighbours in number only.
    df = spark.createDataFrame([(100, 1), (1, 21)], schemas.POINTS)
    assert {r.I_X for r in relative_density(df, 20, 100).collect()} == {None}


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 9])
def test_top_is_rank_with_ties_and_nulls_last(spark, k):
    values = [5.0, 3.0, 3.0, 3.0, 1.0, None, None]
    density = spark.createDataFrame(list(enumerate(values)), "cell_id bigint, I_X double")
    density.createOrReplaceTempView("some_density")
    want = spark.sql(
        f"select cell_id from (select *, rank() over (order by I_X desc) as p from some_density) where p <= {k}"
    )
    assert {r[0] for r in top_dense_cells(density, k).collect()} == {r[0] for r in want.collect()}


def test_neighbours_of_top_cells(spark, points):
    cell, extent, k = 20, 100, 4
    df = spark.createDataFrame(points, schemas.POINTS)
    density = relative_density(df, cell, extent)
    full = brute_density(points, cell, extent)
    n = extent // cell
    top = {r.cell_id: r.I_X for r in top_dense_cells(density, k).collect()}
    want = set()
    for c, value in top.items():
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                row, col = c // n + dr, c % n + dc
                if (dr, dc) != (0, 0) and 0 <= row < n and 0 <= col < n:
                    q = row * n + col
                    want.add((c, value, q, full[q][2] if q in full else None))
    got = [tuple(r) for r in top_dense_neighbors(density, k, cell, extent).collect()]
    assert set(got) == want and len(got) == len(want)
    assert [r[1] for r in got] == sorted((r[1] for r in got), reverse=True)


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, 1)], schemas.POINTS)
    with pytest.raises(ValueError):
        relative_density(df, 0, 100)
    with pytest.raises(ValueError):
        top_dense_cells(df, 0)


def test_cells_are_moved_once_and_borders_twice(spark):
    # Every cell of a 128 by 128 grid is taken.
    points = spark.range(128 * 128).selectExpr("cast(1 + id % 128 as int) as x", "cast(1 + id div 128 as int) as y")
    density = relative_density(points, 1, 128)
    assert density.where("neighbor_avg = 1").count() == 128 * 128
    density.collect()

    def moved(node):
        """Rows that exchanges by tile have written."""
        name, total = node.getClass().getSimpleName(), 0
        if name == "AdaptiveSparkPlanExec":
            return moved(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return moved(node.plan())
        if name == "ShuffleExchangeExec" and "REPARTITION_BY_COL" in node.toString():
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        return total + sum(moved(children.apply(i)) for i in range(children.size()))

    assert 128 * 128 <= moved(density._jdf.queryExecution().executedPlan()) <= 1.2 * 128 * 128


@pytest.mark.parametrize("tile", [2, 3, 64])
def test_tiles_do_not_change_the_result(spark, points, tile):
    df = spark.createDataFrame(points, schemas.POINTS)
    got = {r.cell_id: (r.cell_count, r.neighbor_avg, r.I_X) for r in relative_density(df, 7, 120, tile).collect()}
    assert got == brute_density(points, 7, 120)
