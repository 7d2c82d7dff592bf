"""Grid density: how crowded a cell is against its occupied neighbours.

Points outside [1, extent] on either axis are left out. A cell is numbered
``row * columns + column``, unique inside the extent, so the number alone serves as the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import NEIGHBOUR_OFFSETS, cell_index, offset_rows
from ..functions.ordered import with_rank


def _columns(cell: int, extent: int) -> int:
    if cell < 1 or extent < 1:
        raise ValueError("cell and extent must be at least 1")
    return -(-extent // cell)


def _count_by(points: DataFrame, key: str, extent: int) -> DataFrame:
    """Number of in-extent points for each key. Copies and full cells shrink on the map side."""
    return (
        points.where(f"x between 1 and {extent} and y between 1 and {extent}")
        .groupBy(F.expr(f"{key} as key"))
        .agg(F.count("*").alias("cell_count"))
    )


def grid_cell_counts(points: DataFrame, cell: int = 20, extent: int = 10000) -> DataFrame:
    """Number of points in each occupied cell."""
    columns = _columns(cell, extent)
    key = f"{cell_index('(y - 1)', cell)} * {columns} + {cell_index('(x - 1)', cell)}"
    return _count_by(points, key, extent).selectExpr(
        "key as cell_id", f"key div {columns} as row", f"key % {columns} as col", "cell_count"
    )


#: Cells on a side of a tile. What a tile needs of its surroundings is one cell deep, so copies add about 4 / TILE.
TILE = 32


def relative_density(points: DataFrame, cell: int = 20, extent: int = 10000, tile: int = TILE) -> DataFrame:
    """cell_count over the average count of the occupied ones among its 8 neighbours.

    I_X is null for a cell without occupied neighbours. Counted cells move once, to the tile of ``tile``
    by ``tile`` cells they lie in; those on a tile's border go to the tiles they touch as well. Cells
    then hand their counts to their neighbours inside the tile's task, where an aggregate that the
    tiles already partition collects them: no self-join, and a tile has at most (tile + 2) ** 2 rows
    however many points or cells there are.
    """
    if tile < 2:
        raise ValueError("tile must be at least 2")
    columns = _columns(cell, extent)
    across = columns // tile + 1  # tiles in a row of tiles, one past the edge included
    key = f"{cell_index('(y - 1)', cell)} * {columns} + {cell_index('(x - 1)', cell)}"
    return (
        _count_by(points, key, extent)
        .selectExpr("cell_count", f"key div {columns} as row", f"key % {columns} as col")
        # Truncation sends -1 to tile 0, where row 0 lies: no copy is made past that edge.
        .selectExpr("*", f"explode(sequence((row - 1) div {tile}, (row + 1) div {tile})) as down")
        .selectExpr("*", f"explode(sequence((col - 1) div {tile}, (col + 1) div {tile})) as along")
        .selectExpr("cell_count", "row", "col", f"down * {across} + along as tile")
        .repartition("tile")
        .selectExpr("*", f"{offset_rows([(0, 0), *NEIGHBOUR_OFFSETS])} as d")
        .selectExpr("tile", "cell_count", "row + d.d0 as row", "col + d.d1 as col", "d.d0 = 0 and d.d1 = 0 as own")
        .where(f"row >= 0 and col between 0 and {columns - 1}")
        .where(f"row div {tile} * {across} + col div {tile} = tile")
        .groupBy("tile", F.expr(f"row * {columns} + col as cell_id"))
        .agg(
            F.expr("max(if(own, cell_count, null)) as cell_count"),
            F.expr("avg(if(own, null, cell_count)) as neighbor_avg"),
        )
        .where("cell_count is not null")
        .selectExpr("cell_id", "cell_count", "neighbor_avg", "cell_count / neighbor_avg as I_X")
    )


def top_dense_cells(density: DataFrame, k: int = 50) -> DataFrame:
    """Cells of rank at most ``k`` by falling I_X, ties at the cut kept.

    A rank is at most k exactly when the value is no less than the k-th largest one, so the cut is
    a k-row top-N and the rest a plain filter. A window without partitions would bring all tied
    rows into one task; here any number of ties stays spread out. Cells with null I_X come last
    and only count when fewer than k cells have a value.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    cut = (
        density.select("I_X")
        .where("I_X is not null")
        .orderBy(F.desc("I_X"))
        .limit(k)
        # No value ranks below -Infinity, which stands for "fewer than k": then nulls count too.
        .agg(F.expr(f"if(count(I_X) = {k}, min(I_X), double('-Infinity'))"))
    )
    value = F.expr("coalesce(I_X, double('-Infinity'))")
    return density.where(value >= cut.scalar()).select("cell_id", "I_X")


def rank_cells(density: DataFrame) -> DataFrame:
    """Every cell with its rank by falling I_X, as SQL's ``rank()`` gives it; null I_X last.

    Ties share a rank and the next value skips. No window sees all cells: see ``with_rank``.
    """
    return with_rank(density.select("cell_id", "I_X"), "I_X")


def top_dense_neighbors(
    density: DataFrame, k: int = 50, cell: int = 20, extent: int = 10000
) -> DataFrame:
    """Every in-grid neighbour of the top cells with its I_X, null if empty; densest cells first."""
    columns = _columns(cell, extent)
    around = (
        top_dense_cells(density, k)
        .selectExpr(
            "cell_id as top_cell_id",
            "I_X as top_cell_I_X",
            f"cell_id div {columns} as row",
            f"cell_id % {columns} as col",
            f"{offset_rows(NEIGHBOUR_OFFSETS)} as d",
        )
        .where(f"row + d.d0 between 0 and {columns - 1} and col + d.d1 between 0 and {columns - 1}")
        .selectExpr(
            "top_cell_id", "top_cell_I_X", f"(row + d.d0) * {columns} + col + d.d1 as neighbor_cell_id"
        )
    )
    known = density.selectExpr("cell_id as neighbor_cell_id", "I_X as neighbor_I_X")
    return (
        around.join(known, "neighbor_cell_id", "left")
        .select("top_cell_id", "top_cell_I_X", "neighbor_cell_id", "neighbor_I_X")
        .orderBy(F.desc("top_cell_I_X"), "top_cell_id", "neighbor_cell_id")
    )
