"""Counts of neighbours within a radius, for every point.

Where points lie dense, running totals along the columns of a tile give the points between two ends of a column
as one difference, whatever their number. Elsewhere a cell that lies wholly inside the circle is added as a
number; pairs of cells are refined only where the circle's rim may pass, and points are compared only there.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.artefacts import artefacts, new_path, stored
from ..functions.grid import cell_index, packed

#: Pairs of positions up to which two cells are compared rather than cut into four each.
PAIRS = 4096

# Least side of a tile of running totals, and the greatest radius that tiles are made for.
_TILE = 512
_TILE_R = 1023

# A tile of fewer than one position in so many places is left to the pairs of cells.
_SPARSE = 256

# Share of a tile's places up to which positions are looked up one by one, instead of all places in order;
# how many at a time; and columns of a strip, whose totals are to stay in a core's cache.
_GATHERED = 1 / 64
_GATHER = 4096
_STRIP = 32

# Partitions for a tile, that two seldom share one, and the most of them.
_TILES_APART = 3
_PARTS = 4096


def _distances(side: int) -> tuple[str, str]:
    """Squares of the least and the greatest distance that points of two cells of a side, i and j cells
    apart, can have. Coordinates are whole, so points of one cell differ by at most side - 1."""

    def squared(step: str) -> str:
        return f"({step.format('i')} * {step.format('i')} + {step.format('j')} * {step.format('j')})"

    return squared(f"greatest((abs({{}}) - 1) * {side}L + 1, 0L)"), squared(f"((abs({{}}) + 1) * {side}L - 1)")


def _row(key: str) -> str:
    """First index of a packed cell, or of the difference of two."""
    return f"(({key} + 2147483648) >> 32)"


def _column(key: str) -> str:
    return f"({key} - {_row(key)} * 4294967296)"


def neighbour_counts(points: DataFrame, r: int, pairs: int = PAIRS) -> DataFrame:
    """(x, y, copies, neighbours): for each position the other points within distance ``r``, ends included.

    Copies of a point are neighbours of each other; a position stands for all its copies, whose
    counts are the same. Points without a coordinate are left out.

    * Positions are counted once, and cells of each level from them: a pile of copies is one row, and
      a cell with a third of all points is a number.
    * For radii up to 1023, tiles that hold many positions for their area are answered by running totals:
      ``2 r + 1`` differences for a position, however many neighbours it has. No pair of points is made.
      The rest of this holds for positions in other tiles.
    * A level has cells half as wide as the one before. Whether two cells lie within r, cannot, or may
      partly, follows from their offset alone. Cells within r give their number of points to each
      other; pairs at the rim are compared point by point if that is at most ``pairs`` comparisons, and
      are cut into four by four otherwise. So crowded cells are refined on their own, empty ones never, and no
      pair of cells costs more than ``pairs``, whatever the share of points in one cell.
    * What a cell was given passes to the four it is cut into, so each point looks up one cell at the end.
      Every join is by cell, its rows being cells or bounded numbers of positions.
    """
    if not 0 <= r < 2**29:
        raise ValueError("r must be at least 0 and below 2**29")
    spark = points.sparkSession
    path = new_path(spark, "neighbour-counts")
    with artefacts(spark):
        counted = _counts(points, r, pairs)
        return stored(counted, "neighbour-counts", path=path)


def _counts(points: DataFrame, r: int, pairs: int) -> DataFrame:
    positions = stored(
        points.where("x is not null and y is not null")
        .groupBy(F.expr("cast(x as bigint) as x"), F.expr("cast(y as bigint) as y"))
        .agg(F.expr("count(*) as m")),
        "positions",
    )
    if r > _TILE_R:
        return _by_cells(positions.selectExpr("*", "true as asks"), r, pairs)
    side = max(_TILE, 2 << r.bit_length())
    tile = [f"{cell_index('x', side)} as tx", f"{cell_index('y', side)} as ty"]
    tiles = stored(
        positions.groupBy(*map(F.expr, tile)).agg(F.expr(f"count(*) * {_SPARSE}L >= {side * side}L as dense")), "tiles"
    )
    kinds = {row["dense"]: row["n"] for row in tiles.groupBy("dense").agg(F.expr("count(*) as n")).collect()}
    if True not in kinds:
        return _by_cells(positions.selectExpr("*", "true as asks"), r, pairs)
    dense = _by_totals(positions, tiles.where("dense").select("tx", "ty"), r, side, kinds[True])
    if False not in kinds:
        return dense
    asking = positions.selectExpr("*", *tile).join(tiles, ["tx", "ty"]).selectExpr("x", "y", "m", "not dense as asks")
    return dense.unionByName(_by_cells(stored(asking, "asking"), r, pairs))


def _by_totals(positions: DataFrame, tiles: DataFrame, r: int, side: int, n_tiles: int) -> DataFrame:
    """Counts for the positions of the given tiles (tx, ty), each with a margin of ``r`` all round.

    A column of a tile holds, for each of its places, the points up to there. What lies in the circle's part of a
    column is the difference of two places, and the places' distances from a position are the same for all.
    A tile is a task's array of ``(side + 2 r) ** 2`` numbers, however many points it has.
    """
    width = side + 2 * r
    met = positions
    for c in "xy":
        ends = ", ".join(cell_index(f"({c} {sign} {r})", side) for sign in "-+")
        met = met.selectExpr("*", f"explode(sequence({ends})) as t{c}")
    # A column has one place before the first, where its total is 0.
    place = f"cast((x - tx * {side}L + {r}) * {width + 1} + y - ty * {side}L + {r} + 1 as int) as place"
    placed = met.join(tiles, ["tx", "ty"]).selectExpr("tx", "ty", place, "m")
    # An explicit number: a tile's work does not show in its bytes, by which AQE would merge them.
    parts = max(int(positions.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(_TILES_APART * n_tiles, _PARTS))
    counted = placed.repartition(parts, "tx", "ty").groupBy("tx", "ty").applyInArrow(
        _tile_counts(r, side), "tx long, ty long, place int, m long, within long"
    )
    column = f"(place div {width + 1})"
    return counted.selectExpr(
        f"cast(tx * {side}L + {column} - {r} as int) as x", f"cast(ty * {side}L + (place - {column} * {width + 1}) - {r} - 1 as int) as y",
        "m as copies", "within - 1 as neighbours",
    )


def _tile_counts(r: int, side: int) -> Callable[[pa.Table], pa.Table]:
    """For the places of one tile that are not in its margin: (tx, ty, place, m, within)."""
    width = side + 2 * r
    ends = [(d, math.isqrt(r * r - d * d)) for d in range(-r, r + 1)]
    rare, batch, rows = _GATHERED * side * side, _GATHER, _STRIP

    def counts(rows_of_tile: pa.Table) -> pa.Table:
        places = rows_of_tile["place"].to_numpy()
        copies = rows_of_tile["m"].to_numpy()
        # Half the bytes where every total fits; sums may then wrap on the way, but not in the end.
        number = np.int32 if copies.sum(dtype=np.float64) < 2**31 else np.int64
        totals = np.zeros((width, width + 1), number)
        flat = totals.reshape(-1)
        flat[places] = copies
        np.cumsum(totals, axis=1, out=totals)
        col, at = np.divmod(places, width + 1)
        own = (col >= r) & (col < r + side) & (at > r) & (at <= r + side)
        asked, own_copies = places[own].astype(np.int64), copies[own]
        if len(asked) < rare:
            within = np.zeros(len(asked), np.int64)
            for a in range(0, len(asked), batch):
                some, found = asked[a : a + batch], within[a : a + batch]
                for d, half in ends:
                    found += flat[some + (d * (width + 1) + half)]
                    found -= flat[some + (d * (width + 1) - half - 1)]
        else:
            # Strips of columns, few enough to stay in a core's cache while all distances are gone through.
            sums = np.zeros((side, side), number)
            for a in range(0, side, rows):
                strip = sums[a : a + rows]
                for d, half in ends:
                    near = totals[a + r + d : a + r + d + len(strip)]
                    strip += near[:, r + half + 1 : r + half + 1 + side]
                    strip -= near[:, r - half : r - half + side]
            within = sums[col[own] - r, at[own] - r - 1].astype(np.int64)
        tile = [pa.repeat(pa.scalar(rows_of_tile[c][0].as_py(), pa.int64()), len(asked)) for c in ("tx", "ty")]
        return pa.table([*tile, asked.astype(np.int32), own_copies, within], names=["tx", "ty", "place", "m", "within"])

    return counts


def _by_cells(positions: DataFrame, r: int, pairs: int) -> DataFrame:
    """Counts for the positions that ask, among all."""

    def key(side: int) -> str:
        return packed(cell_index("x", side), cell_index("y", side))

    def cells(side: int) -> DataFrame:
        return positions.groupBy(F.expr(f"{key(side)} as cell")).agg(
            F.expr("sum(m) as n"), F.expr("count(*) as spots"), F.expr("count_if(asks) as asking")
        )

    # Cells about as wide as the radius: those that matter to one are among the 25 around it.
    side = 1 << max(r, 1).bit_length()
    level = stored(cells(side), "cells")
    around = ", ".join(f"struct({i}L as i, {j}L as j)" for i in range(-2, 3) for j in range(-2, 3))
    met = (
        level.where("asking > 0").selectExpr("cell as a", "asking as aspots", f"explode(array({around})) as d")
        .selectExpr("a", "aspots", f"a + {packed('d.i', 'd.j')} as b", "d.i", "d.j")
        .join(level.selectExpr("cell as b", "n as bn", "spots as bspots"), "b")
    )
    given = level.where("asking > 0").selectExpr("cell", "0L as had")
    compared = []
    while True:
        near, far = _distances(side)
        met = stored(met.where(f"{near} <= {r * r}L"), "pairs")
        within = met.where(f"{far} <= {r * r}L").groupBy("a").agg(F.expr("sum(bn) as more"))
        given = stored(
            given.join(within.withColumnRenamed("a", "cell"), "cell", "left").selectExpr("cell", "had + coalesce(more, 0) as had"), "given"
        )
        rim = met.where(f"{far} > {r * r}L")
        # Cells of side 2 have four positions; of side 1 their keys could overflow.
        few = "true" if side == 2 else f"aspots * bspots <= {pairs}"
        compared.append(_compared(positions.selectExpr("*", f"{key(side)} as cell"), rim.where(few), r))
        rest = rim.where(f"not ({few})")
        if side == 2 or rest.isEmpty():
            break
        side //= 2
        quarters = stored(
            cells(side).selectExpr("*", f"{packed(f'({_row("cell")} >> 1)', f'({_column("cell")} >> 1)')} as parent"), "quarters"
        )
        given = quarters.where("asking > 0").join(given.selectExpr("cell as parent", "had"), "parent").select("cell", "had")
        met = (
            rest.select("a", "b")
            .join(quarters.where("asking > 0").selectExpr("parent as a", "cell as qa", "asking as aspots"), "a")
            .join(quarters.selectExpr("parent as b", "cell as qb", "n as bn", "spots as bspots"), "b")
            .selectExpr("qa as a", "aspots", "qb as b", "bn", "bspots", f"{_row('(qb - qa)')} as i", f"{_column('(qb - qa)')} as j")
        )
    close = reduce(DataFrame.unionByName, compared).groupBy("x", "y").agg(F.expr("sum(m) as close"))
    return (
        positions.where("asks").selectExpr("*", f"{key(side)} as cell")
        .join(given, "cell")
        .join(close, ["x", "y"], "left")
        # The point itself is one of those within r.
        .selectExpr("cast(x as int) as x", "cast(y as int) as y", "m as copies", "had + coalesce(close, 0) - 1 as neighbours")
    )


def _compared(placed: DataFrame, rim: DataFrame, r: int) -> DataFrame:
    """(x, y, m): for each position of a cell a, the points of b that are within r."""
    asking = rim.select("a", "b").join(placed.where("asks").selectExpr("cell as a", "x as ax", "y as ay"), "a")
    near = asking.join(placed.selectExpr("cell as b", "x as bx", "y as by", "m"), "b").where(
        f"(ax - bx) * (ax - bx) + (ay - by) * (ay - by) <= {r}L * {r}L"
    )
    return near.groupBy("ax", "ay").agg(F.expr("sum(m) as m")).selectExpr("ax as x", "ay as y", "m")
