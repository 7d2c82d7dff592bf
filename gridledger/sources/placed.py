"""Points written in a space-filling order, so that a window reads only the part of the files near it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import z_order

#: The column that holds the place of a point's cell in the order.
KEY = "_z_cell"

#: Ranges of keys in a window's filter, at most.
_RANGES = 64

#: Bytes of a row group, the least that a filter can skip.
GROUP_BYTES = 4 << 20

# Added to a coordinate, so that every INT has a place.
_LOW = 1 << 31


def write_points(points: DataFrame, path: str, side: int = 16, parts: int | None = None, group_bytes: int = GROUP_BYTES) -> None:
    """Write points (INT x and y, and any other columns) by Z-order of cells of ``side`` units.

    Rows are dealt to ranges of the order, by x and y as well, so that a crowded cell is shared by files; within a
    file they are sorted. Points without a coordinate cannot lie in a window and are left out.
    """
    if side < 2:
        raise ValueError("side must be at least 2")
    if KEY in points.columns:
        raise ValueError(f"points have a column {KEY}")
    parts = parts or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = [f"((cast({c} as bigint) + {_LOW}L) div {side}L)" for c in "xy"]
    (
        points.where("x is not null and y is not null")
        .withColumn(KEY, F.expr(z_order(*cells)))
        .repartitionByRange(parts, KEY, "x", "y")
        .sortWithinPartitions(KEY)
        .write.option("parquet.block.size", str(group_bytes))
        .parquet(path)
    )


def _interleaved(cx: int, cy: int) -> int:
    return sum(((cx >> b) & 1) << (2 * b) | ((cy >> b) & 1) << (2 * b + 1) for b in range(32))


def window_ranges(window: tuple[int, int, int, int], side: int, most: int = _RANGES) -> list[tuple[int, int]]:
    """Ranges of keys that hold every cell of a closed window: at most ``most``, and no longer than need be.

    Squares of the order, the largest first, are cut into four where they cross the window's edge, as long as
    that leaves no more ranges than allowed.
    """
    left, low, right, high = window
    x1, y1, x2, y2 = ((v + _LOW) // side for v in (left, low, right, high))
    if x1 > x2 or y1 > y2:
        return []

    def joined(squares: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
        ranges: list[tuple[int, int]] = []
        for cx, cy, size in sorted(squares, key=lambda s: _interleaved(s[0], s[1])):
            first = _interleaved(cx, cy)
            last = first + size * size - 1
            if ranges and ranges[-1][1] + 1 == first:
                first = ranges.pop()[0]
            ranges.append((first, last))
        return ranges

    size = 1 << 31
    squares = [(0, 0, size)]
    while True:
        finer = []
        for cx, cy, size in squares:
            if size == 1 or (x1 <= cx and cx + size - 1 <= x2 and y1 <= cy and cy + size - 1 <= y2):
                finer.append((cx, cy, size))
                continue
            half = size // 2
            for qx, qy in ((cx, cy), (cx + half, cy), (cx, cy + half), (cx + half, cy + half)):
                if qx <= x2 and qx + half > x1 and qy <= y2 and qy + half > y1:
                    finer.append((qx, qy, half))
        if finer == squares or len(joined(finer)) > most:
            return joined(squares)
        squares = finer


def read_window(spark: SparkSession, path: str, window: tuple[int, int, int, int], side: int = 16) -> DataFrame:
    """The points of ``write_points`` (with the same ``side``) in a closed window (x1, y1, x2, y2).

    Ranges of the order reach the scan as filters, which skip files, row groups and pages; x and y then
    decide exactly. A window wider than what is written is no error.
    """
    left, low, right, high = window
    ends = -_LOW, _LOW - 1
    clipped = max(left, ends[0]), max(low, ends[0]), min(right, ends[1]), min(high, ends[1])
    ranges = window_ranges(clipped, side)
    near = " or ".join(f"{KEY} between {a}L and {b}L" for a, b in ranges) or "false"
    inside = f"x between {left} and {right} and y between {low} and {high}"
    return spark.read.parquet(path).where(near).where(inside).drop(KEY)
