"""Uniform-grid helpers, as SQL text."""

from __future__ import annotations

# The eight neighbours of a grid cell as (row offset, column offset).
NEIGHBOUR_OFFSETS = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]


def cell_index(coordinate: str, size: int | str) -> str:
    """Index of the cell holding the coordinate; floors, so negatives are right too."""
    return f"cast(floor({coordinate} / {size}) as bigint)"


def offset_rows(pairs: list[tuple[int, int]]) -> str:
    """``explode`` of literal structs (d0, d1): plans as Generate, not as a join."""
    structs = ", ".join(f"struct({a}L as d0, {b}L as d1)" for a, b in pairs)
    return f"explode(array({structs}))"


def packed(cx: str, cy: str) -> str:
    """Both indexes of a cell in one BIGINT, the cheapest key to hash, sort and shuffle.

    Exact while indexes lie within 31 bits and a sign, as those of INT coordinates on cells of
    side 2 or more do.
    """
    return f"({cx} * 4294967296 + {cy})"


def unpacked(key: str) -> tuple[str, str]:
    """Both indexes of a packed cell."""
    cx = f"(({key} + 2147483648) >> 32)"
    return cx, f"({key} - {cx} * 4294967296)"


# Shifts and masks that move the bits of a 32-bit number to every other place.
_SPREAD = [
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
]


def z_order(cx: str, cy: str) -> str:
    """Both indexes of a cell with their bits interleaved: cells near each other mostly get near keys, and a
    square of 2**b cells a side, aligned, is one range of keys. Indexes lie in [0, 2**31)."""

    def spread(value: str) -> str:
        for shift, mask in _SPREAD:
            value = f"(({value} | ({value} << {shift})) & {mask}L)"
        return value

    return f"({spread(cx)} | ({spread(cy)} << 1))"


def merged_ranges(keys: list[int], most: int) -> list[tuple[int, int]]:
    """Sorted ranges (first, last) that cover the keys, at most ``most`` of them, with the least in between."""
    keys = sorted(set(keys))
    gaps = sorted(range(1, len(keys)), key=lambda i: keys[i - 1] - keys[i])[: most - 1]
    cuts = sorted(i for i in gaps if keys[i] - keys[i - 1] > 1)
    starts, ends = [0, *cuts], [*cuts, len(keys)]
    return [(keys[a], keys[b - 1]) for a, b in zip(starts, ends)] if keys else []
