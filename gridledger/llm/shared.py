"""Helpers that several of these operators use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.artefacts import shared_folder, stored
from ..functions.groups import HOT_SHARE

__all__ = ["BROADCAST_BYTES", "add_columns", "join_marks", "shared_folder", "small", "stored", "told_apart"]

#: A side of a join is broadcast only if its measured bytes stay below this.
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if ``rows`` of ``row_bytes`` stay below ``limit``, else as it is."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


#: Bits of one piece of a bitmap (what ``bitmap_construct_agg`` gives), and bits spent on a key.
_PIECE_BITS = 32768
_BITS_A_KEY = 16


def join_marks(
    rows: DataFrame, marks: DataFrame, key: str, mark: str, count: str, mark_bytes: int, limit: int | None = None
) -> DataFrame:
    """``rows`` with the column ``mark`` of the row of ``marks`` that has their ``key``, null where none has.

    ``marks`` has one row for each key (a long, not null), a ``mark`` that is never null and in ``count`` a
    number that grows with the rows of the key; pass a stored table, it is read up to five times. While its
    rows of ``mark_bytes`` stay below ``limit`` they are broadcast. Beyond, ``told_apart`` answers most rows
    without a shuffle, and the rest is shuffled, by a join that AQE can split. Wide rows thus move only if
    they are marked or share a bit with a mark. ``rows`` is then read twice.
    """
    limit = BROADCAST_BYTES if limit is None else limit
    seen = marks.agg(F.count("*").alias("keys"), F.coalesce(F.sum(count), F.lit(0)).alias("total")).first()
    named = marks.select(key, mark)
    if seen["keys"] * mark_bytes <= limit:
        return rows.join(F.broadcast(named), key, "left")
    told, open_rows = told_apart(rows, marks, key, mark, count, seen["keys"], seen["total"], limit)
    return told.unionByName(open_rows.join(named.hint("merge"), key, "left"))


def told_apart(
    rows: DataFrame, marks: DataFrame, key: str, mark: str, count: str, n_keys: int, total: int, limit: int
) -> tuple[DataFrame, DataFrame]:
    """Rows whose mark is known, with ``mark``, and the others, without.

    A bitmap of hashed keys, at most ``limit`` in bytes, rules out rows without a mark; keys with more than
    one in ``HOT_SHARE`` of the counts (fewer than that many can have) are looked up in a broadcast.
    """
    pieces = max(1, min(limit * 8, n_keys * _BITS_A_KEY) // _PIECE_BITS)
    hashed = F.xxhash64(key, F.lit(1))
    piece = F.pmod(hashed, F.lit(pieces)).alias("_piece")
    place = F.pmod(F.shiftright(hashed, 32), F.lit(_PIECE_BITS))
    bits = marks.groupBy(piece).agg(F.bitmap_construct_agg(place).alias("_bits"))
    hot = marks.where(F.col(count) * F.lit(HOT_SHARE) > F.lit(total)).select(key, mark)
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    looked_up = rows.withColumn("_piece", piece).join(F.broadcast(bits), "_piece", "left").join(F.broadcast(hot), key, "left")
    is_open = F.col(mark).isNull() & is_set
    return looked_up.where(~is_open).select(*rows.columns, mark), looked_up.where(is_open).select(*rows.columns)


def add_columns(
    docs: DataFrame,
    text_col: str,
    carry: list[str],
    fields: list[tuple[str, pa.DataType, T.DataType]],
    measure: Callable[[list[bytes | None]], list],
) -> DataFrame:
    """Append columns that Python computes from whole texts, one Arrow batch at a time.

    ``measure`` gets the UTF-8 bytes of a batch's texts and returns one sequence for each of
    ``fields`` (name, Arrow type, Spark type). A carried column with a name from ``fields`` gives way.
    """
    names = [name for name, _, _ in fields]
    carry = [c for c in carry if c not in names]
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text_col}`").cast("binary").alias("_raw"))
    schema = T.StructType(
        [docs.schema[c] for c in carry] + [T.StructField(name, kind) for name, _, kind in fields]
    )
    kinds = [kind for _, kind, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = measure(batch.column(len(carry)).to_pylist())
            arrays = batch.columns[: len(carry)] + [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, carry + names)

    return source.mapInArrow(run, schema)
