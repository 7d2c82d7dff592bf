"""Measured size of a table, so that only a proven-small side is ever broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast at most this many measured bytes; every caller has a shuffle plan beyond it.
BROADCAST_BYTES = 64 * 1024 * 1024

# Allowance for row header, null bits, hash-table slot and pointer.
ROW_OVERHEAD = 48


def row_bytes(df: DataFrame) -> str:
    """Upper estimate of one row's size in a broadcast hash table, as SQL text."""
    fixed = ROW_OVERHEAD + 8 * len(df.columns)
    text = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text.append(f"coalesce(octet_length(`{field.name}`), 0) + 8L")
        elif not isinstance(
            field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
        ):
            raise TypeError(f"no size bound for column {field.name}: {field.dataType}")
    return " + ".join([f"{fixed}L", *text])


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (one distributed aggregate, no shuffle of its rows) against ``limit``."""
    if limit <= 0:
        return False
    return (df.agg(F.expr(f"sum({row_bytes(df)})")).first()[0] or 0) <= limit
