"""Running totals and ranks over an order of all rows, without a task that sees them all.

Rows are dealt to ranges of the order, the totals of whole ranges are added up ahead, and each range
then only needs its own rows and one number. A group or a tie may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .artefacts import stored
from .groups import join_groups
from .sizing import BROADCAST_BYTES

_RANGE = "_range_of_order"


def _ranges(df: DataFrame, order: list[Column], parts: int | None, label: str) -> DataFrame:
    """``df`` in ranges of the order, numbered by it. Stored, as the bounds come from a sample."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn(_RANGE, F.spark_partition_id()), label)


def running_totals(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, str], parts: int | None = None
) -> DataFrame:
    """``df`` with the sums of columns from the first row of each key to the present one.

    ``totals`` maps new names to columns, which hold no nulls. ``order`` tells the rows of a key apart.
    A key is shared by as many tasks as it has ranges; at most one key crosses each border of
    ranges, so what is added for those before is a small table.
    """
    placed = _ranges(df, [F.col(k) for k in keys] + order, parts, "ordered")
    span = Window.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumns({name: F.sum(column).over(span) for name, column in totals.items()})

    # Fewer rows than ranges: a key in several of them crosses a border.
    crossing = placed.groupBy(*keys).agg(F.min(_RANGE).alias("_first"), F.max(_RANGE).alias("_last")).where("_first < _last")
    chunks = (
        placed.join(F.broadcast(crossing.select(*keys)), keys)
        .groupBy(*keys, _RANGE)
        .agg(*[F.sum(column).alias(f"_{name}") for name, column in totals.items()])
    )
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = chunks.select(*keys, _RANGE, *[F.sum(f"_{name}").over(before).alias(f"_{name}") for name in totals])
    summed = own.join(F.broadcast(ahead), [*keys, _RANGE], "left")
    return summed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(name) + F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in totals],
    )


def with_rank(
    df: DataFrame,
    value: str,
    name: str = "rank",
    descending: bool = True,
    parts: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with what SQL's ``rank()`` over the whole table gives each row, nulls last.

    Rows are first counted by value, which makes a tie of any size one row before it is moved. The
    distinct values lie in ranges of the order; a rank is the rows of the ranges before, plus those
    before it in its own. Rows then look up their value: common ones by broadcast, others by
    shuffle (``join_groups``), so no tie meets in one task.
    """
    rows = stored(df, "to-rank")
    key = f"`{value}`"
    counts = stored(rows.groupBy(F.expr(key).alias("_value")).agg(F.expr("count(*) as _n")), "counts")
    order = F.col("_value").desc() if descending else F.col("_value").asc()
    placed = _ranges(counts.where("_value is not null"), [order], parts, "values")
    ahead, total = [], 0
    # One row for each range.
    for row in sorted(placed.groupBy(_RANGE).agg(F.expr("sum(_n) as n")).collect(), key=lambda row: row[_RANGE]):
        ahead.append((row[_RANGE], total))
        total += row["n"]
    spark = df.sparkSession
    ahead = spark.createDataFrame(ahead, f"{_RANGE} int, _ahead bigint")
    before = Window.partitionBy(_RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = stored(
        placed.join(F.broadcast(ahead), _RANGE).select(
            "_value", "_n", (F.col("_ahead") + F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias("_rank")
        ),
        "ranks",
    )
    columns = [F.col(f"`{c}`") for c in df.columns]
    found = join_groups(rows.where(f"{key} is not null").withColumn("_value", F.expr(key)), ranked, ["_value"], "_n", broadcast_bytes=broadcast_bytes)
    nulls = rows.where(f"{key} is null").select(*columns, F.lit(total + 1).cast("bigint").alias(name))
    return found.select(*columns, F.col("_rank").alias(name)).unionByName(nulls)
