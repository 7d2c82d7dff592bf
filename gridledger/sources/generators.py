"""Synthetic datasets, computed row by row from an id.

``*_from_ids`` fill in the columns for any table with a non-negative BIGINT ``id``; ``gen_*`` make
``n`` rows from ``spark.range``. Either way the work is split over tasks by Spark, nothing is
shuffled, and the rows do not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.synthetic import letters, uniform_int

# Default sizes and the customer IDs transactions refer to.
CUSTOMER_ROWS = 50_000
TRANSACTION_ROWS = 5_000_000
POINT_ROWS = 10_000_000
RECTANGLE_ROWS = 4_500_000
EXTENT = 10_000


def _hundredths(low: int, above: int, stream: int) -> str:
    """A double with two decimals in [low, above)."""
    return f"{uniform_int(low * 100, above * 100 - 1, stream)} / 100D"


def _int(low: int, high: int, stream: int) -> str:
    return f"cast({uniform_int(low, high, stream)} as int)"


def customers_from_ids(ids: DataFrame) -> DataFrame:
    return ids.selectExpr(
        "id as ID",
        f"{letters(10, 20, 0)} as Name",
        f"{_int(10, 70, 1)} as Age",
        f"if({uniform_int(0, 1, 2)} = 1, 'male', 'female') as Gender",
        f"{_int(1, 10, 3)} as CountryCode",
        f"{_hundredths(100, 10_000, 4)} as Salary",
    )


def transactions_from_ids(ids: DataFrame, customers: int = CUSTOMER_ROWS) -> DataFrame:
    return ids.selectExpr(
        "id as TransID",
        f"{uniform_int(1, customers, 5)} as CustID",
        f"{_hundredths(10, 1_000, 6)} as TransTotal",
        f"{_int(1, 10, 7)} as TransNumItems",
        f"{letters(20, 50, 0)} as TransDesc",
    )


def points_from_ids(ids: DataFrame, extent: int = EXTENT) -> DataFrame:
    return ids.selectExpr(f"{_int(1, extent, 0)} as x", f"{_int(1, extent, 1)} as y")


def rectangles_from_ids(ids: DataFrame, extent: int = EXTENT) -> DataFrame:
    return ids.selectExpr(
        "concat('r', id) as rectId",
        f"{_int(1, extent, 2)} as x",
        f"{_int(1, extent, 3)} as y",
        f"{_int(1, 7, 4)} as w",
        f"{_int(1, 20, 5)} as h",
    )


def seeds_from_ids(ids: DataFrame, extent: int = EXTENT) -> DataFrame:
    """Ids start at 1, centre indexes at 0."""
    return ids.selectExpr(
        "cast(id - 1 as int) as idx", f"{_int(1, extent, 6)} as x", f"{_int(1, extent, 7)} as y"
    )


def gen_customers(spark: SparkSession, n: int = CUSTOMER_ROWS) -> DataFrame:
    return customers_from_ids(spark.range(1, n + 1))


def gen_transactions(
    spark: SparkSession, n: int = TRANSACTION_ROWS, customers: int = CUSTOMER_ROWS
) -> DataFrame:
    return transactions_from_ids(spark.range(1, n + 1), customers)


def gen_points(spark: SparkSession, n: int = POINT_ROWS, extent: int = EXTENT) -> DataFrame:
    return points_from_ids(spark.range(1, n + 1), extent)


def gen_rectangles(spark: SparkSession, n: int = RECTANGLE_ROWS, extent: int = EXTENT) -> DataFrame:
    return rectangles_from_ids(spark.range(1, n + 1), extent)


def gen_seeds(spark: SparkSession, k: int, extent: int = EXTENT) -> DataFrame:
    return seeds_from_ids(spark.range(1, k + 1), extent)
