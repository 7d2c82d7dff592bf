"""Text sinks: comma-separated rows, and report lines of the form ``key<TAB>values``.

Every task writes its own part file. Formatting happens in the last projection before the write,
so operators keep full precision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_decimals(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.2f", value))


def _line(key: Column | None, values: list[Column]) -> Column:
    text = F.concat_ws(",", *[v.cast("string") for v in values])
    if key is None:
        return text.alias("value")
    # A null key is written as such: a line must never be lost.
    return F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit("\t"), text).alias("value")


def customer_txn_summary_lines(summary: DataFrame) -> DataFrame:
    return summary.select(
        _line(
            F.col("ID"),
            [
                F.col("Name"),
                F.col("Salary"),
                F.col("NumTransactions"),
                two_decimals(F.col("TotalSum")),
                F.col("MinItems"),
            ],
        )
    )


def country_txn_report_lines(report: DataFrame) -> DataFrame:
    return report.select(
        _line(
            F.col("CountryCode"),
            [F.col("CustomerCount"), F.col("MinTransTotal"), F.col("MaxTransTotal")],
        )
    )


def age_gender_spend_lines(report: DataFrame) -> DataFrame:
    """For the combined-key form."""
    return report.select(
        _line(
            F.col("AgeGender"),
            [two_decimals(F.col(c)) for c in ("MinTransTotal", "MaxTransTotal", "AvgTransTotal")],
        )
    )


def spatial_join_lines(matches: DataFrame) -> DataFrame:
    return matches.select(
        _line(F.col("rectId"), [F.format_string("(%d,%d)", F.col("x"), F.col("y"))])
    )


def distance_outliers_lines(outliers: DataFrame) -> DataFrame:
    return outliers.select(_line(None, [F.col("x"), F.col("y")]))


def kmeans_lines(centres: DataFrame) -> DataFrame:
    return centres.select(
        F.concat(_line(None, [F.col("x"), F.col("y")]), F.lit(" - "), F.col("status")).alias("value")
    )


def in_key_order(report: DataFrame, *keys: str) -> DataFrame:
    """The report sorted by its keys, for sinks that should be: rows are dealt out by range, so part
    files follow one another and every one of them is written by a task of its own."""
    return report.orderBy(*keys)


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a one-column frame of report lines."""
    lines.write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Write all columns without a header."""
    df.write.mode(mode).option("sep", sep).csv(path)


def write_kmeans_rounds(history: DataFrame, path: str) -> None:
    """One folder for each round, ``iteration_<n>``. What an earlier run left under ``path`` goes first,
    so the highest number is always this run's result.
    """
    spark = history.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "iteration_*")) or []:
        files.delete(old.getPath(), True)
    rounds = [row[0] for row in history.select("iteration").distinct().orderBy("iteration").collect()]
    for n in rounds:
        centres = history.where(F.col("iteration") == n).orderBy("idx").coalesce(1)
        write_lines(kmeans_lines(centres), f"{path.rstrip('/')}/iteration_{n}", mode="overwrite")
