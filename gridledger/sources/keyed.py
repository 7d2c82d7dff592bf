"""Tables written by a common key, so that what is worked out for each key needs no shuffle when they are read.

Write once, read often: ``write_keyed`` deals the rows of every table to the same buckets by their key;
``per_key`` then runs any function of the tables whose result for a key hangs on the rows of that key
alone (a co-group, a join on the key, totals by it) bucket by bucket. Rows of hot keys, and rows
without a key, lie beside the buckets and go through the same function on plain files, so that no bucket
holds much of one key.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.groups import HOT_SHARE

#: What tells the rows of the parts apart, as folders of the path.
_BUCKETED, _HOT, _LAYOUT = "bucketed", "hot", "layout"

# Column of a table's hot keys while they are joined; it must not be one of the table's own.
_KEY = "_hot_key"


def _hot_keys(rows: DataFrame, key: str, hot_share: int) -> DataFrame:
    """Keys with more than one in ``hot_share`` rows: fewer than ``hot_share``, so they can be broadcast."""
    counts = rows.where(f"`{key}` is not null").groupBy(F.col(f"`{key}`").alias(_KEY)).agg(F.expr("count(*) as n"))
    total = rows.agg(F.expr(f"count(`{key}`)")).first()[0]
    return counts.where(f"n * {hot_share}L > {total}L").select(_KEY)


def write_keyed(
    tables: dict[str, tuple[DataFrame, str]], path: str, buckets: int | None = None, hot_share: int = HOT_SHARE
) -> None:
    """Write tables, each given with its key column, under ``path``, which must not exist.

    Key columns must have one type, since equal values then meet in one bucket. ``buckets`` is the number of
    files of each table (by default that of shuffle partitions). A key that is hot in one table is kept out of
    the buckets in all. A table is read three times, so pass stored ones. ``layout`` is written last: what is
    only half written cannot be read.
    """
    if not tables:
        raise ValueError("no tables")
    kinds = {rows.schema[key].dataType.simpleString() for rows, key in tables.values()}
    if len(kinds) > 1:
        raise ValueError(f"keys of unlike types: {sorted(kinds)}")
    for name, (rows, _) in tables.items():
        if _KEY in rows.columns:
            raise ValueError(f"{name} has a column {_KEY}")
    spark = next(iter(tables.values()))[0].sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    found = None
    for rows, key in tables.values():
        mine = _hot_keys(rows, key, hot_share)
        found = mine if found is None else found.union(mine)
    found.distinct().write.parquet(f"{path}/hot_keys")
    # Under hot_share rows for each table.
    hot = F.broadcast(spark.read.parquet(f"{path}/hot_keys"))
    for name, (rows, key) in tables.items():
        meets = F.col(f"`{key}`") == F.col(_KEY)
        few = rows.where(f"`{key}` is null").unionByName(rows.join(hot, meets, "left_semi"))
        few.write.parquet(f"{path}/{name}/{_HOT}")
        many = rows.where(f"`{key}` is not null").join(hot, meets, "left_anti").repartition(buckets, F.col(f"`{key}`"))
        table = _table_name(f"{path}/{name}", buckets)
        spark.sql(f"drop table if exists {table}")
        many.write.bucketBy(buckets, key).option("path", f"{path}/{name}/{_BUCKETED}").format("parquet").saveAsTable(table)
    layout = [(name, key, buckets, rows.schema.json()) for name, (rows, key) in tables.items()]
    spark.createDataFrame(layout, "name string, key string, buckets int, columns string").coalesce(1).write.parquet(f"{path}/{_LAYOUT}")


def _table_name(path: str, buckets: int) -> str:
    """Name in the session's catalog, which alone can hold that files are buckets."""
    return f"gridledger_{hashlib.md5(f'{path} {buckets}'.encode()).hexdigest()}"


def read_keyed(spark: SparkSession, path: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    """For each table of ``write_keyed`` its rows in buckets and its rows beside them."""
    tables = {}
    for row in spark.read.parquet(f"{path}/{_LAYOUT}").collect():
        schema = StructType.fromJson(json.loads(row["columns"]))
        table = _table_name(f"{path}/{row['name']}", row["buckets"])
        if not spark.catalog.tableExists(table):
            # Another session wrote the files: only the catalog has to learn of them.
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(
                f"create table {table} ({columns}) using parquet clustered by (`{row['key']}`) into {row['buckets']} buckets "
                f"location '{path}/{row['name']}/{_BUCKETED}'"
            )
        tables[row["name"]] = spark.table(table), spark.read.schema(schema).parquet(f"{path}/{row['name']}/{_HOT}")
    return tables


def per_key(spark: SparkSession, path: str, function: Callable[..., DataFrame], *names: str, **options: object) -> DataFrame:
    """``function`` of the named tables of ``write_keyed``, for a function that works key by key.

    The rows in buckets and those beside them share no key, so the result is the union of both.
    """
    tables = read_keyed(spark, path)
    missing = [name for name in names if name not in tables]
    if missing:
        raise ValueError(f"not written under {path}: {missing}")
    parts = [function(*[tables[name][part] for name in names], **options) for part in (0, 1)]
    return parts[0].unionByName(parts[1])
