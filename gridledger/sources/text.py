"""Typed scans of headerless comma-separated text.

The schema is fixed, so no pass over the data is spent on inference. ``malformed="null"`` keeps a
line with an unparsable field, with null in its place, and only the columns in use are parsed.
``malformed="drop"`` keeps a line only if it has exactly the schema's number of fields, each empty or
of its type; which lines those are does not depend on the columns in use.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .. import schemas
from ..functions.artefacts import stored

MODES = ("null", "drop")


def _record(schema: StructType) -> tuple[Column, list[Column]]:
    """Whether the line in ``value`` fits the schema in every field, and its typed fields."""
    fields = F.split("value", ",", -1)
    # A line may be short of fields, and its kind is not settled yet.
    fits = [F.size(fields) == len(schema)]
    columns = []
    for place, field in enumerate(schema.fields):
        given = F.get(fields, F.lit(place))
        if isinstance(field.dataType, StringType):
            typed = F.nullif(given, F.lit(""))
        else:
            typed = F.nullif(F.trim(given), F.lit("")).try_cast(field.dataType)
            fits.append((F.trim(given) == "") | typed.isNotNull())
        columns.append(typed.alias(field.name))
    return reduce(lambda a, b: a & b, fits), columns


def parse_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines of the column ``value`` that fit the schema in every field, typed."""
    fits, columns = _record(schema)
    return lines.where(fits).select(*columns)


#: The kind of a line that fits no layout.
BAD = "bad"


def tag_records(lines: DataFrame, layouts: dict[str, StructType]) -> DataFrame:
    """Each line parsed once into a tagged record: ``kind``, a struct for each layout, and the line itself if it
    fits none. Only the struct of a record's own kind is set; a line that fits several is of the first."""
    records = {kind: _record(schema) for kind, schema in layouts.items()}
    tag = reduce(lambda rest, kind: F.when(records[kind][0], kind).otherwise(rest), reversed(layouts), F.lit(BAD))
    tagged = lines.select("value", tag.alias("kind"))
    return tagged.select(
        "kind",
        *[F.when(F.col("kind") == kind, F.struct(*columns)).alias(kind) for kind, (_, columns) in records.items()],
        F.when(F.col("kind") == BAD, F.col("value")).alias("value"),
    )


def split_records(lines: DataFrame, layouts: dict[str, StructType]) -> dict[str, DataFrame]:
    """Records of each kind, and under ``BAD`` the lines of none, from one scan of the lines.

    Tagged records are written once to the shared folder, a sub-folder for each kind; each result reads its own
    alone. Use it inside ``artefacts`` to have the files removed.
    """
    tagged = stored(tag_records(lines, layouts), "records", by=["kind"])
    found = {kind: tagged.where(F.col("kind") == kind).select(f"{kind}.*") for kind in layouts}
    return found | {BAD: tagged.where(F.col("kind") == BAD).select("value")}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, malformed: str = "null"
) -> DataFrame:
    if malformed not in MODES:
        raise ValueError(f"malformed must be one of {MODES}")
    if malformed == "drop":
        return parse_records(spark.read.text(path), schema)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path)


def read_customers(spark: SparkSession, path: str | list[str], malformed: str = "null") -> DataFrame:
    return read_csv(spark, path, schemas.CUSTOMERS, malformed)


def read_transactions(spark: SparkSession, path: str | list[str], malformed: str = "null") -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS, malformed)


def read_points(spark: SparkSession, path: str | list[str], malformed: str = "null") -> DataFrame:
    return read_csv(spark, path, schemas.POINTS, malformed)


def read_rectangles(spark: SparkSession, path: str | list[str], malformed: str = "null") -> DataFrame:
    return read_csv(spark, path, schemas.RECTANGLES, malformed)


def read_mixed(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Customers and transactions lying in the same folder, told apart by their field count.

    Lines that fit neither layout in every field are left out, as ``malformed="drop"`` does. Where
    file names tell the kinds apart, read the two sets of files separately instead: this scans every
    line for each of the results. ``split_mixed`` scans once.
    """
    lines = spark.read.text(path)
    return parse_records(lines, schemas.CUSTOMERS), parse_records(lines, schemas.TRANSACTIONS)


def split_mixed(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``read_mixed`` with one scan of the folder, and the lines that fit neither layout; see ``split_records``."""
    found = split_records(spark.read.text(path), {"customers": schemas.CUSTOMERS, "transactions": schemas.TRANSACTIONS})
    return found["customers"], found["transactions"], found[BAD]


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """Centres from one file of ``x,y`` lines, or ``x,y - STATUS`` as ``kmeans`` reports.

    The index of a centre is its 0-based line number. Lines are not gathered: each is numbered by
    how many stand before it in its part of the file and in the parts before.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) != 1:
        raise ValueError("centres come from exactly one file: their index is the line number")
    pattern = r"^\s*(-?\d+)\s*,\s*(-?\d+)"
    # The lower bits of the id count within a part, the upper ones name it.
    placed = lines.select(
        "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_block_start").alias("start")
    )
    placed = placed.withColumns(
        {"part": F.shiftright("at", 33), "nth": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("start").alias("start"))
    before = {}
    total = 0
    for row in sorted(sizes.collect(), key=lambda row: row["start"]):
        before[row["part"]] = total
        total += row["n"]
    first = F.lit(0).cast("long")
    if before:
        first = F.element_at(F.create_map(*[F.lit(x).cast("long") for item in before.items() for x in item]), F.col("part").cast("long"))
    return (
        placed.where(F.regexp_like("value", F.lit(pattern)))
        .select(
            (first + F.col("nth")).cast("int").alias("idx"),
            F.regexp_extract("value", pattern, 1).cast("int").alias("x"),
            F.regexp_extract("value", pattern, 2).cast("int").alias("y"),
        )
    )
