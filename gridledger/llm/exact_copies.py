"""Exact copies: one text of each set of equal ones stays, that with the smallest id.

Texts are grouped by a 128-bit hash, and the texts of a group are compared before they count as equal.
Only Spark's own functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.artefacts import stored
from ..functions.groups import join_groups

#: Texts are equal if they are so after each run of white space became one space.
SPACES = r"[\x20\x09-\x0D]+"

#: The columns that are added, in their order.
ADDED = ("keep_id", "group_size", "kept", "text_sha256")

#: Bytes that one group needs in a broadcast: a hash and three numbers.
_GROUP_BYTES = 96


def normalised(text_col: str) -> Column:
    """The text that is compared; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), SPACES, " ")


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, _n, _keep, _row): size of each class, the id that stays, and the row that has it."""
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    return rows.groupBy(*keys).agg(F.count("*").alias("_n"), first.alias("_first")).select(
        *keys, "_n", F.col("_first.id").alias("_keep"), F.col("_first.row").alias("_row_kept")
    )


def exact_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    digest=hash128,
    **join_options: int,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` (of the compared text).

    * One scan writes a narrow table: id, 128-bit hash, SHA-256 and what is carried (all columns but
      the text, unless told otherwise). Everything after it works on that table, so texts are not moved.
    * Groups of one hash are counted with map-side combine: a text with a third of all rows is
      one row for each task.
    * Where a hash has several rows, their texts are compared byte by byte: one more aggregate, by hash
      and text, over those rows alone. It is combined on the map side as well, so copies are not
      moved. A hash with different texts is split by text; the others are proven equal.
    * Rows find their class by ``join_groups``: large classes are broadcast, few as they are, and
      the others shuffled by hash, so that no class fills a task.

    Nulls and empty texts: a null text equals the empty one. Rows without an id stay only where the
    class has no id at all; ``keep_id`` is null there. Of several rows with the smallest id one stays. A
    carried column whose name is among the added ones gives way to it. An empty table gives no rows.
    ``digest`` maps a text column to the hash; another one is of use in tests only.
    """
    carry = [c for c in docs.columns if c != text_col] if carry is None else carry
    carry = [c for c in carry if c not in ADDED]
    text = normalised(text_col)
    # A struct keeps the caller's names apart from those used here.
    kept_columns = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col(f"`{id_col}`").alias("_id"),
            digest(text).alias("_hash"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("_sha"),
            kept_columns.alias("_carried"),
        ),
        "hashed",
    )
    classes = stored(_classes(rows, ["_hash"]), "classes")
    several = classes.where("_n > 1").select("_hash", "_n")
    texts = docs.select(digest(text).alias("_hash"), text.alias("_text"))
    distinct = join_groups(texts, several, ["_hash"], "_n", _GROUP_BYTES, **join_options).groupBy("_hash", "_text").agg(F.lit(1))
    clashes = stored(distinct.groupBy("_hash").agg(F.count("*").alias("texts")).where("texts > 1").select("_hash"), "clashes")

    if clashes.isEmpty():
        found = join_groups(rows, classes, ["_hash"], "_n", _GROUP_BYTES, **join_options)
    else:
        found = _split(docs, rows, classes, clashes, text, digest, join_options)
    return found.select(
        *[F.col(f"_carried.`{c}`").alias(c) for c in carry],
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_row_kept")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def _split(docs, rows, classes, clashes, text, digest, join_options) -> DataFrame:
    """Rows with their class where some hashes stand for several texts: these go by SHA-256 and text.

    Rows cannot be matched to texts by their number, which another scan may give anew. Each text of a
    clash therefore has its own SHA-256 in the narrow table; two texts that share hash and SHA-256
    both are not known to anyone, and are refused rather than merged.
    """
    sha = F.unhex(F.sha2(text.cast("binary"), 256))
    different = (
        docs.select(digest(text).alias("_hash"), sha.alias("_sha"), text.alias("_text"))
        .join(clashes, "_hash", "left_semi")
        .groupBy("_hash", "_sha", "_text").agg(F.lit(1))
        .groupBy("_hash", "_sha").agg(F.count("*").alias("texts"))
    )
    if not different.where("texts > 1").isEmpty():
        raise ValueError("two texts share their 128-bit hash and their SHA-256")
    clear = join_groups(rows, stored(classes.join(clashes, "_hash", "left_anti"), "clear-classes"), ["_hash"], "_n", _GROUP_BYTES, **join_options)
    mixed = rows.join(clashes, "_hash", "left_semi")
    by_text = stored(_classes(mixed, ["_hash", "_sha"]), "split-classes")
    return clear.unionByName(join_groups(mixed, by_text, ["_hash", "_sha"], "_n", _GROUP_BYTES, **join_options))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each set of equal texts, all its columns as they were."""
    columns = docs.columns
    packed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    found = exact_copies(packed, "id", "text", carry=["row"])
    return found.where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
