"""Bounded samples of labelled rows for the classifiers, and who is held out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small


def remainder(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def class_counts(rows: DataFrame, label_col: str) -> dict:
    """Rows of each label; labels are few."""
    counted = rows.where(F.col(label_col).isNotNull()).groupBy(label_col).count().collect()
    return {row[label_col]: row["count"] for row in sorted(counted, key=lambda row: str(row[label_col]))}


def sampled(rows: DataFrame, id_col: str, label_col: str, counts: dict, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, or all if there are fewer, picked by the id's hash."""
    draw = F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1 << 30)) / float(1 << 30)
    picks = [(F.col(label_col) == label) & (draw < per_class / count) for label, count in counts.items()]
    return rows.where(reduce(lambda a, b: a | b, picks)) if picks else rows.where("false")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, per_class: int, folds: int, held_out: int
) -> tuple[DataFrame, dict]:
    """(_id, label, text) of sampled labelled documents outside the held-out fold, and the label counts.

    A repeated id counts once in ``labels``. Only the sample's ids are sent to where documents are read.
    """
    known = labels.where((remainder(F.col(id_col), folds) != held_out) & F.col(label_col).isin(0, 1))
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label")).dropDuplicates(["_id"])
    counts = class_counts(known, "label")
    ids = sampled(known, "_id", "label", counts, per_class)
    texts = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("text"))
    expected = sum(min(per_class, n) for n in counts.values())
    return texts.join(small(ids, 2 * expected, 64), F.col("_doc") == F.col("_id")).select("_id", "label", "text"), counts
