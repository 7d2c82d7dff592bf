"""Joins of wide rows with marks on some of their keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridledger.llm import shared
from gridledger.llm.secrets import secret_spans, spans_text
from gridledger.llm.shared import join_marks, stored, told_apart
from gridledger.llm.simhash import near_dedup

from .messy import frame, messy_rows


def tables(spark):
    """60,000 rows, a third of them with one key and marked, another third with one key and not; nulls; every 40th key marked."""
    key = F.when(F.col("id") % 3 == 0, 40).when(F.col("id") % 3 == 1, 41).when(F.col("id") % 1000 == 2, None).otherwise(F.col("id"))
    rows = spark.range(60_000).select(F.col("id").alias("row"), key.cast("long").alias("k"), F.lit("x" * 50).alias("wide"))
    marks = rows.where("k % 40 = 0").groupBy("k").agg(F.count("*").alias("n")).withColumn("m", F.concat(F.lit("m"), "k"))
    return rows, stored(marks, "marks")


@pytest.mark.parametrize("limit", [1 << 20, 16 << 10, 0])
def test_marks_come_to_their_rows(spark, limit):
    rows, marks = tables(spark)
    got = join_marks(rows, marks, "k", "m", "n", 64, limit)
    assert sorted(got.columns) == ["k", "m", "row", "wide"]
    wanted = F.when(F.col("k") % 40 == 0, F.concat(F.lit("m"), "k"))
    assert got.count() == 60_000 and got.select("row").distinct().count() == 60_000
    assert got.where(~F.col("m").eqNullSafe(wanted)).isEmpty()


def test_few_rows_without_a_mark_are_left_open(spark):
    """With 16 bits a key one key in 17 or so shares a bit; common marks are known before the shuffle."""
    rows = spark.range(200_000).select((F.col("id") * 7919).alias("k"))
    marks = stored(rows.where("k % 20 = 0").withColumns({"n": F.lit(1), "m": F.lit(True)}), "marks")
    told, left_open = told_apart(rows, marks, "k", "m", "n", 10_000, 1 << 40, 1 << 20)
    assert told.where("k % 20 = 0").isEmpty() and left_open.where("k % 20 = 0").count() == 10_000
    assert 0.03 < left_open.where("k % 20 <> 0").count() / 190_000 < 0.09
    told, left_open = told_apart(rows, marks, "k", "m", "n", 10_000, 10_000, 1 << 20)
    assert told.where("m").count() == 10_000


def test_empty_sides(spark):
    rows, marks = tables(spark)
    for limit in (1 << 20, 0):
        assert join_marks(rows.limit(0), marks, "k", "m", "n", 64, limit).isEmpty()
        assert join_marks(rows, marks.limit(0), "k", "m", "n", 64, limit).where("m is null").count() == 60_000


def test_operators_beyond_the_broadcast(spark, monkeypatch):
    rows = messy_rows()
    docs = frame(spark, rows).withColumns({"_id": F.lit("i"), "_out": F.lit("o"), "_key": F.lit("k"), "n": F.lit(1)})

    def results():
        spans = secret_spans(docs).select("doc_id", spans_text(F.col("spans")).alias("s"), "_id", "n").collect()
        return sorted(map(str, spans)), sorted(map(str, near_dedup(docs).collect()))

    near = results()
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 0)
    far = results()
    assert len(near[0]) == len(rows) and near == far
