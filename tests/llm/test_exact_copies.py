from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from compare import compare, open_tables
from conftest import SF_SMALL
from pyspark.sql import functions as F

from gridledger.llm.exact_copies import ADDED, exact_copies, normalised, without_copies
from gridledger.llm.oracles import build_oracles
from gridledger.llm.queries import build_queries

from .messy import SCHEMA, frame, messy_rows


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """Sorted (id, keep_id, group_size, kept, sha) of (id, text) pairs."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), place == 0, sha) for place, i in enumerate(ids)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", *ADDED).collect()), key=str)


def variants():
    base = "one text\nof many copies"
    rows = [(i, base if i % 2 else base.replace(" ", " \t ").replace("\n", " \r\n")) for i in range(40)]
    rows += [(100, " lead"), (101, "lead"), (102, "lead "), (103, "\x1clead"), (104, "lead "), (105, "lead ")]
    return rows + [(200, None), (201, ""), (202, " "), (203, "\n\t"), (None, base), (None, "lonely"), (None, "lonely"), (7, base), (0, base)]


def test_query_equals_sql(spark):
    with open_tables(SF_SMALL) as con:
        # The comparison knows no booleans.
        query = lambda s, d: build_queries()["op12_exact_dedup"](s, d).withColumn("kept", F.col("kept").cast("string"))
        sql = f"select * replace (cast(kept as varchar) as kept) from ({build_oracles()['op12_exact_dedup']})"
        assert compare(spark, con, "op12", query, sql, SF_SMALL) > 0


@pytest.mark.parametrize("broadcast", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_equals_brute_force(spark, broadcast):
    rows = variants() + [(r[0], r[1]) for r in messy_rows()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = found(exact_copies(df, broadcast_bytes=broadcast, hot_share=8))
    assert got == brute(rows)


@pytest.mark.parametrize("broadcast", [0, 1 << 20], ids=["shuffle", "broadcast"])
def test_texts_of_one_hash_are_told_apart(spark, broadcast):
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    # A hash with one value, and one with three, in place of 128 bits.
    for weak in (lambda text: F.unhex(F.lit("00")), lambda text: F.unhex(F.concat(F.lit("0"), F.length(text) % 3))):
        assert found(exact_copies(df, digest=weak, broadcast_bytes=broadcast, hot_share=8)) == brute(rows)


def test_columns_stay_and_names_may_clash(spark):
    df = frame(spark).withColumn("keep_id", F.lit("mine")).withColumn("_hash", F.lit(5)).withColumn("row", F.lit("r"))
    got = exact_copies(df)
    assert got.columns == [c for c in df.columns if c not in ("text", "kept", "keep_id")] + list(ADDED)
    assert {r[0] for r in got.select("_hash").collect()} == {5} and got.count() == df.count()
    kept = without_copies(df)
    assert kept.columns == df.columns and kept.schema["keep_id"].dataType.typeName() == "string"
    texts = [norm(r["text"]) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({norm(r[1]) for r in messy_rows()})


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_copies(empty).collect() == [] and without_copies(empty).collect() == []


def test_no_python_on_the_path(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = exact_copies(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert normalised("text") is not None
