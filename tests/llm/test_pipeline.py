"""Each stage of the pipeline against brute force over what it is given."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridledger.llm.shared import stored

from .messy import SCHEMA, frame, messy_rows
from .test_rules_and_copies import components_by_hand, rules_by_hand
from .test_text_and_tokens import BASE, MORE, check_packing, spans_by_hand

CLASHES = {"n_words": "w", "host_rejected": "h", "_host": "o", "tokens": "t", "posterior": "p", "_whole": "x", "domain": "d"}


def masked(text):
    out, at = "", 0
    for a, _, b, _ in spans_by_hand(text, BASE | MORE):
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, b)
    return out + text[at:]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    docs = frame(spark, [r for r in messy_rows() if r[0] is not None]).withColumns({c: F.lit(v) for c, v in CLASHES.items()})
    docs.write.parquet(str(folder / "documents.parquet"))
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 90, 2)] + [(None, 1, False), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic boolean").selectExpr("doc_id", "quality", "cast(toxic as int) as toxic").write.parquet(
        str(folder / "labels.parquet")
    )
    return str(folder)


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    given = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_dedup", "secret_scan", "mixing", "packing"]

    ruled = stored(stages["quality_rules"](spark, docs, tables), "t")
    assert ruled.columns == columns
    want = [r for r in given if (m := rules_by_hand(r["text"]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    got = ruled.collect()
    # No host of these rows fails so often that it falls.
    assert sorted(map(str, got)) == sorted(map(str, want)) and {r["n_words"] for r in got} == {"w"}

    unique = stored(stages["simhash_dedup"](spark, ruled, tables), "t")
    assert unique.columns == columns
    sets = components_by_hand([(r["doc_id"], r["text"]) for r in got], 2)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({c for *_, c in sets})

    clean = stored(stages["secret_scan"](spark, unique, tables), "t")
    assert clean.columns == columns
    assert sorted((r["doc_id"], r["text"], r["kept"], r["spans"]) for r in clean.collect()) == sorted(
        (r["doc_id"], masked(r["text"]), r["kept"], r["spans"]) for r in unique.collect()
    )

    blend = stored(stages["mixing"](spark, clean, tables), "t")
    assert blend.columns == columns
    assert {str(r) for r in blend.collect()} == {str(r) for r in clean.collect()}

    pieces = stages["packing"](spark, blend, tables).collect()
    check_packing(pieces, [(r["doc_id"], r["text"]) for r in blend.collect()])


def test_without_labels_or_documents(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark)
    assert dict(corpus_pipeline.STAGES)["mixing"](spark, docs, str(tmp_path)).count() == docs.count()
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
