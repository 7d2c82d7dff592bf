"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_network import quality_network, quality_scores
from .exact_copies import exact_copies
from .hard_negatives import hard_negatives
from .languages import identify_languages, language_model
from .mixing import mixing_rates
from .packing import pack_documents
from .prefix_trie import prefix_trie
from .quality_rules import METRICS, quality_rules
from .secrets import BASE_RULES, secret_spans, spans_text
from .sharding import shard_documents
from .simhash import simhash_components
from .toxicity import toxicity_model, toxicity_scores
from .vector_graph import nearest_neighbours

Query = Callable[[SparkSession, str], DataFrame]


#: Shares of tokens that the mixing query aims at.
MIX_WEIGHTS = {"good": 0.9, "poor": 0.05, "toxic": 0.05}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    judged = quality_rules(docs, carry=["doc_id"])
    return judged.select("doc_id", *METRICS, "base_failed", "host_rejected", "kept")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, _table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model, carry=["doc_id"])


def op4_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality_network(docs, _table(spark, sf_dir, "labels"))
    return quality_scores(docs, net, carry=["doc_id"])


def op5_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs, language_model(docs), carry=["doc_id"])


def label_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labelled documents."""
    domain = F.expr("case when toxic = 1 then 'toxic' when quality = 0 then 'poor' when quality = 1 then 'good' end")
    return _table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rated, _ = mixing_rates(docs, label_domains(spark, sf_dir), MIX_WEIGHTS, carry=["doc_id"])
    return rated.select("doc_id", "tokens", "posterior", "rate")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secret_spans(docs.select("doc_id", "text"))
    counts = [
        # A second argument of the lambda would be the element's index.
        F.expr(f"cast(size(filter(spans, s -> s.rank = {rank})) as bigint)").alias(f"n_{rule.kind}")
        for rank, rule in enumerate(BASE_RULES)
    ]
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))
    return found.select(
        "doc_id", *counts, F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op9_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op10_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def build_queries() -> dict[str, Query]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_simhash_dedup": op2_simhash_dedup,
        "op3_counterfactual_toxicity": op3_counterfactual_toxicity,
        "op4_byte_network": op4_byte_network,
        "op5_language_families": op5_language_families,
        "op6_soft_mixing": op6_soft_mixing,
        "op7_secret_scan": op7_secret_scan,
        "op8_cost_packing": op8_cost_packing,
        "op9_pruned_graph": op9_pruned_graph,
        "op10_differencing_shards": op10_differencing_shards,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": pipeline,
    }
