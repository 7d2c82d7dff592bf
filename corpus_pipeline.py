"""From documents to packed token sequences: quality rules, near-duplicates, secrets, mixture, packing.

Each stage gets the documents that its predecessor kept, as written to Parquet, and all but the last
return their columns. Nulls, empty texts and repeated rows are treated as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm.mixing import mixed
from gridledger.llm.packing import pack_documents
from gridledger.llm.quality_rules import quality_rules
from gridledger.llm.queries import label_domains
from gridledger.llm.secrets import mask_secrets
from gridledger.llm.shared import stored
from gridledger.llm.simhash import near_dedup

#: Shares of tokens in the mixture. The total is the least at which no domain has to shrink, and no
#: rate is below 1, so the stage repeats documents and drops none.
MIX_WEIGHTS = {"good": 0.82, "poor": 0.06, "toxic": 0.12}


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail neither the base rules nor with their host."""
    # The row goes along as one value, so that its columns cannot be taken for the rules' own.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole"), "text", "source")
    return quality_rules(whole, carry=["_whole"]).where("kept").select("_whole.*")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of near-duplicates: that with the smallest doc_id."""
    return near_dedup(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars following the text."""
    masked = mask_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return masked


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture asks for; as they are where nothing is labelled."""
    domains = label_domains(spark, sf_dir)
    if domains.where("doc_id is not null and domain is not null").isEmpty():
        return docs
    return mixed(docs, domains, MIX_WEIGHTS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; see ``pack_documents``."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither tokenization nor the fitted mixture; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
