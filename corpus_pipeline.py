"""The corpus pipeline: five stages over `documents`, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import byte_bpe, decontaminate, pii, quality_rules, simhash
from sluice.llm.queries import _vocabulary
from sluice.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return quality_rules.quality_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest doc_id stays."""
    return simhash.simhash_near_dedup(docs, shingle=3, radius=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that consist mostly of them go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and digests of the ids and of the decoded bytes."""
    ranks = _vocabulary("byte_bpe_50k.tiktoken")
    both = byte_bpe.encode_and_decode(docs, ranks, keep=["doc_id"])
    return both.select(
        F.col("kept.doc_id").alias("doc_id"),
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("PII", personal_data),
    ("byte-level BPE", tokens),
]

# learned rules, components and tokenisers are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline_" + name.lower().replace(" ", "_"))
    return docs
