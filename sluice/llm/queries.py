"""The registered queries of the training-data operators, and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    byte_bpe,
    decontaminate,
    kneser_ney,
    minhash,
    oracles,
    pii,
    quality_rules,
    simhash,
    substring_dedup,
    token_alignment,
    token_store,
    toxicity,
    url_templates,
    vector_codes,
)


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark, sf):
    found = substring_dedup.substring_dedup(_table(spark, sf, "documents"), min_words=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_token_store(spark, sf):
    manifest = token_store.write_token_store(_table(spark, sf, "documents"), _vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_store.read_token_store(manifest)


def op3_byte_bpe(spark, sf):
    return byte_bpe.round_trip(_table(spark, sf, "documents"), _vocabulary("byte_bpe_50k.tiktoken"))


def op4_url_templates(spark, sf):
    return url_templates.judge_urls(_table(spark, sf, "pages"))


def op5_quality_rules(spark, sf):
    return quality_rules.quality_report(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op6_pii(spark, sf):
    return pii.find_pii(_table(spark, sf, "documents"))


def op7_kneser_ney(spark, sf):
    return kneser_ney.lm_scores(_table(spark, sf, "documents"), order=3)


def op8_decontaminate(spark, sf):
    return decontaminate.contamination_report(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), n=10)


def op9_simhash(spark, sf):
    return simhash.simhash_groups(_table(spark, sf, "documents"), shingle=3, radius=3)


def op10_toxicity(spark, sf):
    return toxicity.toxicity_scores(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_minhash(spark, sf):
    return minhash.minhash_groups(_table(spark, sf, "documents"), shingle=4, percent=80)


def op12_token_alignment(spark, sf):
    return token_alignment.alignment_report(
        _table(spark, sf, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model")
    )


def op13_vector_codes(spark, sf):
    return vector_codes.vector_codes(_table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_token_store,
        op3_byte_bpe,
        op4_url_templates,
        op5_quality_rules,
        op6_pii,
        op7_kneser_ney,
        op8_decontaminate,
        op9_simhash,
        op10_toxicity,
        op11_minhash,
        op12_token_alignment,
        op13_vector_codes,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op8_decontaminate": oracles.DECONTAMINATE,
}
