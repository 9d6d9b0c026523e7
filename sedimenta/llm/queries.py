"""One query per training-data operator, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    decontaminate,
    embedding_duplicates,
    hard_negatives,
    language_id,
    language_model,
    licenses,
    packing,
    pii,
    quality_rules,
    secrets,
    simhash,
    spelling,
    token_counts,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of one of the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", *quality_rules.BASE_MEASURES, "base_failed", "kept", "failed")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every hundredth vector is an anchor.
MINING = hard_negatives.Mining(anchor="id % 100 = 0")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), MINING)
    return mined.withColumn("rank", F.col("rank").cast("int"))


def op12_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.vocabulary(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_licenses": op2_licenses,
    "op3_personal_data": op3_personal_data,
    "op4_secrets": op4_secrets,
    "op5_language_model": op5_language_model,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_decontaminate": op10_decontaminate,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_duplicates": op12_embedding_duplicates,
    "op13_spelling_groups": op13_spelling_groups,
}
