"""The registered queries of this subpackage: thin calls of the operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.llm import bpe, decontaminate, gap_packing, host_rules, licence_scan, line_dedup, near_dup, packing, quality_model, secret_scan, token_alignment, token_counts, vector_codes


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """The pattern that splits texts before merging, for the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    assessed = host_rules.assess(_documents(spark, sf_dir))
    return assessed.withColumn("host_rate", F.round("host_rate", 6))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return packing.pack(packing.library_ids(docs, tokenizer("byte_bpe_multi_50k.tiktoken"), pattern()))


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.licence_report(_documents(spark, sf_dir))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_documents(spark, sf_dir), tokenizer("byte_bpe_multi_50k.tiktoken"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir), width=2, percent=80)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return token_alignment.align_tokens(_documents(spark, sf_dir), *paths, written=False)


def op13_gap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = gap_packing.pack_documents(_documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {
    "op1_host_rules": op1_host_rules,
    "op2_secrets": op2_secrets,
    "op3_packing": op3_packing,
    "op4_fuzzy_lines": op4_fuzzy_lines,
    "op5_token_counts": op5_token_counts,
    "op6_licences": op6_licences,
    "op7_decontaminate": op7_decontaminate,
    "op8_quality": op8_quality,
    "op9_transducer": op9_transducer,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_vector_codes": op11_vector_codes,
    "op12_alignment": op12_alignment,
    "op13_gap_packing": op13_gap_packing,
}
