"""Checks of isolation, uniqueness, coverage and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.config import SESSION_KEY, TENANT, MemoryConfig
from recollect.operators.embedding import embedding_ok


def leaks(results: DataFrame, queries: DataFrame, memories: DataFrame) -> DataFrame:
    """Results whose memory belongs to another tenant than the one who asked.

    Results carry the tenant who asked; query ids are unique within it only.
    """
    asked = queries.select(
        F.col("query_id").cast("string").alias("query_id"),
        F.col("app_name").alias("asked_app"),
        F.col("user_id").alias("asked_user"),
    ).distinct()
    owners = memories.select("memory_id", *TENANT)
    return (
        results.select(
            "query_id", "memory_id", F.col("app_name").alias("asked_app"), F.col("user_id").alias("asked_user")
        )
        .join(asked, ["asked_app", "asked_user", "query_id"], "left_semi")
        .join(owners, "memory_id")
        .filter(
            (F.col("app_name") != F.col("asked_app")) | (F.col("user_id") != F.col("asked_user"))
        )
    )


def self_misses(results: DataFrame, queries: DataFrame, memories: DataFrame) -> DataFrame:
    """Queries of tenants that have memories but got none of their own back."""
    owners = memories.select("memory_id", *TENANT)
    own = (
        results.select("query_id", "memory_id", *TENANT)
        .join(owners, ["memory_id", *TENANT])
        .select("query_id", *TENANT)
        .distinct()
    )
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), *TENANT)
    return asked.join(memories.select(*TENANT).distinct(), list(TENANT), "left_semi").join(
        own, ["query_id", *TENANT], "left_anti"
    )


def isolation_report(results: DataFrame, queries: DataFrame, memories: DataFrame) -> DataFrame:
    """One row per tenant that asked: queries, leaks and self-misses, apart."""
    asked = queries.groupBy(*TENANT).agg(F.count(F.lit(1)).alias("queries"))
    leaked = (
        leaks(results, queries, memories)
        .groupBy(F.col("asked_app").alias("app_name"), F.col("asked_user").alias("user_id"))
        .agg(F.count(F.lit(1)).alias("leaks"))
    )
    missed = self_misses(results, queries, memories).groupBy(*TENANT).agg(
        F.count(F.lit(1)).alias("self_misses")
    )
    zero = F.lit(0).cast("bigint")
    return (
        asked.join(leaked, list(TENANT), "left")
        .join(missed, list(TENANT), "left")
        .select(
            *TENANT,
            "queries",
            F.coalesce("leaks", zero).alias("leaks"),
            F.coalesce("self_misses", zero).alias("self_misses"),
        )
    )


def duplicate_sessions(memories: DataFrame) -> DataFrame:
    """Session keys with more than one memory. Direct memories have no session and are
    meant to be many."""
    return (
        memories.filter(F.col("session_id").isNotNull())
        .groupBy(*SESSION_KEY)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def coverage(memories: DataFrame, config: MemoryConfig) -> DataFrame:
    """Per application: rows a search can reach, and why the others cannot be."""
    no_vector = F.col("embedding").isNull()
    wrong = ~no_vector & ~embedding_ok("embedding", config.dimensions)
    no_tenant = F.col("app_name").isNull() | F.col("user_id").isNull()
    no_text = F.coalesce(F.col("transcript"), F.lit("")) == ""
    return memories.groupBy("app_name").agg(
        F.count(F.lit(1)).alias("memories"),
        F.count_if(~no_vector & ~wrong & ~no_tenant & ~no_text).alias("searchable"),
        F.count_if(no_vector).alias("no_vector"),
        F.count_if(wrong).alias("wrong_length"),
        F.count_if(no_tenant).alias("no_tenant"),
        F.count_if(no_text).alias("no_text"),
    )


def freshness(results: DataFrame, queries: DataFrame, min_results: int = 1) -> DataFrame:
    """Whether each query already gets ``min_results`` hits."""
    keys = [*TENANT, "query_id"]
    counts = results.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits"))
    asked = queries.select(F.col("query_id").cast("string").alias("query_id"), *TENANT)
    hits = F.coalesce("hits", F.lit(0).cast("bigint"))
    return asked.join(counts, keys, "left").select(
        "query_id", *TENANT, hits.alias("hits"), (hits >= min_results).alias("ready")
    )
