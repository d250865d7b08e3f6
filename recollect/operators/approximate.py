"""Approximate search: a candidate budget by signature, then exact scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import TENANT, MemoryConfig
from recollect.functions import vectors as vx
from recollect.functions.signatures import DEFAULT_BITS, signature
from recollect.operators.nearest import nearest


def with_signature(df: DataFrame, config: MemoryConfig) -> DataFrame:
    """Adds the signature column unless the rows already carry one."""
    if "signature" in df.columns:
        return df
    bits = config.signature_bits or DEFAULT_BITS
    return df.withColumn("signature", signature(F.col("embedding"), config.dimensions, bits))


def candidates(queries: DataFrame, memories: DataFrame, config: MemoryConfig) -> DataFrame:
    """The ``num_candidates`` memories with the fewest differing bits per query.

    Only ids and signatures are read: 32 bytes per memory instead of a whole vector.
    """
    return nearest(
        with_signature(queries, config),
        with_signature(memories, config),
        config.num_candidates,
        "hamming",
        (config.signature_bits or DEFAULT_BITS) // 64,
        vector="signature",
    )


def approximate_top_k(
    queries: DataFrame, memories: DataFrame, config: MemoryConfig, small: bool
) -> DataFrame:
    """Exact similarity on the candidates only, then the best ``search_limit``. With
    ``small`` the candidates are known to be few enough to broadcast."""
    chosen = candidates(queries, memories, config).select(*TENANT, "query_id", "memory_id")
    if small:
        chosen = F.broadcast(chosen)
    asked = queries.select(*TENANT, F.col("query_id").cast("string"), F.col("embedding").alias("_q"))
    sim = vx.similarity_in_batches(config.similarity)("embedding", "_q")
    scored = (
        memories.select(*TENANT, F.col("memory_id").cast("string").alias("memory_id"), "embedding")
        .join(chosen, [*TENANT, "memory_id"])
        .join(asked, [*TENANT, "query_id"])
        .select(*TENANT, "query_id", "memory_id", sim.alias("similarity"))
    )
    w = Window.partitionBy(*TENANT, "query_id").orderBy(F.desc("similarity"), "memory_id")
    ranked = scored.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col("rank") <= config.search_limit)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of each query's exact hits that the approximate search also found."""
    keys = [*TENANT, "query_id"]
    found = approximate.select(*keys, "memory_id", F.lit(1.0).alias("_found"))
    return (
        exact.select(*keys, "memory_id")
        .join(found, [*keys, "memory_id"], "left")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("exact_hits"),
            F.avg(F.coalesce("_found", F.lit(0.0))).alias("recall"),
        )
    )
