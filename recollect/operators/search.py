"""Answering tables of queries from the tenant's own memories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import QUERY_INPUT, TENANT, MemoryConfig, Now
from recollect.functions import text as tx
from recollect.functions import vectors as vx
from recollect.functions.maps import STRING_MAP, empty_map, merge_maps
from recollect.functions.typed import is_typed, result_values
from recollect.operators import embedding as em
from recollect.operators.approximate import approximate_top_k
from recollect.operators.nearest import nearest
from recollect.operators.retention import live
from recollect.sources.layout import BUCKET, tenant_bucket_like

#: Up to this many hits (query rows times k) are broadcast to pick up their text.
BROADCAST_HITS = 200_000
#: Fixed value: the role every recalled memory is given.
RECALLED_ROLE = "model"


def prepare_queries(queries: DataFrame, config: MemoryConfig) -> DataFrame:
    """Drops blank queries and embeds the others, unless they bring an ``embedding``."""
    asked = queries
    if "query" in queries.columns:  # a plain comparison also lets Spark prune by these rows
        asked = queries.filter(tx.strip(F.col("query")) != "")
    if "embedding" in queries.columns:
        return asked
    return em.embed(asked, config, "query", QUERY_INPUT)


def shape_results(hits: DataFrame, config: MemoryConfig) -> DataFrame:
    """Result rows: tenant, query, text, role, author, ISO time, score and the metadata map.

    The map starts with session, source and score; stored metadata of the same name
    replaces them there, but never the ``score`` column. Hits without text are left
    out here, after the limit, so a query may get fewer rows than it asked for. Where the
    stored metadata are variants, the map's values are too, and its score is a number.
    """
    score = vx.bounded_score(config.similarity, F.col("similarity"))
    typed = is_typed(hits, "custom_metadata")
    own = F.create_map(
        F.lit("session_id"),
        F.col("session_id"),
        F.lit("source"),
        F.col("source"),
        F.lit("score"),
        score.cast("string"),
    ).cast(STRING_MAP)
    return hits.filter(F.coalesce(F.col("transcript"), F.lit("")) != "").select(
        *TENANT,
        F.col("query_id").cast("string").alias("query_id"),
        "rank",
        "memory_id",
        F.col("transcript").alias("text"),
        F.lit(RECALLED_ROLE).alias("role"),
        tx.default_if_empty(F.col("author"), config.memory_author).alias("author"),
        tx.iso_timestamp(F.col("updated_at")).alias("timestamp"),
        score.alias("score"),
        (
            result_values(F.col("session_id"), F.col("source"), score, F.col("custom_metadata"))
            if typed
            else merge_maps(own, F.coalesce("custom_metadata", empty_map()))
        ).alias("custom_metadata"),
    )


def few_hits(queries: DataFrame, k: int) -> bool:
    """Whether k hits for every query are few enough to broadcast; counts the queries."""
    return queries.count() * k <= BROADCAST_HITS


def asked_tenants_only(memories: DataFrame, queries: DataFrame, small: bool) -> DataFrame:
    """Memories of tenants that ask something. A table laid out by tenant bucket is
    pruned by the bucket as well, before anything is read."""
    keys = list(TENANT)
    if BUCKET in memories.columns:
        queries = queries.withColumn(BUCKET, tenant_bucket_like(memories))
        keys.insert(0, BUCKET)
    tenants = queries.select(*keys).distinct()
    return memories.join(F.broadcast(tenants) if small else tenants, keys, "left_semi")


def with_memories(hits: DataFrame, memories: DataFrame, small: bool) -> DataFrame:
    """Adds the memories' own columns (but no vectors) to the hits. The hits carry the
    tenant's bucket into a table laid out by it, so that texts of other buckets are not read."""
    columns = [c for c in memories.columns if c not in ("embedding", "signature", BUCKET, "slice")]
    ranked, keys = hits.select(*TENANT, "query_id", "memory_id", "similarity", "rank"), [*TENANT, "memory_id"]
    if BUCKET in memories.columns:
        ranked = ranked.withColumn(BUCKET, tenant_bucket_like(memories))
        keys.insert(0, BUCKET)
        columns.append(BUCKET)
    return memories.select(*columns).join(F.broadcast(ranked) if small else ranked, keys).drop(BUCKET)


def budget(config: MemoryConfig, mode: str) -> int:
    """Rows kept per query on the way: the limit, or the candidates of an approximate search."""
    return config.search_limit if mode == "exact" else config.num_candidates


def top_k(
    queries: DataFrame,
    memories: DataFrame,
    config: MemoryConfig,
    mode: str = "exact",
    small: bool | None = None,
) -> DataFrame:
    """Tenant, ``query_id``, ``memory_id``, ``similarity`` and ``rank`` for prepared queries.

    ``small`` is the answer of :func:`few_hits`, where the caller has it already.
    """
    small = few_hits(queries, budget(config, mode)) if small is None else small
    memories = asked_tenants_only(memories, queries, small)
    if mode == "exact":
        return nearest(queries, memories, config.search_limit, config.similarity, config.dimensions)
    if mode == "approximate":
        return approximate_top_k(queries, memories, config, small)
    raise ValueError(f"unknown search mode {mode!r}")


def search(
    queries: DataFrame,
    memories: DataFrame,
    config: MemoryConfig,
    mode: str = "exact",
    now: Now | None = None,
) -> DataFrame:
    """All queries at once: the best memories of each query's own tenant, in order.

    Expired but not yet purged memories are found, unless ``now`` is given.
    """
    asked = prepare_queries(queries, config)
    allowed = memories if now is None else live(memories, config.ttl_seconds, now)
    small = few_hits(queries, budget(config, mode))
    hits = top_k(asked, allowed, config, mode, small)
    return shape_results(with_memories(hits, allowed, small), config)


def search_memory(
    memories: DataFrame, config: MemoryConfig, app_name: str, user_id: str, query: str
) -> DataFrame:
    """One query of one tenant. The tenant filter reaches the scan and the best rows are
    taken by Spark's own top-k, so nothing is shuffled but k rows per task."""
    spark = memories.sparkSession
    own = memories.filter((F.col("app_name") == app_name) & (F.col("user_id") == user_id))
    if BUCKET in memories.columns:
        own = own.filter(
            F.col(BUCKET) == tenant_bucket_like(memories, F.lit(app_name), F.lit(user_id))
        )
    asked = spark.range(1).select(F.lit("0").alias("query_id"), F.lit(query).alias("query"))
    good = em.embedding_ok("embedding", config.dimensions)
    # one vector, taken here: an embedder in Python does not run in a subquery of a filter
    vector = prepare_queries(asked, config).filter(good).select("embedding").first()
    numbers = [] if vector is None else [float(x) for x in vector[0]]
    best = (
        own.filter(good if numbers else F.lit(False))
        .withColumn("_q", F.array(*map(F.lit, numbers)).cast("array<float>"))
        .withColumn("similarity", vx.similarity_in_batches(config.similarity)("embedding", "_q"))
        .orderBy(F.desc("similarity"), "memory_id")
        .limit(config.search_limit)
    )
    w = Window.orderBy(F.desc("similarity"), "memory_id")
    ranked = best.withColumn("rank", F.row_number().over(w).cast("bigint"))
    return shape_results(ranked.withColumn("query_id", F.lit("0")), config)
