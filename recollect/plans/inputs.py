"""How the given tables stand in for sessions, memories and queries, in Spark and in SQL."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect import MemoryConfig, MemoryTable, hashing_embedder
from recollect.config import TENANT
from recollect.functions import crypto
from recollect.functions.maps import STRING_MAP
from recollect.operators.ingest import MEMORY_COLUMNS
from recollect.session import scratch_path
from recollect.sources.events import events_from_messages, one_part

DIMS = 64
CONFIG = MemoryConfig(embedder=hashing_embedder(DIMS), dimensions=DIMS)
FIRST, SECOND = "2024-02-01 00:00:00", "2024-02-02 12:30:00.250000"


def at(ts: str) -> Column:
    return F.lit(ts).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_table(spark: SparkSession, name: str) -> MemoryTable:
    return MemoryTable.create(spark, scratch_path(spark, name), buckets=4, slices=2)


def text_of(c: Column) -> Column:
    return c.cast("string")


def events_of(conversations: DataFrame) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    return events_from_messages(
        conversations,
        app_name=F.concat(F.lit("app"), text_of(conv % 3)),
        user_id=F.concat(F.lit("u"), text_of(conv % 20)),
        session_id=text_of(conv),
        seq=turn,
        author=F.col("role"),
        text=F.col("text"),
        event_id=F.concat_ws("-", text_of(conv), text_of(turn)),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "conversations"))


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a user is asked again, in the user's own tenant."""
    asked = events(spark, sf_dir).filter("author = 'user'")
    return asked.select(
        F.col("event_id").alias("query_id"),
        *TENANT,
        F.col("parts")[0]["text"].alias("query"),
    )


def vector_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memories with given vectors; the text is the document of the same number."""
    vectors, docs = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    null = F.lit(None)
    updated = at("2024-01-01") + F.make_dt_interval(hours=F.col("vec_id"))
    rows = vectors.join(docs, vectors.vec_id == docs.doc_id, "left").select(
        text_of(F.col("vec_id")).alias("memory_id"),
        F.concat(F.lit("app"), text_of(F.col("vec_id") % 2)).alias("app_name"),
        text_of(F.col("label")).alias("user_id"),
        null.cast("string").alias("session_id"),
        F.col("text").alias("transcript"),
        "embedding",
        null.cast("array<bigint>").alias("signature"),
        null.cast("array<string>").alias("event_ids"),
        F.lit("memory").alias("author"),
        F.lit("add_memory").alias("source"),
        F.when(
            F.col("source").isNotNull(),
            F.create_map(F.lit("lang"), "lang", F.lit("source"), "source"),
        ).cast(STRING_MAP).alias("custom_metadata"),
        null.cast("map<string,binary>").alias("secure_metadata"),
        updated.alias("created_at"),
        updated.alias("updated_at"),
    )
    return rows.select(*MEMORY_COLUMNS)


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored vector asks for its neighbours in its own tenant."""
    return table(spark, sf_dir, "embeddings").select(
        text_of(F.col("vec_id")).alias("query_id"),
        F.concat(F.lit("app"), text_of(F.col("vec_id") % 2)).alias("app_name"),
        text_of(F.col("label")).alias("user_id"),
        "embedding",
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ready-made memories with metadata."""
    return table(spark, sf_dir, "documents").select(
        text_of(F.col("doc_id")).alias("entry_id"),
        F.concat(F.lit("app"), text_of(F.col("doc_id") % 3)).alias("app_name"),
        F.concat(F.lit("u"), text_of(F.col("doc_id") % 20)).alias("user_id"),
        F.lit(None).cast("string").alias("author"),
        one_part("text").alias("parts"),
        F.create_map(F.lit("lang"), "lang", F.lit("source"), "source").alias("custom_metadata"),
    )


def customer_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document memories that carry, where there is one, a customer's name and segment as side fields."""
    docs, people = table(spark, sf_dir, "documents"), table(spark, sf_dir, "customer")
    return docs.join(people, docs.doc_id == people.c_custkey, "left").select(
        text_of(F.col("doc_id")).alias("memory_id"),
        F.concat(F.lit("app"), text_of(F.col("doc_id") % 3)).alias("app_name"),
        F.concat(F.lit("u"), text_of(F.col("doc_id") % 20)).alias("user_id"),
        F.col("text").alias("transcript"),
        F.create_map(
            F.lit("lang"), "lang", F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment"
        ).alias("custom_metadata"),
        F.lit(None).cast("map<string,binary>").alias("secure_metadata"),
    )


def session_key(spark: SparkSession) -> bytes:
    """The key from the session's configuration. A session without one gets a random
    key of its own, so that no key is ever written down here."""
    if not spark.conf.get(crypto.KEY_CONF, None):
        spark.conf.set(crypto.KEY_CONF, os.urandom(32).hex())
    return crypto.key_from_conf(spark)


# ---- the same in SQL ---------------------------------------------------------

EVENTS_SQL = """ev AS (
  SELECT 'app' || (conv_id % 3) AS app_name, 'u' || (conv_id % 20) AS user_id,
         CAST(conv_id AS VARCHAR) AS session_id, turn AS seq,
         conv_id || '-' || turn AS event_id, role AS author, text
  FROM conversations)"""


def memory_id_sql(session: str = "session_id") -> str:
    parts = [f"length({c}) || ':' || {c}" for c in ("app_name", "user_id", session)]
    return f"sha256({' || '.join(parts)})"


def transcripts_sql(name: str = "tr", source: str = "ev", where: str = "true") -> str:
    return f"""{name} AS (
  SELECT app_name, user_id, session_id, {memory_id_sql()} AS memory_id,
         string_agg(author || ': ' || text, chr(10) ORDER BY seq) AS transcript,
         string_agg(event_id, ',' ORDER BY seq) AS event_ids,
         count(*) AS turns, max(seq) AS last_seq
  FROM {source} WHERE {where} GROUP BY ALL)""".replace(
        "GROUP BY ALL", "GROUP BY app_name, user_id, session_id"
    )


def hash_vectors_sql(name: str, source: str, row_id: str, text: str, dims: int = DIMS) -> str:
    """CTEs ending in ``name(id, v)``: the hashing embedder's vector of every row."""
    return f"""{name}_words AS (
  SELECT {row_id} AS id,
         unnest(string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')) AS w
  FROM {source}),
{name}_counts AS (
  SELECT id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dims} AS d, count(*) AS n
  FROM {name}_words WHERE w <> '' GROUP BY 1, 2),
{name}_size AS (SELECT id, sqrt(sum(n * n)) AS size FROM {name}_counts GROUP BY 1),
{name} AS (
  SELECT s.id, list(CAST(coalesce(c.n / s.size, 0) AS FLOAT) ORDER BY r.d) AS v
  FROM {name}_size s CROSS JOIN (SELECT unnest(range({dims})) AS d) r
  LEFT JOIN {name}_counts c ON c.id = s.id AND c.d = r.d GROUP BY s.id)"""


VECTORS_SQL = """vm AS (
  SELECT CAST(vec_id AS VARCHAR) AS memory_id, 'app' || (vec_id % 2) AS app_name,
         CAST(label AS VARCHAR) AS user_id, CAST(embedding AS DOUBLE[]) AS v,
         d.text AS transcript, d.lang, d.source AS doc_source,
         TIMESTAMP '2024-01-01' + to_hours(vec_id) AS updated_at
  FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)"""

SIMILARITY_SQL = {
    "cosine": "round(list_cosine_similarity({a}, {b}), 9)",
    "dotProduct": "round(list_inner_product({a}, {b}), 9)",
    "euclidean": "round(-list_distance({a}, {b}), 9)",
}


def top_k_sql(
    name: str, queries: str, memories: str, metric: str = "cosine", k: int = 5, tenant: str = ""
) -> str:
    """CTE ``name(query_id, memory_id, sim, rnk)`` over ``(id, tenant, v)`` relations."""
    tenant = tenant or "q.app_name = m.app_name AND q.user_id = m.user_id"
    sim = SIMILARITY_SQL[metric].format(a="q.v", b="m.v")
    return f"""{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, memory_id) AS rnk
    FROM (SELECT q.query_id, m.memory_id, {sim} AS sim
          FROM {queries} q JOIN {memories} m ON {tenant}) p) t
  WHERE rnk <= {k})"""
