"""Registered queries on retention, isolation and quality."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from recollect.config import TENANT
from recollect.functions.text import iso_timestamp
from recollect.operators import audit
from recollect.operators.ingest import ingest_sessions
from recollect.operators.nearest import nearest
from recollect.operators.retention import live, retention_report
from recollect.operators.search import search
from recollect.plans import inputs as i
from recollect.plans.memory import brief
from recollect.plans.search import HITS_SQL, VQ_SQL

TTL = 43_200

_UPDATED = "TIMESTAMP '2024-01-01' + to_hours(CAST(session_id AS BIGINT)) + to_minutes(last_seq)"


def dated_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session memories dated by session number and number of turns."""
    config = replace(i.CONFIG, signature_bits=None)
    rows = ingest_sessions(i.events(spark, sf_dir), config, i.at(i.FIRST))
    dated = i.at("2024-01-01") + F.make_dt_interval(
        hours=F.col("session_id").cast("int"), mins=F.size("event_ids") - 1
    )
    return rows.withColumn("updated_at", dated)


def _hour_after_last(spark: SparkSession, sf_dir: str):
    """The moment of the purge, as a subquery over the dates alone."""
    last = dated_memories(spark, sf_dir).agg(F.max("updated_at").alias("t")).scalar()
    return last + F.make_dt_interval(hours=F.lit(1))


DATED_SQL = f"""{i.EVENTS_SQL}, {i.transcripts_sql()}, dm AS (SELECT *, {_UPDATED} AS updated_at FROM tr),
nw AS (SELECT max(updated_at) + to_hours(1) AS now FROM dm)"""


def r1_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = live(dated_memories(spark, sf_dir), TTL, _hour_after_last(spark, sf_dir))
    return left.select("session_id", iso_timestamp(F.col("updated_at")).alias("updated_at"))


R1 = f"""WITH {DATED_SQL}
SELECT session_id, strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00') AS updated_at FROM dm, nw
WHERE updated_at + to_seconds({TTL}) > now"""


def r1_purge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purge of a table: the first two applications' sessions have expired."""
    table = i.new_table(spark, "purge")
    ev = i.events(spark, sf_dir)
    table.add_sessions(ev.filter("app_name <> 'app2'"), i.CONFIG, i.at(i.FIRST))
    table.add_sessions(ev.filter("app_name = 'app2'"), i.CONFIG, i.at(i.SECOND))
    table.purge(None, i.at("2024-02-03"))
    table.purge(86_400, i.at("2024-02-03"))
    return brief(table.read()).select("session_id", "updated_at", "text_md5")


R1T = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()}
SELECT session_id, '2024-02-02T12:30:00.250000+00:00' AS updated_at, md5(transcript) AS text_md5
FROM tr WHERE app_name = 'app2'"""


def r2_retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = retention_report(
        dated_memories(spark, sf_dir), TTL, _hour_after_last(spark, sf_dir)
    )
    return report.withColumn("next_expiry", iso_timestamp(F.col("next_expiry")))


R2 = f"""WITH {DATED_SQL}
SELECT app_name, user_id, count(*) FILTER (updated_at + to_seconds({TTL}) > now) AS live,
  count(*) FILTER (updated_at + to_seconds({TTL}) <= now) AS expired,
  strftime(min(updated_at + to_seconds({TTL})) FILTER (updated_at + to_seconds({TTL}) > now), '%Y-%m-%dT%H:%M:%S+00:00') AS next_expiry
FROM dm, nw GROUP BY 1, 2"""


def _pooled(df: DataFrame) -> DataFrame:
    """The mistake an audit must find: all applications of a user searched as one."""
    return df.withColumn("app_name", F.lit("pooled"))


def r3_isolation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of a search that forgot the application: leaks and misses per tenant."""
    queries, memories = i.vector_queries(spark, sf_dir), i.vector_memories(spark, sf_dir)
    leaky = nearest(_pooled(queries), _pooled(memories), 2, "cosine", i.DIMS).filter("rank = 2")
    leaky = leaky.drop("app_name").join(queries.select("query_id", *TENANT), ["query_id", "user_id"])
    return audit.isolation_report(leaky, queries, memories)


R3 = f"""WITH {VQ_SQL},
{i.top_k_sql("hits", "vq", "vm", k=2, tenant="q.user_id = m.user_id")},
rs AS (SELECT h.query_id, q.app_name, q.user_id, m.app_name <> q.app_name AS leak
       FROM hits h JOIN vq q USING (query_id) JOIN vm m ON m.memory_id = h.memory_id WHERE rnk = 2)
SELECT app_name, user_id, count(*) AS queries, count(*) FILTER (leak) AS leaks,
       count(*) FILTER (leak) AS self_misses FROM rs GROUP BY 1, 2"""


def r3_isolated_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report on the library's own search: no leaks; misses only for lack of text."""
    queries, memories = i.vector_queries(spark, sf_dir), i.vector_memories(spark, sf_dir)
    return audit.isolation_report(search(queries, memories, i.CONFIG), queries, memories)


R3S = f"""WITH {HITS_SQL},
ok AS (SELECT DISTINCT query_id FROM hits JOIN vm USING (memory_id) WHERE transcript <> '')
SELECT app_name, user_id, count(*) AS queries, CAST(0 AS BIGINT) AS leaks,
       count(*) FILTER (ok.query_id IS NULL) AS self_misses
FROM vq LEFT JOIN ok USING (query_id) GROUP BY 1, 2"""


def r4_duplicate_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingests appended instead of upserted, the second for longer sessions only."""
    ev = i.events(spark, sf_dir)
    first = ingest_sessions(ev, i.CONFIG, i.at(i.FIRST))
    second = ingest_sessions(ev.filter("seq >= 4"), i.CONFIG, i.at(i.SECOND))
    direct = i.vector_memories(spark, sf_dir)
    return audit.duplicate_sessions(first.unionByName(second).unionByName(direct))


R4 = f"""WITH {i.EVENTS_SQL}
SELECT app_name, user_id, session_id, CAST(2 AS BIGINT) AS copies FROM ev WHERE seq >= 4 GROUP BY 1, 2, 3"""


def r5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows lose their vector, half of it, their user, or (Spanish ones) their text."""
    v, n = F.col("embedding"), F.col("user_id")
    lang = F.col("custom_metadata")["lang"]
    broken = i.vector_memories(spark, sf_dir).withColumns(
        {
            "embedding": F.when(n == "1", None).when(n == "2", F.slice(v, 1, 32)).otherwise(v),
            "user_id": F.when(n != "3", n),
            "transcript": F.when(lang == "es", F.lit("")).otherwise(F.col("transcript")),
        }
    )
    return audit.coverage(broken, i.CONFIG)


R5 = f"""WITH {i.VECTORS_SQL}, b AS (
  SELECT app_name, user_id = '1' AS nv, user_id = '2' AS wl, user_id = '3' AS nt,
         transcript IS NULL OR lang = 'es' AS nx FROM vm)
SELECT app_name, count(*) AS memories, count(*) FILTER (NOT nv AND NOT wl AND NOT nt AND NOT nx) AS searchable,
  count(*) FILTER (nv) AS no_vector, count(*) FILTER (wl) AS wrong_length,
  count(*) FILTER (nt) AS no_tenant, count(*) FILTER (nx) AS no_text FROM b GROUP BY 1"""


def r6_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which queries already get four texts: hits of German memories have none yet."""
    queries = i.vector_queries(spark, sf_dir)
    memories = i.vector_memories(spark, sf_dir).withColumn(
        "transcript",
        F.when(F.col("custom_metadata")["lang"] != "de", F.col("transcript")),
    )
    return audit.freshness(search(queries, memories, i.CONFIG), queries, min_results=4)


R6 = f"""WITH {HITS_SQL}, c AS (
  SELECT query_id, count(*) AS n FROM hits JOIN vm USING (memory_id)
  WHERE transcript <> '' AND lang <> 'de' GROUP BY 1)
SELECT query_id, app_name, user_id, coalesce(n, 0) AS hits, coalesce(n, 0) >= 4 AS ready
FROM vq LEFT JOIN c USING (query_id)"""


QUERIES = {
    "r1_purge": (r1_purge, R1),
    "r1_purge_table": (r1_purge_table, R1T),
    "r2_retention_report": (r2_retention_report, R2),
    "r3_isolation_report": (r3_isolation_report, R3),
    "r3_isolated_search": (r3_isolated_search, R3S),
    "r4_duplicate_sessions": (r4_duplicate_sessions, R4),
    "r5_coverage": (r5_coverage, R5),
    "r6_freshness": (r6_freshness, R6),
}
