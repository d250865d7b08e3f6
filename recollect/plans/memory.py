"""Registered queries on the memory table and the jobs that write it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.config import SESSION_KEY, SOURCE_EVENTS, SOURCE_SESSION, TENANT
from recollect.functions import typed
from recollect.functions.maps import literal_map, merge_maps
from recollect.functions.text import iso_timestamp
from recollect.operators.distill import keep_user_lines
from recollect.operators.ingest import (
    apply_delta,
    ingest_sessions,
    insert_memories,
    new_segments,
    session_updates,
    upsert,
)
from recollect.operators.transcript import segments
from recollect.plans import inputs as i
from recollect.plans.transcript import DISTILLED_SQL
from recollect.sources.events import read_events
from recollect.sources.scratch import stored
from recollect.session import scratch_path

KEYS = list(SESSION_KEY)
EV_TR = f"WITH {i.EVENTS_SQL}, {i.transcripts_sql()}"
FIRST_ISO, SECOND_ISO = "2024-02-01T00:00:00+00:00", "2024-02-02T12:30:00.250000+00:00"


def brief(memories: DataFrame) -> DataFrame:
    """Every stored field of a session memory, flat."""
    return memories.select(
        "memory_id",
        *KEYS,
        F.md5("transcript").alias("text_md5"),
        F.length("transcript").cast("bigint").alias("chars"),
        F.array_join("event_ids", ",").alias("event_ids"),
        F.size("embedding").cast("bigint").alias("dims"),
        "author",
        "source",
        iso_timestamp(F.col("created_at")).alias("created_at"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
    )


def brief_sql(source: str, rest: str, text: str = "transcript", ids: str = "event_ids") -> str:
    return f"""memory_id, app_name, user_id, session_id, md5({text}) AS text_md5,
  length({text}) AS chars, {ids} AS event_ids, CAST({i.DIMS} AS BIGINT) AS dims,
  'memory' AS author, {source} AS source, {rest}"""


def _seeded(spark: SparkSession, sf_dir: str, name: str):
    """A table holding every session."""
    table = i.new_table(spark, name)
    table.add_sessions(i.events(spark, sf_dir), i.CONFIG, i.at(i.FIRST))
    return table


def _seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memories of the first four turns of every session."""
    return ingest_sessions(i.events(spark, sf_dir).filter("seq < 4"), i.CONFIG, i.at(i.FIRST))


# ---- sources and sinks -------------------------------------------------------


def s1_read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events")
    i.events(spark, sf_dir).write.parquet(path)
    return read_events(spark, path).select(
        *KEYS, "seq", "event_id", "author", F.md5(F.col("parts")[0]["text"]).alias("text_md5")
    )


S1 = f"""WITH {i.EVENTS_SQL}
SELECT app_name, user_id, session_id, seq, event_id, author, md5(text) AS text_md5 FROM ev"""


def s2_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = i.new_table(spark, "scan")
    table.add_sessions(i.events(spark, sf_dir), i.CONFIG, i.at(i.FIRST))
    return brief(table.read())


BOTH_FIRST = f"'{FIRST_ISO}' AS created_at, '{FIRST_ISO}' AS updated_at"
S2 = f"{EV_TR} SELECT {brief_sql(repr(SOURCE_SESSION), BOTH_FIRST)} FROM tr"


def s3_lookup_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn asks for its session's memory; openings ask for a session that is not there."""
    stored = session_updates(i.events(spark, sf_dir), i.CONFIG)
    asked = i.events(spark, sf_dir).select(
        *TENANT,
        F.when(F.col("seq") == 0, F.lit("none")).otherwise(F.col("session_id")).alias("session_id"),
        "event_id",
    )
    return asked.join(stored.select(*KEYS, "memory_id", "transcript"), KEYS, "left").select(
        "event_id", "memory_id", F.coalesce(F.length("transcript"), F.lit(0)).cast("bigint").alias("chars")
    )


S3 = f"""{EV_TR}
SELECT ev.event_id, tr.memory_id, coalesce(length(tr.transcript), 0) AS chars
FROM ev LEFT JOIN tr ON ev.app_name = tr.app_name AND ev.user_id = tr.user_id
 AND tr.session_id = CASE WHEN ev.seq = 0 THEN 'none' ELSE ev.session_id END"""


def s4_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session memories, then direct ones on top."""
    table = _seeded(spark, sf_dir, "append")
    rows = insert_memories(
        i.entries(spark, sf_dir), i.CONFIG, i.at(i.SECOND), entry_id=F.col("entry_id")
    )
    table.add_memories(rows)
    return table.read().groupBy(*TENANT, "source").agg(
        F.count(F.lit(1)).alias("memories"),
        F.count("session_id").alias("with_session"),
        F.sum(F.length("transcript")).alias("chars"),
    )


STRIPPED = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
S4 = f"""{EV_TR}, al AS (
  SELECT app_name, user_id, 'add_session_to_memory' AS source, session_id, transcript FROM tr
  UNION ALL
  SELECT 'app' || (doc_id % 3), 'u' || (doc_id % 20), 'add_memory', NULL, {STRIPPED} FROM documents)
SELECT app_name, user_id, source, count(*) AS memories, count(session_id) AS with_session,
       CAST(sum(length(transcript)) AS BIGINT) AS chars FROM al GROUP BY 1, 2, 3"""


def s5_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions seen again are replaced, new ones inserted, the others stay."""
    table = i.new_table(spark, "upsert")
    ev = i.events(spark, sf_dir)
    table.add_sessions(ev.filter("app_name <> 'app0' and seq < 4"), i.CONFIG, i.at(i.FIRST))
    table.add_sessions(ev.filter("app_name <> 'app1'"), i.CONFIG, i.at(i.SECOND))
    return brief(table.read())


S5 = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()}, {i.transcripts_sql("t4", where="seq < 4")},
al AS (SELECT * FROM tr WHERE app_name <> 'app1' UNION ALL SELECT * FROM t4 WHERE app_name = 'app1')
SELECT {brief_sql(repr(SOURCE_SESSION), f'''
  CASE WHEN app_name = 'app0' THEN '{SECOND_ISO}' ELSE '{FIRST_ISO}' END AS created_at,
  CASE WHEN app_name = 'app1' THEN '{FIRST_ISO}' ELSE '{SECOND_ISO}' END AS updated_at''')} FROM al"""


def s6_delete_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _seeded(spark, sf_dir, "delete")
    table.delete_tenant("app0", "u0")
    return table.read().groupBy(*TENANT).agg(F.count(F.lit(1)).alias("memories"))


S6 = f"""{EV_TR} SELECT app_name, user_id, count(*) AS memories FROM tr
WHERE NOT (app_name = 'app0' AND user_id = 'u0') GROUP BY 1, 2"""


def s7_interop_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = _seeded(spark, sf_dir, "interop").interop("text", "vector")
    return renamed.select(
        "session_id", F.md5("text").alias("text_md5"), F.size("vector").cast("bigint").alias("dims")
    )


S7 = f"""{EV_TR}
SELECT session_id, md5(transcript) AS text_md5, CAST({i.DIMS} AS BIGINT) AS dims FROM tr"""


# ---- write dataflows ---------------------------------------------------------


def w1_ingest_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = replace(i.CONFIG, distiller=keep_user_lines)
    return brief(ingest_sessions(i.events(spark, sf_dir), config, i.at(i.FIRST)))


W1 = f"""WITH {DISTILLED_SQL}
SELECT {brief_sql(repr(SOURCE_SESSION), BOTH_FIRST, "ds.stored_text", "tr.event_ids")}
FROM ds JOIN tr USING (app_name, user_id, session_id)"""


def w2_apply_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four turns are stored; a delta from the third on arrives, two turns of it known."""
    delta = i.events(spark, sf_dir).filter("seq >= 2")
    return brief(apply_delta(delta, i.CONFIG, i.at(i.SECOND), _seed(spark, sf_dir)))


W2 = f"""{EV_TR} SELECT {brief_sql(
    f"CASE WHEN last_seq >= 4 THEN '{SOURCE_EVENTS}' ELSE '{SOURCE_SESSION}' END",
    f"'{FIRST_ISO}' AS created_at, CASE WHEN last_seq >= 4 THEN '{SECOND_ISO}' ELSE '{FIRST_ISO}' END AS updated_at",
)} FROM tr"""


def w2_distilled_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the new text is distilled; what was stored raw stays raw."""
    config = replace(i.CONFIG, distiller=keep_user_lines)
    after = apply_delta(i.events(spark, sf_dir), config, i.at(i.SECOND), _seed(spark, sf_dir))
    return after.select("session_id", F.md5("transcript").alias("text_md5"))


W2D = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql("t4", where="seq < 4")},
{i.transcripts_sql("dl", where="seq >= 4")}, d AS (
  SELECT memory_id, transcript AS raw,
         array_to_string(list_filter(string_split(transcript, chr(10)),
                                     lambda x: starts_with(lower(x), 'user:')), chr(10)) AS usr FROM dl)
SELECT session_id, md5(CASE WHEN d.raw IS NULL THEN t4.transcript
  ELSE t4.transcript || chr(10) || substr(CASE WHEN usr <> '' THEN usr ELSE raw END, 1, 2000) END) AS text_md5
FROM t4 LEFT JOIN d USING (memory_id)"""


def w3_insert_memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = insert_memories(
        i.entries(spark, sf_dir),
        replace(i.CONFIG, distiller=keep_user_lines),
        i.at(i.SECOND),
        {"batch": "7"},
        F.col("entry_id"),
    )
    return rows.select(
        "memory_id",
        *KEYS,
        F.md5("transcript").alias("text_md5"),
        F.col("event_ids").isNull().alias("no_event_ids"),
        "author",
        "source",
        F.col("custom_metadata")["lang"].alias("lang"),
        F.col("custom_metadata")["batch"].alias("batch"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
    )


W3 = f"""SELECT sha256('10:add_memory' || length(doc_id::VARCHAR) || ':' || doc_id) AS memory_id, 'app' || (doc_id % 3) AS app_name,
  'u' || (doc_id % 20) AS user_id, CAST(NULL AS VARCHAR) AS session_id, md5({STRIPPED}) AS text_md5,
  true AS no_event_ids, 'memory' AS author, 'add_memory' AS source, lang, '7' AS batch,
  '{SECOND_ISO}' AS updated_at FROM documents"""


def w4_merge_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call's value wins where entry and call name the same key."""
    merged = merge_maps(F.col("custom_metadata"), literal_map({"source": "import", "batch": "7"}))
    return (
        i.entries(spark, sf_dir)
        .withColumn("md", merged)
        .select("entry_id", *[F.col("md")[k].alias(k) for k in ("lang", "source", "batch")],
                F.size("md").cast("bigint").alias("keys"))
    )


W4 = """SELECT CAST(doc_id AS VARCHAR) AS entry_id, lang, 'import' AS source, '7' AS batch,
CAST(3 AS BIGINT) AS keys FROM documents"""


def typed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as ready-made memories whose metadata are JSON objects."""
    docs = i.table(spark, sf_dir, "documents")
    shares = F.struct((F.col("n_chars") / 1000).alias("thousands"), F.array("lang", "source").alias("tags"))
    fields = F.struct("lang", F.col("n_chars").alias("chars"), (F.col("n_chars") > 2000).alias("long"), shares.alias("more"))
    json = docs.select(F.col("doc_id").cast("string").alias("entry_id"), F.to_json(fields).alias("json"))
    return i.entries(spark, sf_dir).drop("custom_metadata").join(json, "entry_id").withColumn("custom_metadata", typed.from_json(F.col("json"))).drop("json")


def w4_typed_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, truth values and nested objects come back as such after they were stored; the
    call's number replaces the entry's string."""
    entries = typed_entries(spark, sf_dir)
    made = insert_memories(entries, i.CONFIG, i.at(i.FIRST), {"lang": 5, "batch": 7.5}, F.col("entry_id"))
    md = F.col("custom_metadata")
    kinds = F.transform(F.array_sort(F.map_keys(md)), lambda k: F.concat(k, F.lit(":"), F.split(F.schema_of_variant(md[k]), "<")[0]))
    return stored(made.select("memory_id", "custom_metadata"), "typed").select(
        "memory_id", typed.value_of(md, "chars", "bigint").alias("chars"), typed.value_of(md, "long", "boolean").alias("long"),
        F.try_variant_get(md["more"], "$.thousands", "double").alias("thousands"), F.try_variant_get(md["more"], "$.tags[1]", "string").alias("tag"),
        typed.value_of(md, "lang", "bigint").alias("lang"), typed.as_strings(md)["batch"].alias("batch"),
        F.array_join(kinds, ",").alias("kinds"),
    )


W4T = """SELECT sha256(length('add_memory') || ':add_memory' || length(CAST(doc_id AS VARCHAR)) || ':' || doc_id) AS memory_id,
  n_chars AS chars, n_chars > 2000 AS long, n_chars / 1000 AS thousands, source AS tag, CAST(5 AS BIGINT) AS lang, '7.5' AS batch,
  'batch:DOUBLE,chars:BIGINT,lang:BIGINT,long:BOOLEAN,more:OBJECT' AS kinds
FROM documents WHERE trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') <> ''"""


def w5_upsert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation time and metadata survive an update without metadata; one with it replaces the map."""
    ev = i.events(spark, sf_dir)
    first = apply_delta(
        ev.filter("seq < 2"), i.CONFIG, i.at(i.FIRST),
        spark.createDataFrame([], _seed(spark, sf_dir).schema), {"topic": "a", "level": "1"},
    )
    plain = session_updates(ev, i.CONFIG).filter("app_name <> 'app0'")
    tagged = plain.withColumn(
        "custom_metadata",
        F.when(F.col("app_name") == "app1", literal_map({"topic": "b"})).otherwise(literal_map({})),
    )
    done = upsert(first, tagged, i.CONFIG, i.at(i.SECOND))
    return done.select(
        "session_id",
        F.col("custom_metadata")["topic"].alias("topic"),
        F.col("custom_metadata")["level"].alias("level"),
        iso_timestamp(F.col("created_at")).alias("created_at"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
        F.md5("transcript").alias("text_md5"),
    )


W5 = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()}, {i.transcripts_sql("t2", where="seq < 2")}
SELECT tr.session_id, CASE WHEN tr.app_name = 'app1' THEN 'b' ELSE 'a' END AS topic,
  CASE WHEN tr.app_name = 'app1' THEN NULL ELSE '1' END AS level, '{FIRST_ISO}' AS created_at,
  CASE WHEN tr.app_name = 'app0' THEN '{FIRST_ISO}' ELSE '{SECOND_ISO}' END AS updated_at,
  md5(CASE WHEN tr.app_name = 'app0' THEN t2.transcript ELSE tr.transcript END) AS text_md5
FROM tr JOIN t2 USING (memory_id)"""


def w6_event_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event comes twice and only user turns have an id: known ids go, repeats stay."""
    ev = i.events(spark, sf_dir).withColumn(
        "event_id", F.when(F.col("author") == "user", F.col("event_id"))
    )
    stored = ingest_sessions(ev.filter("seq < 4"), i.CONFIG, i.at(i.FIRST))
    fresh = new_segments(segments(ev.unionByName(ev)), stored)
    return fresh.groupBy("session_id", "author").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("seq").alias("seq_sum")
    )


W6 = f"""WITH {i.EVENTS_SQL}, tw AS (SELECT * FROM ev UNION ALL SELECT * FROM ev)
SELECT session_id, author, count(*) AS kept, CAST(sum(seq) AS BIGINT) AS seq_sum FROM tw
WHERE author <> 'user' OR seq >= 4 GROUP BY 1, 2"""


def w6_dedupe_within_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the option that drops repeats inside one delta as well."""
    ev = i.events(spark, sf_dir).withColumn(
        "event_id", F.when(F.col("author") == "user", F.col("event_id"))
    )
    stored = ingest_sessions(ev.filter("seq < 4"), i.CONFIG, i.at(i.FIRST))
    fresh = new_segments(segments(ev.unionByName(ev)), stored, dedupe_within_batch=True)
    return fresh.groupBy("session_id", "author").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("seq").alias("seq_sum")
    )


W6B = f"""WITH {i.EVENTS_SQL}, tw AS (
  SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE author <> 'user')
SELECT session_id, author, count(*) AS kept, CAST(sum(seq) AS BIGINT) AS seq_sum FROM tw
WHERE author <> 'user' OR seq >= 4 GROUP BY 1, 2"""


def w7_no_op_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known events and blank ones change nothing, not even the update time."""
    ev = i.events(spark, sf_dir)
    table = i.new_table(spark, "no-op")
    table.add_sessions(ev, i.CONFIG, i.at(i.FIRST))
    table.add_events(ev, i.CONFIG, i.at(i.SECOND))
    blank = ev.select(
        *KEYS, "seq", F.concat("event_id", F.lit("x")).alias("event_id"), "author",
        F.array(F.struct(F.lit(" \n ").alias("text"))).alias("parts"),
    )
    table.add_events(blank, i.CONFIG, i.at(i.SECOND))
    return brief(table.read())


QUERIES = {
    "s1_read_events": (s1_read_events, S1),
    "s2_scan_table": (s2_scan_table, S2),
    "s3_lookup_sessions": (s3_lookup_sessions, S3),
    "s4_append": (s4_append, S4),
    "s5_upsert": (s5_upsert, S5),
    "s6_delete_tenant": (s6_delete_tenant, S6),
    "s7_interop_names": (s7_interop_names, S7),
    "w1_ingest_sessions": (w1_ingest_sessions, W1),
    "w2_apply_delta": (w2_apply_delta, W2),
    "w2_distilled_delta": (w2_distilled_delta, W2D),
    "w3_insert_memories": (w3_insert_memories, W3),
    "w4_merge_metadata": (w4_merge_metadata, W4),
    "w4_typed_metadata": (w4_typed_metadata, W4T),
    "w5_upsert_rules": (w5_upsert_rules, W5),
    "w6_event_dedup": (w6_event_dedup, W6),
    "w6_dedupe_within_batch": (w6_dedupe_within_batch, W6B),
    "w7_no_op_guards": (w7_no_op_guards, S2),
}
