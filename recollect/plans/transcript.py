"""Registered queries on transcripts, distillation and text protection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.config import SESSION_KEY
from recollect.functions import text as tx
from recollect.operators.distill import compression_report, distill, keep_user_lines
from recollect.operators.ingest import insert_memories
from recollect.operators.transcript import segments, transcripts
from recollect.plans import inputs as i

KEYS = list(SESSION_KEY)


def t1_join_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text")))
    no_text = F.array(F.struct(F.lit(None).cast("string").alias("text")))
    joined = tx.join_parts(F.concat(lines, no_text))
    return i.table(spark, sf_dir, "conversations").select("conv_id", "turn", joined.alias("joined"))


T1 = "SELECT conv_id, turn, replace(text, chr(10), '') AS joined FROM conversations"


def _uneven_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive: system turns say nothing, every fifth turn has no content, ids and authors may be missing."""
    said = F.when(F.col("author") == "system", F.lit(" \t\n ")).otherwise(
        F.concat(F.lit("\n 　"), F.col("parts")[0]["text"], F.lit(" \t\n"))
    )
    ev = i.events(spark, sf_dir)
    return ev.select(
        *KEYS,
        "seq",
        F.when(F.col("author") == "user", F.col("event_id")).alias("event_id"),
        F.when(F.col("author") == "user", F.col("author")).alias("author"),
        F.when(F.col("seq") % 5 != 4, i.one_part(said)).alias("parts"),
    )


def t2_drop_blank_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = segments(_uneven_events(spark, sf_dir))
    return segs.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("kept"), F.sum("seq").alias("seq_sum")
    )


T2 = f"""WITH {i.EVENTS_SQL}
SELECT app_name, user_id, session_id, count(*) AS kept, CAST(sum(seq) AS BIGINT) AS seq_sum
FROM ev WHERE author <> 'system' AND seq % 5 <> 4 GROUP BY 1, 2, 3"""


def t3_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = segments(_uneven_events(spark, sf_dir))
    return segs.select("session_id", "seq", "text", F.length("text").cast("bigint").alias("chars"))


T3 = f"""WITH {i.EVENTS_SQL}
SELECT session_id, seq, text, length(text) AS chars FROM ev WHERE author <> 'system' AND seq % 5 <> 4"""


def t4_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(_uneven_events(spark, sf_dir)).select("session_id", "seq", "author", "event_id")


T4 = f"""WITH {i.EVENTS_SQL}
SELECT session_id, seq, CASE WHEN author = 'user' THEN author ELSE 'unknown' END AS author,
       CASE WHEN author = 'user' THEN event_id ELSE '' END AS event_id
FROM ev WHERE author <> 'system' AND seq % 5 <> 4"""


def t5_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = transcripts(segments(i.events(spark, sf_dir)), block_turns=2)
    return done.select(*KEYS, "transcript", "turns")


T5 = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()}
SELECT app_name, user_id, session_id, transcript, turns FROM tr"""


def t6_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = _uneven_events(spark, sf_dir)
    done = transcripts(segments(twice.unionByName(twice)))
    return done.select(
        *KEYS,
        F.array_join("event_ids", ",").alias("event_ids"),
        F.size("event_ids").cast("bigint").alias("ids"),
    )


T6 = f"""WITH {i.EVENTS_SQL}, tw AS (SELECT * FROM ev UNION ALL SELECT * FROM ev)
SELECT app_name, user_id, session_id,
       coalesce(string_agg(event_id, ',' ORDER BY seq) FILTER (author = 'user'), '') AS event_ids,
       count(*) FILTER (author = 'user') AS ids
FROM tw WHERE author <> 'system' AND seq % 5 <> 4 GROUP BY 1, 2, 3"""


def t7_default_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Openings carry no session id, assistants an empty one: both land in the tenant's shared session."""
    ev = i.events(spark, sf_dir).withColumn(
        "session_id",
        F.when(F.col("seq") == 0, None)
        .when(F.col("author") == "assistant", F.lit(""))
        .otherwise(F.col("session_id")),
    )
    return (
        segments(ev, default_session=True)
        .groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    )


T7 = f"""WITH {i.EVENTS_SQL}
SELECT app_name, user_id,
       CASE WHEN seq = 0 OR author = 'assistant' THEN '_default' ELSE session_id END AS session_id,
       count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars
FROM ev GROUP BY 1, 2, 3"""


def t8_distill_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A distiller that keeps system lines only: most sessions have none and stay raw."""

    def system_lines(t):
        return F.array_join(F.filter(F.split(t, "\n"), lambda ln: ln.startswith("system:")), "\n")

    done = distill(transcripts(segments(i.events(spark, sf_dir))), system_lines)
    return done.select(*KEYS, "stored_text")


T8 = f"""WITH {i.EVENTS_SQL}, {i.transcripts_sql()}, d AS (
  SELECT *, array_to_string(list_filter(string_split(transcript, chr(10)),
                                        lambda x: starts_with(x, 'system:')), chr(10)) AS sys FROM tr)
SELECT app_name, user_id, session_id, CASE WHEN trim(sys) <> '' THEN sys ELSE transcript END AS stored_text
FROM d"""


def t9_keep_user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = distill(transcripts(segments(i.events(spark, sf_dir))), keep_user_lines)
    return done.select(*KEYS, "stored_text")


DISTILLED_SQL = f"""{i.EVENTS_SQL}, {i.transcripts_sql()}, d AS (
  SELECT *, array_to_string(list_filter(string_split(transcript, chr(10)),
                                        lambda x: starts_with(lower(x), 'user:')), chr(10)) AS usr FROM tr),
ds AS (SELECT app_name, user_id, session_id, transcript,
              substr(CASE WHEN usr <> '' THEN usr ELSE transcript END, 1, 2000) AS stored_text FROM d)"""
T9 = f"WITH {DISTILLED_SQL} SELECT app_name, user_id, session_id, stored_text FROM ds"


def t10_append_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = segments(i.events(spark, sf_dir))
    prior = transcripts(segs.filter("seq < 4 and author <> 'user'")).select(
        *KEYS, F.col("transcript").alias("prior")
    )
    delta = transcripts(segs.filter("seq >= 4 or author = 'user'"))
    text = tx.append_text(F.col("prior"), F.col("transcript"))
    return delta.join(prior, KEYS, "left").select(*KEYS, text.alias("combined"))


T10 = f"""WITH {i.EVENTS_SQL},
{i.transcripts_sql("pr", where="seq < 4 AND author <> 'user'")},
{i.transcripts_sql("dl", where="seq >= 4 OR author = 'user'")}
SELECT dl.app_name, dl.user_id, dl.session_id,
       CASE WHEN coalesce(pr.transcript, '') <> '' THEN trim(pr.transcript || chr(10) || dl.transcript, ' ' || chr(10))
            ELSE dl.transcript END AS combined
FROM dl LEFT JOIN pr USING (memory_id)"""


def t11_compression_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = distill(transcripts(segments(i.events(spark, sf_dir))), keep_user_lines)
    return compression_report(done, ["app_name", "user_id"])


T11 = f"""WITH {DISTILLED_SQL}
SELECT app_name, user_id, CAST(sum(length(transcript)) AS BIGINT) AS raw_chars,
       CAST(sum(length(stored_text)) AS BIGINT) AS kept_chars,
       CAST(sum(length(stored_text)) AS DOUBLE) / CAST(sum(length(transcript)) AS DOUBLE) AS kept_ratio
FROM ds GROUP BY 1, 2"""

_CONNECT = "concat(text, ' db://u', doc_id, ':pw', doc_id, '@h/', source, ' key=sk-', doc_id)"


def t12_mask_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = i.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.mask_credentials(F.expr(_CONNECT)).alias("masked"))


T12 = f"""SELECT doc_id, regexp_replace({_CONNECT}, '{tx.CREDENTIALS}', '://\\1:****@', 'g') AS masked
FROM documents"""


def t13_mask_secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    secret = F.when(F.col("lang") != "en", F.concat(F.lit("sk-"), i.text_of(F.col("doc_id"))))
    docs = i.table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.mask_secret(F.expr(_CONNECT), secret).alias("masked"))


T13 = f"""SELECT doc_id, CASE WHEN lang <> 'en' THEN replace({_CONNECT}, 'sk-' || doc_id, '***REDACTED***')
       ELSE {_CONNECT} END AS masked FROM documents"""


def t14_iso_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp"))
    ev = i.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        tx.iso_timestamp(ts).alias("iso"),
        tx.iso_timestamp(F.date_trunc("second", ts)).alias("iso_second"),
    )


T14 = """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN
    CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END END AS iso,
  CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') END AS iso_second
FROM events"""


def t15_entry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries in two parts; those in German come without text and are skipped."""
    said = F.when(F.col("custom_metadata")["lang"] != "de", F.col("parts")[0]["text"])
    parts = F.concat(i.one_part(F.lit(" \n")), i.one_part(said), i.one_part(F.lit("\t")))
    rows = i.entries(spark, sf_dir).withColumn("parts", parts)
    done = insert_memories(rows, i.CONFIG, i.at(i.FIRST), entry_id=F.col("entry_id"))
    return done.select("app_name", "user_id", "memory_id", F.col("transcript").alias("text"))


T15 = """SELECT 'app' || (doc_id % 3) AS app_name, 'u' || (doc_id % 20) AS user_id,
  sha256('10:add_memory' || length(doc_id::VARCHAR) || ':' || doc_id) AS memory_id,
  trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text
FROM documents WHERE lang <> 'de'"""


QUERIES = {
    "t1_join_parts": (t1_join_parts, T1),
    "t2_drop_blank_events": (t2_drop_blank_events, T2),
    "t3_strip": (t3_strip, T3),
    "t4_defaults": (t4_defaults, T4),
    "t5_transcripts": (t5_transcripts, T5),
    "t6_event_ids": (t6_event_ids, T6),
    "t7_default_session": (t7_default_session, T7),
    "t8_distill_with_fallback": (t8_distill_with_fallback, T8),
    "t9_keep_user_lines": (t9_keep_user_lines, T9),
    "t10_append_delta": (t10_append_delta, T10),
    "t11_compression_report": (t11_compression_report, T11),
    "t12_mask_credentials": (t12_mask_credentials, T12),
    "t13_mask_secret": (t13_mask_secret, T13),
    "t14_iso_timestamps": (t14_iso_timestamps, T14),
    "t15_entry_text": (t15_entry_text, T15),
}
