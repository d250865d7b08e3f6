"""Registered queries on streams, each drained before its result is read."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.streaming import StreamingQuery

from recollect.config import SESSION_KEY
from recollect.plans import inputs as i
from recollect.plans.memory import EV_TR, W2, brief
from recollect.session import scratch_path
from recollect.streaming.stateful import late_rows, state_lines, stream_transcripts, use_rocksdb, without_repeats
from recollect.streaming.upsert import stream_deltas, stream_finished_sessions

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as a stream of events. The pattern matches one path, which may be a
    file or a folder of part files."""
    return i.events_of(spark.readStream.schema(CONVERSATIONS).parquet(f"{sf_dir}/{{conversations.parquet}}"))


def finish(query: StreamingQuery) -> None:
    """Waits for a stream that ends by itself."""
    query.awaitTermination()


def _twice(events: DataFrame) -> DataFrame:
    """Delivery at least once: every event comes two times."""
    return events.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")


def w8_finished_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of finished turns has their sessions saved, each one whole."""
    table = i.new_table(spark, "autosave")
    finish(stream_finished_sessions(
        _arriving(spark, sf_dir),
        lambda: i.events(spark, sf_dir),
        table,
        i.CONFIG,
        scratch_path(spark, "autosave-state"),
        now=lambda: i.at(i.FIRST),
    ))
    return brief(table.read()).select("memory_id", "session_id", "text_md5", "event_ids", "source")


W8 = f"""{EV_TR} SELECT memory_id, session_id, md5(transcript) AS text_md5, event_ids,
'add_session_to_memory' AS source FROM tr"""


def x1_stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four turns are stored; then all events stream in, every one delivered twice."""
    table = i.new_table(spark, "deltas")
    table.add_sessions(i.events(spark, sf_dir).filter("seq < 4"), i.CONFIG, i.at(i.FIRST))
    finish(stream_deltas(
        _twice(_arriving(spark, sf_dir)),
        table,
        replace(i.CONFIG, dedupe_within_batch=True),
        scratch_path(spark, "deltas-state"),
        now=lambda: i.at(i.SECOND),
    ))
    return brief(table.read())


def _drain(stream: DataFrame, path: str) -> StreamingQuery:
    """Reads a stream to its end; each batch's rows go to a folder of their own."""
    query = stream.writeStream.foreachBatch(
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    ).outputMode("update").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start()
    finish(query)
    return query


def _latest(spark: SparkSession, path: str) -> DataFrame:
    """What the last batch with a session said of it."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    latest = F.max_by(F.struct("transcript", "turns", "new_turns"), "batch").alias("last")
    return rows.groupBy(*SESSION_KEY).agg(latest).select(*SESSION_KEY, "last.*")


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a time: a week, on each day the sessions of that rest, a turn a minute."""
    day = (F.col("session_id").cast("long") % DAYS).cast("int")
    minutes = F.make_dt_interval(days=day, mins=F.col("seq").cast("int"))
    return i.events(spark, sf_dir).withColumn("day", day).withColumn("said", i.at("2024-01-01") + minutes)


def _in_batches(spark: SparkSession, name: str, *parts: DataFrame) -> DataFrame:
    """A stream that brings each part as a batch of its own."""
    path = scratch_path(spark, name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


#: Days over which the sessions are spread.
DAYS = 7


def x2_stateful_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice and known ones are recognised in state."""
    use_rocksdb(spark)
    path = scratch_path(spark, "stateful")
    _drain(stream_transcripts(_twice(_arriving(spark, sf_dir)), dedupe_within_batch=True), path)
    return _latest(spark, path).select("session_id", F.md5("transcript").alias("text_md5"), "turns")


def x2_initial_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four turns are stored before the stream begins, which brings all of them again: sessions
    without a further turn are not touched, the others go on from what is stored."""
    use_rocksdb(spark)
    table = i.new_table(spark, "begun")
    table.add_sessions(i.events(spark, sf_dir).filter("seq < 4"), i.CONFIG, i.at(i.FIRST))
    path = scratch_path(spark, "initial")
    _drain(stream_transcripts(_twice(_arriving(spark, sf_dir)), dedupe_within_batch=True, stored=table.read()), path)
    before = table.read().select(*SESSION_KEY, "transcript", F.size("event_ids").cast("long").alias("turns"), F.lit(0).cast("long").alias("new_turns"))
    after = _latest(spark, path)
    both = before.join(after.select(*SESSION_KEY), list(SESSION_KEY), "left_anti").unionByName(after)
    return both.select("session_id", F.md5("transcript").alias("text_md5"), "turns", "new_turns")


def x2_new_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, each event delivered twice: what is emitted are new lines only, which
    put together are the transcripts."""
    use_rocksdb(spark)
    events = i.events(spark, sf_dir)
    parts = [events.filter(c) for c in ("seq < 2", "seq between 1 and 3", "seq > 2")]
    path = scratch_path(spark, "new-lines")
    stream = _in_batches(spark, "three", *map(_twice, parts))
    _drain(stream_transcripts(stream, dedupe_within_batch=True, whole=False), path)
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    pieces = F.array_sort(F.collect_list(F.struct("batch", "transcript")))
    return rows.groupBy("session_id").agg(F.md5(F.array_join(pieces["transcript"], "\n")).alias("text_md5"), F.max("turns").alias("turns"))


def x2_bounded_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats within a day of event time are recognised; the first day's events, which come
    again after six more, are late: dropped and counted."""
    events = _timed(spark, sf_dir)
    early, rest = events.filter("day < 3"), events.filter("day >= 3")
    again = events.filter(F.col("day").isin(0, DAYS - 1))
    path = scratch_path(spark, "bounded")
    query = _drain(without_repeats(_in_batches(spark, "late", _twice(early), _twice(rest), again), "said", "1 day"), path)
    rows = spark.read.parquet(f"{path}/batch=*")
    return rows.select("event_id", "session_id", F.lit(late_rows(query)).cast("long").alias("late_rows"))


X2B = f"""WITH {i.EVENTS_SQL} SELECT event_id, session_id,
  (SELECT count(*) FROM ev WHERE CAST(session_id AS BIGINT) % {DAYS} = 0) AS late_rows FROM ev"""


#: A session is forgotten two days after its last line (and half a minute, as lines come by the minute).
TTL = 2 * 86_400 + 30


def x3_state_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a week in three batches, kept for two days: what the state holds in the end,
    read from the checkpoint. Idle sessions are gone, active ones hold all their lines."""
    use_rocksdb(spark)
    events = _timed(spark, sf_dir)
    parts = [events.filter(c) for c in ("day < 2", "day between 2 and 4", "day > 4")]
    path = scratch_path(spark, "expiry")
    _drain(stream_transcripts(_in_batches(spark, "week", *parts), ttl_seconds=TTL, time="said"), path)
    lines = F.array_sort(F.collect_list("line"))
    return state_lines(spark, f"{path}-state").groupBy("session_id").agg(
        F.md5(F.array_join(lines, "\n")).alias("lines_md5"), F.count(F.lit(1)).alias("turns")
    )


X3 = f"""WITH {i.EVENTS_SQL}, s AS (
  SELECT session_id, CAST(session_id AS BIGINT) % {DAYS} * 86400 + max(seq) * 60 AS last,
    md5(string_agg(author || ': ' || text, chr(10) ORDER BY author || ': ' || text)) AS lines_md5, count(*) AS turns
  FROM ev GROUP BY session_id)
SELECT session_id, lines_md5, turns FROM s WHERE last + {TTL} > (SELECT max(last) FROM s)"""

X2 = f"{EV_TR} SELECT session_id, md5(transcript) AS text_md5, turns FROM tr"
X2I = f"{EV_TR} SELECT session_id, md5(transcript) AS text_md5, turns, greatest(turns - 4, 0) AS new_turns FROM tr"


QUERIES = {
    "w8_finished_sessions": (w8_finished_sessions, W8),
    "x1_stream_to_table": (x1_stream_to_table, W2),
    "x2_stateful_transcripts": (x2_stateful_transcripts, X2),
    "x2_initial_state": (x2_initial_state, X2I),
    "x2_new_lines": (x2_new_lines, X2),
    "x2_bounded_dedup": (x2_bounded_dedup, X2B),
    "x3_state_expiry": (x3_state_expiry, X3),
}
