"""Streams with state: begun on stored memories, expiring by event time, bounded deduplication."""

import uuid
from datetime import datetime, timedelta

import pytest
from helpers import CONFIG
from pyspark.sql import functions as F

from recollect import ingest_sessions
from recollect.plans import streaming
from recollect.plans.streaming import _arriving, _drain, _in_batches, _latest
from recollect.streaming.stateful import late_rows, state_lines, stream_transcripts, use_rocksdb, without_repeats

EVENT = "app_name string, user_id string, session_id string, seq long, event_id string, author string, parts array<struct<text:string>>, said timestamp"
START = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def state_store(spark):
    use_rocksdb(spark)


def line(session, seq, text, hours=0.0, event_id="", user="u"):
    name = f"{session}-{seq}" if event_id == "" else event_id
    return ("a", user, session, seq, name, "user", [(text,)], START + timedelta(hours=hours))


def stream(spark, *batches):
    return _in_batches(spark, "in", *[spark.createDataFrame(list(rows), EVENT) for rows in batches])


def drained(spark, tmp_path, df):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    return path, _drain(df, path)


def test_goes_on_from_stored_memories(spark, tmp_path):
    old = [line("s", 0, "one"), line("s", 1, "two"), line("idle", 0, "rest"), line("s", 0, "other", user="v")]
    stored = ingest_sessions(spark.createDataFrame(old, EVENT), CONFIG, "2024-01-01")
    free = stored.limit(1).withColumn("session_id", F.lit(None).cast("string"))  # a direct memory has no session
    batches = [*old, line("s", 2, "three")], [line("s", 3, "four"), line("s", 2, "three"), line("new", 0, "first")]
    path, _ = drained(spark, tmp_path, stream_transcripts(stream(spark, *batches), stored=stored.union(free)))
    got = {(r.user_id, r.session_id): (r.transcript, r.turns, r.new_turns) for r in _latest(spark, path).collect()}
    assert got == {
        ("u", "s"): ("user: one\nuser: two\nuser: three\nuser: four", 4, 1), ("u", "new"): ("user: first", 1, 1),
    }


def test_new_lines_alone(spark, tmp_path):
    batches = [line("s", 0, "one")], [line("s", 0, "one"), line("s", 1, "two"), line("s", 2, "three")]
    path, _ = drained(spark, tmp_path, stream_transcripts(stream(spark, *batches), whole=False))
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*").orderBy("batch").collect()
    assert [(r.transcript, r.new_turns, r.turns) for r in rows] == [("user: one", 1, 1), ("user: two\nuser: three", 2, 3)]
    assert state_lines(spark, f"{path}-state").count() == 0


def test_idle_sessions_are_gone_and_begin_anew(spark, tmp_path):
    batches = (
        [line("idle", 0, "old", 0), line("active", 0, "one", 0)],
        [line("active", 1, "two", 20), line("other", 0, "x", 30)],
        [line("idle", 1, "again", 60), line("active", 2, "three", 40)],
    )
    events = stream_transcripts(stream(spark, *batches), ttl_seconds=24 * 3600, time="said", delay="1 day")
    path, _ = drained(spark, tmp_path, events)
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*").collect()
    # the watermark stood at 6 hours when the third batch came: both sessions were still known
    assert {(r.session_id, r.turns) for r in rows if r.batch == 2} == {("idle", 2), ("active", 3)}
    left = {}
    for r in state_lines(spark, f"{path}-state").collect():
        left.setdefault(r.session_id, []).append(r.line)
    # at 36 hours in the end, nothing has been silent for a day beyond 60, 40 and 30 hours
    assert left == {"idle": ["user: old", "user: again"], "active": ["user: one", "user: two", "user: three"], "other": ["user: x"]}


def test_an_expired_session_starts_again_with_nothing(spark, tmp_path):
    batches = [line("s", 0, "old", 0)], [line("t", 0, "x", 48)], [line("t", 1, "y", 49)], [line("s", 0, "old", 50), line("s", 1, "new", 50)]
    path, _ = drained(spark, tmp_path, stream_transcripts(stream(spark, *batches), ttl_seconds=3600, time="said"))
    got = {r.session_id: (r.transcript, r.turns) for r in _latest(spark, path).collect()}
    assert got["s"] == ("user: old\nuser: new", 2), "its ids were forgotten too"


def test_repeats_within_the_delay_and_late_rows(spark, tmp_path):
    nameless = line("s", 5, "no id", 10, event_id=None)
    batches = (
        [line("s", 0, "a", 0), line("s", 0, "a", 0), nameless, nameless],
        [line("s", 1, "b", 30), line("s", 0, "a", 9)],
        [line("s", 1, "b", 31)],  # late is what lies behind the watermark of the batch before
        [line("s", 2, "too late", 1), line("s", 1, "b", 29)],
    )
    path, query = drained(spark, tmp_path, without_repeats(stream(spark, *batches), "said", "10 hours"))
    rows = spark.read.parquet(f"{path}/batch=*").collect()
    assert sorted((r.event_id or "", r.parts[0].text) for r in rows) == [("", "no id"), ("", "no id"), ("s-0", "a"), ("s-1", "b")]
    assert late_rows(query) == 1


def test_a_table_loses_all_repeats(spark):
    rows = spark.createDataFrame([line("s", 0, "a"), line("s", 0, "a", 99), line("s", 1, "b")], EVENT)
    assert without_repeats(rows, "said", "1 hour").count() == 2


@pytest.mark.parametrize("name", ["w8_finished_sessions", "x1_stream_to_table", "x2_stateful_transcripts", "x2_initial_state"])
def test_conversations_in_a_folder_of_part_files(spark, tmp_path, name):
    rows = [(conv, turn, "user", f"text {conv} {turn}") for conv in range(6) for turn in range(5 + conv % 2)]
    turns = spark.createDataFrame(rows, streaming.CONVERSATIONS)
    turns.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = streaming.QUERIES[name][0](spark, str(tmp_path)).collect()
    assert len(found) == 6
    assert "turns" not in found[0] or {int(r.session_id): r.turns for r in found} == {conv: 5 + conv % 2 for conv in range(6)}


def test_conversations_in_one_file(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "a")], streaming.CONVERSATIONS).coalesce(1).write.parquet(f"{tmp_path}/w")
    next(tmp_path.glob("w/part-*")).rename(tmp_path / "conversations.parquet")
    path, _ = drained(spark, tmp_path, stream_transcripts(_arriving(spark, str(tmp_path))))
    assert [r.transcript for r in _latest(spark, path).collect()] == ["user: a"]
