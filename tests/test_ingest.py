from dataclasses import replace

from helpers import CONFIG, event, events, one, session
from pyspark.sql import functions as F

from recollect import apply_delta, ingest_sessions, insert_memories, schema
from recollect.operators.distill import keep_user_lines
from recollect.operators.transcript import segments
from recollect.operators.ingest import new_segments

T1, T2 = "2024-01-01", "2024-01-02"
TALK = [("user", "hello"), ("bot", "hi")]


def test_session_becomes_one_memory(spark):
    got = one(ingest_sessions(session(spark, TALK), CONFIG, T1))
    assert got.transcript == "user: hello\nbot: hi"
    assert (got.event_ids, got.author, got.source) == (["e0", "e1"], "memory", "add_session_to_memory")
    assert got.created_at == got.updated_at and got.custom_metadata is None
    assert list(got.asDict()) == schema.MEMORIES.fieldNames()


def test_session_without_text_stores_nothing(spark):
    assert ingest_sessions(session(spark, [("user", " \n")]), CONFIG, T1).isEmpty()


def test_ingesting_again_replaces_and_keeps_creation_and_metadata(spark):
    stored = apply_delta(
        session(spark, TALK), CONFIG, T1, spark.createDataFrame([], schema.MEMORIES), {"topic": "x"}
    )
    got = one(ingest_sessions(session(spark, [("user", "bye")]), CONFIG, T2, stored))
    assert got.transcript == "user: bye" and got.event_ids == ["e0"]
    assert got.custom_metadata == {"topic": "x"}
    assert got.created_at < got.updated_at
    again = one(ingest_sessions(session(spark, [("user", "bye")]), CONFIG, T2, stored))
    assert again == got


def test_delta_appends_only_what_is_new(spark):
    stored = ingest_sessions(session(spark, TALK), CONFIG, T1)
    delta = session(spark, [*TALK, ("user", "more")])
    got = one(apply_delta(delta, CONFIG, T2, stored))
    assert got.transcript == "user: hello\nbot: hi\nuser: more"
    assert got.event_ids == ["e0", "e1", "e2"] and got.source == "add_events_to_memory"


def test_known_delta_leaves_the_row_alone(spark):
    stored = ingest_sessions(session(spark, TALK), CONFIG, T1)
    assert one(apply_delta(session(spark, TALK), CONFIG, T2, stored)) == one(stored)


def test_only_the_delta_is_distilled(spark):
    stored = ingest_sessions(session(spark, TALK), CONFIG, T1)
    config = replace(CONFIG, distiller=keep_user_lines)
    got = one(apply_delta(session(spark, [*TALK, ("bot", "x"), ("user", "y")]), config, T2, stored))
    assert got.transcript == "user: hello\nbot: hi\nuser: y"


def test_repeats_in_a_delta_and_events_without_id_are_kept(spark):
    none = spark.createDataFrame([], schema.MEMORIES)
    rows = events(
        spark,
        event("s", 0, "u", "a", "e0"),
        event("s", 1, "u", "a", "e0"),
        event("s", 2, "u", "b"),
        event("s", 3, "u", "b", ""),
    )
    stored = apply_delta(rows, CONFIG, T1, none)
    assert one(stored).event_ids == ["e0", "e0"] and one(stored).transcript.count("\n") == 3
    after = one(apply_delta(rows, CONFIG, T2, stored))
    assert after.transcript == "u: a\nu: a\nu: b\nu: b\nu: b\nu: b"
    assert after.event_ids == ["e0"]
    once = one(apply_delta(rows, replace(CONFIG, dedupe_within_batch=True), T1, none))
    assert once.event_ids == ["e0"] and once.transcript == "u: a\nu: b\nu: b"


def test_event_without_id_is_not_mistaken_for_one_named_like_its_position(spark):
    stored = ingest_sessions(events(spark, event("s", 0, "u", "a", "7")), CONFIG, T1)
    fresh = new_segments(segments(events(spark, event("s", 7, "u", "b", ""))), stored)
    assert fresh.count() == 1


def test_direct_memories(spark):
    rows = spark.createDataFrame(
        [
            ("app", "ann", None, [(" likes ",), (None,), ("tea ",)], {"k": "entry", "only": "e"}),
            ("app", "ann", "doctor", [("likes tea",)], None),
            ("app", "ann", None, [(" ",)], None),
            ("app", "ann", None, None, None),
        ],
        schema.DIRECT_MEMORIES,
    )
    config = replace(CONFIG, distiller=lambda t: F.lit("never"))
    got = sorted(insert_memories(rows, config, T1, {"k": "call"}).collect(), key=lambda r: r.author)
    assert [r.author for r in got] == ["doctor", "memory"]
    assert [r.transcript for r in got] == ["likes tea", "likes tea"]
    assert got[1].custom_metadata == {"k": "call", "only": "e"} and got[0].custom_metadata == {"k": "call"}
    assert got[0].memory_id != got[1].memory_id and got[0].session_id is None
    plain = insert_memories(rows, config, T1).filter("author = 'doctor'")
    assert one(plain).custom_metadata == {}


def test_number_of_embedding_tasks_changes_nothing_else(spark):
    spread = replace(CONFIG, embed_partitions=3)
    stored = ingest_sessions(session(spark, TALK), CONFIG, T1)
    delta = session(spark, [*TALK, ("user", "more")])
    assert one(apply_delta(delta, spread, T2, stored)) == one(apply_delta(delta, CONFIG, T2, stored))
    assert one(ingest_sessions(delta, spread, T2)) == one(ingest_sessions(delta, CONFIG, T2))
    assert ingest_sessions(delta, spread, T2).rdd.getNumPartitions() == 3
