from datetime import datetime

import pytest
from helpers import CONFIG, event, events, one, questions, session

from recollect import MemoryTable, insert_memories, schema, search
from recollect.session import scratch_path
from recollect.streaming.stateful import stream_transcripts, use_rocksdb
from recollect.streaming.upsert import stream_deltas, stream_finished_sessions

T1, T2 = "2024-01-01 00:00:00", "2024-01-05 00:00:00"


@pytest.fixture
def table(spark):
    return MemoryTable.create(spark, scratch_path(spark, "table"), buckets=4, slices=2)


def many(spark, n=12, text="hello"):
    rows = [event(f"s{k}", 0, "user", f"{text} {k}", f"{k}-0", user=f"u{k % 5}") for k in range(n)]
    return events(spark, *rows)


def gens(table):
    return table._commits().selectExpr("max(gen)").first()[0]


def test_new_table_is_empty(spark, table):
    assert table.read().count() == 0
    assert MemoryTable(spark, table.path).buckets == 4


def test_upsert_touches_only_what_it_must(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    before = {r.memory_id: r for r in table.read().collect()}
    table.add_events(events(spark, event("s3", 1, "user", "more", "3-1", user="u3")), CONFIG, T2)
    after = {r.memory_id: r for r in table.read().collect()}
    changed = [k for k in after if after[k] != before[k]]
    assert len(before) == len(after) == 12 and len(changed) == 1
    assert after[changed[0]].transcript == "user: hello 3\nuser: more"
    last = table._commits().filter(f"gen = {gens(table)}").collect()
    assert len(last) == 1, "one session lies in one folder"


def test_known_events_write_nothing(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    gen = gens(table)
    table.add_events(many(spark), CONFIG, T2)
    assert gens(table) == gen


def test_a_transaction_is_applied_once(spark, table):
    rows = spark.createDataFrame([("app", "u1", None, [("tea",)], None)], schema.DIRECT_MEMORIES)
    memories = insert_memories(rows, CONFIG, T1)
    table.add_memories(memories, txn="a:1")
    table.add_memories(memories, txn="a:1")
    assert table.read().count() == 1
    table.add_memories(memories, txn="a:2")
    assert table.read().count() == 2


def test_uncommitted_files_are_ignored_and_replaced(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    half = table.read().limit(3)
    half.drop("tenant_bucket", "slice").write.parquet(
        f"{table.path}/data/gen={gens(table) + 1}/tenant_bucket=0/slice=0"
    )
    assert table.read().count() == 12
    table.add_sessions(many(spark, 13), CONFIG, T2)
    assert table.read().count() == 13


def test_delete_find_and_purge(spark, table):
    table.add_sessions(many(spark, 6), CONFIG, T1)
    table.add_sessions(many(spark, 12, "again").filter("session_id > 's5'"), CONFIG, T2)
    assert one(table.find_session("app", "u2", "s2")).transcript == "user: hello 2"
    assert table.find_session("app", "u1", "s2").isEmpty()
    table.delete_tenant("app", "u2")
    assert table.read().filter("user_id = 'u2'").isEmpty()
    left = table.read().count()
    table.purge(None, "2025-01-01")
    assert table.read().count() == left
    table.purge(86_400, datetime(2024, 1, 5, 12))
    rest = table.read()
    assert 0 < rest.count() < left and rest.filter("transcript like '%hello%'").isEmpty()
    gen = gens(table)
    table.purge(86_400, "2024-01-05 12:00:00")
    assert gens(table) == gen, "a second purge finds nothing to rewrite"


def test_appends_add_up_and_compaction_keeps_them(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    rows = spark.createDataFrame([("app", "u1", None, [("tea",)], None)] * 2, schema.DIRECT_MEMORIES)
    for n in range(3):
        table.add_memories(insert_memories(rows, CONFIG, T1))
    before = sorted(r.memory_id for r in table.read().collect())
    assert len(before) == 18
    table.replace_all(lambda df: df)
    assert sorted(r.memory_id for r in table.read().collect()) == before


def test_vacuum_removes_what_was_replaced(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    table.delete_tenant("app", "u2")
    before = sorted(r.memory_id for r in table.read().collect())
    old = spark.read.parquet(f"{table.path}/data").filter("user_id = 'u2'")
    assert not old.isEmpty()
    assert table.vacuum() > 0 and table.vacuum() == 0
    assert sorted(r.memory_id for r in table.read().collect()) == before
    assert spark.read.parquet(f"{table.path}/data").filter("user_id = 'u2'").isEmpty()


def test_search_prunes_to_the_asking_tenants_buckets(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    found = search(questions(spark, ("1", "app", "u3", "hello")), table.read(), CONFIG)
    assert {r.custom_metadata["session_id"] for r in found.collect()} == {"s3", "s8"}
    plan = found._jdf.queryExecution().toString().lower()
    assert "dynamicpruning" in plan


def test_interop_names(spark, table):
    table.add_sessions(many(spark), CONFIG, T1)
    assert {"text", "vec"} < set(table.interop("text", "vec").columns)


# ---- streams -----------------------------------------------------------------


def feed(spark, *batches):
    """A folder that delivers one batch per file, in order."""
    path = scratch_path(spark, "feed")
    for rows in batches:
        rows.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema.EVENTS).option("maxFilesPerTrigger", 1)
    return stream.parquet(path)


TURNS = [("user", "a"), ("bot", "b"), ("user", "c"), ("bot", "d")]


def test_stream_equals_batch_and_restarts_where_it_was(spark, table):
    talk = session(spark, TURNS)
    stream = feed(spark, talk.filter("seq < 2"), talk.filter("seq < 3"), talk)
    state = scratch_path(spark, "state")
    for _ in range(2):
        query = stream_deltas(stream, table, CONFIG, state, now=lambda: T1)
        assert query.awaitTermination(120)
    got = one(table.read())
    assert got.transcript == "user: a\nbot: b\nuser: c\nbot: d"
    assert got.event_ids == ["e0", "e1", "e2", "e3"]


def test_finished_sessions_are_saved_whole(spark, table):
    talk = session(spark, TURNS)
    query = stream_finished_sessions(
        feed(spark, talk.filter("seq = 3")), lambda: talk, table, CONFIG,
        scratch_path(spark, "state"), now=lambda: T1,
    )
    assert query.awaitTermination(120)
    assert one(table.read()).transcript == "user: a\nbot: b\nuser: c\nbot: d"


def test_state_dedups_and_appends_in_arrival_order(spark):
    use_rocksdb(spark)
    talk = session(spark, TURNS)
    late = events(spark, event("s", 1, "bot", "late", "e9"), event("s", 5, "bot", "no id"))
    stream = stream_transcripts(feed(spark, talk.filter("seq > 1"), talk, late, late))
    out = scratch_path(spark, "out")
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/n={n}"))
        .option("checkpointLocation", scratch_path(spark, "state"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("n").collect()
    assert rows[-1].transcript.split("\n") == [
        "user: c", "bot: d", "user: a", "bot: b", "bot: late", "bot: no id", "bot: no id",
    ]
    assert [r.new_turns for r in rows] == [2, 2, 2, 1]
