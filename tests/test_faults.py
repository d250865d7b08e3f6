"""Cases that once went wrong: keys, tenants, writers, timers, secrets in plans."""

from types import SimpleNamespace

import pandas as pd
import pytest
from helpers import CONFIG, event, events, questions, session

from recollect import MemoryTable, ingest_sessions, search
from recollect.functions import crypto
from recollect.operators import protect
from recollect.operators.distill import keep_user_lines
from recollect.session import scratch_path
from recollect.sources.memory_table import ConcurrentWrite
from recollect.streaming.stateful import SessionTranscripts

from pyspark.sql import functions as F

T1, T2 = "2024-01-01 00:00:00", "2024-01-05 00:00:00"


def test_no_two_keys_come_together(spark):
    sep = "\x1f"
    rows = events(
        spark, event("c", 0, "user", "one", app=f"a{sep}b", user="u"), event(f"u{sep}c", 0, "user", "two", app="a", user="b"),
        event("1:c", 0, "user", "three", app="a", user="b"), event("c", 0, "user", "four", app="a", user="b1:"),
    )
    stored = ingest_sessions(rows, CONFIG, T1)
    assert stored.select("memory_id").distinct().count() == 4
    assert ingest_sessions(rows, CONFIG, T2, stored).count() == 4


def test_tenants_may_use_the_same_query_ids(spark):
    rows = [event(f"{u}{k}", 0, "user", f"{u} says word{k}", user=u) for u in ("ann", "bob") for k in range(6)]
    stored = ingest_sessions(events(spark, *rows), CONFIG, T1)
    asked = questions(spark, *[("1", "app", u, "word1 word2") for u in ("ann", "bob")])
    for mode in ("exact", "approximate"):
        found = search(asked, stored, CONFIG, mode).collect()
        for user in ("ann", "bob"):
            own = [r for r in found if r.user_id == user]
            assert sorted(r.rank for r in own) == [1, 2, 3, 4, 5] and all(r.text.startswith(f"user: {user}") for r in own)


def test_second_writer_fails_before_it_reads(spark):
    table = MemoryTable.create(spark, scratch_path(spark, "writers"), buckets=2, slices=1)
    table.add_sessions(session(spark, [("user", "hello")]), CONFIG, T1)
    with table._claimed():
        with pytest.raises(ConcurrentWrite):
            table.add_sessions(session(spark, [("user", "other")]), CONFIG, T2)
    assert [r.transcript for r in table.read().collect()] == ["user: hello"]
    table.add_sessions(session(spark, [("user", "other")]), CONFIG, T2)
    assert [r.transcript for r in table.read().collect()] == ["user: other"]
    fs, path = table._claim(3)
    fs.create(path, False).close()  # of a writer that died
    assert table.release() and not table.release()


def test_blank_delta_writes_nothing(spark):
    table = MemoryTable.create(spark, scratch_path(spark, "blank"), buckets=2, slices=1)
    table.add_sessions(session(spark, [("user", "hello")]), CONFIG, T1)
    before = table._commits().count()
    table.add_events(events(spark, event("s", 7, "user", " \n", "new-id"), event("t", 0, "user", None, "x")), CONFIG, T2)
    assert table._commits().count() == before


def test_unchanged_signatures_are_kept_as_they_are(spark):
    stored = ingest_sessions(session(spark, [("user", "hello")]), CONFIG, T1)
    marked = stored.withColumn("signature", F.transform("signature", lambda _: F.lit(7).cast("long")))
    again = ingest_sessions(session(spark, [("user", "hello")]), CONFIG, T2, marked).first()
    assert set(again.signature) == {7}
    changed = ingest_sessions(session(spark, [("user", "bye")]), CONFIG, T2, marked).first()
    assert set(changed.signature) != {7}


def test_keys_do_not_show_in_plans_or_settings(spark):
    key = bytes(range(32))
    rows = spark.createDataFrame([({"ssn": "1"}, None)], "custom_metadata map<string,string>, secure_metadata map<string,binary>")
    secured = protect.encrypt_fields(rows, {"ssn": crypto.DETERMINISTIC}, key)
    opened = protect.decrypt_fields(secured, ["ssn"], key)
    assert opened.first().ssn == "1"
    used = [key, crypto._derived(key, "encrypt"), crypto._derived(key, "nonce")]
    for df in (secured, opened):
        plan = df._jdf.queryExecution().toString().lower()
        assert not any(k.hex() in plan for k in used) and "redacted" in plan
    spark.conf.set(crypto.KEY_CONF, key.hex())
    shown = " ".join(str(tuple(r)) for r in spark.sql("SET").collect())
    spark.conf.unset(crypto.KEY_CONF)
    assert key.hex() not in shown


class _Handle:
    """State of one key, with the calls that the processor makes."""

    def __init__(self):
        self.ids, self.lines, self.timers, self.value = {}, [], [], []

    def getMapState(self, *_):
        ids = self.ids
        return SimpleNamespace(
            containsKey=lambda k: k in ids, updateValue=lambda k, v: ids.update({k: v}), clear=ids.clear
        )

    def getListState(self, *_):
        lines = self.lines
        return SimpleNamespace(exists=lambda: bool(lines), get=lambda: iter(lines), appendList=lines.extend, clear=lines.clear)

    def getValueState(self, *_):
        value = self.value

        def update(row):
            value[:] = [row]

        return SimpleNamespace(exists=lambda: bool(value), get=lambda: value[0], update=update, clear=value.clear)

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_session_expires_as_a_whole_after_its_last_line():
    handle, processor = _Handle(), SessionTranscripts(ttl_seconds=17)
    processor.init(handle)

    def write(at, *ids):
        rows = pd.DataFrame({"seq": range(len(ids)), "event_id": ids, "author": "user", "text": ids})
        clock = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: at * 1000)
        return [t for out in processor.handleInputRows(("a", "u", "s"), iter([rows]), clock) for t in out.transcript]

    assert write(0, "e0") == ["user: e0"]
    assert write(6, "e1", "e0") == ["user: e0\nuser: e1"]
    assert write(20, "e2") == ["user: e0\nuser: e1\nuser: e2"], "active sessions keep all lines"
    assert handle.timers == [37_000]
    assert write(30, "e2") == [] and handle.timers == [37_000], "known events are no activity"
    assert list(processor.handleExpiredTimer(("a", "u", "s"), None, None)) == []
    assert not handle.ids and not handle.lines and not handle.value
    assert write(50, "e2") == ["user: e2"]


def test_the_distillers_cap_is_an_argument(spark):
    text = "user: " + "x" * 3000
    got = spark.range(1).select(
        F.length(keep_user_lines(F.lit(text))), F.length(keep_user_lines(F.lit(text), cap=10)), F.length(keep_user_lines(F.lit(text), cap=None))
    ).first()
    assert tuple(got) == (2000, 10, 3006)
