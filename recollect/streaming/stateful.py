"""Deduplication and transcript per session in streaming state, without reading the table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from recollect.config import SESSION_KEY
from recollect.operators.transcript import segments

OUTPUT = (
    "app_name string, user_id string, session_id string, "
    "transcript string, new_turns bigint, turns bigint"
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Milliseconds of a second.
_MS = 1000


class SessionTranscripts(StatefulProcessor):
    """Keeps the seen event ids and the lines of each session.

    Ids are a map in state, looked up one by one, and lines are appended, so a batch
    costs what it brings plus the one text it emits. With ``ttl_seconds`` a session is
    forgotten as a whole that long after its last new line: each write moves its timer.
    ``time`` names the column that tells when a line was said; without it the clock counts.
    Unless ``whole``, only the new lines are emitted, and lines are neither kept nor read.
    """

    def __init__(
        self, ttl_seconds: int | None = None, dedupe_within_batch: bool = False, time: str | None = None, whole: bool = True
    ) -> None:
        self.ttl_ms = None if ttl_seconds is None else ttl_seconds * _MS
        self.dedupe_within_batch, self.time, self.whole = dedupe_within_batch, time, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "event_id string", "known boolean")
        self.lines = handle.getListState("lines", "line string")
        self.turns = handle.getValueState("turns", "turns bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A stored memory: its ids are known, its text stands in front of the lines to come."""
        for event_ids, transcript in zip(initialState.event_ids, initialState.transcript):
            known = [event_id for event_id in (event_ids if event_ids is not None else []) if event_id]
            for event_id in known:
                self.seen.updateValue((event_id,), (True,))
            if transcript and self.whole:
                self.lines.appendList([(transcript,)])
            self.turns.update((self._turns() + len(known),))
        if self.ttl_ms is not None:
            start = timerValues.getCurrentWatermarkInMs() if self.time else timerValues.getCurrentProcessingTimeInMs()
            self._expire_at(start + self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(["seq", "event_id"], kind="stable")
        lines, ids, batch_ids, last = [], [], set(), None
        times = arrived[self.time] if self.time else [None] * len(arrived)
        for event_id, author, text, said in zip(arrived.event_id, arrived.author, arrived.text, times):
            if event_id:
                if self.seen.containsKey((event_id,)):
                    continue
                if self.dedupe_within_batch and event_id in batch_ids:
                    continue
                batch_ids.add(event_id)
                ids.append(event_id)
            lines.append(f"{author}: {text}")
            last = said if last is None or (said is not None and said > last) else last
        if not lines:
            return
        if self.ttl_ms is not None:
            at = int(last.timestamp() * _MS) if self.time else timerValues.getCurrentProcessingTimeInMs()
            self._expire_at(at + self.ttl_ms)
        for event_id in ids:  # after the loop: repeats inside one batch are kept by default
            self.seen.updateValue((event_id,), (True,))
        turns = self._turns() + len(lines)
        self.turns.update((turns,))
        prior = []
        if self.whole:
            prior = [row[0] for row in self.lines.get()] if self.lines.exists() else []
            self.lines.appendList([(line,) for line in lines])
        yield pd.DataFrame(
            {
                "app_name": [key[0]],
                "user_id": [key[1]],
                "session_id": [key[2]],
                "transcript": ["\n".join(prior + lines)],
                "new_turns": [len(lines)],
                "turns": [turns],
            }
        )

    def _turns(self) -> int:
        return self.turns.get()[0] if self.turns.exists() else 0

    def _expire_at(self, ms: int) -> None:
        """The session's one timer; lines that arrive late do not bring it forward."""
        timers = list(self.handle.listTimers())
        if self.time:
            ms = max([ms, *timers])
        for timer in timers:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No new line for the time to live: the session is gone, its ids too."""
        self.seen.clear()
        self.lines.clear()
        self.turns.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_transcripts(
    events: DataFrame,
    ttl_seconds: int | None = None,
    dedupe_within_batch: bool = False,
    stored: DataFrame | None = None,
    time: str | None = None,
    delay: str = "0 seconds",
    whole: bool = True,
) -> DataFrame:
    """A stream of the sessions changed by each micro-batch, with their whole transcript
    (or, unless ``whole``, their new lines).

    ``stored`` (``app_name, user_id, session_id, event_ids, transcript``) is what is known
    before the stream's first batch, so that it can be begun on an existing table. Without a
    TTL no time mode is set, so no event is ever dropped as late. With a TTL, sessions expire
    by the clock, or, where ``time`` names a timestamp column, once the stream's watermark
    (``delay`` behind the latest) has passed; lines behind the watermark are then dropped. State
    must live in RocksDB (``spark.sql.streaming.stateStore.providerClass``).
    """
    by_time = time if ttl_seconds is not None else None
    segs = segments(events, default_session=True, keep=[by_time] if by_time else [])
    if by_time:
        segs = segs.withWatermark(by_time, delay)
    known = None
    if stored is not None:
        columns = [*SESSION_KEY, "event_ids", "transcript"]
        known = stored.filter("session_id is not null").select(*columns).groupBy(*SESSION_KEY)
    return segs.groupBy(*SESSION_KEY).transformWithStateInPandas(
        statefulProcessor=SessionTranscripts(ttl_seconds, dedupe_within_batch, by_time, whole),
        outputStructType=OUTPUT,
        outputMode="Update",
        timeMode="None" if ttl_seconds is None else "EventTime" if by_time else "ProcessingTime",
        initialState=known,
    )


def state_lines(spark, checkpoint: str) -> DataFrame:
    """``app_name, user_id, session_id, line``: what the state of a stream of whole transcripts
    holds, read from its checkpoint."""
    state = spark.read.format("statestore").option("stateVarName", "lines").load(checkpoint)
    return state.select(*[F.col("key")[c].alias(c) for c in SESSION_KEY], F.col("list_element")["line"].alias("line"))


def without_repeats(events: DataFrame, time: str, delay: str) -> DataFrame:
    """The bounded mode: events with an id only once, as long as repeats come within ``delay``.

    State holds an id for ``delay`` of event time and no longer. Events without an id stay.
    Events further behind the latest one of the batch before last are dropped as late and
    counted (:func:`late_rows`). Streams and tables alike; on a table all repeats go.
    """
    key = F.when(F.coalesce("event_id", F.lit("")) != "", F.col("event_id")).otherwise(F.concat(F.lit("\0"), F.uuid()))
    watched = events.withColumn("_once", key).withWatermark(time, delay)
    names = [*SESSION_KEY, "_once"]
    once = watched.dropDuplicatesWithinWatermark(names) if events.isStreaming else watched.dropDuplicates(names)
    return once.drop("_once")


def late_rows(query: StreamingQuery) -> int:
    """Rows that a stream has dropped because they came behind its watermark, over the
    batches whose progress Spark still keeps (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
