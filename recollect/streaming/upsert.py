"""Micro-batches of events into the memory table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recollect.config import SESSION_KEY, MemoryConfig, Now
from recollect.sources.memory_table import MemoryTable



def stream_deltas(
    events: DataFrame,
    table: MemoryTable,
    config: MemoryConfig,
    checkpoint: str,
    name: str = "deltas",
    metadata: Mapping[str, str] | None = None,
    now: Callable[[], Now] = F.current_timestamp,
    **trigger,
) -> StreamingQuery:
    """Appends every micro-batch to its sessions' memories.

    Each batch is one transaction of the table, named by its number: a batch that is
    run again after a failure is recognised and skipped. Known event ids are dropped
    however long ago they were stored, and late events are kept, in arrival order.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            table.add_events(batch, config, now(), metadata, txn=f"{name}:{batch_id}")
        finally:
            batch.unpersist()

    return _start(events, write, checkpoint, name, trigger)


def stream_finished_sessions(
    finished: DataFrame,
    all_events: Callable[[], DataFrame],
    table: MemoryTable,
    config: MemoryConfig,
    checkpoint: str,
    name: str = "sessions",
    now: Callable[[], Now] = F.current_timestamp,
    **trigger,
) -> StreamingQuery:
    """Saves sessions as they finish: a stream of keys picks their events from the log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keys = batch.select(*SESSION_KEY).distinct()
        done = all_events().join(keys, list(SESSION_KEY), "left_semi")
        table.add_sessions(done, config, now(), txn=f"{name}:{batch_id}")

    return _start(finished, write, checkpoint, name, trigger)


def _start(stream: DataFrame, write, checkpoint: str, name: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.queryName(name).trigger(**(trigger or {"availableNow": True})).start()
