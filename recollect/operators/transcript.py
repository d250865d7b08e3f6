"""From chat events to one transcript per session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.config import DEFAULT_EVENT_AUTHOR, DEFAULT_SESSION, SESSION_KEY
from recollect.functions import text as tx

#: Turns joined into one block before blocks are joined into a session.
BLOCK_TURNS = 1024


def segments(events: DataFrame, default_session: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Events with text: key, ``seq``, ``event_id`` ('' if missing), ``author``, ``text``, ``keep``.

    With ``default_session`` a missing session id becomes the tenant's shared one.
    """
    session = F.col("session_id")
    if default_session:
        session = tx.default_if_empty(session, DEFAULT_SESSION)
    raw = events.select(
        "app_name",
        "user_id",
        session.alias("session_id"),
        "seq",
        F.coalesce(F.col("event_id"), F.lit("")).alias("event_id"),
        tx.default_if_empty(F.col("author"), DEFAULT_EVENT_AUTHOR).alias("author"),
        tx.strip(tx.join_parts(F.col("parts"))).alias("text"),
        *keep,
    )
    return raw.filter(F.col("text") != "")


def transcripts(segs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per session: ``transcript``, ``event_ids`` and ``turns``, in ``seq`` order.

    Two levels: turns are gathered per (session, block of turns), then the few block
    texts per session are put together. A session holding a large part of all events
    is thus sorted and joined by many tasks, and only finished strings meet in the
    one row that is its result. ``block_turns=0`` goes straight to the session, which
    saves a shuffle where sessions are known to be short.
    """
    turn = F.struct(
        "seq",
        "event_id",
        F.concat("author", F.lit(": "), "text").alias("line"),
    )

    def gathered(*keys):
        return segs.groupBy(*keys).agg(F.sort_array(F.collect_list(turn)).alias("_turns"))

    pieces = [
        F.array_join("_turns.line", "\n").alias("transcript"),
        F.filter("_turns.event_id", lambda e: e != "").alias("event_ids"),
        F.size("_turns").cast("bigint").alias("turns"),
    ]
    if not block_turns:
        return gathered(*SESSION_KEY).select(*SESSION_KEY, *pieces)

    segs = segs.withColumn("_block", F.floor(F.col("seq") / block_turns))
    blocks = gathered(*SESSION_KEY, "_block").select(*SESSION_KEY, "_block", *pieces)
    block = F.struct("_block", "transcript", "event_ids", "turns")
    return (
        blocks.groupBy(*SESSION_KEY)
        .agg(
            F.sort_array(F.collect_list(block)).alias("_blocks"),
            F.sum("turns").alias("turns"),
        )
        .select(
            *SESSION_KEY,
            F.array_join("_blocks.transcript", "\n").alias("transcript"),
            F.flatten("_blocks.event_ids").alias("event_ids"),
            "turns",
        )
    )
