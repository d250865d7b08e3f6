"""Writing memories: whole sessions, deltas of events, and ready-made entries.

Each job takes the stored memories (or none) and returns what should be stored
afterwards; :class:`recollect.sources.memory_table.MemoryTable` does the writing.
``now`` is always given by the caller, so that a job can be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect import schema
from recollect.config import (
    DOCUMENT_INPUT,
    SESSION_KEY,
    SOURCE_DIRECT,
    SOURCE_EVENTS,
    SOURCE_SESSION,
    MemoryConfig,
    Now,
)
from recollect.functions import text as tx
from recollect.functions.maps import STRING_MAP, literal_map, merge_maps
from recollect.functions.signatures import signature
from recollect.functions.typed import is_typed, merge_typed, typed_map
from recollect.operators import embedding as em
from recollect.operators.distill import distill
from recollect.operators.transcript import segments, transcripts

MEMORY_COLUMNS = schema.MEMORIES.fieldNames()


def key_of(*parts: Column | str) -> Column:
    """A digest of the parts. Each is written with its length, so that no two different
    keys come together whatever characters they hold; a null part is not an empty one."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    written = [F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*written), 256)


def session_memory_id(session: Column | None = None) -> Column:
    """Key of a session's one memory."""
    session = F.col("session_id") if session is None else session
    return key_of("app_name", "user_id", session)


def _vectorise(df: DataFrame, config: MemoryConfig, vector: Column, kept: str | None = None) -> DataFrame:
    """Adds ``embedding`` and ``signature``, and settles the column order. A signature in
    the column ``kept`` is taken as it is."""
    df = em.check_vectors(df.withColumn("embedding", vector), config)
    if config.signature_bits:
        sig = signature(F.col("embedding"), config.dimensions, config.signature_bits)
        if kept:
            sig = F.when(F.size(kept) == config.signature_bits // 64, F.col(kept)).otherwise(sig)
    else:
        sig = F.lit(None).cast("array<bigint>")
    return df.withColumn("signature", sig).select(*MEMORY_COLUMNS)


def _spread(df: DataFrame, config: MemoryConfig) -> DataFrame:
    """By ``memory_id`` into as many tasks as embedding should have; a join on that key
    then needs no shuffle of its own."""
    if config.embed_partitions is None:
        return df
    return df.repartition(config.embed_partitions, "memory_id")


def session_updates(events: DataFrame, config: MemoryConfig) -> DataFrame:
    """What ingesting whole sessions sets: text, ids, source. Sessions without text vanish."""
    done = distill(transcripts(segments(events)), config.distiller)
    return done.select(
        session_memory_id().alias("memory_id"),
        *SESSION_KEY,
        F.col("stored_text").alias("transcript"),
        "event_ids",
        F.lit(SOURCE_SESSION).alias("source"),
        F.lit(None).cast(STRING_MAP).alias("custom_metadata"),
    )


def new_segments(segs: DataFrame, stored: DataFrame, dedupe_within_batch: bool = False) -> DataFrame:
    """Segments whose event id is not stored yet; those without an id always stay.

    Stored ids are unfolded only for the sessions present in ``segs``. The event id is
    part of the join key, so one long session spreads over many tasks; segments without
    an id get a key of their own and spread as well.
    """
    has_id = F.col("event_id") != ""
    keyed = segs.withColumn("_has_id", has_id).withColumn(
        "_id", F.when(has_id, F.col("event_id")).otherwise(F.col("seq").cast("string"))
    )
    touched = segs.select(*SESSION_KEY).distinct()
    known = (
        stored.filter(F.col("session_id").isNotNull())
        .select(*SESSION_KEY, "event_ids")
        .join(touched, list(SESSION_KEY), "left_semi")
        .select(*SESSION_KEY, F.explode("event_ids").alias("_id"))
        .withColumn("_has_id", F.lit(True))
    )
    on = [*SESSION_KEY, "_has_id", "_id"]
    fresh = keyed.join(known, on, "left_anti")
    if dedupe_within_batch:
        first = F.min(F.struct("seq", "event_id", "author", "text")).alias("_first")
        once = fresh.filter("_has_id").groupBy(*on).agg(first).select(*SESSION_KEY, "_first.*")
        fresh = once.unionByName(fresh.filter("not _has_id").select(*once.columns))
    return fresh.select(*segs.columns)


def delta_updates(
    events: DataFrame,
    stored: DataFrame,
    config: MemoryConfig,
    metadata: Mapping[str, str] | None = None,
) -> DataFrame:
    """What appending events adds: new text and ids. Only the new text is distilled; a
    session all of whose events are known does not appear, and so stays as it is."""
    segs = segments(events, default_session=True)
    fresh = new_segments(segs, stored, config.dedupe_within_batch)
    return distill(transcripts(fresh), config.distiller).select(
        session_memory_id().alias("memory_id"),
        *SESSION_KEY,
        F.col("stored_text").alias("transcript"),
        "event_ids",
        F.lit(SOURCE_EVENTS).alias("source"),
        literal_map(metadata).alias("custom_metadata"),
    )


def upsert(
    stored: DataFrame | None,
    updates: DataFrame,
    config: MemoryConfig,
    now: Now,
    append: bool = False,
) -> DataFrame:
    """All memories after applying ``updates``, keyed by ``memory_id``, in one join.

    Updated rows take every field of the update, except that ``created_at`` is kept
    from the first write and ``custom_metadata`` is replaced only by a non-empty map.
    With ``append``, text and ids go behind what is stored. Rows whose text did not
    change keep their vector: the embedder sees null for them.
    """
    now = tx.moment(now)
    if stored is None:
        fresh = _spread(updates, config).select(
            "*",
            F.lit(config.memory_author).alias("author"),
            F.lit(None).cast("map<string,binary>").alias("secure_metadata"),
            now.alias("created_at"),
            now.alias("updated_at"),
        )
        return _vectorise(fresh, config, em.embed_column(config, F.col("transcript"), DOCUMENT_INPUT))

    u, s = _spread(updates, config).alias("u"), _spread(stored, config).alias("s")
    hit = F.col("u.memory_id").isNotNull()

    text, ids = F.col("u.transcript"), F.col("u.event_ids")
    if append:
        text = tx.append_text(F.col("s.transcript"), text)
        known = F.coalesce(F.array_distinct("s.event_ids"), F.array().cast("array<string>"))
        ids = F.concat(known, ids)

    def pick(name: str, new: Column | None = None) -> Column:
        new = F.col(f"u.{name}") if new is None else new
        return F.when(hit, new).otherwise(F.col(f"s.{name}")).alias(name)

    same = text.eqNullSafe(F.col("s.transcript")) & F.col("s.embedding").isNotNull()
    changed = hit & ~same
    metadata = F.when(F.size("u.custom_metadata") > 0, F.col("u.custom_metadata")).otherwise(
        F.col("s.custom_metadata")
    )
    merged = u.join(s, F.col("u.memory_id") == F.col("s.memory_id"), "full_outer").select(
        F.coalesce("u.memory_id", "s.memory_id").alias("memory_id"),
        *[pick(c) for c in (*SESSION_KEY, "source")],
        pick("transcript", text),
        pick("event_ids", ids),
        pick("author", F.lit(config.memory_author)),
        metadata.alias("custom_metadata"),
        F.col("s.secure_metadata").alias("secure_metadata"),
        F.coalesce("s.created_at", now).alias("created_at"),
        pick("updated_at", now),
        F.when(changed, text).alias("_to_embed"),
        F.when(~changed, F.col("s.embedding")).alias("_kept"),
        F.when(~changed, F.col("s.signature")).alias("_signature"),
    )
    vector = F.coalesce(em.embed_column(config, F.col("_to_embed"), DOCUMENT_INPUT), F.col("_kept"))
    return _vectorise(merged, config, vector, "_signature")


def ingest_sessions(
    events: DataFrame, config: MemoryConfig, now: Now, stored: DataFrame | None = None
) -> DataFrame:
    """Whole sessions replace the text and ids of their memories."""
    return upsert(stored, session_updates(events, config), config, now)


def apply_delta(
    events: DataFrame,
    config: MemoryConfig,
    now: Now,
    stored: DataFrame,
    metadata: Mapping[str, str] | None = None,
) -> DataFrame:
    """New events are appended to the text and ids of their sessions' memories."""
    updates = delta_updates(events, stored, config, metadata)
    return upsert(stored, updates, config, now, append=True)


def insert_memories(
    entries: DataFrame,
    config: MemoryConfig,
    now: Now,
    metadata: Mapping[str, object] | None = None,
    entry_id: Column | None = None,
) -> DataFrame:
    """Independent memories, never distilled and never merged; blank entries are skipped.

    ``entry_id`` is a key of the entry that stays the same if a task is run again;
    without one each row gets a random key. Metadata may be strings or variants
    (:mod:`recollect.functions.typed`), which keep their types.
    """
    now = tx.moment(now)
    if is_typed(entries, "custom_metadata"):
        given = merge_typed(F.col("custom_metadata"), typed_map(metadata or {}))
    else:
        given = merge_maps(F.col("custom_metadata"), literal_map(metadata))
    key = F.uuid() if entry_id is None else key_of(F.lit(SOURCE_DIRECT), entry_id.cast("string"))
    rows = entries.select(
        key.alias("memory_id"),
        "app_name",
        "user_id",
        F.lit(None).cast("string").alias("session_id"),
        tx.strip(tx.join_parts(F.col("parts"))).alias("transcript"),
        F.lit(None).cast("array<string>").alias("event_ids"),
        tx.default_if_empty(F.col("author"), config.memory_author).alias("author"),
        F.lit(SOURCE_DIRECT).alias("source"),
        given.alias("custom_metadata"),
        F.lit(None).cast("map<string,binary>").alias("secure_metadata"),
        now.alias("created_at"),
        now.alias("updated_at"),
    ).filter(F.col("transcript") != "")
    # embedding costs far more than moving its text, so first spread the rows evenly
    rows = _spread(rows, config) if config.embed_partitions else rows.repartition("memory_id")
    return _vectorise(rows, config, em.embed_column(config, F.col("transcript"), DOCUMENT_INPUT))
