"""Settings shared by ingest, search and retention."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column

# Defaults and enums a caller of the original service relies on.
DOCUMENT_INPUT = "document"
QUERY_INPUT = "query"
SIMILARITIES = ("cosine", "euclidean", "dotProduct")
DEFAULT_DIMENSIONS = 1024
DEFAULT_SEARCH_LIMIT = 5
DEFAULT_CANDIDATES_MULTIPLIER = 20
DEFAULT_MEMORY_AUTHOR = "memory"
DEFAULT_SESSION = "_default"
DEFAULT_EVENT_AUTHOR = "unknown"
SOURCE_SESSION = "add_session_to_memory"
SOURCE_EVENTS = "add_events_to_memory"
SOURCE_DIRECT = "add_memory"

TENANT = ("app_name", "user_id")
SESSION_KEY = ("app_name", "user_id", "session_id")

#: (text column, input type) -> vector column
Embedder = Callable[[Column, str], Column]
#: a point in time
Now = Column | datetime | str
#: raw transcript column -> distilled column
Distiller = Callable[[Column], Column]


@dataclass(frozen=True)
class MemoryConfig:
    """One memory service's settings; every job takes one of these."""

    embedder: Embedder | None = None
    distiller: Distiller | None = None
    dimensions: int = DEFAULT_DIMENSIONS
    similarity: str = "cosine"
    search_limit: int = DEFAULT_SEARCH_LIMIT
    candidates_multiplier: int = DEFAULT_CANDIDATES_MULTIPLIER
    memory_author: str = DEFAULT_MEMORY_AUTHOR
    ttl_seconds: int | None = None
    dedupe_within_batch: bool = False
    strict_embedding: bool = True
    signature_bits: int | None = 256
    #: Tasks to embed in. Left open, Spark sizes tasks by bytes, which is too coarse for a
    #: slow model: 64 MB of text are one task.
    embed_partitions: int | None = None

    def __post_init__(self) -> None:
        if self.embedder is None:
            raise ValueError("an embedder is required; see recollect.operators.embedding")
        if self.similarity not in SIMILARITIES:
            raise ValueError(f"similarity must be one of {SIMILARITIES}, got {self.similarity!r}")
        if self.search_limit < 1:
            raise ValueError("search_limit must be at least 1")
        if self.dimensions < 1:
            raise ValueError("dimensions must be at least 1")
        if self.embed_partitions is not None and self.embed_partitions < 1:
            raise ValueError("embed_partitions must be at least 1")
        if self.ttl_seconds is not None and self.ttl_seconds < 0:
            raise ValueError("ttl_seconds must not be negative")

    @property
    def num_candidates(self) -> int:
        """Candidate budget of an approximate search; never below the limit."""
        return max(self.search_limit, self.search_limit * max(1, self.candidates_multiplier))
