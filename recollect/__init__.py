"""Long-term conversation memory at table scale, expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

from recollect.config import MemoryConfig
from recollect.operators.embedding import batch_embedder, column_embedder, hashing_embedder
from recollect.operators.ingest import apply_delta, ingest_sessions, insert_memories
from recollect.operators.search import search, search_memory
from recollect.sources.memory_table import MemoryTable

__all__ = [
    "MemoryConfig",
    "MemoryTable",
    "apply_delta",
    "batch_embedder",
    "column_embedder",
    "hashing_embedder",
    "ingest_sessions",
    "insert_memories",
    "search",
    "search_memory",
]

# Functions that run on executors travel with the job, so the package need not be
# installed (or be on the path) there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
