"""Nearest neighbours within a tenant, without writing out pairs.

Both sides are cut into blocks of (tenant, memory part, query part), shuffled so that
a block lies in one task, and sorted so that a block's queries come before its
memories. Each task then streams through its rows once: it keeps the queries of the
current block and, per query, the best ``k`` so far; every batch of memories is one
matrix product. What leaves the task is at most ``k`` rows per query and block.

A tenant holding a large part of all memories (or of all queries) is cut into many
parts; the other side is repeated for each of them. See :mod:`recollect.operators.skew`
for why the list of such tenants is short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import TENANT
from recollect.functions.vectors import RANK_PLACES
from recollect.operators.skew import heavy_keys

#: A tenant with more memories / queries than this (and a notable share of all) is cut.
MEMORY_BLOCK = 100_000
QUERY_BLOCK = 2_000
#: Blocks smaller than these do not cut a tenant into more parts than this, as each row of the
#: other side is repeated for each part.
PARTS = 8
#: Rows put together before a task hands them back to Spark.
OUT_ROWS = 8_192
#: Scores held at once in a task: queries x memories of one matrix product.
TILE = 4_000_000
OUT_COLUMNS = [*TENANT, "query_id", "memory_id", "similarity"]


def nearest(
    queries: DataFrame,
    memories: DataFrame,
    k: int,
    metric: str,
    length: int,
    vector: str = "embedding",
    memory_block: int = MEMORY_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``app_name, user_id, query_id, memory_id, similarity, rank`` of the best ``k``
    memories per query. Query ids need to be unique within their tenant only.

    Ordered by similarity (rounded, higher is closer), then ``memory_id``. ``metric`` is
    one of the similarity names, or ``hamming`` on signature columns, where the
    similarity is minus the number of differing bits. Rows whose ``vector`` is missing or
    not ``length`` long take no part; they are dropped after counting, so that finding
    the heavy tenants reads (or computes) no vectors.
    """
    stacked = arranged(queries, memories, vector, (length, length), memory_block, query_block)
    best = stacked.mapInArrow(
        lambda batches: _scan(batches, k, metric),
        "app_name string, user_id string, query_id string, memory_id string, similarity double",
    )
    w = Window.partitionBy(*TENANT, "query_id").orderBy(F.desc("similarity"), "memory_id")
    return best.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def arranged(
    queries: DataFrame, memories: DataFrame, vector: str, lengths: tuple[int, int],
    memory_block: int = MEMORY_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``app_name, user_id, _m, _q, _kind, _id, _v``: both sides by block, a block's queries
    (kind 0) before its memories (kind 1), each by id. Rows whose ``vector`` has not the length
    of their side take no part."""
    big_m = F.broadcast(heavy_keys(memories, TENANT, "_mn", memory_block, most=PARTS, usual=MEMORY_BLOCK))
    big_q = F.broadcast(heavy_keys(queries, TENANT, "_qn", query_block, most=PARTS, usual=QUERY_BLOCK))

    block = [*TENANT, "_m", "_q"]

    def blocks(side: DataFrame, kind: int, row_id: str, own: str, other: str) -> DataFrame:
        """Own part by hash of the id; one copy for each part of the other side."""
        rows = side.select(
            *TENANT,
            F.lit(kind).alias("_kind"),
            F.col(row_id).cast("string").alias("_id"),
            F.col(vector).alias("_v"),
        ).filter(F.size("_v") == lengths[kind])
        parts = F.coalesce(F.col(f"{own}n"), F.lit(1))
        copies = F.coalesce(F.col(f"{other}n"), F.lit(1))
        return (
            rows.join(big_m, list(TENANT), "left")
            .join(big_q, list(TENANT), "left")
            .withColumn(own, F.pmod(F.xxhash64("_id"), parts).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1)))
            .select(*block, "_kind", "_id", "_v")
        )

    stacked = blocks(queries, 0, "query_id", "_q", "_m").unionByName(
        blocks(memories, 1, "memory_id", "_m", "_q")
    )
    return stacked.repartition(*block).sortWithinPartitions(*block, "_kind", "_id")


def _scan(batches: Iterator[pa.RecordBatch], k: int, metric: str) -> Iterator[pa.RecordBatch]:
    """One task's arranged rows in, its best candidates out."""
    block, found, rows = None, [], 0
    for batch in batches:
        *keys, kinds, ids, vectors = batch.columns
        kinds = kinds.to_numpy()
        for start, stop in runs([*keys, batch.column(4)]):
            key = tuple(c[start].as_py() for c in keys)
            if block is None or block.key != key:
                if block is not None:
                    found.extend(block.candidates())
                    rows += block.size
                    if rows >= OUT_ROWS:
                        yield from found
                        found, rows = [], 0
                block = _Block(key, k, metric)
            row_ids = ids.slice(start, stop - start).to_numpy(zero_copy_only=False)
            matrix = vectors.slice(start, stop - start).flatten().to_numpy()
            matrix = matrix.reshape(stop - start, -1)
            (block.add_memories if kinds[start] else block.add_queries)(row_ids, matrix)
    if block is not None:
        found.extend(block.candidates())
    yield from found


def runs(columns: list[pa.Array]) -> list[tuple[int, int]]:
    """Stretches of rows over which all columns stay the same."""
    n = len(columns[0])
    if n == 0:
        return []
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for c in columns:
        values = c.to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(change)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), n]))


class _Block:
    """The queries of one block and the best memories seen for each."""

    def __init__(self, key: tuple, k: int, metric: str) -> None:
        self.key, self.k, self.metric = key, k, metric
        self.query_ids: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.best: np.ndarray | None = None  # queries x (up to k) similarities
        self.best_ids: np.ndarray | None = None

    @property
    def size(self) -> int:
        return 0 if self.best is None else self.best.size

    def add_queries(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        self.query_ids.append(ids)
        self.vectors.append(matrix)

    def add_memories(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        if not self.query_ids:
            return
        if self.best is None:
            self.vectors = [_prepare(np.concatenate(self.vectors), self.metric)]
            n = len(self.vectors[0])
            self.best = np.empty((n, 0))
            self.best_ids = np.empty((n, 0), dtype=object)
        memories = _prepare(matrix, self.metric)
        step = max(1, TILE // max(1, len(ids)))
        merged = [
            self._merge(slice(at, at + step), ids, memories)
            for at in range(0, len(self.vectors[0]), step)
        ]
        self.best = np.concatenate([m[0] for m in merged])
        self.best_ids = np.concatenate([m[1] for m in merged])

    def _merge(self, rows: slice, ids: np.ndarray, memories: np.ndarray):
        """Best k of what was kept and the new memories. Memories arrive by id, so a
        stable order leaves the smaller id first among equals."""
        fresh = _similarities(self.vectors[0][rows], memories, self.metric)
        scores = np.concatenate([self.best[rows], fresh], axis=1)
        if scores.shape[1] > self.k:
            cut = -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            r, c = np.nonzero(scores >= cut)
            order = np.lexsort((c, -scores[r, c], r))
            first = np.searchsorted(r[order], np.arange(len(scores)))
            columns = c[order][first[:, None] + np.arange(self.k)]
        else:
            columns = np.argsort(-scores, axis=1, kind="stable")
        kept = self.best_ids.shape[1]
        names = ids[np.maximum(columns - kept, 0)]
        if kept:
            old = np.take_along_axis(self.best_ids[rows], np.minimum(columns, kept - 1), axis=1)
            names = np.where(columns < kept, old, names)
        return np.take_along_axis(scores, columns, axis=1), names

    def candidates(self) -> list[pa.RecordBatch]:
        if self.best is None:
            return []
        width, n = self.best.shape[1], self.best.size
        arrays = [
            pa.array([self.key[0]] * n, pa.string()),
            pa.array([self.key[1]] * n, pa.string()),
            pa.array(np.repeat(np.concatenate(self.query_ids), width), pa.string()),
            pa.array(self.best_ids.ravel(), pa.string()),
            pa.array(self.best.ravel(), pa.float64()),
        ]
        return [pa.RecordBatch.from_arrays(arrays, names=OUT_COLUMNS)]


def _prepare(matrix: np.ndarray, metric: str) -> np.ndarray:
    if metric == "hamming":
        return matrix.view(np.uint64)
    matrix = matrix.astype(np.float64)
    if metric == "cosine":
        size = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.divide(matrix, size, out=np.zeros_like(matrix), where=size > 0)
    return matrix


def _similarities(queries: np.ndarray, memories: np.ndarray, metric: str) -> np.ndarray:
    if metric == "hamming":
        # unpacked to -1 and 1, the product is (equal bits) - (differing bits)
        a, b = signs(queries), signs(memories)
        return ((a @ b.T - a.shape[1]) / 2).astype(np.float64)
    if metric == "euclidean":
        # differences, not the expanded square: that one loses the small distances
        value = np.empty((len(queries), len(memories)))
        step = max(1, TILE // max(1, memories.size))
        for at in range(0, len(queries), step):
            apart = queries[at : at + step, None, :] - memories[None, :, :]
            value[at : at + step] = -np.sqrt(np.einsum("ijk,ijk->ij", apart, apart))
    else:
        value = queries @ memories.T
    return np.round(value, RANK_PLACES)


def signs(words: np.ndarray) -> np.ndarray:
    """64-bit words as rows of -1 and 1."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1)
    return bits.astype(np.float32) * 2 - 1
