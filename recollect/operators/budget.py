"""How many candidates an approximate search needs: where exact hits stand in its order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import TENANT, MemoryConfig
from recollect.functions.signatures import DEFAULT_BITS
from recollect.operators.approximate import with_signature
from recollect.operators.nearest import MEMORY_BLOCK, QUERY_BLOCK, arranged, runs, signs

#: Standard deviations of the confidence bound: 95 % on one side.
DEVIATIONS = 1.6448536269514722
#: Places summed up together before they are put in one order.
PLACES = 1024
_BETWEEN = "\x1f"


def hit_places(
    hits: DataFrame, queries: DataFrame, memories: DataFrame, config: MemoryConfig,
    memory_block: int = MEMORY_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``app_name, user_id, query_id, memory_id, place`` of each of ``hits``: its place among its
    tenant's memories by differing bits, then by id. A budget finds a hit if it is no smaller.

    One pass over the signatures: a task holds the hits of a block and counts, batch by batch,
    the memories that come before each. Hits without a signature have no place and are left out.
    """
    words = (config.signature_bits or DEFAULT_BITS) // 64
    signed = with_signature(memories, config).select(*TENANT, F.col("memory_id").cast("string").alias("memory_id"), "signature")
    asked = with_signature(queries, config).select(*TENANT, F.col("query_id").cast("string").alias("query_id"), F.col("signature").alias("_q"))
    held = hits.select(*TENANT, "query_id", "memory_id").join(asked, [*TENANT, "query_id"]).join(signed, [*TENANT, "memory_id"])
    name = F.concat_ws(_BETWEEN, "query_id", "memory_id").alias("query_id")
    both = held.select(*TENANT, name, F.concat("_q", "signature").alias("signature"))
    rows = arranged(both, signed, "signature", (2 * words, words), memory_block, query_block)
    counted = rows.mapInArrow(lambda batches: _before(batches, words), "app_name string, user_id string, name string, before bigint")
    places = counted.groupBy(*TENANT, "name").agg((F.sum("before") + 1).alias("place"))
    query, memory = (F.element_at(F.split("name", _BETWEEN), k) for k in (1, 2))
    return places.select(*TENANT, query.alias("query_id"), memory.alias("memory_id"), "place")


def _before(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    key, held = None, None
    for batch in batches:
        *keys, kinds, ids, vectors = batch.columns
        kinds = kinds.to_numpy()
        for start, stop in runs([*keys, batch.column(4)]):
            found = tuple(c[start].as_py() for c in keys)
            if found != key:
                if held is not None:
                    yield held.counts(key)
                key, held = found, _Hits(words)
            names = ids.slice(start, stop - start).to_numpy(zero_copy_only=False)
            matrix = vectors.slice(start, stop - start).flatten().to_numpy().reshape(stop - start, -1)
            (held.compare if kinds[start] else held.add)(names, matrix)
    if held is not None:
        yield held.counts(key)


class _Hits:
    """The hits of one block, and how many memories were seen that come before each."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.names: list[str] = []
        self.own_ids = np.zeros(0, object)
        self.signs = np.zeros((0, 64 * words), np.float32)
        self.differing = np.zeros(0)
        self.before = np.zeros(0, np.int64)

    def add(self, names: np.ndarray, matrix: np.ndarray) -> None:
        query, hit = (signs(matrix[:, k : k + self.words]) for k in (0, self.words))
        self.names += names.tolist()
        self.own_ids = np.append(self.own_ids, np.array([name.split(_BETWEEN)[1] for name in names], object))
        self.signs = np.concatenate([self.signs, query])
        self.differing = np.append(self.differing, (query * hit < 0).sum(1))
        self.before = np.zeros(len(self.names), np.int64)

    def compare(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        if not self.names:
            return
        memories = signs(matrix)
        for at in range(0, len(self.names), 1024):
            own = slice(at, at + 1024)
            differing = (self.signs.shape[1] - self.signs[own] @ memories.T) / 2
            limit = self.differing[own, None]
            self.before[own] += (differing < limit).sum(1)
            hit, other = np.nonzero(differing == limit)
            own_ids = self.own_ids[own]
            first = ids[other] < own_ids[hit]  # ties by id
            self.before[own] += np.bincount(hit[first.astype(bool)], minlength=len(own_ids))

    def counts(self, key: tuple) -> pa.RecordBatch:
        n = len(self.names)
        columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.string()), pa.array(self.names, pa.string()), pa.array(self.before)]
        return pa.RecordBatch.from_arrays(columns, ["app_name", "user_id", "name", "before"])


def budget_curve(places: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """``budget, hits, recall, at_least`` for every budget at which one more hit is found.

    ``recall`` is the share of hits at that place or before; ``at_least`` its lower bound by
    Wilson's score interval, hits taken as independent. Places are added up in two levels, so
    that no task sees more than their number divided by PLACES, or PLACES of them.
    """
    each = places.groupBy("place").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.expr(f"place div {PLACES}"))
    blocks = each.groupBy("block").agg(F.sum("n").alias("own"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"), F.sum("own").over(whole).alias("all"))
    within = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = each.withColumn("sum", F.sum("n").over(within)).join(blocks, "block")
    hits, every = F.col("sum") + F.col("before"), F.col("all").cast("double")
    curve = summed.select(F.col("place").alias("budget"), hits.alias("hits"), (hits / every).alias("recall"), every.alias("_n"))
    p, n, z = F.col("recall"), F.col("_n"), float(deviations)
    spread = F.lit(z) * F.sqrt((p * (F.lit(1.0) - p) + F.lit(z * z / 4) / n) / n)
    low = (p + F.lit(z * z / 2) / n - spread) / (F.lit(1.0) + F.lit(z * z) / n)
    return curve.withColumn("at_least", low).drop("_n")


def least_budgets(curve: DataFrame, targets: Sequence[float]) -> DataFrame:
    """``target, budget``: the least budget whose recall is, and the least whose lower bound is
    (``safe_budget``), at least the target; null where none is."""
    rows = [F.struct(F.lit(float(t)).alias("target"), *[
        F.min(F.when(F.col(c) >= t, F.col("budget"))).alias(name) for c, name in (("recall", "budget"), ("at_least", "safe_budget"))
    ]) for t in targets]
    return curve.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
