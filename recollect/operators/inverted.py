"""Inverted lists: a search looks into the lists nearest to its query and at nothing else.

Centroids are fitted by k-means on a bounded sample, and every memory gets the number of its
nearest one. The number is a stored column that the files are partitioned by, so a search
reads only the lists that its queries ask for, and compares a query with the memories of
its own tenant in its own lists.

Directions are rounded to whole numbers before anything is fitted or assigned. Sums and
distances are then exact: lists do not depend on how the work was split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.config import TENANT, MemoryConfig
from recollect.operators.nearest import nearest

#: Column and partition name of the list number; a vector without direction is in NO_LIST.
LIST, NO_LIST = "list", -1
#: Vectors the centroids are fitted on per list, lists at most, rounds of k-means, lists that are probed.
SAMPLE_PER_LIST, MOST_LISTS, ROUNDS, PROBES = 64, 4096, 8, 8
#: Steps of a component of a direction, which lies between -1 and 1.
STEPS = 1 << 15
#: Rows compared with all centroids at once.
CHUNK = 2048
_BETWEEN = "\x1f"


def _directions(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a direction, and those rounded."""
    size = np.asarray(column.value_lengths().fill_null(0))
    good = size == dims
    rows = column.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)
    length = np.sqrt((rows * rows).sum(1))
    solid = (length > 0) & np.isfinite(length)
    good[good] = solid
    return good, np.floor(rows[solid] / length[solid, None] * STEPS).astype(np.int64)


def _order(rows: np.ndarray, centroids: np.ndarray, first: int) -> np.ndarray:
    """For each row its ``first`` nearest centroids, ties by number. Whole numbers up to
    2**15 in some thousand dimensions multiply exactly in float64."""
    found = []
    for at in range(0, len(rows), CHUNK):
        part = rows[at : at + CHUNK].astype(np.float64)
        far = (centroids * centroids).sum(1)[None, :] - 2 * (part @ centroids.T.astype(np.float64))
        found.append(np.argsort(far, axis=1, kind="stable")[:, :first])
    return np.concatenate(found) if found else np.zeros((0, first), np.int64)


def _sums(centroids: np.ndarray):
    """A task's number and sum of the vectors next to each centroid."""
    lists, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(lists, np.int64), np.zeros((lists, dims), np.int64)
        for batch in batches:
            _, rows = _directions(batch.column(0), dims)
            own = _order(rows, centroids, 1)[:, 0]
            count += np.bincount(own, minlength=lists)
            np.add.at(total, own, rows)
        used = np.flatnonzero(count)
        flat = pa.array(total[used].ravel())
        ends = pa.array(np.arange(len(used) + 1, dtype=np.int32) * dims)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), pa.ListArray.from_arrays(ends, flat)], ["list", "n", "total"])

    return run


def _sample(memories: DataFrame, config: MemoryConfig, rows: int) -> DataFrame:
    """The vectors with the smallest md5 of their ids: as good as drawn, and always the same."""
    whole = memories.filter(F.size("embedding") == config.dimensions)
    return whole.orderBy(F.md5(F.col("memory_id").cast("string")), "memory_id").select("embedding").limit(rows)


def fit_centroids(
    memories: DataFrame, config: MemoryConfig, lists: int, rounds: int = ROUNDS, per_list: int = SAMPLE_PER_LIST
) -> np.ndarray:
    """Up to ``lists`` centroids (at most MOST_LISTS), from ``lists * per_list`` vectors.

    The first ones of the sample are where k-means begins. A round is one job over the
    sample; a centroid moves to the mean of its vectors, rounded down, and stays where it is
    without any.
    """
    lists = max(1, min(lists, MOST_LISTS))
    drawn = _sample(memories, config, lists * per_list).persist()
    try:
        first = drawn.limit(lists).collect()
        _, centroids = _directions(pa.array([r.embedding for r in first], pa.list_(pa.float64())), config.dimensions)
        for _ in range(rounds if len(centroids) else 0):
            sums = drawn.mapInArrow(_sums(centroids), "list long, n long, total array<bigint>")
            sums = sums.select("list", "n", F.posexplode("total").alias("d", "x")).groupBy("list", "d").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
            moved = centroids.copy()
            for r in sums.collect():  # lists x dimensions numbers
                moved[r["list"], r.d] = r.x // r.n
            if (moved == centroids).all():
                break
            centroids = moved
        return centroids
    finally:
        drawn.unpersist()


def nearest_lists(vector: Column, centroids: np.ndarray, dims: int, probes: int = 1) -> Column:
    """``array<int>`` of the ``probes`` nearest lists; NO_LIST alone without a direction."""

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        good, rows = _directions(column, dims)
        first = min(probes, len(centroids))
        found = _order(rows, centroids, first) if first else np.zeros((len(rows), 0), np.int64)
        size = np.where(good & (first > 0), first, 1)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        flat = np.full(ends[-1], NO_LIST, np.int32)
        if first:
            flat[np.repeat(good, size)] = found.ravel()
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return run(vector)


class InvertedLists:
    """Vectors of memories in folders by list, and the centroids beside them."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        stored = spark.read.parquet(f"{self.path}/centroids").orderBy(LIST).collect()  # MOST_LISTS rows at most
        self.centroids = np.array([r.centroid for r in stored], np.int64) if stored else np.zeros((0, 0), np.int64)

    @classmethod
    def create(cls, memories: DataFrame, path: str, config: MemoryConfig, lists: int, **fit) -> InvertedLists:
        """Fit centroids on ``memories`` and file them all."""
        spark, path = memories.sparkSession, path.rstrip("/")
        centroids = fit_centroids(memories, config, lists, **fit)
        rows = [(k, c.tolist()) for k, c in enumerate(centroids)]
        spark.createDataFrame(rows, f"{LIST} int, centroid array<bigint>").coalesce(1).write.parquet(f"{path}/centroids")
        made = cls(spark, path)
        made.add(memories, config)
        return made

    def add(self, memories: DataFrame, config: MemoryConfig) -> None:
        """File more memories; the centroids stay. A list too large for one task is split."""
        number = nearest_lists(F.col("embedding"), self.centroids, config.dimensions)[0]
        rows = memories.select(*TENANT, F.col("memory_id").cast("string").alias("memory_id"), "embedding", number.alias(LIST))
        rows = rows.hint("rebalance", LIST).sortWithinPartitions(LIST, *TENANT, "memory_id")
        rows.write.mode("append").partitionBy(LIST).parquet(f"{self.path}/vectors")

    def read(self) -> DataFrame:
        columns = f"app_name string, user_id string, memory_id string, embedding array<float>, {LIST} int"
        return self.spark.read.schema(columns).parquet(f"{self.path}/vectors")

    def top_k(self, queries: DataFrame, config: MemoryConfig, probes: int = PROBES) -> DataFrame:
        """Like an exact search (``nearest``), but only in the ``probes`` lists nearest to each
        query, and among the vectors without direction, which have no list. A query without
        direction meets these alone.

        A tenant's part of a list is a block of its own, cut further where it is heavy.
        """
        lists = nearest_lists(F.col("embedding"), self.centroids, config.dimensions, probes)
        asked = queries.select(*TENANT, F.col("query_id").cast("string"), "embedding", lists.alias("_lists"))
        asked = asked.withColumn(LIST, F.explode(F.array_union("_lists", F.array(F.lit(NO_LIST))))).drop("_lists")
        wanted = [r[0] for r in asked.select(LIST).distinct().collect()]  # numbers of lists
        held = self.read().filter(F.col(LIST).isin(wanted))
        part = F.concat_ws(_BETWEEN, F.col("user_id"), F.col(LIST).cast("string")).alias("user_id")
        hits = nearest(
            asked.select("app_name", part, "query_id", "embedding"), held.select("app_name", part, "memory_id", "embedding"),
            config.search_limit, config.similarity, config.dimensions,
        )
        owner = F.regexp_extract("user_id", f"(?s)^(.*){_BETWEEN}-?\\d+$", 1)
        w = Window.partitionBy(*TENANT, "query_id").orderBy(F.desc("similarity"), "memory_id")
        ranked = hits.withColumn("user_id", owner).withColumn("rank", F.row_number().over(w).cast("bigint"))
        return ranked.filter(F.col("rank") <= config.search_limit)
