"""A text classifier of learned subword vectors.

Words and character n-grams are hashed to vectors, a text is the mean of its vectors, and a
softmax layer stands on top; all of it is learned by stochastic gradient descent. As the
layer is linear in the mean, a trained model comes down to one number per bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import arrays

#: Buckets for words and n-grams together, dimensions, sizes of the n-grams in bytes.
BUCKETS, DIMS, GRAMS = 1 << 16, 16, (3, 5)
#: Labelled texts that a model is fitted on at most, drawn by a hash of the id. This bounds
#: what the driver holds; nothing else depends on it.
SAMPLE = 4000
EPOCHS, RATE, SEED = 8, 4.0, 17


def _features(data: np.ndarray, bounds: np.ndarray):
    """For each kind of feature its buckets in order and how many stand before each text."""
    starts, ends, first = arrays.words(data, bounds)
    yield (arrays.hashes(data, starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64), first
    for size in GRAMS:
        count = len(data) - size + 1
        if count <= 0:
            yield np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
            continue
        code = np.zeros(count, np.uint32)
        for step in range(size):
            code = code * np.uint32(0x01000193) + data[step : step + count]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        bucket = (code >> np.uint32(16)).astype(np.int64) ^ size
        inside = np.ones(count, bool)  # an n-gram lies in one text
        for border in bounds[1:-1]:
            inside[max(0, border - size + 1) : border] = False
        upto = np.concatenate([[0], np.cumsum(inside)])
        yield bucket[inside], upto[np.minimum(bounds, count)]


def _sparse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct buckets of each text and their shares."""
    found = []
    for data, bounds in arrays.pieces(pa.array(texts, pa.string())):
        kinds = list(_features(data, bounds))
        for k in range(len(bounds) - 1):
            own = np.concatenate([bucket[first[k] : first[k + 1]] for bucket, first in kinds])
            distinct, times = np.unique(own, return_counts=True)
            found.append((distinct, (times / max(len(own), 1)).astype(np.float32)))
    return found


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """The weight of each bucket and the bias, for the log odds of label 1.

    Without texts of both labels the weights are 0 and the bias says what there is.
    """
    n, ones = len(labels), sum(labels)
    if not ones or ones == n:
        return np.zeros(BUCKETS, np.float32), float(np.log((ones + 1) / (n - ones + 1)))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    layer, bias = np.zeros((DIMS, 2), np.float32), np.zeros(2, np.float32)
    inputs = _sparse(texts)
    steps, done = EPOCHS * n, 0
    for _ in range(EPOCHS):
        for k in rng.permutation(n):
            rate = RATE * (1 - done / steps)
            done += 1
            buckets, share = inputs[k]
            own = vectors[buckets]
            mean = share @ own
            odds = mean @ layer + bias
            p = np.exp(odds - odds.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = layer @ p
            layer -= 0.1 * rate * np.outer(mean, p)
            bias -= 0.01 * rate * p
            vectors[buckets] = own - (rate * len(buckets) ** 0.5) * share[:, None] * back
    weight = vectors @ (layer[:, 1] - layer[:, 0])
    return weight.astype(np.float32), float(bias[1] - bias[0])


def _scores(data: np.ndarray, bounds: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    total, number = np.zeros(len(bounds) - 1), np.zeros(len(bounds) - 1)
    for bucket, first in _features(data, bounds):
        sums = np.concatenate([[0.0], np.cumsum(weight[bucket], dtype=np.float64)])
        total += sums[first[1:]] - sums[first[:-1]]
        number += np.diff(first)
    return 1 / (1 + np.exp(-(total / np.maximum(number, 1) + bias)))


def held_out(id_column: Column) -> Column:
    """The fold that a model may not learn from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str) -> DataFrame:
    """``text, label`` of at most SAMPLE labelled rows outside the held-out fold."""
    known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))).distinct()
    drawn = known.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    own = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].cast("string").alias("text"))
    # SAMPLE rows of two numbers: safe to broadcast
    joined = own.join(F.broadcast(drawn), "id").orderBy(F.xxhash64("id"), "id", "text").limit(SAMPLE)
    return joined.select(F.coalesce("text", F.lit("")).alias("text"), "label")


def quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    The model learns from labelled rows outside the held-out fold, and sees texts only. A
    null or empty text has the score of the bias. A null id is not held out and never learned
    from. Rows that repeat a labelled id are learned from each, within the bound. Without
    labels every score is 0.5. Repeated rows are rows of their own; other columns are not
    looked at.
    """
    rows = training_texts(docs, labels, id_col, text, label).collect()
    weight, bias = fit([r["text"] for r in rows], [r["label"] for r in rows])
    model = docs.sparkSession.sparkContext.broadcast((weight, bias))  # one number per bucket

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        parts = [_scores(*piece, *model.value) for piece in arrays.pieces(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    own = docs[f"`{id_col}`"]
    scored = docs.select(own, held_out(own).alias("held_out"), run(docs[f"`{text}`"].cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
