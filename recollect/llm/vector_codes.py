"""Vector codes: each part of a vector as the number of its nearest codebook entry.

The entries of a codebook hang in a GNAT (geometric near-neighbour access tree): a node has
split points, its other entries belong to their nearest split point, and for each pair of
split point and child the range of distances between them is stored. A query that measured
the split points leaves out each child whose range it cannot reach. All decisions about
distances are made in integers; square roots only exclude, and are widened before they do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm.store import stored

#: Parts of a vector, entries of a codebook, rounds of moving the entries, scale of components.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Split points of a node; as many entries and a half are a leaf.
SPLITS = 16
#: By how much roots are widened: their own error is near 2e-16.
SLACK = 1e-12
#: Components of this size and more count as not finite (float32 has none).
LARGEST = 2.0**128
#: Bits of a limb of a sum, and limbs: 2**138 times the rows of a task fits.
LIMB, LIMBS = 40, 5
#: Up to so many labels their sums are broadcast; more are joined by shuffle, in SALTS pieces.
BROADCAST_LABELS, SALTS = 100_000, 32
#: Vectors worked on at once.
CHUNK = 4096


def _bound(x: np.ndarray, y: np.ndarray) -> int:
    """No squared distance, nor a term of one, is larger."""
    top = max(int(abs(x).max(initial=0)), int(abs(y).max(initial=0)))
    return 4 * x.shape[1] * top * top


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All squared distances between integer rows of ``x`` and ``y``, exact."""
    if not x.shape[1] or not len(x) or not len(y):
        return np.zeros((len(x), len(y)), np.int64)
    bound = _bound(x, y)
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
    x, y = x.astype(kind), y.astype(kind)
    found = (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)[None, :]
    return found if kind is object else found.astype(np.int64)


def _roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


@dataclass
class Node:
    """``entries`` are measured; each child with the distance ranges from them to its entries."""

    entries: np.ndarray
    children: list[tuple[np.ndarray, np.ndarray, Node]]


class Gnat:
    """Exact nearest entries; ties go to the lower number."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.top = self._grown(np.arange(len(points)))

    def _grown(self, members: np.ndarray) -> Node:
        if len(members) <= SPLITS * 3 // 2:
            return Node(members, [])
        to = squared(self.points[members], self.points[members[:1]])
        while to.shape[1] < SPLITS and (far := to.min(1)).any():  # the entry farthest from all split points
            to = np.hstack([to, squared(self.points[members], self.points[members[[far.argmax()]]])])
        splits = np.unique((to == 0).argmax(0))
        if len(splits) < 2:  # all alike
            return Node(members, [])
        to = squared(self.points[members], self.points[members[splits]])
        owner = to.argmin(1)
        owner[splits] = -1
        children = []
        for j in range(len(splits)):
            own = np.flatnonzero(owner == j)
            if len(own):
                reach = _roots(to[own])
                children.append((reach.min(0) * (1 - SLACK), reach.max(0) * (1 + SLACK), self._grown(members[own])))
        return Node(members[splits], children)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row the entry and the squared distance, and how many distances it took."""
        best, entry = squared(queries, self.points[:1])[:, 0], np.zeros(len(queries), np.int64)
        if _bound(queries, self.points) >= 1 << 63:
            best = best.astype(object)
        return entry, best, self._search(self.top, np.arange(len(queries)), queries, entry, best)

    def _search(self, node: Node, rows: np.ndarray, queries: np.ndarray, entry: np.ndarray, best: np.ndarray) -> int:
        found = squared(queries[rows], self.points[node.entries])
        least = found.argmin(1)  # entries are in ascending order, so a tie gives the lowest
        d, number = found[np.arange(len(rows)), least], node.entries[least]
        d = d.astype(best.dtype)
        better = (d < best[rows]) | ((d == best[rows]) & (number < entry[rows]))
        best[rows[better]], entry[rows[better]] = d[better], number[better]
        measured, reach = found.size, _roots(found)
        for low, high, child in node.children:
            radius = _roots(best[rows]) * (1 + SLACK)
            beyond = (reach * (1 - SLACK) - radius[:, None] > high) | (low - reach * (1 + SLACK) > radius[:, None])
            left = rows[~beyond.any(1)]
            if len(left):
                measured += self._search(child, left, queries, entry, best)
        return measured


def _integers(column: pa.Array, size: int) -> np.ndarray:
    """Rows of ``floor(SCALE * x)``; multiplying by a power of two is exact."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)
    scaled = np.floor(flat * SCALE)
    if np.abs(scaled).max(initial=0) < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)


def _cuts(size: int) -> list[slice]:
    edges = [k * size // PARTS for k in range(PARTS + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _partial_sums(trees: list[Gnat], size: int):
    """A task's sums for each used component of each codebook: slot, count, limbs."""
    cuts, entries = _cuts(size), len(trees[0].points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(entries, np.int64) for _ in cuts]
        sums = [np.zeros((entries, cut.stop - cut.start), object) for cut in cuts]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = _integers(batch.column(0).slice(at, CHUNK), size)
                for cut, tree, count, total in zip(cuts, trees, counts, sums):
                    entry = tree.nearest(rows[:, cut])[0]
                    order = np.argsort(entry, kind="stable")
                    used, heads = np.unique(entry[order], return_index=True)
                    kind = np.int64 if rows.dtype != object and np.abs(rows).max(initial=0) < 1 << 50 else object
                    if total.shape[1]:
                        total[used] += np.add.reduceat(rows[order][:, cut].astype(kind), heads, axis=0).astype(object)
                    count += np.bincount(entry, minlength=entries)
        slots, numbers, limbs = [], [], []
        for part, (cut, count, total) in enumerate(zip(cuts, counts, sums)):
            for e in np.flatnonzero(count).tolist():
                for c, value in enumerate(total[e].tolist()):
                    slots.append(e * size + cut.start + c)
                    numbers.append(int(count[e]))
                    limbs.append([(value >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(LIMBS - 1)] + [value >> (LIMB * (LIMBS - 1))])
        columns = [pa.array(slots, pa.int64()), pa.array(numbers, pa.int64())]
        columns += [pa.array([row[k] for row in limbs], pa.int64()) for k in range(LIMBS)]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", *(f"l{k}" for k in range(LIMBS))])

    return run


def _moved(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (one row per entry, parts side by side) after one round."""
    size = books.shape[1]
    trees = [Gnat(books[:, cut]) for cut in _cuts(size)]
    schema = "slot long, n long, " + ", ".join(f"l{k} long" for k in range(LIMBS))
    sums = kept.select("embedding").mapInArrow(_partial_sums(trees, size), schema).groupBy("slot").agg(
        F.sum("n").alias("n"), *[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)]
    )
    moved = books.astype(object)
    for row in sums.collect():  # one row per component of an entry, whatever the table's size
        value = sum(row[f"l{k}"] << (LIMB * k) for k in range(LIMBS))
        moved[divmod(row.slot, size)] = value // row.n
    top = max((abs(v) for v in moved.ravel().tolist()), default=0)
    return moved.astype(np.int64) if top < 1 << 62 else moved


def _coder(books: np.ndarray):
    """Column functions' work: the code of each vector and its error."""
    size = books.shape[1]
    cuts = _cuts(size)
    trees = [Gnat(books[:, cut]) for cut in cuts]

    @F.arrow_udf("struct<code:string, error:long>")
    def run(column: pa.Array) -> pa.Array:
        codes, errors = [], []
        for at in range(0, len(column), CHUNK):
            rows = _integers(column.slice(at, CHUNK), size)
            found = [tree.nearest(rows[:, cut]) for cut, tree in zip(cuts, trees)]
            number = np.stack([f[0] for f in found], 1).astype(np.uint8).tobytes().hex()
            codes += [number[k : k + 2 * PARTS] for k in range(0, len(number), 2 * PARTS)]
            for each in zip(*(f[1].tolist() for f in found)):
                error = int(sum(each))
                errors.append(error if error < 1 << 63 else None)
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["code", "error"])

    return run


def codebooks(kept: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """One row per entry, the parts side by side, after ``rounds`` passes over ``kept``
    (``vec_id, embedding`` as ``kept_vectors`` gives them)."""
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    size = len(first[0].embedding) if first else 0
    books = _integers(pa.array([row.embedding for row in first], pa.list_(pa.float64())), size) if first else np.zeros((0, 0), np.int64)
    for _ in range(rounds if first else 0):
        books = _moved(kept, books)
    return books


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, embedding, label`` of the rows whose vector has finite components only, and as
    many as that of the smallest id has."""
    x = F.col("embedding")
    plain = vectors.select(
        vectors[f"`{id_col}`"].alias("vec_id"), vectors[f"`{column}`"].alias("embedding"), vectors[f"`{label}`"].alias("label")
    )
    kept = plain.filter(x.isNotNull() & F.forall(x, lambda v: F.coalesce(F.abs(v) < F.lit(LARGEST), F.lit(False))))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select(F.size(x).alias("n")).first()
    return kept.filter(F.size(x) == F.lit(first.n)) if first else kept


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every usable row of ``vectors``.

    Components become ``floor(1024 * x)``; a vector's PARTS equal parts (one component more or
    less, where its length does not divide) have a codebook each, which starts as the parts of
    the ENTRIES smallest ids (of all, if there are fewer; equal ids by their vectors) and moves
    for ROUNDS rounds to the floors of its members' means. ``error`` is the sum of the squared
    distances to the entries, ``label_error`` its sum over rows of equal label (null is a
    label). Rows go whose vector is null, holds a null or a component that is not finite
    (2**128 and more counts as such), or is of another length than that of the smallest id.
    An error that a long cannot hold is null, and so is a label's sum; rows that repeat an id
    are rows of their own; an empty table gives none. Other columns are not looked at.
    """
    kept = kept_vectors(vectors, id_col, column, label)
    books = codebooks(kept)
    flat = [str(v) for cut in _cuts(books.shape[1]) for v in books[:, cut].ravel().tolist()]
    digest = hashlib.sha256(",".join(flat).encode()).hexdigest()
    if not len(books):
        coded = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = kept.select("vec_id", "label", _coder(books)("embedding").alias("c")).select("vec_id", "label", "c.*")
    coded = stored(coded, "codes")
    sums = stored(coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error")), "labels")
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= BROADCAST_LABELS:
        both = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left")
    else:  # a label may hold a third of the rows: its rows go to SALTS tasks, its sum to each of them
        salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
        sums = sums.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = salted.join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("piece")), "left")
    return both.select(F.col("vec_id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
