"""Similarity links inside banded buckets, and connected components.

A bucket is never expanded into pairs. Its rows are first compared with one centre (a
star). Rows of a bucket that then lie in different components are compared in blocks, each
pair of blocks in a task of its own, until every two of them have been: nothing is left
unchecked. Sets are compared in Arrow batches; what leaves a task are links that join
components, fewer than its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm.store import discard, spread, stored, unsized

#: Rows of a block on either side, and shingles that they have together at most (on average).
OPEN, WHOLE, WEIGHT = 512, 2048, 4_000_000
#: Buckets with more pairs to compare are first shrunk by stars around this many centres.
HEAVY, CENTRES = 1 << 24, 8
#: Up to so many buckets of two rows and more (24 bytes each) are broadcast to find their rows.
BROADCAST_BUCKETS = 1_000_000
#: Columns of a dense comparison.
DENSE = 4096

_TASK = "t long, uid long, side int, label long, items {items}"

#: Sorted distinct 64-bit values of each row, one after the other, and the bounds of the rows.
Flatten = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the smallest reachable node.

    Alternating large and small stars until nothing changes. Every step is a grouping
    with partial aggregation or a join that Spark can split, so a node with very many
    neighbours is no problem.
    """
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))]
    edges = stored(edges.filter("a != b").distinct(), "edges")
    before = None
    while (now := edges.agg(*mark).first()) != before:
        before = now
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        down = (
            both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct()
        )
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))
        last, edges = edges, stored(
            down.join(low, "u").select(F.explode(pairs).alias("e")).select("e.a", "e.b").filter("a != b").distinct(),
            "edges",
        )
        discard(last)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    found = stored(nodes.union(roots), "components")
    discard(edges)
    return found


def _shared(values: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the ``left`` with the ``right`` rows."""
    found = np.zeros((len(left), len(right)), np.int64)
    size = np.diff(bounds)
    at = np.arange(int(size[right].sum())) + np.repeat(bounds[right] - (np.cumsum(size[right]) - size[right]), size[right])
    flat, cuts = values[at], np.concatenate([[0], np.cumsum(size[right])])
    if len(left) <= 4:
        for k, row in enumerate(left):
            own = values[bounds[row] : bounds[row + 1]]
            if len(own):
                hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                total = np.concatenate([[0], np.cumsum(hit)])
                found[k] = total[cuts[1:]] - total[cuts[:-1]]
        return found
    at = np.arange(int(size[left].sum())) + np.repeat(bounds[left] - (np.cumsum(size[left]) - size[left]), size[left])
    own, owner = values[at], np.repeat(np.arange(len(left)), size[left])
    known = np.intersect1d(own, flat)
    if not len(known):
        return found
    both = []
    for part, row in ((own, owner), (flat, np.repeat(np.arange(len(right)), size[right]))):
        place = np.minimum(np.searchsorted(known, part), len(known) - 1)
        hit = known[place] == part
        both.append((place[hit], row[hit]))
    for low in range(0, len(known), DENSE):  # counts are whole numbers that float32 holds
        width, sides = min(DENSE, len(known) - low), []
        for (place, row), n in zip(both, (len(left), len(right))):
            inside = (place >= low) & (place < low + width)
            side = np.zeros((n, width), np.float32)
            side[row[inside], place[inside] - low] = 1
            sides.append(side)
        found += (sides[0] @ sides[1].T).astype(np.int64)
    return found


def _joining(uid: np.ndarray, label: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Of links between rows those that join components which earlier ones do not."""
    pairs = np.unique(np.stack([np.minimum(label[left], label[right]), np.maximum(label[left], label[right])], 1), axis=0, return_index=True)[1]
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = x = root.get(y, y)
        return x

    for k in pairs.tolist():
        a, b = find(int(label[left[k]])), find(int(label[right[k]]))
        if a != b:
            root[a] = b
            yield int(uid[left[k]]), int(uid[right[k]])


def _links(flatten: Flatten, percent: int):
    """Compare each task's rows of side 0 with those of side 1; rows come sorted by task."""

    def compared(rows: pa.RecordBatch) -> pa.RecordBatch:
        t, uid, side, label = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        values, bounds = flatten(rows.column(4))
        size, links = np.diff(bounds), []
        cuts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
        for low, high in zip(cuts.tolist(), cuts[1:].tolist()):
            left, right = low + np.flatnonzero(side[low:high] == 0), low + np.flatnonzero(side[low:high] == 1)
            if not len(left) or not len(right):
                continue
            inter = _shared(values, bounds, left, right)
            similar = (100 * inter >= percent * (size[left][:, None] + size[right][None, :] - inter)) & (inter > 0)
            x, y = np.nonzero(similar & (label[left][:, None] != label[right][None, :]))
            links += _joining(uid, label, left[x], right[y])
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.column(0).to_numpy()
            last = int(np.searchsorted(t, t[-1]))  # the last task may go on in the next batch
            if last or (held and held[0].column(0)[0].as_py() != t[0]):
                yield compared(pa.concat_batches([*held, batch.slice(0, last)]))
                held = []
            held.append(batch.slice(last))
        if held:
            yield compared(pa.concat_batches(held))

    return run


def _compared(tasks: DataFrame, sets: DataFrame, flatten: Flatten, percent: int) -> DataFrame:
    """Links ``a, b`` found in ``tasks(t, uid, side, label)``."""
    rows = unsized(tasks, sets, "uid").select("t", "uid", "side", "label", "items")
    dealt = rows.repartition("t").sortWithinPartitions("t")
    return dealt.mapInArrow(_links(flatten, percent), "a long, b long")


def _blocks(n: Column, weight: Column, most: int) -> Column:
    return F.ceil(F.greatest(n / most, weight / WEIGHT, F.lit(1))).cast("int")


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def _block(seed: int, n: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), "uid"), n).cast("int")


def _star(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """Tasks that compare ``c`` with its ``x``, for distinct ``pairs(c, x)``."""
    n = _blocks(F.count(F.lit(1)), F.sum("n"), WHOLE)
    centres = pairs.join(weights.withColumnRenamed("uid", "x"), "x").groupBy("c").agg(n.alias("blocks"))
    t = F.xxhash64("c", "j").alias("t")
    first = centres.select("c", _numbers(F.col("blocks")).alias("j")).select(t, F.col("c").alias("uid"), F.lit(0).alias("side"), F.col("c").alias("label"))
    rest = pairs.join(centres, "c").withColumnRenamed("x", "uid").withColumn("j", _block(3, F.col("blocks")))
    return first.union(rest.select(t, "uid", F.lit(1).alias("side"), F.col("uid").alias("label")))


def _open(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of buckets in which rows other than the centre (which has been compared with
    all of them) lie in different components: with their ``label``, the commonest label
    ``main``, and the numbers of blocks on both sides."""
    label = nodes.select(F.col("node").alias("uid"), F.col("root").alias("label"))
    rest = rows.filter("uid != c").select("key", "uid", "n").join(label, "uid", "left")
    rest = stored(rest.withColumn("label", F.coalesce("label", "uid")), "labelled")
    each = rest.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("w"))
    buckets = (
        each.groupBy("key")
        .agg(F.sum("k").alias("rows"), F.sum("w").alias("weight"), F.max(F.struct("k", "label", "w")).alias("m"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1")
        .select(
            "key", F.col("m.label").alias("main"), (F.col("rows") - F.col("m.k")).alias("open"), "rows",
            _blocks(F.col("rows") - F.col("m.k"), F.col("weight") - F.col("m.w"), OPEN).alias("ko"),
            _blocks(F.col("rows"), F.col("weight"), WHOLE).alias("kr"),
        )
    )
    found = stored(rest.join(buckets, "key"), "open")
    discard(rest)
    return found


def _pairs_left(rows: DataFrame) -> tuple[int, int]:
    """Pairs to compare in heavy buckets, and open rows of all."""
    heavy = F.when(F.col("open") * F.col("rows") > HEAVY, F.col("rows"))
    got = rows.filter("label != main").agg(F.coalesce(F.sum(heavy), F.lit(0)), F.count(F.lit(1))).first()
    return got[0], got[1]


def _shrinking(rows: DataFrame, seed: int) -> DataFrame:
    """Tasks that compare the open rows of heavy buckets with some centres of each."""
    heavy = rows.filter(F.col("open") * F.col("rows") > HEAVY)
    h = F.xxhash64(F.lit(seed), "key", "uid")
    slot = F.pmod(h, F.lit(CENTRES)) + F.when(F.col("label") != F.col("main"), CENTRES).otherwise(0)
    drawn = heavy.groupBy("key", slot.alias("slot")).agg(F.min(F.struct(h.alias("h"), "uid", "label", "ko")).alias("m"))
    t = F.xxhash64("key", "i").alias("t")
    first = drawn.select("key", "m.uid", "m.label", _numbers(F.col("m.ko")).alias("i")).select(t, "uid", F.lit(0).alias("side"), "label")
    rest = heavy.filter("label != main").withColumn("i", _block(seed, F.col("ko")))
    return first.union(rest.select(t, "uid", F.lit(1).alias("side"), "label"))


def _everything(rows: DataFrame) -> DataFrame:
    """Tasks that compare each row outside a bucket's main component with all of the bucket."""
    t = F.xxhash64("key", "i", "j").alias("t")
    some = rows.filter("label != main").withColumn("i", _block(1, F.col("ko"))).withColumn("j", _numbers(F.col("kr")))
    every = rows.withColumn("j", _block(2, F.col("kr"))).withColumn("i", _numbers(F.col("ko")))
    return some.select(t, "uid", F.lit(0).alias("side"), "label").union(every.select(t, "uid", F.lit(1).alias("side"), "label"))


def link(buckets: DataFrame, sets_of, flatten: Flatten, percent: int = 80) -> DataFrame | None:
    """Components of the rows that share a bucket and are similar.

    ``buckets(key, uid, n)``, where n is the size of the row's set or about that, and a row may
    come repeatedly;
    ``sets_of(ids, few)`` gives the full sets ``(uid, items)`` of the rows in ``ids(uid)``, in any
    form that ``flatten`` can read; ``few`` tells that there are no more than BROADCAST_BUCKETS. Two rows are linked when
    ``100 * intersection >= percent * union``. Returns ``nodes(node, root)``, or None where no
    bucket has two rows.

    Each bucket has a centre, drawn so that two rows meet another one in each bucket they
    share, and compared with all its rows. Of what rows are left in different components of
    a bucket, all pairs are compared, in blocks. Buckets with very many such pairs are shrunk
    before by further stars, for as long as each round halves them; the blocks then cover
    the rest, whatever its size: their work may grow with the square of the rows that are in
    a bucket but not in its main component.
    """
    # the least and the greatest of a hash that differs from bucket to bucket: two rows, or none
    m = F.expr("uid ^ key")
    firsts = buckets.groupBy("key").agg(F.min(m).alias("m"), F.max(m).alias("top")).filter("m != top")
    firsts = stored(firsts.select("key", F.expr("m ^ key").alias("c")), "centres")
    found = firsts.count()
    if not found:
        discard(firsts)
        return None
    shared = buckets.join(F.broadcast(firsts) if found <= BROADCAST_BUCKETS else firsts, "key")
    rows = stored(shared.dropDuplicates(["key", "uid"]), "buckets")
    discard(firsts)
    ids = stored(rows.select("uid").distinct(), "ids")
    few = ids.count() <= BROADCAST_BUCKETS
    sets = stored(sets_of(F.broadcast(ids) if few else ids, few), "sets")
    discard(ids)
    weights = rows.groupBy("uid").agg(F.max("n").alias("n"))
    star = stored(rows.filter("uid != c").select("c", F.col("uid").alias("x")).distinct(), "stars")
    nodes = components(stored(_compared(_star(star, weights), sets, flatten, percent), "links"))
    discard(star)
    before, seed = None, 10
    while True:
        left = _open(rows, nodes)
        heavy, count = _pairs_left(left)
        if not count:
            break
        last = not heavy or (before is not None and 2 * heavy > before)
        tasks = _everything(left) if last else _shrinking(left, seed)
        more = stored(_compared(tasks, sets, flatten, percent), "more")
        nodes = _joined(nodes, more)
        discard(left, more)
        if last:
            break
        before, seed = heavy, seed + 1
    discard(rows, sets)
    return nodes


def _joined(nodes: DataFrame, fresh: DataFrame) -> DataFrame:
    """Components after adding links."""
    if not fresh.take(1):
        return nodes
    return components(fresh.toDF("a", "b").union(nodes.toDF("a", "b")))


def with_least(members: DataFrame, order: Column, name: str) -> DataFrame:
    """``members(root, uid, ...)`` with the least ``order`` of their root in a column ``name``."""
    least = stored(members.groupBy("root").agg(F.min(order).alias(name)), "heads")
    return spread(members, least, "root")
