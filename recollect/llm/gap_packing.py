"""Best-fit packing of whole documents: large ones are matched, small ones fill the gaps.

Lengths are integers up to the length of a sequence, so the plan is made on the number of
pieces of each length, whatever the number of documents. It says where the pieces of a
length go by their rank among those of that length; ranks are counted by Spark.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recollect.llm.chunks import Chunks, groups, single_threaded, spans, word_encoder, word_split
from recollect.llm.store import stored

#: Tokens of a sequence, the id behind each document, and characters worked on at once.
CAPACITY, END, SIZE = 2048, 0, 1 << 20
#: Up to so many rows the ranks that parts begin with are broadcast (16 MB); more are joined by shuffle.
BROADCAST_PARTS = 1_000_000

_PIECES = "doc_id long, piece int, start long, length long, ids binary, part long, rank long"


class Gaps:
    """Runs of sequences (first number, how many) by the room left in each."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.runs:
                self.runs[room] = []
                insort(self.rooms, room)
            self.runs[room].append((first, n))

    def take(self, need: int) -> tuple[int, int, int] | None:
        """Remove and return ``(room, first, n)`` with the least room of at least ``need``."""
        at = bisect_left(self.rooms, need)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room], self.rooms[at]
        return room, first, n


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Where pieces go, and the number of sequences, for ``counts[length]`` pieces.

    Rows of ``length, rank, n, sequence, each, offset``: of the pieces of that length, the n
    from ``rank`` on go, ``each`` to a sequence, to those from ``sequence`` on, in at
    ``offset``. Pieces above a third of the capacity share a sequence with one more such piece
    at most: from the largest on, each is matched with the largest that fits, which gives
    as many pairs as there can be. The others go, the largest first, into the least room that
    holds them. Pieces of one length are placed together, so the number of rows depends on
    the lengths alone.
    """
    left = {size: n for size, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    gaps, made = Gaps(), 0

    def place(size: int, n: int, sequence: int, each: int, offset: int) -> None:
        rows.append((size, rank[size], n, sequence, each, offset))
        rank[size] += n
        left[size] -= n

    large = sorted(size for size in left if 3 * size > capacity)
    while large:
        size = large[-1]
        at = bisect_left(large, capacity - size + 1) - 1
        if at < 0:
            n, room = left[size], capacity - size
            place(size, n, made, 1, 0)
        else:
            other = large[at]
            if other == size and left[size] > 1:
                n, room = left[size] // 2, capacity - 2 * size
                place(size, 2 * n, made, 2, 0)
            elif other == size:  # the last one: a smaller one may be left
                n, room = 1, capacity - size
                if at:
                    room -= large[at - 1]
                    place(large[at - 1], 1, made, 1, size)
                place(size, 1, made, 1, 0)
            else:
                n, room = min(left[size], left[other]), capacity - size - other
                place(size, n, made, 1, 0)
                place(other, n, made, 1, size)
        gaps.add(room, made, n)
        made += n
        large = [size for size in large if left[size]]
    for size in sorted(left, reverse=True):
        while n := left[size]:
            room, first, runs = gaps.take(size) or (capacity, made, -(-n * size // (capacity - capacity % size)))
            if first == made:
                made += runs
            each = min(room // size, n)
            used = min(runs, n // each)
            place(size, used * each, first, each, capacity - room)
            gaps.add(room - each * size, first, used)
            gaps.add(room, first + used, runs - used)
    return np.array(sorted(rows), np.int64).reshape(-1, 6), made


def _placed(rows: np.ndarray):
    """Column function: sequence and offset of the piece of a length with a rank."""
    keys = (rows[:, 0] << 44) | rows[:, 1]

    @F.arrow_udf("struct<sequence_id:long, offset:long>")
    def run(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, number = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        own = rows[np.searchsorted(keys, (size << 44) | number, "right") - 1]
        sequence, place = np.divmod(number - own[:, 1], own[:, 4])
        return pa.StructArray.from_arrays([pa.array(own[:, 3] + sequence), pa.array(own[:, 5] + place * size)], ["sequence_id", "offset"])

    return run


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """``doc_id, piece, start, length, ids, part, rank``: the ids of each whole text by the
    tokenizer file at ``path`` (read on the driver) and ``end`` (None: nothing) behind, cut
    at every ``capacity`` tokens.

    ``ids`` are little-endian 32-bit numbers. ``rank`` counts the pieces of the same length
    within their part, which is what a task read. A special string in a text is one token, as
    the library has it; none is added.
    """
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    coder.no_truncation()
    coder.no_padding()
    shared = docs.sparkSession.sparkContext.broadcast(coder)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_threaded()
        library, part, seen = shared.value, TaskContext.get().partitionId(), [0] * (capacity + 1)
        chunks = Chunks(word_encoder(library), split=word_split)
        for names, texts in groups(batches, SIZE):
            numbers, first, _ = chunks.numbers(texts)
            ids, before = chunks.ids(0, numbers, first)
            if end is not None:
                ids = np.insert(ids, before[1:], end)
                before = before + np.arange(len(before))
            size = np.diff(before)
            cuts = -(-size // capacity)
            start = spans(np.zeros(len(size), np.int64), cuts) * capacity
            owner = np.repeat(np.arange(len(size)), cuts)
            length = np.minimum(size[owner] - start, capacity)
            ranks = np.empty(len(length), np.int64)
            for k, n in enumerate(length.tolist()):
                ranks[k] = seen[n]
                seen[n] += 1
            ends = np.concatenate([[0], np.cumsum(length)]) * 4  # pieces follow each other as the ids do
            flat = pa.py_buffer(ids.astype("<u4").tobytes())
            columns = [
                pa.array([names[k] for k in owner.tolist()], pa.int64()), pa.array((start // capacity).astype(np.int32)), pa.array(start),
                pa.array(length), pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(ends), flat]).cast(pa.binary()),
                pa.array(np.full(len(length), part, np.int64)), pa.array(ranks),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids", "part", "rank"])

    plain = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))
    return plain.mapInArrow(run, _PIECES)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int | None = END) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``: each piece of each document
    with its ids and its place in a sequence of at most ``capacity`` tokens.

    Only documents longer than a sequence are cut, into whole sequences and a rest, so that
    nothing is lost; the pieces of a sequence lie next to each other from offset 0 on.
    Null and empty texts have the end id alone. Repeated rows are packed each; a null id is
    carried; an empty table gives no rows; other columns are not looked at. The packing does not
    depend on how rows are dealt to tasks, but for which of equally long pieces goes where.
    """
    cut = stored(pieces(docs, path, id_col, text, capacity, end), "pieces")
    held = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = stored(held.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    counts = {row.length: row.n for row in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row for each length
    rows, _ = plan(counts, capacity)
    parts = held.select("part", "length", "base")
    parts = F.broadcast(parts) if held.count() <= BROADCAST_PARTS else parts
    ranked = cut.join(parts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    return ranked.select("doc_id", "piece", "start", "length", "ids", _placed(rows)("length", "rank").alias("p")).select(
        F.col("doc_id").alias(id_col), "piece", "start", "length", "ids", "p.sequence_id", "p.offset"
    )


def sequences(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``sequence_id, input_ids, cu_seqlens, doc_ids``: the pieces of ``pack_documents`` put
    together, one row per sequence (its pieces are no more than it has tokens)."""
    each = F.array_sort(F.collect_list(F.struct("offset", "length", F.col(id_col).alias("id"), "ids")))
    whole = packed.groupBy("sequence_id").agg(each.alias("p"))
    ends = F.transform("p", lambda p: (p.offset + p.length).cast("int"))
    joined = F.aggregate("p", F.lit(b""), lambda got, p: F.concat(got, p.ids))
    return whole.select(
        "sequence_id", joined.alias("input_ids"), F.concat(F.array(F.lit(0)), ends).alias("cu_seqlens"),
        F.transform("p", lambda p: p.id).alias("doc_ids"),
    )
