"""Packing of token ids into rows of one length: best fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recollect.llm import bpe

#: Tokens of a packed row, and tokens that a task packs together (its memory: some 20 bytes each).
LENGTH, BLOCK = 2048, 4_000_000

_SCHEMA = (
    "shard int, block int, row int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
    "seq_ids array<long>, seq_starts array<long>"
)


class Capacities:
    """Open rows by the room they have, in a segment tree over room: the least that is enough
    is found in the depth of the tree."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.counts = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, row)`` with the least room of at least ``need``."""
        at = need + self.size
        if not self.counts[at]:
            # up to the first subtree on the right that has rows, then down its left side
            while at > 1 and not (at % 2 == 0 and self.counts[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.counts[2 * at] else 2 * at + 1
        room = at - self.size
        self._change(room, -1)
        return room, self.rows[room].pop()

    def _change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.counts[at] += by
            at //= 2


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Which items share each row; sizes from 1 to ``length``. Ties keep their order."""
    rows: list[list[int]] = []
    room = Capacities(length)
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        found = room.take(size)
        if found is None:
            rows.append([])
            found = length, len(rows) - 1
        left, row = found[0] - size, found[1]
        rows[row].append(item)
        if left:
            room.add(left, row)
    return rows


def _pack(block: list[tuple[int | None, int, np.ndarray]], length: int, pad: int) -> Iterator[tuple]:
    """Packed rows of ``(id, start in its document, ids)``, each of ``length`` tokens at most."""
    sizes = np.array([len(ids) for _, _, ids in block], np.int64)
    for items in best_fit(sizes, length):
        ends = np.cumsum([0, *(sizes[i] for i in items)])
        ids = np.full(length, pad, "<u2")
        places = np.zeros(length, "<u2")
        for i, a, b in zip(items, ends[:-1], ends[1:]):
            ids[a:b] = block[i][2]
            places[a:b] = np.arange(b - a)
        yield ids.tobytes(), ends.tolist(), places.tobytes(), [block[i][0] for i in items], [block[i][1] for i in items]


def library_ids(docs: DataFrame, path: str, pattern: str, out: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with the token ids of each whole text in a column ``out``, by the tiktoken library.

    The rank file at ``path`` is read on the driver. No special tokens; a null text has no
    ids. A column of that name is replaced. Texts with white space so long that the library
    gives up are encoded by our own transducer, which gives the same ids.
    """
    import tiktoken

    spark = docs.sparkSession
    coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    shared, tables = spark.sparkContext.broadcast(coder), bpe.prepared(spark, path)  # the vocabulary, twice

    def encode(value: str) -> np.ndarray:
        try:
            return shared.value.encode_to_numpy(value, disallowed_special=())
        except ValueError:
            return np.concatenate([ids for _, ids, *_ in bpe.encoded(pa.array([value]), tables.value)])

    @F.arrow_udf("array<int>")
    def run(column: pa.Array) -> pa.Array:
        parts, ends = [np.zeros(0, np.int32)], [0]
        for value in column:
            ids = encode(value.as_py() or "")
            parts.append(ids.astype(np.int32))
            ends.append(ends[-1] + len(ids))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)))

    return docs.withColumn(out, run(docs[f"`{text}`"].cast("string")))


def pack(docs: DataFrame, id_col: str = "doc_id", ids: str = "ids", length: int = LENGTH, pad: int = 0, block: int = BLOCK) -> DataFrame:
    """Rows of ``length`` token ids for every id in the ``array<int>`` column ``ids`` of ``docs``.

    ``input_ids`` and ``position_ids`` are little-endian 16-bit matrices rows, padded with
    ``pad`` and 0 behind the last segment; ``cu_seqlens`` are the cumulative lengths of the
    segments from 0 on; positions start anew in each. ``seq_ids`` and ``seq_starts`` name
    each segment's document and its first token there. A document of more than ``length``
    tokens is cut into full rows and a rest, so nothing is lost; null and empty ones take
    no room. Repeated rows are packed each; a null id is carried as null. Tasks pack what
    they read, ``block`` tokens at a time, so memory is bounded and nothing is shuffled;
    ``shard`` and ``block`` tell the parts. Ids that 16 bits cannot hold fail the job. Other
    columns are not looked at.
    """
    if not 0 < length < 1 << 16:
        raise ValueError("length must fit 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, held, tokens = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(_pack(held, length, pad))
            for k in range(0, len(rows), 256):
                part = rows[k : k + 256]
                columns = [
                    pa.array([shard] * len(part), pa.int32()), pa.array([number] * len(part), pa.int32()),
                    pa.array(range(k, k + len(part)), pa.int32()), pa.array([r[0] for r in part], pa.binary()),
                    pa.array([r[1] for r in part], pa.list_(pa.int32())), pa.array([r[2] for r in part], pa.binary()),
                    pa.array([r[3] for r in part], pa.list_(pa.int64())), pa.array([r[4] for r in part], pa.list_(pa.int64())),
                ]
                names = ["shard", "block", "row", "input_ids", "cu_seqlens", "position_ids", "seq_ids", "seq_starts"]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            if len(flat) and not 0 <= flat[ends[0] : ends[-1]].min(initial=0) <= flat[ends[0] : ends[-1]].max(initial=0) < 1 << 16:
                raise ValueError("ids must fit 16 bits")
            for k, name in enumerate(batch.column(0).to_pylist()):
                own = flat[ends[k] : ends[k + 1]].astype("<u2")
                for start in range(0, len(own), length):
                    held.append((name, start, own[start : start + length]))
                tokens += len(own)
                if tokens >= block:
                    yield from flush()
                    number, held, tokens = number + 1, [], 0
        yield from flush()

    none = F.array().cast("array<int>")
    plain = docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), F.coalesce(docs[f"`{ids}`"], none).alias("ids"))
    return plain.mapInArrow(run, _SCHEMA)
