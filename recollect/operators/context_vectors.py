"""Vectors that know related words, learned from the texts themselves by random indexing.

Every word has a fixed sparse vector of signs, taken from digests of the word. A word's
context vector is the sum of the sparse vectors of the words that stand near it, weighted
by how rare these are; so words used in the same company get similar vectors without ever
meeting. A text's vector is the weighted sum of its words' context vectors.

All of it is counting: sums of whole numbers. Texts are cut into blocks; a task holds one
block's texts and what its words weigh, and adds up there whatever it can before anything is
shuffled, so that never a row per pair of words is. Texts and vectors go from task to task packed.
Results do not depend on how the work was split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.operators.embedding import tokens
from recollect.operators.nearest import runs
from recollect.sources.scratch import discard, stored, stored_alone

#: Entries of a word's sparse vector, words to either side that are its context.
ENTRIES, WINDOW = 4, 2
#: Steps of a weight, and of a component.
WEIGHT, STEPS = 1024, 1 << 15
#: Up to so many words a vocabulary is broadcast (a word and a number each).
BROADCAST_WORDS = 200_000
#: Bytes of text in a block; a longer text is a block of its own. Larger blocks repeat fewer words,
#: and a task holds a number for each component of each of its block's words.
BLOCK = 32_000_000
#: Rows of vectors and places in a text that are worked on at once.
ROWS, PLACES = 1 << 13, 1 << 18
#: Blocks go through the shuffle in lots, up to LOTS of LEAST blocks or more, and its files are deleted
#: after each: what is on disk at once is a lot's texts and vectors, and what the lots come to.
LOTS, LEAST = 8, 16
_SMALL, _PACKED = "dims array<smallint>, x array<int>", "v binary"


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_WORDS else df


def _blocks(df: DataFrame, row_id: Column, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts that have words, ``block, packed`` (a table ``_id, clean``: words with a space between),
    the words of each block, ``part, word, texts`` (how many of its texts have the word), and what is
    to be discarded after both."""
    rows = df.select(row_id.alias("_id"), F.array_join(tokens(F.col(text)), " ").alias("clean")).filter("clean <> ''")
    size = BLOCK
    schema = "block string, packed binary, word string, texts bigint"
    done = stored(rows.mapInArrow(lambda batches: _cut(batches, size), schema), "blocks", "zstd")
    words = done.filter("word is not null").select(F.col("block").alias("part"), "word", "texts")
    return done.filter("word is null").select("block", "packed"), words, done


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    part, number, held, room = TaskContext.get().partitionId(), 0, [], size
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
        start, done = 0, 0
        while start < len(ends):
            stop = min(int(np.searchsorted(ends, done + room)) + 1, len(ends))
            held.append(batch.slice(start, stop - start))
            room -= int(ends[stop - 1]) - done
            start, done = stop, int(ends[stop - 1])
            if room <= 0:
                yield from _block(f"{part}-{number}", held)
                number, held, room = number + 1, [], size
    if held:
        yield from _block(f"{part}-{number}", held)


def _block(name: str, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = pa.table({"_id": pa.chunked_array([b.column(0) for b in held]), "clean": pa.chunked_array([b.column(1) for b in held])})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(texts)
    columns = ["block", "packed", "word", "texts"]
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64())], columns)
    doc, word, known = _words(texts["clean"])
    count = np.zeros(len(known), np.int64)
    for at in _pieces(doc):
        count += np.bincount(_pairs(doc[at], word[at], len(known))[1], minlength=len(known))
    yield pa.RecordBatch.from_arrays([pa.array([name] * len(known), pa.string()), pa.nulls(len(known), pa.binary()), known.cast(pa.string()), pa.array(count)], columns)


def _unpacked(blocks: pa.Table) -> pa.Table:
    """The texts of a block, ``_id, clean``."""
    return pa.ipc.open_stream(blocks["packed"][0].as_py()).read_all()


def _by_lots(docs: DataFrame, given: DataFrame, work: Callable[[DataFrame, DataFrame], DataFrame]) -> list[DataFrame]:
    """What ``work`` makes of the blocks and of what is ``given`` for them, stored for each lot of blocks."""
    lots = _lots(docs)
    of = [[df.filter(F.pmod(F.xxhash64(key), F.lit(lots)) == lot) for df, key in ((docs, "block"), (given, "part"))] for lot in range(lots)]
    return [stored_alone(work(*both), "lot") for both in of]


def _lots(docs: DataFrame) -> int:
    return max(1, min(LOTS, docs.count() // LEAST))


def _words(clean: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each word in turn its text's number and its own; the words by number."""
    lists = pc.split_pattern(clean.combine_chunks(), " ")
    coded = pc.dictionary_encode(lists.flatten())
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), lists.value_lengths().to_numpy(zero_copy_only=False))
    del lists
    pa.default_memory_pool().release_unused()
    return doc, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _pieces(doc: np.ndarray) -> Iterator[slice]:
    """Stretches of PLACES words, about, which end where a text ends."""
    low = 0
    while low < len(doc):
        high = int(np.searchsorted(doc, doc[min(low + PLACES, len(doc)) - 1], "right"))
        yield slice(low, high)
        low = high


def _pairs(doc: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words of each text in order of texts, and how often each is there."""
    pairs, times = np.unique(doc.astype(np.int64) * n + word, return_counts=True)
    return pairs // n, pairs % n, times


def _own_entries(words: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the words' own entries, a column for each."""
    place, sign = np.zeros((2, ENTRIES, len(words)), np.int64)
    for at, word in enumerate(words.to_pylist()):
        for k in range(ENTRIES):
            digest = hashlib.md5(f"{word}:{k}".encode()).digest()
            place[k, at], sign[k, at] = int.from_bytes(digest[:4], "big") % dims, 1 if digest[4] < 0x80 else -1
    return place, sign


def _contexts(texts: pa.Table, given: pa.Table, dims: int) -> pa.Table:
    """A block's part of the context vector of each of its words that weigh something."""
    doc, word, known = _words(texts["clean"])
    at = pc.index_in(known, given["word"].combine_chunks().cast(known.type))
    at = at.fill_null(-1).to_numpy(zero_copy_only=False)
    weight = np.where(at >= 0, given["weight"].to_numpy()[at], 0) if len(given) else np.zeros(len(known), np.int64)
    weighs = np.flatnonzero(weight)
    # only what weighs something has a row and an entry
    row = np.full(len(known), -1)
    row[weighs] = np.arange(len(weighs))
    place, sign = _own_entries(known.take(pa.array(weighs)), dims)
    amount = weight[weighs] * sign
    sums = np.zeros(len(weighs) * dims, np.int64)
    for low in range(0, len(word), PLACES):
        for k in range(1, WINDOW + 1):
            high = min(low + PLACES, len(word) - k)
            a, b = word[low:high], word[low + k : high + k]
            near = np.flatnonzero((doc[low:high] == doc[low + k : high + k]) & (a != b) & (row[a] >= 0) & (row[b] >= 0))
            a, b = row[a[near]], row[b[near]]
            for own, other in ((a, b), (b, a)):
                for e in range(ENTRIES):
                    np.add.at(sums, own * dims + place[e][other], amount[e][other])
    sums = sums.reshape(-1, dims)
    some = np.flatnonzero(sums.any(axis=1))
    return pa.table({"word": known.take(pa.array(weighs[some])).cast(pa.string()), "weight": weight[weighs[some]], "v": _packed(sums, some)})


def _packed(sums: np.ndarray, some: np.ndarray) -> pa.Array:
    """``some`` rows, each as bytes: how many bytes a number takes, a bit for each component that is not zero, and
    these. No number is zero, so those above it are stored less one."""
    parts = [_pack(sums[some[low : low + ROWS]]) for low in range(0, len(some), ROWS)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def _pack(sums: np.ndarray) -> pa.Array:
    there = sums != 0
    count, bits = there.sum(axis=1), np.packbits(there, axis=1)
    sums = sums - (sums > 0)
    most = np.maximum(sums.max(axis=1, initial=0), ~sums.min(axis=1, initial=0))
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    start = np.concatenate([[0], np.cumsum(1 + bits.shape[1] + count * width)])
    data = np.zeros(start[-1], np.uint8)
    data[start[:-1]] = width
    data[start[:-1, None] + 1 + np.arange(bits.shape[1])] = bits
    for size in (2, 4, 8):
        rows = np.flatnonzero(width == size)
        data[_places(start[rows] + 1 + bits.shape[1], count[rows] * size)] = sums[rows][there[rows]].astype(f"<i{size}").view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(sums), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(data)])


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _vectors(cells: pa.Array, dims: int, kind: type = np.int64) -> np.ndarray:
    """The rows that ``_packed`` has packed."""
    out = np.zeros((len(cells), dims), kind)
    for low in range(0, len(cells), ROWS):
        part = cells.slice(low, ROWS)
        start = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part)].astype(np.int64)
        data, size = np.frombuffer(part.buffers()[2], np.uint8), -(-dims // 8)
        there = np.unpackbits(data[start[:, None] + 1 + np.arange(size)], axis=1, count=dims).astype(bool)
        width, count = data[start], there.sum(axis=1)
        for w in (2, 4, 8):
            rows = np.flatnonzero(width == w)
            values = data[_places(start[rows] + 1 + size, count[rows] * w)].view(f"<i{w}").astype(np.int64)
            some = np.zeros((len(rows), dims), np.int64)
            some[there[rows]] = values + (values >= 0)
            out[low + rows] = some
    return out


def _sparse(sums: np.ndarray, kind: type) -> dict[str, pa.Array]:
    row, dim = np.nonzero(sums)
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sums)))]).astype(np.int32))
    return {"dims": pa.ListArray.from_arrays(ends, pa.array(dim.astype(np.int16))), "x": pa.ListArray.from_arrays(ends, pa.array(sums[row, dim].astype(kind)))}


def _dense(dims_of: pa.Array, x: pa.Array, into: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``out`` with each list's values added to its row of ``into``."""
    where = np.repeat(into, dims_of.value_lengths().to_numpy(zero_copy_only=False))
    np.add.at(out, (where, dims_of.flatten().to_numpy(zero_copy_only=False)), x.flatten().to_numpy(zero_copy_only=False).astype(out.dtype))
    return out


def _summed(parts: DataFrame, keys: list[str], dims: int, finish: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """The parts' packed vectors ``v`` added up by the first of ``keys``, then ``finish``ed, many at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None  # the last key may go on in the next batch
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
            if not len(batch):
                continue
            starts = np.array([start for start, _ in runs([batch.column(0)])])
            group = np.cumsum(np.isin(np.arange(len(batch)), starts)) - 1
            sums = np.zeros((len(starts), dims), np.int64)
            for low in range(0, len(batch), ROWS):
                np.add.at(sums, group[low : low + ROWS], _vectors(batch.column("v").slice(low, ROWS), dims))
            names = pa.table({k: batch.column(k).take(pa.array(starts)) for k in keys})
            if last is not None:
                if last.column(0)[0].as_py() == names.column(0)[0].as_py():
                    sums[0] += kept[0]
                else:
                    names, sums = pa.concat_tables([last, names]), np.concatenate([kept, sums])
            yield from ended(names.slice(0, len(names) - 1), sums[:-1])
            last, kept = names.slice(len(names) - 1), sums[-1:]
        if last is not None:
            yield from ended(last, kept)

    def ended(names: pa.Table, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(sums.any(axis=1))
        rows = pa.table({**{k: names[k].take(pa.array(some)) for k in keys}, **finish(sums[some])})
        yield from rows.combine_chunks().to_batches()

    return parts.repartition(keys[0]).sortWithinPartitions(keys[0]).mapInArrow(run, schema)


def _scaled(sums: np.ndarray) -> dict[str, pa.Array]:
    top = np.abs(sums).max(axis=1, keepdims=True) if len(sums) else sums
    return _sparse(np.floor((sums * STEPS).astype(np.float64) / top), np.int32)


def fit_words(texts: DataFrame, dims: int, text: str = "text") -> DataFrame:
    """``word, weight, dims, x``: the entries of each word's context vector that are not zero; the
    largest in size is STEPS. A word's weight is log2 of the number of texts over those with the
    word, in steps; a word that all texts have weighs nothing and is left out. Null texts count
    as texts without words."""
    docs, words, blocks = _blocks(texts, F.lit(None).cast("bigint"), text)
    total = texts.agg(F.count(F.lit(1)).cast("double").alias("n")).scalar()
    weight = F.floor(F.log2(total / F.col("texts")) * WEIGHT + 0.5).cast("bigint")
    counted = words.groupBy("word").agg(F.sum("texts").alias("texts"))
    weights = stored_alone(counted.select("word", weight.alias("weight")).filter("weight > 0"), "weights")
    given = stored_alone(words.join(_few(weights), "word").select("part", "word", "weight"), "given")

    def contexts(docs: DataFrame, given: DataFrame) -> DataFrame:
        parts = docs.groupBy("block").cogroup(given.groupBy("part")).applyInArrow(
            lambda own, other: _contexts(_unpacked(own), other, dims), f"word string, weight bigint, {_PACKED}"
        )
        return _summed(parts, ["word", "weight"], dims, lambda sums: {"v": _packed(sums, np.arange(len(sums)))}, f"word string, weight bigint, {_PACKED}")

    sums = _by_lots(docs, given, contexts)
    discard(blocks, weights, given)
    found = stored_alone(_summed(reduce(DataFrame.union, sums), ["word", "weight"], dims, _scaled, f"word string, weight bigint, {_SMALL}"), "words")
    discard(*sums)
    return found


def _text_sums(texts: pa.Table, given: pa.Table, dims: int) -> pa.Table:
    """The weighted sum of the context vectors of each text's words, for a block of texts."""
    doc, word, known = _words(texts["clean"])
    at = pc.index_in(known, given["word"].combine_chunks().cast(known.type)).fill_null(-1).to_numpy(zero_copy_only=False)
    sums, weight = np.zeros((len(texts), dims), np.int64), given["weight"].to_numpy()
    vectors = _vectors(given["v"].combine_chunks(), dims, np.int32)
    for piece in _pieces(doc):
        own, other, times = _pairs(doc[piece], word[piece], len(known))
        found = at[other] >= 0
        own, other, times = own[found], at[other[found]], times[found]
        if len(own):
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            amount = times * weight[other]
            for d in range(dims):
                sums[own[starts], d] = np.add.reduceat(amount * vectors[other, d], starts)
    return pa.table({"_id": texts["_id"], "v": _packed(sums, np.arange(len(sums)))})


def _pack_words(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """The words' sparse vectors packed."""
    for batch in batches:
        x = _dense(batch.column("dims"), batch.column("x"), np.arange(len(batch)), np.zeros((len(batch), dims), np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("weight"), _packed(x, np.arange(len(x)))], ["word", "weight", "v"])


def embed_by_context(df: DataFrame, words: DataFrame, dims: int, id_col: str, text: str = "text") -> DataFrame:
    """``df`` with ``embedding``: the weighted sum of the context vectors of a text's words, its
    largest component in size 1 (similarities by cosine do not look at lengths). Texts without a
    known word have zeros; null texts have none. ``id_col`` is unique. ``words`` is the result
    of ``fit_words``, on these texts or on others."""

    def unit(sums: np.ndarray) -> dict[str, pa.Array]:
        top = np.abs(sums).max(axis=1, keepdims=True) if len(sums) else sums
        flat = pa.array((sums / top).astype(np.float32).ravel())
        return {"_v": pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, dims, dtype=np.int32)), flat)}

    docs, own, blocks = _blocks(df.filter(F.col(id_col).isNotNull()), F.col(id_col), text)
    kind = df.schema[id_col].dataType.simpleString()
    known = words.select("word", "weight", "dims", "x").mapInArrow(lambda batches: _pack_words(batches, dims), "word string, weight bigint, v binary")
    known = F.broadcast(known) if words.count() <= BROADCAST_WORDS else known
    given = stored_alone(own.select("part", "word").join(known, "word").select("part", "word", "weight", "v"), "given")

    def text_sums(docs: DataFrame, given: DataFrame) -> DataFrame:
        return docs.groupBy("block").cogroup(given.groupBy("part")).applyInArrow(
            lambda texts, known: _text_sums(_unpacked(texts), known, dims), f"_id {kind}, {_PACKED}"
        )

    sums = _by_lots(docs, given, text_sums)
    discard(blocks, given)
    vectors = stored_alone(_summed(reduce(DataFrame.union, sums), ["_id"], dims, unit, f"_id {kind}, _v array<float>"), "vectors")
    discard(*sums)
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dims)
    # the text itself need not go through the join
    both = df.withColumn("_some", F.col(text).isNotNull()).join(vectors, F.col(id_col) == F.col("_id"), "left").drop("_id")
    return both.withColumn("embedding", F.when(F.col("_some"), F.coalesce("_v", zeros))).drop("_v", "_some")
