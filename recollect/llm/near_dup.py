"""Near-duplicate documents: one-permutation MinHash with optimal densification."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import arrays
from recollect.llm.linking import link, with_least
from recollect.llm.store import beside, discard, given_back, numbered, stored

#: Rows per band and bands. A pair at the threshold of 0.8 misses all 30 bands with
#: probability (1 - 0.8**6)**30 = 1e-4, one at 0.85 with 7e-7; at 0.3 it meets in 2 %.
ROWS, BANDS = 6, 30

_SKETCH = "struct<n:long, digest:binary, bands:array<long>>"


def _shingles(data: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, and how many stand before each text.

    A text of fewer words, but not none, has its whole sequence as its one shingle.
    """
    data = arrays.lowered(data)
    starts, ends, first = arrays.words(data, bounds)
    word = arrays.hashes(data, starts, ends)
    count = np.diff(first)
    made = np.where(count == 0, 0, np.maximum(count - width + 1, 1))
    at = np.repeat(first[:-1] - (np.cumsum(made) - made), made) + np.arange(made.sum())
    length = np.repeat(np.minimum(count, width), made)
    value = length.astype(np.uint64)
    for step in range(width):
        inside = step < length
        part = word[np.where(inside, at + step, 0)] if len(word) else word
        value = np.where(inside, arrays.mix(value * np.uint64(0x9E3779B97F4A7C15) + part), value)
    return value, np.concatenate([[0], np.cumsum(made)])


def _sets(column: pa.Array, width: int):
    """The sorted distinct shingle hashes of each text, piece by piece: values, bounds."""
    for data, bounds in arrays.pieces(column):
        values, first = _shingles(data, bounds, width)
        parts = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]
        sizes = np.array([len(p) for p in parts], np.int64)
        yield np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


def _probes(bins: int, tries: int = 64) -> np.ndarray:
    """For each bin the bins it borrows from when empty, the same for every text."""
    seed = np.arange(bins * tries, dtype=np.uint64).reshape(bins, tries)
    return (arrays.mix(seed + np.uint64(0x51ED27)) % np.uint64(bins)).astype(np.int64)


def _signatures(values: np.ndarray, bounds: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """One row of ``bins`` minima per text with shingles; empty bins are densified."""
    texts, sizes = len(bounds) - 1, np.diff(bounds)
    row = np.repeat(np.arange(texts), sizes)
    bin_of = ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = row * bins + bin_of
    head = np.ones(len(cell), bool)  # values are sorted, so a bin's first value is its least
    head[1:] = cell[1:] != cell[:-1]
    table = np.zeros(texts * bins, np.uint64)
    filled = np.zeros(texts * bins, bool)
    table[cell[head]] = values[head]
    filled[cell[head]] = True
    table, filled = table.reshape(texts, bins), filled.reshape(texts, bins)
    some = np.flatnonzero(sizes)
    empty_row, empty_bin = np.nonzero(~filled[some])
    empty_row = some[empty_row]
    for step in range(probes.shape[1] + bins):
        if not len(empty_row):
            break
        source = probes[empty_bin, step] if step < probes.shape[1] else (empty_bin + step) % bins
        found = filled[empty_row, source]
        table[empty_row[found], empty_bin[found]] = table[empty_row[found], source[found]]
        empty_row, empty_bin = empty_row[~found], empty_bin[~found]
    return table


def _band_keys(table: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(table), bands)).copy()
    for r in range(rows):
        keys = arrays.mix(keys * np.uint64(0x9E3779B97F4A7C15) + table[:, r::rows][:, :bands])
    return keys


def sketch(width: int, rows: int = ROWS, bands: int = BANDS):
    """Column function: set size, digest of the set, and band keys (none for an empty set)."""
    probes = _probes(rows * bands)

    @F.arrow_udf(_SKETCH)
    def run(column: pa.Array) -> pa.Array:
        sizes, digests, keys = [], [], []
        for values, bounds in _sets(column, width):
            sizes.append(np.diff(bounds))
            raw = values.tobytes()
            digests += [
                hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])
            ]
            keys.append(_band_keys(_signatures(values, bounds, rows * bands, probes), rows, bands))
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        each = np.where(size > 0, bands, 0)
        flat = np.concatenate(keys)[size > 0].ravel().view(np.int64) if keys else np.zeros(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(size), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            ["n", "digest", "bands"],
        )

    return run


def _shingle_sets(width: int):
    """The sorted distinct shingle hashes of each text of a batch, and the bounds of the texts."""

    def flatten(items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for values, bounds in _sets(items, width):
            flat.append(values)
            ends.append(bounds[1:] + ends[-1][-1])
        return np.concatenate(flat), np.concatenate(ends)

    return flatten


def _grouped(docs: DataFrame, text: str, id_col: str, width: int, percent: int, carry: bool) -> tuple[DataFrame, DataFrame]:
    """The stored rows ``uid, doc, text, n`` (no text unless ``carry``), and ``uid, root, doc``
    of those in components of two or more rows."""
    rows = numbered(docs, text, carry, id_col)
    rows = stored(rows.withColumn("s", sketch(width)(F.col("text").cast("string"))).select("uid", "doc", "text", "s.*"), "sketches")
    # copies (equal sets) meet in their first row before anything is banded; it brings its bands
    # along, so that rows are not joined with the first ones by shuffling all bands twice
    first = (
        rows.filter("n > 0").groupBy("digest")
        .agg(F.min(F.struct("uid", "n", "bands")).alias("row"), F.count(F.lit(1)).alias("copies"))
    )
    first = stored(first.select("digest", "copies", F.col("row.uid").alias("rep"), "row.n", "row.bands"), "firsts")
    buckets = first.select(F.explode("bands").alias("key"), F.col("rep").alias("uid"), "n")
    first = first.select("digest", "copies", "rep")

    def sets_of(ids: DataFrame, few: bool) -> DataFrame:
        # texts go to the tasks, not their shingles: hashes of 8 bytes do not compress
        return rows.select("uid", F.col("text").cast("string").alias("items")).join(ids, "uid", "left_semi")

    found = link(buckets, sets_of, _shingle_sets(width), percent)
    reps = first.filter("copies > 1")
    if found is not None:
        nodes = found.toDF("rep", "root")
        reps = first.join(nodes, "rep", "left").filter("copies > 1 or root is not null")
        reps = reps.withColumn("root", F.coalesce("root", "rep"))
    else:
        reps = reps.withColumn("root", F.col("rep"))
    members = stored(rows.filter("n > 0").select("uid", "digest", "doc").join(reps.select("digest", "root"), "digest").drop("digest"), "members")
    discard(first, *([] if found is None else [found]))
    return rows, members


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 2, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    A row's set is its distinct shingles of ``width`` words, words being
    ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; fewer words make one shingle. Rows are
    linked at ``percent`` Jaccard similarity, computed on the full sets; ``component_id``
    is the smallest id reachable. Null and blank texts have an empty set and are linked
    with nothing. Rows that repeat an id are rows of their own with one id; a row with a
    null id takes part in links, and is kept only if it is linked with no row that has an id
    (``component_id`` null). Columns other than id and text are not looked at.
    """
    rows, members = _grouped(docs, text, id_col, width, percent, carry=False)
    placed = with_least(members, F.col("doc")[id_col], "least").select("uid", "root", "least")
    own = F.col("doc")[id_col]
    component = F.when(F.col("root").isNull(), own).otherwise(F.col("least"))
    return (
        rows.select("uid", "doc", "n").join(placed, "uid", "left")
        .select(
            own.alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
            own.eqNullSafe(component).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row left of each component: the smallest id (null last), and among
    rows that repeat it the first read. All columns are returned as they were."""
    rows, members = _grouped(docs, text, id_col, width, percent, carry=True)
    own = F.col("doc")[id_col]
    order = F.struct(own.isNull(), own, F.col("uid"))
    gone = stored(with_least(members, order, "head").filter("uid != head.uid").select("uid"), "gone")
    return given_back(beside(rows.select("uid", "doc", "text"), gone, "left_anti"), docs.columns, text)
