"""Hashes of the substrings of texts, in Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters worked on at once (a longer text is a piece of its own).
PIECE = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (the finaliser of MurmurHash3)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def windows(points: np.ndarray, length: int) -> np.ndarray:
    """A hash of ``length`` code points from each place on, as far as there are so many."""
    n = max(len(points) - length + 1, 0)
    value = np.full(n, length, np.uint64)
    for step in range(length):
        value = value * np.uint64(0x9E3779B97F4A7C15) + points[step : step + n]
    return _mixed(value).view(np.int64)


def gram_places(text: Column, lengths: Sequence[int], wanted: np.ndarray | None = None) -> Column:
    """``array<struct<gram:long, pos:int>>``: hashes and places (from 1, in code points) of all
    substrings of the given lengths, of those in the sorted array ``wanted`` if given."""

    def of_piece(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(t) for t in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(sizes) - sizes
        grams, places = [], []
        for length in lengths:
            found = windows(points, length)
            at = np.arange(len(found)) if wanted is None else np.flatnonzero(_among(found, wanted))
            grams.append(found[at])
            places.append(at)
        gram, place = np.concatenate(grams), np.concatenate(places)
        size = np.concatenate([np.full(len(p), n) for p, n in zip(places, lengths)])
        owner = np.searchsorted(starts, place, "right") - 1
        inside = place + size <= starts[owner] + sizes[owner]  # not across the end of a text
        gram, place, owner = gram[inside], place[inside], owner[inside]
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
        gram, pos = gram[order], (place - starts[owner] + 1)[order]
        return [(gram[a:b], pos[a:b]) for a, b in zip(cuts, cuts[1:])]

    @F.arrow_udf("array<struct<gram:long, pos:int>>")
    def run(column: pa.Array) -> pa.Array:
        found, held, size = [], [], 0
        for value in column:
            held.append(value.as_py() or "")
            size += len(held[-1])
            if size >= PIECE:
                found += of_piece(held)
                held, size = [], 0
        if held:
            found += of_piece(held)
        ends = np.concatenate([[0], np.cumsum([len(g) for g, _ in found])]).astype(np.int32)
        grams, places = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        flat = pa.StructArray.from_arrays([pa.array(grams, pa.int64()), pa.array(places.astype(np.int32))], ["gram", "pos"])
        return pa.ListArray.from_arrays(pa.array(ends), flat)

    return run(text)


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(wanted):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)
    return wanted[at] == values
