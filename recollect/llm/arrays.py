"""Texts of an Arrow batch as numpy arrays: words, their ids and hashes, all of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once (a longer text is a piece of its own).
PIECE = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(bytes, offsets)`` of consecutive rows, ``most`` bytes or one row; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(bounds, bounds[row] + most, "right")) - 1
        last = min(max(last, row + 1), len(column))
        yield data[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        row = last


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at ``bounds`` (the ends of the texts)."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(inside) + 1, bool)
    cut[bounds] = True
    edge = inside[1:] != inside[:-1]
    starts = inside.copy()
    starts[1:] &= edge | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= edge | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the words before each text."""
    starts, ends = runs(~_SPACE[data], bounds)
    return starts, ends, np.searchsorted(starts, bounds)


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in the spans, which must not overlap."""
    step = np.zeros(n + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).astype(bool)


def ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """An integer for each span, equal for equal bytes."""
    index = np.concatenate([[0], np.cumsum(ends - starts)])
    packed = data[covered(len(data), starts, ends)]
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(index), pa.py_buffer(packed)]
    )
    return array.dictionary_encode().indices.to_numpy()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0xD6E8FEB86659FD93)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same in every batch and task. Spans must not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(longest, _ODD), dtype=np.uint64)
    inside = covered(len(data), starts, ends)
    at = np.arange(int((ends - starts).sum())) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    values = _BYTE[data[inside]] * powers[at]
    sums = np.add.reduceat(values, np.concatenate([[0], np.cumsum(ends - starts)[:-1]]))
    return mix(sums + (ends - starts).astype(np.uint64))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, nothing else."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def per_text(counts_at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of a value per byte (or word) over each text."""
    total = np.concatenate([[0], np.cumsum(counts_at, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
