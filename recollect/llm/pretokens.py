"""The splits that byte-level BPE makes before merging, computed on whole Arrow batches.

Gives the matches of
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Letters and numbers that came with Unicode 16
_NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
]
_NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]


def classes(unicode16: bool = False) -> np.ndarray:
    """The class of each code point, by Unicode 15 or 16 (tokenizer libraries differ in it)."""
    kind = {"L": LETTER, "N": NUMBER}
    table = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    table[_SPACES] = SPACE
    for value, ranges in ((LETTER, _NEW_LETTERS), (NUMBER, _NEW_NUMBERS)):
        for low, high in ranges:
            table[low : high + 1] = value if unicode16 else OTHER
    return table


def split(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """First bytes of the pre-tokens of the texts that ``bounds`` cut from ``data`` (UTF-8).

    Each pre-token ends where the next one starts.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    head = (data & 0xC0) != 0x80
    at = np.flatnonzero(head)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(code)
    edge = np.searchsorted(at, bounds)  # bounds counted in code points
    first = np.zeros(n + 1, bool)
    first[edge] = True
    kind = table[code]
    fresh = np.ones(n, bool)  # starts of runs of one class
    fresh[1:] = kind[1:] != kind[:-1]
    fresh |= first[:-1]
    space = kind == SPACE
    blank = code == 0x20
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first[:-1]
    start = fresh & (space | ~after_blank)
    # the last of a run of white space goes with, or stands before, what follows
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:-1]
    start |= last
    # contractions, where an apostrophe is the first of its match
    quote = np.flatnonzero((code == 0x27) & fresh & ~after_blank)
    if len(quote):
        limit = edge[np.searchsorted(edge, quote, "right")]  # the end of the text
        padded = np.concatenate([code, np.zeros(2, np.uint32)])
        one = np.where(quote + 1 < limit, padded[quote + 1], 0)
        two = np.where(quote + 2 < limit, padded[quote + 2], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[quote[short | long] + 1] = False
        follows = np.concatenate([quote[short] + 2, quote[long] + 3])
        limits = np.concatenate([limit[short], limit[long]])
        start[follows[follows < limits]] = True
    return at[start]


def distinct(data: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The different pre-tokens, and which of them stands at each place."""
    index = np.append(starts, len(data)).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(index), pa.py_buffer(np.ascontiguousarray(data))]
    ).dictionary_encode()
    return array.dictionary, array.indices.to_numpy()
