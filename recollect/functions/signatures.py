"""Sign-of-projection signatures (Charikar 2002, with +-1 entries as in Achlioptas 2003)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BITS = 256
#: A projection this close to zero counts as zero, whatever the order of summation.
ZERO_BAND = 1e-9


@lru_cache(maxsize=8)
def planes(bits: int, dims: int) -> np.ndarray:
    """(dims, bits) matrix; +1 where the first hex digit of md5('plane:dim') is below 8."""
    signs = [
        [1 if hashlib.md5(f"{j}:{i}".encode()).digest()[0] < 0x80 else -1 for j in range(bits)]
        for i in range(dims)
    ]
    return np.array(signs, dtype=np.int8)


def signature(vector: Column, dims: int, bits: int = DEFAULT_BITS) -> Column:
    """``array<bigint>`` of ``bits/64`` words; null where the vector has another length.

    A matrix product per Arrow batch: thousands of multiplications per row are far
    cheaper there than as an interpreted lambda per element.
    """
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")

    compact = planes(bits, dims)  # made once, sent with the job: one byte per entry

    @F.pandas_udf("array<bigint>")
    def sign_bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matrix = compact.astype(np.float64)
        for vectors in batches:
            out: list = [None] * len(vectors)
            good = [i for i, v in enumerate(vectors) if v is not None and len(v) == dims]
            if good:
                stacked = np.stack([np.asarray(vectors.iloc[i], dtype=np.float64) for i in good])
                on = (stacked @ matrix) > ZERO_BAND
                words = np.packbits(on, axis=1, bitorder="little").view(np.int64)
                for i, row in zip(good, words):
                    out[i] = row
            yield pd.Series(out, dtype=object)

    # not pushed into filters, where it would be computed a second time
    return sign_bits.asNondeterministic()(vector)
