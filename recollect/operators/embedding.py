"""Turning text into vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from recollect.config import DOCUMENT_INPUT, Embedder, MemoryConfig

#: a batch of texts and the input type -> one vector per text
BatchFn = Callable[[Sequence[str], str], Sequence[Sequence[float]]]

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def column_embedder(fn: Callable[[Column], Column]) -> Embedder:
    """An embedder that is a plain column expression and ignores the input type."""
    return lambda text, input_type: fn(text)


def batch_embedder(make_model: Callable[[], BatchFn], batch_size: int = 256) -> Embedder:
    """An embedder around a Python model.

    ``make_model`` runs once per task, so connections and weights are reused by all
    of the task's batches. The model gets up to ``batch_size`` texts at a time; null
    texts are never sent to it and stay null.
    """

    def apply(text: Column, input_type: str) -> Column:
        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = make_model()
            for texts in batches:
                out: list = [None] * len(texts)
                present = np.flatnonzero(texts.notna().to_numpy())
                for start in range(0, len(present), batch_size):
                    where = present[start : start + batch_size]
                    vectors = model(texts.iloc[where].tolist(), input_type)
                    if len(vectors) != len(where):
                        raise ValueError(f"model returned {len(vectors)} vectors for {len(where)} texts")
                    for i, v in zip(where, vectors):
                        out[i] = np.asarray(v, dtype=np.float32)
                yield pd.Series(out, dtype=object)

        # not pushed into filters, where the model would be called a second time
        return run.asNondeterministic()(text)

    return apply


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    words = F.split(F.regexp_replace(F.lower(text), TOKEN_BREAK, " "), " ")
    return F.filter(words, lambda w: w != "")


def hashing_embedder(dims: int) -> Embedder:
    """Deterministic bag-of-words vectors of unit length, without a model.

    Words are made by Spark; a batch's different words are hashed once and counted with
    numpy, so that a text costs what its words cost, whatever the number of dimensions.
    """

    @F.arrow_udf(ArrayType(FloatType()))
    def unit_counts(spaced: pa.Array) -> pa.Array:
        done = [_unit_counts(part, dims) for part in _slices(spaced)]
        flat = pa.array(np.concatenate([np.zeros(0, np.float32), *[d.ravel() for d in done]]))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dims, dtype=np.int32)), flat)

    def embed_text(text: Column) -> Column:
        return F.when(text.isNotNull(), unit_counts(F.regexp_replace(F.lower(text), TOKEN_BREAK, " ")))

    return column_embedder(embed_text)


def _slices(texts: pa.Array, size: int = 8_000_000) -> Iterator[pa.Array]:
    """The texts of a batch, about so many bytes at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, done = 0, 0
    while start < len(texts):
        stop = min(int(np.searchsorted(ends, done + size)) + 1, len(texts))
        yield texts.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def _unit_counts(spaced: pa.Array, dims: int) -> np.ndarray:
    """Of each text, how many words fall into each bucket, scaled to length 1."""
    lists = pc.split_pattern(pc.fill_null(spaced, ""), " ")
    coded = pc.dictionary_encode(lists.flatten())
    row = np.repeat(np.arange(len(spaced)), lists.value_lengths().to_numpy(zero_copy_only=False))
    words = coded.dictionary.to_pylist()
    bucket = np.array([_bucket(w, dims) if w else -1 for w in words], np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
    row, bucket = row[bucket >= 0], bucket[bucket >= 0]
    counts = np.bincount(row * dims + bucket, minlength=len(spaced) * dims).reshape(len(spaced), dims).astype(np.float64)
    size = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, size, out=np.zeros_like(counts), where=size > 0).astype(np.float32)


def _bucket(word: str, dims: int) -> int:
    """The first 32 bits of a word's MD5, modulo the dimensions."""
    return int.from_bytes(hashlib.md5(word.encode()).digest()[:4], "big") % dims


def embed_column(config: MemoryConfig, text: Column, input_type: str = DOCUMENT_INPUT) -> Column:
    return config.embedder(text, input_type)


def check_vectors(df: DataFrame, config: MemoryConfig, column: str = "embedding") -> DataFrame:
    """An empty vector is an error in strict mode."""
    if not config.strict_embedding:
        return df
    return df.withColumn(
        column,
        F.when(
            F.size(column) == 0, F.raise_error(F.lit("the embedder returned an empty vector"))
        ).otherwise(F.col(column)),
    )


def embedding_ok(column: str, dims: int) -> Column:
    """Whether a stored vector can be searched: present and of the configured length."""
    return F.coalesce(F.size(column) == dims, F.lit(False))


def embed(
    df: DataFrame,
    config: MemoryConfig,
    text_col: str = "stored_text",
    input_type: str = DOCUMENT_INPUT,
) -> DataFrame:
    """Adds ``embedding`` and ``embedding_ok``; a wrong length is only flagged."""
    embedded = df.withColumn("embedding", embed_column(config, F.col(text_col), input_type))
    return check_vectors(embedded, config).withColumn(
        "embedding_ok", embedding_ok("embedding", config.dimensions)
    )
