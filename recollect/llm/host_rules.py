"""Quality rules of documents and of the hosts they come from.

Rule failures are counted by host, each host's failure rate is shrunk towards the corpus by
an empirical beta prior, and the verdict of the host goes back to its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.llm import arrays
from recollect.llm.store import stored

#: A host is rejected when more than this share of its documents is expected to fail.
MAX_HOST_RATE = 0.5
#: Hosts' rates are broadcast up to this number (some MB); beyond, the join is shuffled.
BROADCAST_HOSTS = 50_000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated_words(word: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text, the words in windows of WINDOW words that are found twice or more in it."""
    starts = len(word) - WINDOW + 1
    if starts <= 0:
        return np.zeros(n_texts, np.int64)
    at = np.flatnonzero(text[:starts] == text[WINDOW - 1 :])
    mark = arrays.mix(text.astype(np.uint64) + np.uint64(1))[at]
    hashed = arrays.mix(word.astype(np.uint64) + np.uint64(1 << 40))
    for step in range(WINDOW):
        mark = arrays.mix(mark * np.uint64(0x9E3779B97F4A7C15) + hashed[at + step])
    ordered = np.sort(mark)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    at = at[np.isin(mark, twice)]
    if not len(at):
        return np.zeros(n_texts, np.int64)
    # windows with equal hashes are compared word by word
    exact = np.column_stack([text[at], *(word[at + step] for step in range(WINDOW))])
    _, which, times = np.unique(exact, axis=0, return_inverse=True, return_counts=True)
    at = at[times[which.ravel()] > 1]
    step = np.zeros(len(word) + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return np.bincount(text[np.cumsum(step[:-1]) > 0], minlength=n_texts)


def _repeated_lines(data: np.ndarray, bounds: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line."""
    n_texts = len(bounds) - 1
    starts, ends = arrays.runs(data != 10, bounds)
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    if not len(starts):
        return np.zeros(n_texts, np.int64)
    text = np.searchsorted(bounds, starts, "right") - 1
    line = arrays.ids(data, starts, ends).astype(np.int64)
    first = np.unique(text * (line.max() + 1) + line, return_index=True)[1]
    return np.bincount(text, minlength=n_texts) - np.bincount(text[first], minlength=n_texts)


def _counts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    starts, ends, first = arrays.words(data, bounds)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(bounds) - 1), n_words)
    begins = (data & 0xC0) != 0x80  # first bytes of code points
    inside = arrays.covered(len(data), starts, ends)
    word = arrays.ids(data, starts, ends) if len(starts) else np.zeros(0, np.int32)
    return [
        n_words,
        arrays.per_text(begins & inside, bounds),
        arrays.per_text(_SYMBOL[data], bounds),
        _repeated_lines(data, bounds, starts),
        _repeated_words(word, text, len(bounds) - 1),
    ]


def _batch(column: pa.Array) -> pa.Array:
    parts = [_counts(*piece) for piece in arrays.pieces(column)]
    whole = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(len(_COUNTS))]
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in whole], _COUNTS)


def rule_counts(text: Column) -> Column:
    """The counts that the rules look at, of each whole text."""
    return F.arrow_udf(_batch, "struct<" + ", ".join(f"{c}:long" for c in _COUNTS) + ">")(text)


def host_rates(counted: DataFrame) -> DataFrame:
    """``host, docs, failed, rate`` of ``counted(host, base_failed)``; null hosts are left out.

    The prior is the beta distribution with the mean and the variance (by moments) of the
    failure rates of all hosts; ``rate`` is the posterior mean. Where hosts do not differ
    more than chance allows, or there is one host only, the prior weighs as much as the
    mean host has documents.
    """
    hosts = (
        counted.filter("host is not null").groupBy("host")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    rate = F.col("failed") / F.col("docs")
    prior = hosts.agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"),
        F.avg(1 / F.col("docs")).alias("noise"), F.avg("docs").alias("size"),
    )
    spread = F.col("mean") * (1 - F.col("mean"))
    between = F.col("var") - spread * F.col("noise")  # without what sampling alone makes
    weight = F.when((between > 0) & (between < spread), spread / between - 1).otherwise(F.col("size"))
    weight = F.greatest(weight, F.lit(0.0))
    one = prior.select(F.struct((F.col("mean") * weight).alias("a"), weight.alias("w")).alias("prior"))
    shrunk = (F.col("failed") + F.col("prior.a")) / (F.col("docs") + F.col("prior.w"))
    return hosts.withColumn("prior", one.scalar()).select("host", "docs", "failed", shrunk.alias("rate"))


def assess(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The id, the counts, ``base_failed``, ``host_rate`` and ``kept`` for every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: none). A document fails by
    itself with fewer than MIN_WORDS words or more than MAX_REPEAT_PERCENT of its words in
    repeated windows; it is also rejected when its host's shrunk failure rate is over
    MAX_HOST_RATE. A null host has no verdict (``host_rate`` null). Repeated rows count
    each, and other columns are not looked at. An empty table gives an empty result.
    """
    return _verdicts(_scored(docs, id_col, text, host, carry=False)).select("doc.*", *_COUNTS, "base_failed", "host_rate", "kept")


def drop_failing(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all their columns."""
    return _verdicts(_scored(docs, id_col, text, host, carry=True)).filter("kept").select("doc.*")


def _scored(docs: DataFrame, id_col: str, text: str, host: str, carry: bool) -> DataFrame:
    kept = F.struct(*[docs[f"`{c}`"] for c in (docs.columns if carry else [id_col])]).alias("doc")
    rows = docs.select(kept, docs[f"`{host}`"].cast("string").alias("host"), rule_counts(docs[f"`{text}`"].cast("string")).alias("counts"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return stored(rows.select("doc", "host", "counts.*").withColumn("base_failed", failed), "rules")


def _verdicts(scored: DataFrame) -> DataFrame:
    rates = stored(host_rates(scored), "hosts").select("host", F.col("rate").alias("host_rate"))
    if rates.count() <= BROADCAST_HOSTS:
        rates = F.broadcast(rates)
    kept = ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= MAX_HOST_RATE)
    return scored.join(rates, "host", "left").withColumn("kept", kept)
