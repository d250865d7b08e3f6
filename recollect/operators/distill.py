"""Shortening a transcript before it is embedded and stored."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.config import Distiller
from recollect.functions import text as tx

# What the built-in distiller keeps, and its usual cap in characters.
KEPT_PREFIX = "user:"
DISTILLED_CHARS = 2000


def keep_user_lines(transcript: Column, cap: int | None = DISTILLED_CHARS) -> Column:
    """Built-in distiller: lines by the user, or everything if there are none.

    The text is cut after ``cap`` characters; None keeps all of it
    (``functools.partial(keep_user_lines, cap=None)`` as a distiller).
    """
    lines = F.split(transcript, tx.LINE_BREAK)
    kept = F.filter(lines, lambda ln: F.lower(ln).startswith(KEPT_PREFIX))
    text = F.when(F.size(kept) > 0, F.array_join(kept, "\n")).otherwise(transcript)
    return text if cap is None else F.substring(text, 1, cap)


def batch_distiller(make_fn: Callable[[], Callable[[Sequence[str]], Sequence[str]]]) -> Distiller:
    """Distiller around a Python function on a batch of texts; set up once per task."""

    def apply(transcript: Column) -> Column:
        @F.pandas_udf("string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            fn = make_fn()
            for texts in batches:
                yield pd.Series(list(fn(texts.tolist())), dtype=object)

        return run.asNondeterministic()(transcript)

    return apply


def distill(df: DataFrame, distiller: Distiller | None, text_col: str = "transcript") -> DataFrame:
    """Adds ``stored_text``: the distilled text, or the raw one if that came out blank."""
    if distiller is None:
        return df.withColumn("stored_text", F.col(text_col))
    return (
        df.withColumn("_distilled", distiller(F.col(text_col)))
        .withColumn(
            "stored_text",
            F.when(tx.has_text(F.col("_distilled")), F.col("_distilled")).otherwise(
                F.col(text_col)
            ),
        )
        .drop("_distilled")
    )


def compression_report(
    df: DataFrame, keys: Sequence[str], raw: str = "transcript", kept: str = "stored_text"
) -> DataFrame:
    """Raw and kept characters and their ratio, per group."""
    raw_chars, kept_chars = F.sum(F.length(raw)), F.sum(F.length(kept))
    return df.groupBy(*keys).agg(
        raw_chars.alias("raw_chars"),
        kept_chars.alias("kept_chars"),
        (kept_chars / F.greatest(raw_chars, F.lit(1))).alias("kept_ratio"),
    )
