"""Rows whose vector cannot be used, set aside instead of failing the job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recollect.config import MemoryConfig
from recollect.sources.scratch import stored

#: Why a row is set aside.
MISSING, EMPTY, WRONG_LENGTH, NOT_FINITE = "missing", "empty", "wrong_length", "not_finite"


@dataclass(frozen=True)
class Checked:
    """``kept`` rows, ``rejected`` ones with their ``reason``, and how many there are of each."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def reason(config: MemoryConfig, column: str = "embedding"):
    """Why a vector cannot be searched; null where it can."""
    v = F.col(column)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return (
        F.when(v.isNull(), MISSING).when(F.size(v) == 0, EMPTY).when(F.size(v) != config.dimensions, WRONG_LENGTH).when(~finite, NOT_FINITE)
    )


def set_aside(embedded: DataFrame, config: MemoryConfig, column: str = "embedding") -> Checked:
    """Split rows by whether their vector has the configured length and finite numbers.

    The rows are written once, so the model is called once for both outputs, and counted in
    the same pass (an observation, no job of its own). Make ``embedded`` with
    ``strict_embedding=False``, or its first empty vector fails everything.
    """
    seen = Observation()
    marked = embedded.withColumn("reason", reason(config, column))
    count = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in (MISSING, EMPTY, WRONG_LENGTH, NOT_FINITE)]
    rows = stored(marked.observe(seen, F.count(F.when(F.col("reason").isNull(), 1)).alias("kept"), *count), "checked")
    return Checked(rows.filter("reason is null").drop("reason"), rows.filter("reason is not null"), dict(seen.get))
