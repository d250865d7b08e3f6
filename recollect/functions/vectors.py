"""Similarity between two vector columns, and the bounded score built on it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Similarities are rounded to this many places before ranking, so that the order
#: of summation never decides between equal vectors; memory_id does.
RANK_PLACES = 9


def dot_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot_product(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of the angle; 0 when either vector has no length."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot_product(a, b) / scale)


def euclidean_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(
        a,
        b,
        lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")),
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def similarity(metric: str, a: Column, b: Column) -> Column:
    """Higher is closer for every metric: a distance is returned negated."""
    if metric == "cosine":
        value = cosine_similarity(a, b)
    elif metric == "dotProduct":
        value = dot_product(a, b)
    elif metric == "euclidean":
        value = -euclidean_distance(a, b)
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return F.round(value, RANK_PLACES)


def similarity_in_batches(metric: str) -> Callable[[Column, Column], Column]:
    """The same values from Arrow batches. Array lambdas are interpreted element by
    element, so for many rows this is the faster way."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        if len(a) == 0:
            return pd.Series([], dtype="float64")
        x, y = (np.stack(s.to_numpy()).astype(np.float64) for s in (a, b))
        if metric == "euclidean":
            value = -np.linalg.norm(x - y, axis=1)
        else:
            value = np.einsum("ij,ij->i", x, y)
            if metric == "cosine":
                scale = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
                value = np.divide(value, scale, out=np.zeros_like(value), where=scale > 0)
        return pd.Series(np.round(value, RANK_PLACES))

    return score


def bounded_score(metric: str, sim: Column) -> Column:
    """Score shown to the caller: (1+s)/2, or 1/(1+d) for a distance.

    The choice is this library's own; stores differ in their formula.
    """
    if metric == "euclidean":
        return F.lit(1.0) / (F.lit(1.0) - sim)
    return (F.lit(1.0) + sim) / F.lit(2.0)


def hamming_distance(a: Column, b: Column) -> Column:
    """Differing bits of two signatures of 64-bit words."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda acc, v: acc + v)
