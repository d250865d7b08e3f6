"""Finding heavy keys, so that joins can split them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy when it holds more than this share of all rows. By counting alone
#: there are fewer than 1/HEAVY_SHARE such keys, whatever the table's size.
HEAVY_SHARE = 1e-4


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    splits: str,
    min_rows: int,
    share: float = HEAVY_SHARE,
    most: int | None = None,
    usual: int = 1,
) -> DataFrame:
    """Keys with more than ``max(min_rows, share * all rows)`` rows and the number of
    pieces each should be cut into (column ``splits``). With ``most`` there are no more pieces
    than that, unless they would then be larger than ``usual``: where the other side is repeated
    for each piece, repeats do not grow with the table as long as pieces are small.

    Only the key columns are read and counts are combined before the shuffle. The
    result has fewer than ``1/share`` rows, which is what makes broadcasting it safe.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_all"))
    limit = F.greatest(F.lit(float(min_rows)), F.lit(share) * total.scalar())
    pieces = F.ceil(F.col("_rows") / F.col("_limit"))
    if most is not None:
        pieces = F.least(pieces, F.greatest(F.lit(most), F.ceil(F.col("_rows") / F.lit(usual))))
    return (
        counts.withColumn("_limit", limit)
        .filter(F.col("_rows") > F.col("_limit"))
        .select(*keys, pieces.cast("int").alias(splits))
    )
