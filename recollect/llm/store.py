"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect.session import scratch_path

#: Up to so many rows a table is broadcast by ``spread``; of a larger one only the keys that have
#: more than one row in so many, which are fewer than that.
BROADCAST_ROWS, HEAVY = 200_000, 10_000
#: Numbers that ``beside`` broadcasts at once, about; a row counts as ten.
CELLS = 10_000_000

_recorded: list[str] | None = None


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, fixes row ids, and survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    if _recorded is not None:
        _recorded.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Add what ``stored`` writes meanwhile to ``paths``."""
    global _recorded
    before, _recorded = _recorded, paths
    try:
        yield
    finally:
        _recorded = before


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``stored`` wrote, and empty the list."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored``, once nothing unwritten depends on them any more."""
    for table in tables:
        delete(table.sparkSession, list({file.rsplit("/", 1)[0] for file in table.inputFiles()}))


def spread(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``small`` (a stored table with one row per ``key``), where a key may
    hold a third of the rows: by broadcast, or that of the heavy keys only. No key is repeated for
    this, as Spark would take the repeated table for as small as the one stored, and broadcast it."""
    if small.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), key)
    each = stored(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "sizes")
    heavy = F.broadcast(stored(each.filter(F.col("n") > (each.agg(F.sum("n")).first()[0] or 0) / HEAVY).select(key), "heavy"))
    discard(each)
    many = rows.join(F.broadcast(small.join(heavy, key, "left_semi")), key)
    return many.union(unsized(rows.join(heavy, key, "left_anti"), small, key))


def unsized(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """An inner join in which Spark broadcasts neither side by its own estimate: it takes a compressed
    file, or an explode, for far smaller than the rows that are in it."""
    return left.join(right.hint("merge"), key)


def beside(rows: DataFrame, small: DataFrame, how: str, cells: Column | None = None) -> DataFrame:
    """``rows`` joined to ``small`` (a stored table with one row per ``uid``; ``cells`` numbers in
    each), for ``how`` left or left_anti. ``rows`` hold whole texts and are not shuffled: ``small``
    is broadcast, if it is large in ranges of ``uid``, one after the other."""
    weight = small.agg(F.sum(F.lit(10) + (F.lit(0) if cells is None else cells))).first()[0] or 0
    parts = -(-weight // CELLS)
    if parts <= 1:
        return rows.join(F.broadcast(small), "uid", how)
    cuts = sorted({int(x) for x in small.approxQuantile("uid", [k / parts for k in range(1, parts)], 0.1 / parts)})
    found = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        inside = (F.lit(True) if low is None else F.col("uid") >= low) & (F.lit(True) if high is None else F.col("uid") < high)
        found.append(stored(rows.filter(inside).join(F.broadcast(small.filter(inside)), "uid", how), "beside"))
    return reduce(DataFrame.union, found)


def numbered(docs: DataFrame, text: str, carry: bool, id_col: str) -> DataFrame:
    """``uid``, ``doc`` (struct of the columns to give back, but for the text) and ``text``.

    Names of the input cannot clash with the operators' own, as they are inside ``doc``.
    With ``carry`` all columns are kept, else the id column only. ``uid`` is stable only
    once the result is stored.
    """
    kept = [docs[f"`{c}`"] for c in (docs.columns if carry else [id_col]) if c != text or c == id_col]
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*kept).alias("doc"), docs[f"`{text}`"].alias("text"))


def given_back(rows: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns of the input from ``doc`` and ``text``."""
    return rows.select(*[(F.col("text") if c == text else F.col("doc")[c]).alias(c) for c in columns])
