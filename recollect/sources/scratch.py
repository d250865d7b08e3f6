"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recollect.session import scratch_path

#: Whether Spark deletes a query's shuffle files when it has ended, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to a fresh folder and read back: computed once, whatever executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """``stored``, for a large shuffle of which nothing else reads: its files are deleted at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name, "zstd")
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored``, once nothing unwritten depends on them any more."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
