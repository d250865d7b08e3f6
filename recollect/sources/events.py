"""Reading chat events, as a table or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recollect import schema


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Event rows from Parquet with the declared schema."""
    return spark.read.schema(schema.EVENTS).parquet(path)


def stream_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New event files in a folder, as a stream."""
    reader = spark.readStream.schema(schema.EVENTS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def one_part(text: Column | str) -> Column:
    """Content made of a single text part."""
    return F.array(F.struct((F.col(text) if isinstance(text, str) else text).alias("text")))


def events_from_messages(
    messages: DataFrame,
    app_name: Column,
    user_id: Column,
    session_id: Column,
    seq: Column,
    author: Column,
    text: Column,
    event_id: Column,
) -> DataFrame:
    """Event rows from a table with one message per row."""
    return messages.select(
        app_name.alias("app_name"),
        user_id.alias("user_id"),
        session_id.alias("session_id"),
        seq.cast("bigint").alias("seq"),
        event_id.alias("event_id"),
        author.alias("author"),
        one_part(text).alias("parts"),
    )
