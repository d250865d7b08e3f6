"""How the memory table is laid out in folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "tenant_bucket"
SLICE = "slice"
#: Number of tenant buckets and of slices within each; part of a table's identity.
BUCKETS = 64
SLICES = 4
_METADATA_KEY = "buckets"


def tenant_bucket(buckets: int, app: Column | str = "app_name", user: Column | str = "user_id") -> Column:
    """A tenant's memories share a bucket, so a search of one tenant reads one bucket."""
    return F.pmod(F.xxhash64(app, user), F.lit(buckets)).cast("int")


def memory_slice(slices: int) -> Column:
    """A bucket is cut by memory, so a large tenant lies in several folders."""
    return F.pmod(F.xxhash64("memory_id"), F.lit(slices)).cast("int")


def mark_buckets(df: DataFrame, buckets: int) -> DataFrame:
    """Notes the number of buckets on the bucket column, for readers further on."""
    return df.withMetadata(BUCKET, {_METADATA_KEY: buckets})


def tenant_bucket_like(
    memories: DataFrame, app: Column | str = "app_name", user: Column | str = "user_id"
) -> Column:
    """The bucket rule of the table ``memories`` was read from."""
    return tenant_bucket(memories.schema[BUCKET].metadata[_METADATA_KEY], app, user)
