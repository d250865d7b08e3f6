"""Expiry of memories a number of seconds after their last update."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recollect.config import TENANT, Now
from recollect.functions.text import moment


def expiry(ttl_seconds: int, updated_at: Column | str = "updated_at") -> Column:
    updated = F.col(updated_at) if isinstance(updated_at, str) else updated_at
    return updated + F.make_dt_interval(secs=F.lit(ttl_seconds))


def live(memories: DataFrame, ttl_seconds: int | None, now: Now) -> DataFrame:
    """What a purge at ``now`` leaves. The bound is computed from ``now``, so the
    comparison is with the bare column and reaches the scan."""
    if ttl_seconds is None:
        return memories
    bound = moment(now) - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return memories.filter(F.col("updated_at").isNull() | (F.col("updated_at") > bound))


def expired(memories: DataFrame, ttl_seconds: int | None, now: Now) -> DataFrame:
    """What a purge at ``now`` removes; rows without a time never expire."""
    if ttl_seconds is None:
        return memories.limit(0)
    bound = moment(now) - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return memories.filter(F.col("updated_at") <= bound)


def retention_report(memories: DataFrame, ttl_seconds: int, now: Now) -> DataFrame:
    """Live and expired rows per tenant and when the next live one expires."""
    ends, now = expiry(ttl_seconds), moment(now)
    is_live = F.col("updated_at").isNull() | (ends > now)
    return memories.groupBy(*TENANT).agg(
        F.count_if(is_live).alias("live"),
        F.count_if(~is_live).alias("expired"),
        F.min(F.when(is_live, ends)).alias("next_expiry"),
    )
