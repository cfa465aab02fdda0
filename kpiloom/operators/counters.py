"""Counter deltas in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def delta(value: Column, before: Column, reset_aware: Column | bool = True) -> Column:
    """The increase since ``before``: the value itself at first sight or, if reset-aware, after a decrease."""
    aware = F.lit(reset_aware) if isinstance(reset_aware, bool) else reset_aware
    change = value - before
    return F.when(before.isNull(), value).when((change < 0) & aware, value).otherwise(change)


def with_deltas(
    samples: DataFrame,
    keys: list[str],
    order: list[str],
    value: str = "value",
    reset_aware: bool = True,
    ttl_seconds: float | None = None,
    at: str = "ts",
) -> DataFrame:
    """``samples`` with delta, reset (any decrease), expired and late (time before the last) by key.

    A sample ``ttl_seconds`` or more after the last one counts as the first.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    last, last_at = F.lag(value).over(window), F.lag(at).over(window)
    gap = F.col(at).cast("timestamp").cast("double") - last_at.cast("timestamp").cast("double")
    expired = F.coalesce(gap >= ttl_seconds, F.lit(False)) if ttl_seconds is not None else F.lit(False)
    before = F.when(~expired, last)
    return samples.select(
        "*",
        delta(F.col(value), before, reset_aware).alias("delta"),
        F.coalesce(F.col(value) < before, F.lit(False)).alias("reset"),
        expired.alias("expired"),
        F.coalesce(gap < 0, F.lit(False)).alias("late"),
    )
