"""The query-language constructs that the shipped dashboards and alerts use."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples in a task that puts series in order.
TASK_ROWS = 250_000


def dealt(samples: DataFrame, keys: list[str]) -> DataFrame:
    """``samples`` by ``keys`` in tasks of about ``TASK_ROWS``, whatever their number.

    Adaptive execution joins partitions by their compressed size; samples of a
    series compress so well that a task would get millions, and sort them in
    memory as they are.
    """
    spark = samples.sparkSession
    return samples.repartition(max(math.ceil(samples.count() / TASK_ROWS), spark.sparkContext.defaultParallelism), *keys)


def instant(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts") -> DataFrame:
    """The last value of each series that is not null."""
    samples = samples.where(F.col(value).isNotNull())
    return samples.groupBy(*keys).agg(F.max_by(value, ts).alias("value"), F.max(ts).alias("ts"))


def increase(samples: DataFrame, keys: list[str], window: str, value: str = "value", ts: str = "ts") -> DataFrame:
    """Reset-corrected increase of each series by window, without extrapolation to the window's edges."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(ts))
    change = F.when(before.isNull(), 0.0).when(F.col(value) < before, F.col(value)).otherwise(F.col(value) - before)
    rows = samples.withColumn("_change", change).withColumn("_ts", F.col(ts).cast("timestamp"))
    return rows.groupBy(*keys, F.window("_ts", window).alias("w")).agg(F.sum("_change").alias("increase")).withColumn("window_start", F.col("w.start")).drop("w")


def rate(samples: DataFrame, keys: list[str], window: str, seconds: int, **names) -> DataFrame:
    """``increase`` for each second of the window."""
    return increase(samples, keys, window, **names).withColumn("rate", F.col("increase") / seconds)


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _steps(first: Column, before: Column, step: int) -> Column:
    """The multiples of ``step`` seconds from ``first`` to, but without, ``before`` (both in microseconds), in seconds."""
    start, stop = (F.ceil(c / (step * 1_000_000)).cast("bigint") for c in (first, before))
    return F.when(stop > start, F.transform(F.sequence(start, stop - 1), lambda i: i * step))


def increase_over(samples: DataFrame, keys: list[str], window: int, step: int, value: str = "value", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """(keys, step, increase): at every ``step`` seconds, the reset-corrected increase within the ``window`` seconds up to it.

    The window is half-open, (step - window, step]; it needs two samples, and
    nothing is extrapolated to its edges.  Each change between neighbours goes
    to the steps whose window holds both, window / step of them at most.
    """
    order = Window.partitionBy(*keys).orderBy(ts, *([tie] if tie else []))
    now, before, before_at = F.col(value), F.lag(value).over(order), F.lag(_micros(ts)).over(order)
    change = F.when(now < before, now).otherwise(now - before).cast("double")
    rows = dealt(samples, keys).select(*keys, change.alias("change"), _micros(ts).alias("at"), before_at.alias("before_at"))
    spread = rows.select(*keys, "change", F.explode(_steps(F.col("at"), F.col("before_at") + window * 1_000_000, step)).alias("step"))
    return spread.groupBy(*keys, "step").agg(F.sum("change").alias("increase"))


def at_steps(samples: DataFrame, keys: list[str], lookback: int, step: int, value: str = "value", ts: str = "ts", tie: str | None = None) -> DataFrame:
    """(keys, step, value): at every ``step`` seconds the last value that is not null, if it is less than ``lookback`` seconds old."""
    order = Window.partitionBy(*keys).orderBy(ts, *([tie] if tie else []))
    held = dealt(samples, keys).where(F.col(value).isNotNull())
    rows = held.select(*keys, F.col(value).cast("double").alias("value"), _micros(ts).alias("at"), F.lead(_micros(ts)).over(order).alias("next_at"))
    until = F.least(F.col("at") + lookback * 1_000_000, F.coalesce("next_at", F.col("at") + lookback * 1_000_000))
    return rows.select(*keys, "value", F.explode(_steps(F.col("at"), until, step)).alias("step"))


def divided(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """value of ``left`` by value of ``right`` where labels agree; null where the divisor is 0."""
    joined = left.withColumnRenamed("value", "_l").join(right.withColumnRenamed("value", "_r"), on)
    return joined.withColumn("value", F.when(F.col("_r") != 0, F.col("_l") / F.col("_r"))).drop("_l", "_r")


def held_for(samples: DataFrame, keys: list[str], condition: Column, seconds: int, ts: str = "ts", stretch: str = "30 days") -> DataFrame:
    """Stretches (start, end) in which the condition held at every sample for ``seconds`` or more.

    Islands are found within stretches of time first, so one series is many
    tasks; then a window over what is left of each stretch, its islands at the
    edges, joins those that go on.
    """
    by = [*keys, "_stretch"]
    order = Window.partitionBy(*by).orderBy(ts)
    flagged = samples.withColumn("_on", F.coalesce(condition, F.lit(False))).withColumn("_stretch", F.window(F.col(ts).cast("timestamp"), stretch)["start"])
    islands = flagged.withColumn("_island", F.sum(F.when(F.col("_on"), 0).otherwise(1)).over(order))
    span = [F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("samples")]
    on = islands.where("_on").groupBy(*by, "_island").agg(*span)
    whole = islands.groupBy(*by).agg(F.max("_island").alias("_last"))  # the last island reaches the stretch's end, island 0 its start
    pieces = whole.join(on, by, "left")
    across = Window.partitionBy(*keys).orderBy("_stretch", "_island")
    breaks = F.when((F.col("_island") == 0) & F.coalesce(F.lag((F.col("_island") == F.col("_last")) & F.col("start").isNotNull()).over(across), F.lit(False)), 0).otherwise(1)
    joined = pieces.withColumn("_run", F.sum(breaks).over(across)).where("start IS NOT NULL")
    spans = joined.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("samples").alias("samples"))
    length = F.col("end").cast("timestamp").cast("double") - F.col("start").cast("timestamp").cast("double")
    return spans.where(length >= seconds).drop("_run")
