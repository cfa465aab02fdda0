"""Sliding windows per operator network and slice, and anomaly rules over them.

One aggregation computes every rule's statistics by conditional aggregates; a
rule is a predicate and an evidence map over its columns, so all rules share
one shuffle.  Aggregates over (window, key) combine before it, so a network
with a third of all samples costs its tasks no more than their own rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.rules import Rule, Rules

SHIPPED = Rules.load()
#: Series of the shipped rules: name to (namespace, KPI).
NAMES = SHIPPED.series
RULES = SHIPPED.rules

BROADCAST_TICKS = 100_000


def statistics(samples: DataFrame, by: list[str | Column], order: Column | None = None, names: Iterable[str] = NAMES) -> DataFrame:
    """n, mean, sigma, peak and last of every series of ``names`` in ``samples`` (metric, value), by group.

    ``last`` is the last in ``order`` (time, then arrival); sigma is the
    population's; an empty series has n 0 and nulls.
    """
    order = order if order is not None else F.struct("ts", "seq")
    out = []
    for m in names:
        v = F.when(F.col("metric") == m, F.col("value"))
        out += [
            F.count(v).alias(f"{m}_n"), F.avg(v).alias(f"{m}_mean"), F.stddev_pop(v).alias(f"{m}_sigma"), F.max(v).alias(f"{m}_peak"),
            F.max_by(v, F.when(v.isNotNull(), order)).alias(f"{m}_last"),
        ]
    return samples.groupBy(*by).agg(*out)


def events(stats: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """An event for every window and rule whose condition holds; nothing is de-duplicated."""
    found = F.array(
        *[
            F.when(
                r.condition(),
                F.struct(
                    F.lit(r.name).alias("rule_name"), F.lit(r.severity).alias("severity"), F.array(*map(F.lit, r.affected)).alias("affected_nfs"),
                    F.create_map(*[x for k, v in r.evidence().items() for x in (F.lit(k), v.cast("double"))]).alias("evidence"),
                ),
            )
            for r in rules
        ]
    )
    rows = stats.withColumn("e", F.explode(F.filter(found, lambda e: e.isNotNull())))
    return rows.select("e.rule_name", "e.severity", "plmn", "slice_id", "e.affected_nfs", "e.evidence", "window_start", "window_end", F.col("window_end").alias("timestamp"))


def slice_text(sst: Column, sd: Column) -> Column:
    """``sst:sd``, empty without a slice."""
    return F.when(sst.isNull(), "").otherwise(F.concat_ws(":", sst.cast("string"), F.coalesce(sd, F.lit(""))))


def samples(records: DataFrame, prefix: str = "ran.", names: Mapping[str, tuple[str, str]] = NAMES) -> DataFrame:
    """Window samples (plmn, slice_id, metric, ts, seq, value) of normalised records."""
    # one KPI may go by several names
    named = [F.when((F.col("namespace") == prefix + ns) & (F.col("kpi_name") == kpi), m) for m, (ns, kpi) in names.items()]
    s = F.col("attributes.slice_id")
    wanted = records.where(F.col("kpi_name").isin(sorted({kpi for _, kpi in names.values()})))
    rows = wanted.select(
        F.col("attributes.plmn_id").alias("plmn"), slice_text(s["sst"], s["sd"]).alias("slice_id"), F.explode(F.array_compact(F.array(*named))).alias("metric"),
        F.col("timestamp").alias("ts"), F.col("record_id").alias("seq"), "value",
    )
    return rows


def sliding(rows: DataFrame, length: str = "30 seconds", slide: str = "5 seconds", watermark: str | None = None, names: Iterable[str] = NAMES) -> DataFrame:
    """Statistics of epoch-aligned half-open windows; with a watermark also on streams.

    Samples are summed up once for each pane, of the greatest length that both
    the window and the slide are multiples of; windows then merge panes, so no
    sample is copied to all windows that hold it.  On streams these are two
    stateful aggregations, one after the other, and append mode gives a window
    once the watermark has passed it and removes what it held.
    """
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    whole, part = micros(length), micros(slide)
    pane = math.gcd(whole, part)  # bounds of windows are bounds of panes
    if watermark or rows.isStreaming:
        rows = rows.withWatermark("ts", watermark) if watermark else rows
        panes = _panes(rows, F.window("ts", f"{pane} microseconds").alias("pane"), names)
        stats = _merged(panes, F.window(F.window_time("pane"), length, slide).alias("w"), names)
    else:
        at = F.unix_micros("ts")
        panes = _panes(rows, (at - F.pmod(at, F.lit(pane))).alias("pane"), names)
        stats = _merged(panes.withColumn("w", F.explode(_windows_of(F.col("pane"), pane, whole, part))), F.col("w"), names)
    return stats.withColumn("window_start", F.col("w.start")).withColumn("window_end", F.col("w.end")).drop("w")


def micros(interval: str) -> int:
    """A length of time in microseconds."""
    return pd.Timedelta(interval) // pd.Timedelta("1us")


def _windows_of(pane: Column, size: int, whole: int, part: int) -> Column:
    """The windows (start, end) that hold a pane of ``size`` microseconds; they start at multiples of ``part``."""
    first = pane + size - whole
    starts = F.sequence(first + F.pmod(-first, F.lit(part)), pane, F.lit(part))
    return F.transform(starts, lambda s: F.struct(F.timestamp_micros(s).alias("start"), F.timestamp_micros(s + whole).alias("end")))


def _panes(rows: DataFrame, pane: Column, names: Iterable[str]) -> DataFrame:
    """n, mean, squared deviations, peak and last of every series, by pane."""
    out = []
    for m in names:
        v = F.when(F.col("metric") == m, F.col("value"))
        out += [
            F.count(v).alias(f"{m}_n"), F.avg(v).alias(f"{m}_mean"), (F.var_pop(v) * F.count(v)).alias(f"{m}_dev"), F.max(v).alias(f"{m}_peak"),
            F.max(F.when(v.isNotNull(), F.struct(F.struct("ts", "seq").alias("at"), v.alias("v")))).alias(f"{m}_last"),
        ]
    return rows.groupBy(pane, "plmn", "slice_id").agg(*out)


def _spread(m: str, mean: Column) -> Callable[[Column, Column], Column]:
    """Adds a pane's squared deviations from a window's mean."""

    def add(total: Column, pane: Column) -> Column:
        off = pane[f"{m}_mean"] - mean
        return total + F.coalesce(pane[f"{m}_dev"] + pane[f"{m}_n"] * off * off, F.lit(0.0))

    return add


def _merged(panes: DataFrame, window: Column, names: Iterable[str]) -> DataFrame:
    """``statistics`` of the panes in each ``window``, as ``w``.

    The squared deviations from a window's mean are those within panes and those
    of the panes' means from it, taken in a second pass over the few panes of a
    window; sums of squares would cancel where values are large.
    """
    held = F.struct(*[F.col(f"{m}_{x}").alias(f"{m}_{x}") for m in names for x in ("n", "mean", "dev")])
    totals = [a for m in names for a in (F.sum(f"{m}_n").alias(f"{m}_n"), F.sum(F.col(f"{m}_mean") * F.col(f"{m}_n")).alias(f"{m}_total"), F.max(f"{m}_peak").alias(f"{m}_peak"), F.max(f"{m}_last").alias(f"{m}_last"))]
    windows = panes.groupBy(window, "plmn", "slice_id").agg(F.collect_list(held).alias("panes"), *totals)
    columns = []
    for m in names:
        n = F.nullif(F.col(f"{m}_n"), F.lit(0))
        mean = F.col(f"{m}_total") / n

        columns += [F.col(f"{m}_n"), mean.alias(f"{m}_mean"), F.sqrt(F.aggregate("panes", F.lit(0.0), _spread(m, mean)) / n).alias(f"{m}_sigma"), F.col(f"{m}_peak"), F.col(f"{m}_last.v").alias(f"{m}_last")]
    return windows.select("w", "plmn", "slice_id", *columns)


def trailing(rows: DataFrame, ticks: DataFrame, length_seconds: int = 30, names: Iterable[str] = NAMES) -> DataFrame:
    """Statistics of the closed windows [tick - length, tick] for every tick (column ``tick``).

    A sample is copied to the ticks that see it by equi-join on the stretch of
    ``length`` it lies in, so the join never compares all ticks with all samples.
    Up to ``BROADCAST_TICKS`` ticks go to the samples; more meet them by a
    shuffle on the stretch.
    """
    second = lambda c: F.col(c).cast("timestamp").cast("double")
    stretch = lambda c: F.floor(second(c) / length_seconds)
    spread = ticks.select("tick", F.explode(F.array(stretch("tick"), stretch("tick") - 1)).alias("stretch"))
    few = ticks.limit(BROADCAST_TICKS + 1).count() <= BROADCAST_TICKS
    near = rows.withColumn("stretch", stretch("ts")).join(F.broadcast(spread) if few else spread, "stretch")
    seen = near.where((second("ts") <= second("tick")) & (second("ts") >= second("tick") - length_seconds))
    stats = statistics(seen, ["tick", "plmn", "slice_id"], names=names)
    return stats.withColumn("window_end", F.col("tick").cast("timestamp")).withColumn(
        "window_start", (F.col("tick").cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(length_seconds)))
    ).drop("tick")


def event_counts(found: DataFrame) -> DataFrame:
    """How many events by rule, severity, network and slice parts."""
    parts = F.split("slice_id", ":", 2)
    return found.groupBy("rule_name", "severity", "plmn", parts[0].alias("sst"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("sd")).agg(F.count("*").alias("events"))
