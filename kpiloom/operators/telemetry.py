"""The pipeline's own numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.sources.scrape import error_class

#: Upper bounds of the default latency histogram, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def histogram(rows: DataFrame, keys: list[str], value: str, buckets: tuple[float, ...] = BUCKETS) -> DataFrame:
    """(keys, le, count): how many values lie at or below each bound, with the infinite one; and sum and total."""
    counts = rows.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(buckets)], F.count(value).alias("total"), F.sum(value).alias("sum")
    )
    bound = F.array(*[F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(buckets)], F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("count")))
    return counts.select(*keys, F.explode(bound).alias("x"), "total", "sum").select(*keys, "x.le", "x.count", "total", "sum")


def quantiles(buckets: DataFrame, keys: list[str], wanted: tuple[float, ...]) -> DataFrame:
    """(keys, quantile, value): quantiles of cumulative buckets (``le``, ``count``), those of all series of a key added up.

    A value lies between its bucket's bounds in proportion to its rank; the
    lowest bucket begins at 0 where its bound is positive, else it gives its
    bound, and the infinite one gives the highest finite bound.  Null without
    any value.  Buckets are added up before a key's few bounds come together.
    """
    bound = F.when(F.col("le") == "+Inf", float("inf")).otherwise(F.col("le").cast("double"))
    merged = buckets.groupBy(*keys, bound.alias("le")).agg(F.sum("count").alias("count"))
    rows = merged.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("le", "count"))).alias("b")).withColumn("quantile", F.explode(F.array(*map(F.lit, wanted))))
    rank = F.col("quantile") * F.element_at("b", -1)["count"]
    rows = rows.withColumn("rank", rank).withColumn("i", F.size(F.filter("b", lambda x: x["count"] < F.col("rank"))))
    hit, below = F.get("b", F.col("i")), F.get("b", F.col("i") - 1)
    low, less = F.coalesce(below["le"], F.lit(0.0)), F.coalesce(below["count"], F.lit(0))
    value = (
        F.when(F.element_at("b", -1)["count"] == 0, None)
        .when(hit["le"] == float("inf"), below["le"])
        .when(below.isNull() & (hit["le"] <= 0), hit["le"])
        .when(hit["count"] == less, hit["le"])
        .otherwise(low + (hit["le"] - low) * (F.col("rank") - less) / (hit["count"] - less))
    )
    return rows.select(*keys, "quantile", value.alias("value"))


def counts(records: DataFrame, partial: DataFrame, failures: DataFrame) -> DataFrame:
    """(vendor, metric, count) of records, partial failures (unsupported KPIs aside) and total failures."""
    parts = [
        records.groupBy(F.col("attributes.vendor").alias("vendor")).agg(F.count("*").alias("count")).withColumn("metric", F.lit("records_total")),
        partial.where("NOT unsupported").groupBy("vendor").agg(F.count("*").alias("count")).withColumn("metric", F.lit("partial_failures_total")),
        failures.groupBy("vendor").agg(F.count("*").alias("count")).withColumn("metric", F.lit("total_failures_total")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _one_each(rows: DataFrame, metric: str, step: int, **labels: Column) -> DataFrame:
    """A row (metric, series, at) for each of ``rows``, at the end of its step."""
    at = (F.floor(F.unix_micros("timestamp") / (step * 1_000_000)) + 1) * step
    return rows.select(F.lit(metric).alias("metric"), F.to_json(F.struct(*[v.alias(k) for k, v in labels.items()])).alias("series"), at.alias("at"))


def running_totals(found: DataFrame, step: int) -> DataFrame:
    """(metric, series, at) counted up: a counter's value at each step that changed it, and 0 a step before its first.

    Rows are counted by step before a series' steps come together.
    """
    steps = found.groupBy("metric", "series", "at").agg(F.count("*").alias("n"))
    born = steps.groupBy("metric", "series").agg((F.min("at") - step).alias("at")).withColumn("n", F.lit(0).cast("long"))
    series = Window.partitionBy("metric", "series").orderBy("at")
    return steps.unionByName(born).select("metric", "series", "at", F.sum("n").over(series).cast("double").alias("value"))


def of_run(raw: DataFrame, outcomes: DataFrame, failures: DataFrame, events: DataFrame, step: int = 15) -> DataFrame:
    """(metric, labels, ts, value): what a run tells of itself, from what it has written.

    ``collector_scrape_success`` is a gauge, 1 or 0 for each scrape; the others
    are counters by steps of ``step`` seconds of the rows' own time: scrapes and
    their errors by class, records, partial failures (unsupported KPIs aside),
    scrapes that failed as a whole, late scrapes (one for each, not one a KPI),
    and events by rule.
    """
    collector = F.concat_ws("-", "vendor", F.lower("nf_type"))
    of = {"collector": collector, "instance": F.col("instance_id")}
    failed = raw.where("payload IS NULL")
    late = outcomes.where("kind = 'late'").dropDuplicates(["record_id", "vendor", "nf_type", "instance_id"])
    counted = [
        _one_each(raw, "collector_scrape_total", step, **of),
        _one_each(failed, "collector_scrape_error_total", step, **of, error=error_class(F.col("status"), F.col("timed_out"))),
        _one_each(outcomes.where("kind = 'record'"), "normalizer_records_total", step, vendor=F.col("vendor"), namespace=F.col("namespace")),
        _one_each(outcomes.where("kind = 'partial' AND NOT unsupported"), "normalizer_partial_failures_total", step, vendor=F.col("vendor"), namespace=F.col("namespace")),
        _one_each(failures, "normalizer_total_failures_total", step, vendor=F.col("vendor")),
        _one_each(late, "counter_ooo_total", step, vendor=F.col("vendor")),
        _one_each(events, "correlator_events_total", step, rule_name=F.col("rule_name"), severity=F.col("severity")),
    ]
    totals = running_totals(reduce(DataFrame.unionByName, counted), step)
    labels = F.from_json("series", "map<string,string>").alias("labels")
    gauges = raw.select(F.lit("collector_scrape_success").alias("metric"), F.to_json(F.struct(*[v.alias(k) for k, v in of.items()])).alias("series"), "timestamp", F.when(F.col("payload").isNotNull(), 1.0).otherwise(0.0).alias("value"))
    return gauges.select("metric", labels, F.col("timestamp").alias("ts"), "value").unionByName(totals.select("metric", labels, F.timestamp_seconds("at").alias("ts"), "value"))
