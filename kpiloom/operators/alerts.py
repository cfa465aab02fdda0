"""Alert rules over the pipeline's own telemetry, evaluated at regular steps.

Telemetry is rows (metric, labels, ts, value).  A rule's expression gives a
value for each series and step; where it meets the threshold at every step for
``hold`` seconds, the alert fires.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators import promql

_COMPARE = {"==": operator.eq, ">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "!=": operator.ne}


@dataclass(frozen=True)
class Alert:
    """``function`` (instant, rate or increase over ``window`` seconds) of a metric, compared with a threshold."""

    name: str
    metric: str
    function: str
    window: int
    compare: str
    threshold: float
    hold: int
    severity: str = "warning"
    labels: dict[str, str] = field(default_factory=dict)


#: The alerts that ship.
ALERTS = (
    Alert("CollectorScrapeFailure", "collector_scrape_success", "instant", 300, "==", 0, 120),
    Alert("CollectorHighErrorRate", "collector_scrape_error_total", "rate", 300, ">", 0.1, 300),
    Alert("NormalizerQueueSaturated", "normalizer_worker_queue_depth", "instant", 300, ">", 200, 60),
    Alert("NormalizerHighSkew", "normalizer_worker_dispatch_skew", "instant", 300, ">", 50, 300),
    Alert("DeadLetterAccumulating", "dead_letter_total", "rate", 600, ">", 0, 600),
    Alert("StoreErrors", "counter_store_errors_total", "rate", 300, ">", 0, 120, "critical"),
    Alert("CounterResetStorm", "counter_reset_total", "rate", 300, ">", 10, 60),
    Alert("OOOTelemetry", "counter_ooo_total", "rate", 300, ">", 5, 300),
    Alert("RegistrationStorm", "correlator_events_total", "increase", 300, ">", 0, 0, "critical", {"rule_name": "RegistrationStorm"}),
    Alert("SessionDrop", "correlator_events_total", "increase", 300, ">", 0, 0, "warning", {"rule_name": "SessionDrop"}),
    Alert("RANCoreDivergence", "correlator_events_total", "increase", 300, ">", 0, 0, "warning", {"rule_name": "RANCoreDivergence"}),
)


def series_key(labels: Column) -> Column:
    """Labels as one string, in order of name."""
    entries = F.array_sort(F.map_entries(F.coalesce(labels, F.create_map().cast("map<string,string>"))))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ",")


def _selected(rule: Alert) -> Column:
    held = F.col("metric") == rule.metric
    for k, v in rule.labels.items():
        held = held & (F.try_element_at("labels", F.lit(k)) == v)
    return held


def evaluate(telemetry: DataFrame, rules: Sequence[Alert] = ALERTS, step: int = 30) -> DataFrame:
    """(alert, severity, series, since, fires_at, until, peak) of every stretch in which a rule held long enough.

    Rules with one function and window share one pass over their metrics.
    Stretches are found where a series was put in order, so hits are not moved.
    """
    rows = telemetry.withColumn("series", series_key(F.col("labels")))
    found = None
    for function, window in dict.fromkeys((r.function, r.window) for r in rules):
        group = [r for r in rules if (r.function, r.window) == (function, window)]
        own = rows.where(F.col("metric").isin(sorted({r.metric for r in group})))
        keys = ["metric", "series", "labels_key"]
        own = own.withColumn("labels_key", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("labels")))))  # a map is no grouping key
        if function == "instant":
            values = promql.at_steps(own, keys, window, step)
        else:
            values = promql.increase_over(own, keys, window, step).withColumnRenamed("increase", "value")
            if function == "rate":
                values = values.withColumn("value", F.col("value") / window)
        values = values.withColumn("labels", F.from_json("labels_key", "map<string,string>"))
        named = [
            F.when(
                _selected(r) & _COMPARE[r.compare](F.col("value"), r.threshold),
                F.struct(F.lit(r.name).alias("alert"), F.lit(r.severity).alias("severity"), F.lit(r.hold).alias("hold")),
            )
            for r in group
        ]
        hits = values.select(*keys, "step", "value", F.explode(F.filter(F.array(*named), lambda x: x.isNotNull())).alias("r")).select(*keys, "step", "value", "r.*")
        order = Window.partitionBy(*keys, "alert").orderBy("step")
        islands = hits.withColumn("island", F.col("step") - F.row_number().over(order) * step)
        spans = islands.groupBy(*keys, "alert", "severity", "hold", "island").agg(F.min("step").alias("since"), F.max("step").alias("until"), F.max("value").alias("peak"))
        found = spans if found is None else found.unionByName(spans)
    return found.where("until - since >= hold").select("alert", "severity", "series", "since", (F.col("since") + F.col("hold")).alias("fires_at"), "until", "peak")
