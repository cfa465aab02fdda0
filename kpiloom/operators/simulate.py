"""Scenarios: deterministic series over ticks, and the check of expected events against observed ones."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.operators import correlate
from kpiloom.operators.normalize import normalize
from kpiloom.registry import Registry
from kpiloom.sources.exposition import rendered

SHIPPED = Path(__file__).parent.parent / "scenarios"
START = "2024-01-01 00:00:00"


@dataclass
class Scenario:
    """A scenario file: network functions with their metrics and events, and the expected anomalies."""

    name: str
    duration: int
    nfs: list[dict]
    expected: list[dict]

    @staticmethod
    def load(path: str | Path) -> Scenario:
        d = yaml.safe_load(Path(path).read_text())
        return Scenario(d["name"], int(d.get("duration", 0)), d.get("nfs", []), d.get("expected_events", []))

    @staticmethod
    def load_all(directory: str | Path = SHIPPED) -> list[Scenario]:
        """The named scenarios of a directory's YAML files, by name; unreadable files are passed over."""
        out = []
        for f in sorted(Path(directory).iterdir()):
            if f.suffix in (".yaml", ".yml"):
                try:
                    out.append(Scenario.load(f))
                except (yaml.YAMLError, KeyError, TypeError):
                    continue
        return sorted((s for s in out if s.name), key=lambda s: s.name)


def metrics(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    """One row for each series of each scenario: its base values and the events on it, in the scenario's order."""
    rows = []
    for scenario, nf in ((s, nf) for s in scenarios for nf in s.nfs):
        for ord_, m in enumerate(nf["metrics"]):
            labels = m.get("labels") or {}
            hits = [
                (int(e["start_sec"]), int(e["duration_sec"]), float(e.get("override") or 0) or None, float(e.get("rate_scale") or 0) or None)
                for e in nf.get("events", [])
                if e["metric"] == m["name"] and all(labels.get(k) == v for k, v in (e.get("labels") or {}).items())
            ]
            rows.append((scenario.name, scenario.duration, nf["vendor"], nf["type"], nf["instance_id"], nf.get("protocol", "prometheus"), ord_, m["name"], labels, m["type"], float(m.get("baseline", 0)), float(m.get("rate_per_second", 0)), float(m.get("jitter", 0)), hits))
    return spark.createDataFrame(
        rows,
        "scenario string, duration int, vendor string, nf_type string, instance_id string, protocol string, ord int, name string, labels map<string,string>, type string, baseline double,"
        " rate double, jitter double, events array<struct<start:int,duration:int,override:double,scale:double>>",
    )


def series(spark: SparkSession, scenarios: list[Scenario], seed: int = 1) -> DataFrame:
    """The scenarios' series at ticks 0 to duration.

    A counter grows by its rate times the scales of all events active at the
    step's end; a gauge has its first active override, else jitters around its
    baseline by a hash of tick and series.
    """
    rows = metrics(spark, scenarios).withColumn("tick", F.explode(F.sequence(F.lit(0), "duration")))

    def active(e: Column) -> Column:
        return (e["start"] <= F.col("tick")) & (F.col("tick") < e["start"] + e["duration"])

    now = F.filter("events", active)
    scale = F.aggregate(F.filter(now, lambda e: e["scale"].isNotNull()), F.lit(1.0), lambda a, e: a * e["scale"])
    override = F.try_element_at(F.filter(now, lambda e: e["override"].isNotNull()), F.lit(1))["override"]
    noise = F.pmod(F.xxhash64(F.lit(seed), "tick", "instance_id", "name", "ord"), F.lit(2_000_001)) / 1_000_000.0 - 1.0
    run = Window.partitionBy("scenario", "instance_id", "nf_type", "ord").orderBy("tick")
    step = F.when(F.col("tick") > 0, F.col("rate") * scale).otherwise(0.0)
    value = F.when(F.col("type") == "counter", F.col("baseline") + F.sum(step).over(run)).otherwise(F.coalesce(override, F.col("baseline") + noise * F.col("jitter")))
    return rows.select("scenario", "tick", "vendor", "nf_type", "instance_id", "protocol", "ord", "name", "labels", "type", value.alias("value"))


def scrapes(points: DataFrame) -> DataFrame:
    """The series rendered as raw records, one scrape an instance and tick, in simulated time.

    A scenario is an operator network of its own, so that windows keep scenarios apart.
    """
    lines = F.array_sort(F.collect_list(F.struct("name", "ord", rendered(F.col("name"), F.col("labels"), F.col("value")).alias("line"), "type")), _by_name)
    text = F.array_join(F.transform(lines, lambda x: F.concat(F.lit("# TYPE "), x["name"], F.lit(" "), x["type"], F.lit("\n"), x["line"])), "\n")
    rows = points.where("protocol = 'prometheus'").groupBy("scenario", "vendor", "nf_type", "instance_id", "protocol", "tick").agg(text.alias("text"))
    return rows.select(
        F.xxhash64("scenario", "nf_type", "instance_id", "tick").alias("record_id"), "vendor", "nf_type", F.concat_ws("/", "scenario", "instance_id").alias("instance_id"), F.lit("sim").alias("endpoint"), F.encode("text", "UTF-8").alias("payload"), "protocol",
        (F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("tick"))).alias("timestamp"),
        F.create_map(F.lit("plmn"), F.col("scenario")).alias("meta"), F.lit("v1").alias("schema_version"),
    )


def _by_name(a: Column, b: Column) -> Column:
    return F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(a["ord"] - b["ord"])


def observed(spark: SparkSession, scenarios: list[Scenario], registry: Registry, window: int = 30, every: int = 5) -> DataFrame:
    """The events (with scenario and at_sec) that the rules find; tick 0 only warms the counters up."""
    start = F.lit(START).cast("timestamp")
    records = normalize(scrapes(series(spark, scenarios)), registry).records.where(F.col("timestamp") > start)
    last = max(s.duration for s in scenarios)
    ticks = spark.range(every, last + 1, every).select((start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("tick"))
    found = correlate.events(correlate.trailing(correlate.samples(records, registry.prefix), ticks, window))
    at = (F.col("timestamp").cast("double") - start.cast("double")).cast("int")
    duration = F.create_map(*[F.lit(x) for s in scenarios for x in (s.name, s.duration)])
    return found.withColumn("scenario", F.col("plmn")).withColumn("at_sec", at).where(F.col("at_sec") <= duration[F.col("scenario")])


def expectations(spark: SparkSession, scenarios: list[Scenario]) -> DataFrame:
    """One row for each expected event, and one with a null rule for a scenario that expects none."""
    names = ("gt", "lt", "gte", "lte", "eq")
    rows = []
    for s in scenarios:
        for i, e in enumerate(s.expected or [{}]):
            evidence = {k: tuple(float(v[n]) if v.get(n) is not None else None for n in names) for k, v in (e.get("evidence") or {}).items()}
            within = int(e.get("within_seconds") or 0) or s.duration
            rows.append((s.name, s.nfs[0]["vendor"], i, e.get("rule"), e.get("severity"), within, list(e.get("affected_nfs") or []), evidence))
    return spark.createDataFrame(
        rows,
        "scenario string, vendor string, id int, rule string, severity string, within_seconds int, affected array<string>,"
        " evidence map<string,struct<gt:double,lt:double,gte:double,lte:double,eq:double>>",
    )


def assess(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(scenario, vendor, id, rule, passed, at_sec): the first event that meets each expectation.

    An event may meet several expectations; an expectation without rule is met
    by a scenario without events.
    """

    def holds(bound: Column, test: Column) -> Column:
        return bound.isNull() | F.coalesce(test, F.lit(False))

    def meets(e: Column) -> Column:
        v, c = F.try_element_at("o.evidence", e["key"]), e["value"]
        checks = holds(c["gt"], v > c["gt"]) & holds(c["lt"], v < c["lt"]) & holds(c["gte"], v >= c["gte"]) & holds(c["lte"], v <= c["lte"]) & holds(c["eq"], v == c["eq"])
        return v.isNotNull() & checks

    e, o = expected.alias("e"), found.alias("o")
    asked = (
        (F.col("e.rule") == F.col("o.rule_name"))
        & (F.coalesce("e.severity", F.lit("")).isin("") | (F.col("e.severity") == F.col("o.severity")))
        & (F.size(F.array_except("e.affected", "o.affected_nfs")) == 0)
        & (F.col("o.at_sec") <= F.col("e.within_seconds"))
        & F.forall(F.map_entries("e.evidence"), meets)
    )
    fits = (F.col("e.scenario") == F.col("o.scenario")) & (F.col("e.rule").isNull() | F.coalesce(asked, F.lit(False)))
    keys = [F.col(f"e.{k}").alias(k) for k in ("scenario", "vendor", "id", "rule")]
    joined = e.join(o, fits, "left").groupBy(*keys).agg(F.min("o.at_sec").alias("at_sec"))
    return joined.select("scenario", "vendor", "id", F.coalesce("rule", F.lit("none")).alias("rule"), (F.col("rule").isNull() == F.col("at_sec").isNull()).alias("passed"), "at_sec")


def base_name(name: str) -> Column:
    """A scenario's name without its vendor."""
    return F.regexp_replace(name, "^(free5gc|open5gs|oai|nokia|ericsson)_", "")


def certify(spark: SparkSession, scenarios: list[Scenario], registry: Registry) -> DataFrame:
    """(scenario, base, vendor, rule, passed, at_sec) of every expectation, all scenarios in one job."""
    results = assess(expectations(spark, scenarios), observed(spark, scenarios, registry))
    return results.select("scenario", base_name("scenario").alias("base"), "vendor", "rule", "passed", "at_sec")


def matrix(results: DataFrame) -> DataFrame:
    """Results by rule and scenario base, with a line for each vendor, and counts."""
    line = F.struct("vendor", "passed", "at_sec")
    return results.groupBy("rule", "base").agg(F.array_sort(F.collect_list(line)).alias("vendors"), F.count_if("passed").alias("passed"), F.count("*").alias("total"), F.bool_and("passed").alias("ok"))
