"""Rules from files and quantiles of cumulative buckets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kpiloom.operators import correlate, telemetry
from kpiloom.operators.rules import SHIPPED, RuleError, Rules


def windows(spark, rows, names):
    """rows: (metric, second, value)."""
    samples = spark.createDataFrame(rows, "metric string, s long, value double").selectExpr("'n' AS plmn", "'' AS slice_id", "metric", "timestamp_seconds(s) AS ts", "s AS seq", "value")
    return correlate.sliding(samples, "60 seconds", "60 seconds", names=names)


def test_a_rule_on_a_new_kpi_needs_a_file_only(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("series: {q: {namespace: amf, kpi: queue.depth}, r: {namespace: amf, kpi: registration.success_rate}}\nrules: [{name: Full, affected: [AMF], when: [q.n >= 2, q.last > 2 * q.mean - 1, r.last < 0.9], evidence: {depth: q.last}}, {name: Halved, severity: critical, when: q.last / q.peak < 0.5}]\n")
    rules = Rules.load(SHIPPED, tmp_path / "a.yaml")
    assert [r.name for r in rules.rules] == ["RegistrationStorm", "SessionDrop", "RANCoreDivergence", "Full", "Halved"]
    assert rules.series["q"] == ("amf", "queue.depth") and rules.series["r"] == rules.series["reg_rate"]
    rows = [("q", 0, 1.0), ("q", 5, 9.0), ("r", 5, 0.5)]  # fires: 9 > 2 * 5 - 1 does not, below it does
    rows += [("q", 60, 1.0), ("q", 65, 1.0), ("q", 70, 10.0), ("r", 70, 0.5)]
    rows += [("q", 120, 10.0), ("q", 125, 1.0)]  # no rate: the conjunction has no value; halved
    rows += [("q", 180, 0.0)]  # 0 / 0 holds for nothing
    rows += [("r", 240, 0.1)]  # no depth at all
    found = correlate.events(windows(spark, rows, rules.series), rules.rules).select(F.unix_timestamp("window_start").alias("s"), "rule_name", "severity", "affected_nfs", "evidence")
    assert sorted((r.s, r.rule_name, r.severity, r.affected_nfs, r.evidence) for r in found.collect()) == [(60, "Full", "warning", ["AMF"], {"depth": 10.0}), (120, "Halved", "critical", [], {})]


def test_one_kpi_under_two_names_is_read_for_both(spark):
    record = spark.sql("SELECT 'ran.amf' AS namespace, 'k' AS kpi_name, 2.0D AS value, timestamp_seconds(0) AS timestamp, 7L AS record_id, named_struct('plmn_id', 'p', 'slice_id', named_struct('sst', 1, 'sd', 'x')) AS attributes")
    got = correlate.samples(record.unionByName(record.withColumn("kpi_name", F.lit("other"))), names={"a": ("amf", "k"), "b": ("amf", "k"), "c": ("smf", "k")}).collect()
    assert sorted((r.metric, r.slice_id, r.value, r.seq) for r in got) == [("a", "1:x", 2.0, 7), ("b", "1:x", 2.0, 7)]


@pytest.mark.parametrize(
    "text",
    [
        "", "a: [", "rules: []", "rules: [{name: A}]", "rules: [{name: A, when: x.n > 1}]", "series: {x: {namespace: a}}\nrules: [{name: A, when: x.n > 1}]",
        "series: {x: {namespace: a, kpi: k}}\nrules: [{name: A, when: x.median > 1}]", "series: {x: {namespace: a, kpi: k}}\nrules: [{name: A, when: x.n >}]",
        "series: {x: {namespace: a, kpi: k}}\nrules: [{name: A, when: 1 > 0}]", "series: {x: {namespace: a, kpi: k}}\nrules: [{name: A, when: x.n > 1}, {name: A, when: x.n > 2}]",
        "series: {x: {namespace: a, kpi: k}}\nrules: [{name: SessionDrop, when: x.n > 1}]", "series: {att: {namespace: a, kpi: k}}\nrules: [{name: A, when: att.n > 1}]",
    ],
)
def test_rule_files_that_cannot_be_run(tmp_path, text):
    (tmp_path / "a.yaml").write_text(text)
    with pytest.raises(RuleError):
        Rules.load(SHIPPED, tmp_path / "a.yaml")


def test_quantiles_of_merged_buckets(spark):
    rows = [("a", 1, "1.0", 2), ("a", 1, "2.0", 4), ("a", 1, "+Inf", 4), ("a", 2, "1.0", 0), ("a", 2, "2.0", 4), ("a", 2, "+Inf", 6), ("none", 1, "1.0", 0), ("none", 1, "+Inf", 0), ("low", 1, "-1.0", 3), ("low", 1, "+Inf", 3)]
    df = spark.createDataFrame(rows, "k string, series int, le string, count long")
    got = {(r.k, r.quantile): r.value for r in telemetry.quantiles(df, ["k"], (0.1, 0.5, 0.99)).collect()}
    assert got[("a", 0.1)] == pytest.approx(0.5) and got[("a", 0.5)] == pytest.approx(1.5)
    assert got[("a", 0.99)] == 2.0 and got[("none", 0.5)] is None and got[("low", 0.5)] == -1.0
