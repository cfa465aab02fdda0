"""Golden values of the telemetry pipeline."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.functions import formula, paths
from kpiloom.functions.transforms import compile_transform, failure, seconds
from kpiloom.operators import correlate, promql
from kpiloom.operators.counters import with_deltas
from kpiloom.operators.normalize import normalize
from kpiloom.operators.series_index import VendorIndex
from kpiloom.registry import Mapping, Registry, RegistryError
from kpiloom.schema import RAW
from kpiloom.sources import exposition, gnmi
from kpiloom.sources.scrape import COLLECTORS, Collector

T0 = dt.datetime(2024, 1, 1)


def amf(a, f, d, u):
    return f"""# TYPE free5gc_nas_msg_received_total counter
free5gc_nas_msg_received_total{{name="RegistrationRequest"}} {a}
free5gc_nas_nas_msg_sent_total{{name="RegistrationReject"}} {f}
free5gc_nas_msg_received_total{{name="DeregistrationRequestUEOriginatingDeregistration"}} {d}
free5gc_amf_business_ue_connectivity {u}
""".encode()


def scrape(i, payload, vendor="free5gc", nf="AMF", instance="a", protocol="prometheus"):
    return (i, vendor, nf, instance, "", payload, protocol, T0 + dt.timedelta(seconds=15 * i), None, "v1")


@pytest.fixture(scope="module")
def normal(spark):
    rows = [
        scrape(1, amf(1000, 3, 50, 950)),
        scrape(2, amf(1050, 5, 55, 960)),
        scrape(3, amf(12, 0, 2, 950)),
        scrape(4, b"", instance="b"),
        scrape(5, amf(0, 0, 0, 0), instance="c"),
        scrape(6, b"", vendor="unknown"),
        scrape(7, b"", nf="NSSF"),
        scrape(8, b"", protocol="netconf"),
        scrape(9, gnmi.encode([("/gnb/cell/prb/utilization", {}, 0.72), ("/gnb/handover/attempts", {}, 500.0), ("/gnb/handover/successes", {}, 490.0)]), "oai", "gNB", "g", "gnmi"),
        scrape(10, gnmi.encode([("/gnb/handover/attempts", {}, 600.0), ("/gnb/handover/successes", {}, 585.0)]), "oai", "gNB", "g", "gnmi"),
        scrape(11, b"\xff\xff", "oai", "gNB", "g2", "gnmi"),
        scrape(12, b"ericsson_pm:job:rd:pmNrRegInitAttSum:amf_001 5000\nericsson_pm:job:rd:pmNrRegInitFailSum:amf_001 12\nericsson_pm:job:rd:pmNrRrcConnectedUeSum:amf_001 920\n", "ericsson_enm", instance="e"),
    ]
    out = normalize(spark.createDataFrame(rows, RAW), Registry.load())
    records = {(r.record_id, r.kpi_name): r for r in out.records.collect()}
    partial = {(r.record_id, r.kpi_name): (r.reason, r.unsupported) for r in out.partial.collect()}
    return records, partial, {r.record_id: r.reason for r in out.failures.collect()}


def test_deltas_resets_and_derived_rates(normal):
    records, _, _ = normal
    value = lambda i, k: records[i, k].value
    assert [value(1, f"registration.{k}") for k in ("attempt_count", "failure_count")] == [1000, 3]
    assert value(1, "registration.success_rate") == pytest.approx(0.997)
    assert (value(2, "registration.attempt_count"), value(2, "registration.failure_count"), value(2, "deregistration.count"), value(2, "ue.connected_count")) == (50, 2, 5, 960)
    assert value(2, "registration.success_rate") == pytest.approx(0.96)
    assert (value(3, "registration.attempt_count"), value(3, "registration.failure_count"), value(3, "deregistration.count")) == (12, 0, 2)
    assert value(5, "registration.success_rate") == 0
    assert (value(10, "handover.attempt_count"), value(10, "handover.success_count"), value(10, "handover.success_rate")) == (100, 95, 0.95)
    assert records[12, "registration.attempt_count"].labels["instance_id"] == "amf_001"
    assert value(12, "registration.success_rate") == pytest.approx(0.9976)


def test_absent_series_and_failures(normal):
    records, partial, failures = normal
    assert records[4, "registration.attempt_count"].value == 0
    assert partial[4, "ue.connected_count"] == ("metric not found", False)
    assert partial[1, "handover.success_rate"] == ("dependency failed: handover.attempt_count", True)
    assert failures[6] == "vendor not mapped" and failures[7] == "unknown namespace" and failures[8] == "unsupported protocol" and failures[11].startswith("gnmi")


def evaluate(text, **values):
    return formula.evaluate(formula.parse(text), {k.replace("__", "."): v for k, v in values.items()})


@pytest.mark.parametrize("text, want", [("1 + 2 * 3", 7), ("(1 + 2) * 3", 9), ("10 - 4 - 3", 3), (".5 * 1e2", 50), ("3 > 2", 1), ("2 != 2", 0), ("1 > 0 ? 5 : 6", 5), ("0 ? 1 : 2", 2), ("8 / 4 / 2", 1)])
def test_formula_values(text, want):
    assert evaluate(text) == want


@pytest.mark.parametrize("text", ["", "  ", "(1", "1 +", "-1", "1 < 2 < 3", "1 ? 2", "1 ? 2 :", "a = 1", "1 2", "f(1)"])
def test_formula_errors(text):
    with pytest.raises(formula.FormulaError):
        formula.parse(text)


def test_division_by_zero_is_nan_and_unselected_nan_goes():
    assert math.isnan(evaluate("1 / 0")) and math.isnan(evaluate("0 / 0"))
    assert evaluate("a.b > 0 ? 1 / a.b : 0", a__b=0.0) == 0


NUMBER = st.sampled_from([0.0, 1.0, -2.5, 1e308, float("nan"), float("inf"), 3.0])
TREES = st.recursive(
    st.sampled_from(["x", "y"]).map(lambda n: formula.Node("name", (n,))) | NUMBER.map(lambda v: formula.Node("num", (v,))),
    lambda t: st.builds(lambda k, a, b: formula.Node(k, (a, b)), st.sampled_from(["+", "-", "*", "/", ">", "<", ">=", "<=", "==", "!="]), t, t) | st.builds(lambda a, b, c: formula.Node("if", (a, b, c)), t, t, t),
    max_leaves=8,
)


@given(st.lists(TREES, min_size=5, max_size=10), NUMBER, NUMBER)
@settings(max_examples=8, deadline=None)
def test_compiled_formulas_equal_the_evaluator(spark, trees, x, y):
    df = spark.createDataFrame([(x, y)], "x double, y double")
    got = df.select(*[formula.to_column(t, F.col).alias(f"c{i}") for i, t in enumerate(trees)]).first()
    for g, t in zip(got, trees, strict=True):
        want = formula.evaluate(t, {"x": x, "y": y})
        assert g == want or math.isnan(g) and math.isnan(want)


def test_exposition_parsing(spark):
    text = """# HELP a help
# TYPE a counter
a{x="1",y="q\\"\\\\ \\n,}"} 5 1700000000
b 42.5
# TYPE h histogram
h_bucket{le="1"} 3
h_sum 53423
h_count 144320
# TYPE s summary
s{quantile="0.5"} 7
s_sum 1.7560473e7
s_count 2693
bad line here now
inf +Inf
"""
    rows = spark.createDataFrame([(text,), (None,)], "t string").select(exposition.series("t" and F.col("t")).alias("s")).collect()
    got = [(x.name, x.value, x.type) for x in rows[0].s]
    assert got == [("a", 5, "counter"), ("b", 42.5, "untyped"), ("h_sum", 53423, "histogram"), ("h_count", 144320, "histogram"), ("s_sum", 17560473, "summary"), ("s_count", 2693, "summary"), ("inf", math.inf, "untyped")]
    assert rows[0].s[0].labels == {"x": "1", "y": 'q"\\ \n,}'} and rows[1].s == []


def test_gnmi_prefix_keys_and_numbers():
    message = gnmi.encode([("prb/utilization", {"id": "1", "direction": "dl"}, -42.0)], prefix="/gnb/cell")
    assert gnmi.decode(message) == [(0, "/gnb/cell/prb/utilization", {"id": "1", "direction": "dl"}, -42.0, "untyped")]
    assert gnmi.decode(b"\x18\x01") == []
    with pytest.raises(ValueError):
        gnmi.decode(b"\x0a\x05abc")


def test_templates_and_paths(spark):
    assert paths.split_path("/a//b") == ["a", "b"] and paths.split_path("a:b") == ["a", "b"]
    assert paths.variables("/x/{{.A}}-{{.B}}/{{ .C }}") == ["A", "B", "C"]
    assert paths.expand("{{.A}}/{{.B}}", {"A": "1", "B": "2"}) == "1/2"
    with pytest.raises(KeyError):
        paths.expand("{{.A}}", {})
    t = F.array(*[F.lit(s) for s, _ in paths.template_segments("/a/{{.X}}/c")])
    rows = spark.createDataFrame([("/a/b/c",), ("a:b:c",), ("/a/b",), ("/a/b/d",), ("a_b_c",)], "p string")
    assert [r[0] for r in rows.select(paths.matches(t, F.col("p"))).collect()] == [True, True, False, False, False]
    assert [r[0] for r in rows.select(F.size(paths.extraction_segments(F.col("p")))).collect()] == [3, 3, 2, 3, 3]


def test_transforms(spark):
    rows = spark.createDataFrame([(1, 100.0), (2, 400.0)], "t int, v double")
    one = lambda text: [r[0] for r in rows.select("t", compile_transform(text, F.col("v"), [F.lit(1)], [F.col("t")]).alias("o")).orderBy("t").select("o").collect()]
    assert one("identity") == [100, 400] and one("delta") == [100, 300] and one("rate(30s)") == [100, 10] and one("ratio(0,1)") == [0.25, 0.25]
    assert seconds("1h2m3.5s") == 3723.5
    for bad in ("nope", "rate(x)"):
        with pytest.raises(ValueError):
            compile_transform(bad, F.col("v"), [], [F.col("t")])


def test_ttl_and_resets(spark):
    rows = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), v) for i, s, v in [(1, 0, 5.0), (2, 9, 8.0), (3, 20, 9.0), (4, 21, 4.0), (5, 15, 6.0)]], "seq long, ts timestamp, value double").withColumn("k", F.lit("a"))
    got = with_deltas(rows, ["k"], ["seq"], ttl_seconds=11).orderBy("seq").collect()
    assert [r.delta for r in got] == [5, 3, 9, 4, 2] and [r.reset for r in got] == [False, False, False, True, False]
    assert [r.late for r in got] == [False] * 4 + [True]


@pytest.mark.parametrize("n, fires", [(9, False), (10, True)])
def test_storm_needs_eleven_samples(spark, n, fires):
    rows = [("p", "", m, T0 + dt.timedelta(seconds=i), i, v) for i in range(n) for m, v in (("att", 10.0 + i % 2), ("reg_rate", 0.99))]
    rows += [("p", "", "att", T0 + dt.timedelta(seconds=n), n, 1000.0), ("p", "", "reg_rate", T0 + dt.timedelta(seconds=n), n, 0.45)]
    samples = spark.createDataFrame(rows, "plmn string, slice_id string, metric string, ts timestamp, seq long, value double")
    ticks = spark.createDataFrame([(T0 + dt.timedelta(seconds=n),)], "tick timestamp")
    found = [r.rule_name for r in correlate.events(correlate.trailing(samples, ticks, 60)).collect()]
    assert found == (["RegistrationStorm"] if fires else [])


def test_registry_rules(tmp_path):
    def load(kpis):
        (tmp_path / "x.yaml").write_text(__import__("yaml").safe_dump({"namespace": "x", "kpis": kpis, "vendors": {}}))
        return Registry.load(tmp_path)

    a = {"name": "a", "spec_ref": "s"}
    with pytest.raises(RegistryError, match="no registry"):
        Registry.load(tmp_path / "none")
    for kpis in ([{"name": "a"}], [a, {"name": "b", "spec_ref": "s", "formula": "a"}], [a, {"name": "b", "spec_ref": "s", "formula": "c", "depends_on": ["c"]}]):
        with pytest.raises(RegistryError):
            load(kpis)
    with pytest.raises(RegistryError, match="a -> b -> a"):
        load([{"name": n, "spec_ref": "s", "formula": m, "depends_on": [m]} for n, m in (("a", "b"), ("b", "a"))])
    order = load([{"name": "r", "spec_ref": "s", "formula": "a", "depends_on": ["a"]}, a]).evaluation_order("ran.x")
    assert order == ["a", "r"]
    shipped = Registry.load()
    assert sum(len(n.kpis) for n in shipped.namespaces.values()) == 36


def test_registry_files_in_both_spellings(tmp_path):
    kpis = "kpis: [{name: a, unit: u, spec_ref: r, description: d, derived: false}, {name: b, unit: u, spec_ref: r}, {name: c, unit: u, spec_ref: r}]\n"
    ours, other = tmp_path / "ours", tmp_path / "other"
    for folder, text in (
        (ours, "namespace: amf\nversion: v1\n" + kpis + "vendors: {v: {protocol: prometheus, metrics: {a: {metric: m, type: counter, reset_aware: true, strategy: sum_by, labels: {x: y}}, b: {template: '/p/{{.I}}', type: gauge, extract: {i: 1}}, c: {path: /q, type: gauge}}}}\n"),
        (other, "namespace: net.core.amf\nnf_type: AMF\nschema_version: v1\nspec: s\n" + kpis + "mappings: {v: {source_protocol: prometheus, metrics: {a: {prometheus_metric: m, type: counter, reset_aware: true, label_match_strategy: sum_by, labels: {x: y}}, b: {source_template: '/p/{{.I}}', type: gauge, label_extract: [{segment: 1, label: i}]}, c: {gnmi_path: /q, type: gauge}}}}\n"),
    ):
        folder.mkdir()
        (folder / "amf.yaml").write_text(text)
    a, b = Registry.load(ours), Registry.load(other)
    assert (a.prefix, b.prefix) == ("ran.", "net.core.") and b.names() == ["net.core.amf"]
    assert a.namespaces["ran.amf"] == b.namespaces["net.core.amf"] and len(b.namespaces["net.core.amf"].mappings["v"]) == 3
    for bad, why in (("kpis: []", "no mappings"), ("kpis: []\nmappngs: {}", "unknown key"), ("kpis: []\nvendors: {}\nmappings: {}", "twice"), (kpis + "vendors: {v: {protocol: gnmi, metrics: {a: {pth: /x, type: gauge}}}}", "unknown key 'pth'")):
        (other / "amf.yaml").write_text(f"namespace: net.core.amf\n{bad}\n")
        with pytest.raises(RegistryError, match=why):
            Registry.load(other)
    (other / "amf.yaml").write_text("namespace: a.x\nkpis: []\nvendors: {}\n")
    (other / "smf.yaml").write_text("namespace: b.y\nkpis: []\nvendors: {}\n")
    with pytest.raises(RegistryError, match="different prefixes"):
        Registry.load(other)


def test_rule_metrics_exist_in_the_registry():
    r = Registry.load()
    assert all(r.kpi(f"ran.{ns}", k) for ns, k in correlate.NAMES.values())


def test_collectors():
    assert COLLECTORS.names()[0] == "free5gc-amf" and COLLECTORS.get("gnmi-gnb", endpoint="e", paths=("/a",)).vendor == "oai"
    for bad in ({"endpoint": ""}, {"endpoint": "e", "interval": "0s"}, {"endpoint": "e", "protocol": "gnmi"}):
        with pytest.raises(ValueError):
            Collector("v", "AMF", **bad)
    with pytest.raises(KeyError):
        COLLECTORS.get("nope")


def _by_hand(mappings, series):
    """Every mapping against every series."""
    out = []
    for m in mappings:
        if m is None:
            out.append([])
        elif m.template and not paths.literal(m.template):
            wanted = [s for s, _ in paths.template_segments(m.template)]
            out.append([s for s in series if len(paths.split_path(s[1])) == len(wanted) and all(w in (None, x) for w, x in zip(wanted, paths.split_path(s[1]), strict=True))])
        else:
            out.append([s for s in series if s[1] == m.metric and all(dict(s[2] or ()).get(k, "") == v for k, v in m.labels.items())])
    return out


SEGMENT = st.sampled_from(["a", "b", "c"])
TEMPLATE = st.lists(SEGMENT | st.just("{{.V}}"), min_size=1, max_size=3).map(":".join)
LABELS = st.dictionaries(st.sampled_from(["k", "l"]), st.sampled_from(["", "x"]))


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.none() | TEMPLATE.map(lambda t: Mapping(t, "gauge", template=t)) | st.builds(lambda n, ls: Mapping(n, "gauge", labels=ls), SEGMENT, LABELS), max_size=8),
    st.lists(st.tuples(st.lists(SEGMENT, min_size=1, max_size=3).map(":".join), st.none() | LABELS.map(lambda d: list(d.items()))), max_size=12),
)
def test_index_finds_what_every_pair_gives(mappings, named):
    series = [(i, name, labels, 1.0, "untyped") for i, (name, labels) in enumerate(named)]
    assert VendorIndex(mappings).hits(series) == _by_hand(mappings, series)


class Counted(str):
    """A name that counts how often it is hashed."""

    hashed = 0

    def __hash__(self):
        Counted.hashed += 1
        return super().__hash__()


def test_probes_of_an_index_do_not_grow_with_the_mappings():
    series = [(i, Counted(f"m{i}"), None, float(i), "gauge") for i in range(5000)]
    probes = []
    for n in (5, 500):
        index = VendorIndex([Mapping(f"m{i}", "gauge") for i in range(n)] + [Mapping("", "gauge", template=f"t:{i}:{{{{.V}}}}") for i in range(n)])
        Counted.hashed = 0
        found = index.hits(series)
        probes.append(Counted.hashed)
        assert [len(f) for f in found] == [1] * n + [0] * n
    assert probes == [5000, 5000]
    paths_of = [(i, f"t:{i % 500}:x{i}", None, float(i), "gauge") for i in range(5000)]
    assert [len(f) for f in index.hits(paths_of)] == [0] * 500 + [10] * 500


def test_transform_failure_is_a_reason(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    found = rows.select("k", failure("ratio(0, 1)", [F.col("k")]).alias("r"), failure("delta", [F.col("k")]).alias("none")).distinct().collect()
    assert {(r.k, r.r, r.none) for r in found} == {("a", None, None), ("b", "index of ratio(0,1) out of range for 1 values", None)}


def test_series_are_put_in_order_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(promql, "TASK_ROWS", 1000, raising=False)
    rows = spark.range(40_000).selectExpr("CAST(id DIV 20 AS string) AS s", "timestamp_seconds(id % 20 * 10) AS ts", "CAST(id AS double) AS value")
    for out in (promql.increase_over(rows, ["s"], 60, 30), promql.at_steps(rows, ["s"], 60, 30)):
        assert out.select(F.spark_partition_id().alias("p")).distinct().count() >= 35
