"""The queries over the synthetic tables, each with SQL of the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.functions import formula, paths
from kpiloom.functions.transforms import compile_transform, failure
from kpiloom.operators import alerts, correlate, promql, simulate, sinks, telemetry
from kpiloom.operators.counters import with_deltas
from kpiloom.operators.normalize import combined, extracted, normalize, split_handled
from kpiloom.operators.rules import SHIPPED as SHIPPED_RULES
from kpiloom.operators.rules import Rules
from kpiloom.plans.views import SCRAPES, SERIES, WINDOWS, scrapes, seconds, series, window_samples
from kpiloom.registry import Kpi, Mapping, Namespace, Registry
from kpiloom.sources import exposition, gnmi
from kpiloom.sources.scrape import COLLECTORS, error_class
from kpiloom.streaming.counters import stream_deltas
from kpiloom.streaming.drain import drained, with_end

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


@cache
def registry() -> Registry:
    return Registry.load()


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _r(c: Column | str, name: str | None = None) -> Column:
    out = F.round(F.col(c) if isinstance(c, str) else c, 6)
    return out.alias(name or c) if name or isinstance(c, str) else out


# -- normalisation -------------------------------------------------------------

_LINES = {
    "free5gc": ('free5gc_nas_msg_received_total{name="RegistrationRequest"}', 'free5gc_nas_nas_msg_sent_total{name="RegistrationReject"}', 'free5gc_nas_msg_received_total{name="DeregistrationRequestUEOriginatingDeregistration"}', "free5gc_amf_business_ue_connectivity"),
    "open5gs": ('open5gs_amf_registration_total{status="attempted"}', 'open5gs_amf_registration_total{status="failed"}', "open5gs_amf_deregistration_total", "open5gs_amf_ue_connected"),
    "ericsson_enm": ("ericsson_pm:j:r:pmNrRegInitAttSum:a", "ericsson_pm:j:r:pmNrRegInitFailSum:a", "ericsson_pm:j:r:other:a", "ericsson_pm:j:r:pmNrRrcConnectedUeSum:a"),
}
_OF_METRIC = ("signup", "error", "purchase", "view")


def raw_scrapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scrape for each instance and day, as exposition text of the counters and the gauge seen in it."""
    s = series(spark, sf_dir).withColumn("day", F.floor(F.col("hour") / 24).cast("bigint"))
    last = lambda m, c: F.max_by(c, F.when(F.col("metric") == m, F.struct("ts", "event_id")))
    seen = lambda m: F.count_if(F.col("metric") == m) > 0
    g = s.groupBy("inst", "vendor", "day").agg(*[F.when(seen(m), last(m, "value" if m == "view" else "raw").cast("double")).alias(m) for m in _OF_METRIC])
    lines = []
    for i, m in enumerate(_OF_METRIC):
        name = F.create_map(*[x for v, n in _LINES.items() for x in (F.lit(v), F.lit(n[i]))])[F.col("vendor")]
        lines.append(F.when(F.col(m).isNotNull(), F.concat(name, F.lit(" "), F.col(m).cast("string"))))
    return g.select(
        (F.col("inst").cast("bigint") * 10_000_000 + F.col("day")).alias("record_id"), "vendor", F.lit("AMF").alias("nf_type"), F.col("inst").cast("string").alias("instance_id"),
        F.lit("").alias("endpoint"), F.encode(F.concat_ws("\n", *lines), "UTF-8").alias("payload"), F.lit("prometheus").alias("protocol"),
        F.timestamp_seconds(F.col("day") * 86_400).alias("timestamp"), F.lit(None).cast("map<string,string>").alias("meta"), F.lit("v1").alias("schema_version"),
    )


_NORMAL = f"""
WITH {SERIES}, g AS (
  SELECT inst, vendor, hour // 24 AS day, CAST(inst AS BIGINT) * 10000000 + hour // 24 AS record_id,
    CAST(arg_max(raw, struct_pack(t := ts, e := event_id)) FILTER (metric = 'signup') AS DOUBLE) AS att,
    CAST(arg_max(raw, struct_pack(t := ts, e := event_id)) FILTER (metric = 'error') AS DOUBLE) AS fail,
    CAST(arg_max(raw, struct_pack(t := ts, e := event_id)) FILTER (metric = 'purchase') AS DOUBLE) AS dereg,
    arg_max(value, struct_pack(t := ts, e := event_id)) FILTER (metric = 'view') AS ue
  FROM series GROUP BY inst, vendor, hour // 24
), z AS (SELECT *, coalesce(att, 0) AS a, coalesce(fail, 0) AS f, coalesce(dereg, 0) AS d FROM g
), l AS (SELECT *, lag(a) OVER w AS pa, lag(f) OVER w AS pf, lag(d) OVER w AS pd FROM z WINDOW w AS (PARTITION BY inst ORDER BY day)
), v AS (SELECT *, CASE WHEN pa IS NULL OR a < pa THEN a ELSE a - pa END AS da, CASE WHEN pf IS NULL OR f < pf THEN f ELSE f - pf END AS df,
                CASE WHEN pd IS NULL OR d < pd THEN d ELSE d - pd END AS dd FROM l)
"""


@query("normalize_flagship", _NORMAL + """
SELECT record_id, 'registration.attempt_count' AS kpi_name, round(da, 6) AS value FROM v
UNION ALL SELECT record_id, 'registration.failure_count', round(df, 6) FROM v
UNION ALL SELECT record_id, 'deregistration.count', round(dd, 6) FROM v WHERE vendor <> 'ericsson_enm'
UNION ALL SELECT record_id, 'ue.connected_count', round(ue, 6) FROM v WHERE ue IS NOT NULL
UNION ALL SELECT record_id, 'registration.success_rate', round(CASE WHEN da > 0 THEN (da - df) / da ELSE 0 END, 6) FROM v
UNION ALL SELECT record_id, 'handover.attempt_count', 0.0 FROM v WHERE vendor = 'open5gs'
UNION ALL SELECT record_id, 'handover.success_count', 0.0 FROM v WHERE vendor = 'open5gs'
UNION ALL SELECT record_id, 'handover.success_rate', 0.0 FROM v WHERE vendor = 'open5gs'
""")
def normalize_flagship(spark, sf_dir):
    return normalize(raw_scrapes(spark, sf_dir), registry()).records.select("record_id", "kpi_name", _r("value"))


@query("derived_failure_propagation", _NORMAL + """
, p AS (
  SELECT record_id, 'ue.connected_count' AS kpi_name, 'metric not found' AS reason, FALSE AS unsupported FROM v WHERE ue IS NULL
  UNION ALL SELECT record_id, k, 'no mapping', TRUE FROM v, (VALUES ('handover.attempt_count'), ('handover.success_count')) x(k) WHERE vendor <> 'open5gs'
  UNION ALL SELECT record_id, 'deregistration.count', 'no mapping', TRUE FROM v WHERE vendor = 'ericsson_enm'
  UNION ALL SELECT record_id, 'handover.success_rate', 'dependency failed: handover.attempt_count', TRUE FROM v WHERE vendor <> 'open5gs')
SELECT * FROM p""")
def derived_failure_propagation(spark, sf_dir):
    return normalize(raw_scrapes(spark, sf_dir), registry()).partial.select("record_id", "kpi_name", "reason", "unsupported")


def _as_records(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    pick = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i + 1).cast("int"))
    nf = F.create_map(*map(F.lit, ("click", "AMF", "error", "SMF", "purchase", "UPF", "signup", "gNB", "view", "NSSF")))
    return e.select(
        F.col("event_id").alias("record_id"), pick(("free5gc", "open5gs", "ericsson_enm", "oai", "unknown"), F.col("user_id") % 5).alias("vendor"), nf[F.col("event_type")].alias("nf_type"),
        F.lit("i").alias("instance_id"), F.lit("").alias("endpoint"), F.lit(None).cast("binary").alias("payload"), pick(("prometheus", "gnmi", "netconf"), F.col("event_id") % 3).alias("protocol"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.lit(None).cast("map<string,string>").alias("meta"), F.lit("v1").alias("schema_version"),
    )


#: Fixed values, written down from the mappings: (namespace, vendor, base KPIs with a mapping, without one).
_PAIRS = """
  ('ran.amf', 'free5gc', 4, 2), ('ran.amf', 'open5gs', 6, 0), ('ran.amf', 'ericsson_enm', 3, 3), ('ran.amf', 'nokia_enm', 3, 3),
  ('ran.gnb', 'ericsson_enm', 4, 4), ('ran.gnb', 'oai', 8, 0),
  ('ran.slice', 'ericsson_enm', 3, 2), ('ran.slice', 'free5gc', 5, 0), ('ran.slice', 'open5gs', 5, 0),
  ('ran.smf', 'ericsson_enm', 3, 2), ('ran.smf', 'free5gc', 1, 4), ('ran.smf', 'open5gs', 5, 0),
  ('ran.upf', 'ericsson_enm', 4, 2), ('ran.upf', 'open5gs', 6, 0)"""
_RECORDS = f"""
WITH m(namespace, vendor, mapped, missing) AS (VALUES {_PAIRS}), r AS (
  SELECT event_id AS record_id, ['free5gc', 'open5gs', 'ericsson_enm', 'oai', 'unknown'][user_id % 5 + 1] AS vendor,
         'ran.' || CASE event_type WHEN 'click' THEN 'amf' WHEN 'error' THEN 'smf' WHEN 'purchase' THEN 'upf' WHEN 'signup' THEN 'gnb' ELSE 'nssf' END AS namespace,
         ['prometheus', 'gnmi', 'netconf'][event_id % 3 + 1] AS protocol FROM events)
"""


@query("can_handle_semi", _RECORDS + "SELECT record_id, namespace, vendor FROM r WHERE EXISTS (SELECT 1 FROM m WHERE m.namespace = r.namespace AND m.vendor = r.vendor) AND protocol <> 'netconf'")
def can_handle_semi(spark, sf_dir):
    return split_handled(_as_records(spark, sf_dir), registry())[0].select("record_id", "namespace", "vendor")


@query("unhandled_anti", _RECORDS + """
SELECT record_id, vendor, CASE WHEN namespace = 'ran.nssf' THEN 'unknown namespace' WHEN NOT EXISTS (SELECT 1 FROM m WHERE m.namespace = r.namespace AND m.vendor = r.vendor)
  THEN 'vendor not mapped' ELSE 'unsupported protocol' END AS reason
FROM r WHERE protocol = 'netconf' OR NOT EXISTS (SELECT 1 FROM m WHERE m.namespace = r.namespace AND m.vendor = r.vendor)""")
def unhandled_anti(spark, sf_dir):
    return split_handled(_as_records(spark, sf_dir), registry())[1].select("record_id", "vendor", "reason")


@query("kpi_mapping_outer", _RECORDS + """SELECT namespace, vendor, count(*) AS records, CAST(sum(mapped) AS BIGINT) AS mapped, CAST(sum(missing) AS BIGINT) AS missing
FROM r JOIN m USING (namespace, vendor) WHERE protocol <> 'netconf' GROUP BY 1, 2""")
def kpi_mapping_outer(spark, sf_dir):
    """Base KPIs that the scrapes of each namespace and vendor are asked for, with and without a mapping."""
    handled = split_handled(_as_records(spark, sf_dir), registry())[0]
    of_plan = handled.select("namespace", "vendor", F.size(F.filter("plan", lambda p: p["mapped"])).alias("with"), F.size(F.filter("plan", lambda p: p["mapped"].isNull())).alias("without"))
    return of_plan.groupBy("namespace", "vendor").agg(F.count("*").alias("records"), F.sum("with").alias("mapped"), F.sum("without").alias("missing"))


@query("unsupported_kpis", _RECORDS + """SELECT namespace, vendor, CAST(sum(missing) AS BIGINT) AS unsupported FROM r JOIN m USING (namespace, vendor) WHERE protocol = 'prometheus' AND missing > 0 GROUP BY 1, 2""")
def unsupported_kpis(spark, sf_dir):
    """Partial failures of scraped events for want of a mapping."""
    scraped = _as_records(spark, sf_dir).where("protocol = 'prometheus'")
    rows = normalize(scraped, registry()).partial.where("unsupported AND reason = 'no mapping'")
    return rows.groupBy("namespace", "vendor").agg(F.count("*").alias("unsupported"))


# -- matching ------------------------------------------------------------------

def _arrays(spark, sf_dir):
    """The samples of an instance and hour as one array in arrival order."""
    s = series(spark, sf_dir)
    item = F.struct("ts", "event_id", F.col("metric").alias("name"), F.create_map(F.lit("k"), F.col("k")).alias("labels"), F.col("iv").cast("double").alias("value"))
    by = lambda a, b: F.when(a["ts"] < b["ts"], -1).when(a["ts"] > b["ts"], 1).otherwise((a["event_id"] - b["event_id"]).cast("int"))
    return s.groupBy("inst", "hour").agg(F.array_sort(F.collect_list(item), by).alias("series"))


def _matched(spark, sf_dir, metric: str, labels: dict, strategy: str) -> DataFrame:
    required = F.create_map(*[F.lit(x) for p in labels.items() for x in p]) if labels else F.create_map().cast("map<string,string>")
    plan = F.struct(F.lit(strategy).alias("strategy"), F.lit(None).cast("array<string>").alias("template"))
    hits = F.filter("series", lambda s: (s["name"] == metric) & paths.superset(s["labels"], required))
    return _arrays(spark, sf_dir).select("inst", "hour", combined(hits, plan).alias("value")).where("value IS NOT NULL")


def _match_sql(where: str, value: str) -> str:
    return f"WITH {SERIES} SELECT inst, hour, {value} AS value FROM series WHERE {where} GROUP BY inst, hour"


_FIRST = "CAST(arg_min(iv, struct_pack(t := ts, e := event_id)) AS DOUBLE)"


@query("match_sum_by", _match_sql("metric = 'signup'", "CAST(sum(iv) AS DOUBLE)"))
def match_sum_by(spark, sf_dir):
    return _matched(spark, sf_dir, "signup", {}, "sum_by")


@query("match_exact_first", _match_sql("metric = 'click' AND k = '3'", _FIRST))
def match_exact_first(spark, sf_dir):
    return _matched(spark, sf_dir, "click", {"k": "3"}, "exact")


@query("match_any_first", _match_sql("metric = 'view'", _FIRST))
def match_any_first(spark, sf_dir):
    return _matched(spark, sf_dir, "view", {"absent": ""}, "any")


def _paths(spark, sf_dir):
    s = series(spark, sf_dir)
    path = (
        F.when(F.col("event_id") % 3 == 0, F.concat_ws("/", F.lit(""), F.lit("pm"), "metric", F.lit("reg"), F.col("inst").cast("string"), F.lit("attempts")))
        .when(F.col("event_id") % 3 == 1, F.concat_ws(":", F.lit("pm"), "metric", F.lit("reg"), F.col("inst").cast("string"), F.lit("attempts")))
        .otherwise(F.concat_ws("_", F.lit("pm"), "metric", F.col("inst").cast("string")))
    )
    return s.select("event_id", path.alias("path"))


_PATHS = f"""WITH {SERIES}, p AS (SELECT event_id, metric, inst, event_id % 3 AS f, CASE event_id % 3 WHEN 0 THEN '/pm/' || metric || '/reg/' || inst || '/attempts'
  WHEN 1 THEN 'pm:' || metric || ':reg:' || inst || ':attempts' ELSE 'pm_' || metric || '_' || inst END AS path FROM series)"""
_TEMPLATE = "/pm/{{.NF}}/reg/{{.Instance}}/attempts"


def _template() -> Column:
    return F.array(*[F.lit(s) for s, _ in paths.template_segments(_TEMPLATE)])


@query("template_match", _PATHS + " SELECT event_id, path FROM p WHERE f <> 2")
def template_match(spark, sf_dir):
    return _paths(spark, sf_dir).where(paths.matches(_template(), F.col("path")))


@query("template_label_extract", _PATHS + " SELECT event_id, 'Instance=' || inst || ',NF=' || metric || ',seg=' || inst AS labels FROM p WHERE f <> 2")
def template_label_extract(spark, sf_dir):
    names = F.array(*[F.lit(v) for _, v in paths.template_segments(_TEMPLATE)])
    item = F.struct(_template().alias("template"), names.alias("captures"), F.create_map(F.lit("seg"), F.lit(3)).alias("extract"))
    hits = F.array(F.struct(F.col("path").alias("name"), F.lit(None).cast("map<string,string>").alias("labels")))
    rows = _paths(spark, sf_dir).where(paths.matches(_template(), F.col("path")))
    labels = extracted(hits, item)
    return rows.select("event_id", F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("labels"))


_PARTS = 12


def _many_templates() -> Registry:
    """A vendor with a template for each kind of event and part: literal segments tell them apart, the instance is captured."""
    kpis = {f"{m}.part{j}": Kpi(f"{m}.part{j}", "count", "-") for m in _OF_METRIC for j in range(_PARTS)}
    found = {k: Mapping("", "gauge", template=f"pm:{k.replace('.', ':')}:{{{{.Instance}}}}:value") for k in kpis}
    return Registry([Namespace("amf", "1", kpis, list(kpis), {"parts": "prometheus"}, {"parts": found})])


@query("template_trie", f"""WITH {SERIES} SELECT CAST(inst AS BIGINT) * 10000000 + hour // 24 AS record_id, metric || '.part' || event_id % {_PARTS} AS kpi_name, CAST(inst AS VARCHAR) AS instance,
  CAST(arg_min(iv, struct_pack(t := ts, e := event_id)) AS DOUBLE) AS value
FROM series WHERE metric IN {_OF_METRIC} GROUP BY inst, hour // 24, metric, event_id % {_PARTS}""")
def template_trie(spark, sf_dir):
    """Scrapes whose series are told apart by templates; of two series that meet one, the first in the payload counts."""
    s = series(spark, sf_dir).withColumn("day", F.floor(F.col("hour") / 24).cast("bigint"))
    line = F.concat(F.lit("pm:"), "metric", F.lit(":part"), (F.col("event_id") % _PARTS).cast("string"), F.lit(":"), F.col("inst").cast("string"), F.lit(":value "), F.col("iv").cast("string"))
    lines = F.array_sort(F.collect_list(F.struct("ts", "event_id", line.alias("line"))))
    raw = s.groupBy("inst", "day").agg(F.array_join(F.transform(lines, lambda e: e["line"]), "\n").alias("text")).select(
        (F.col("inst").cast("bigint") * 10_000_000 + F.col("day")).alias("record_id"), F.lit("parts").alias("vendor"), F.lit("AMF").alias("nf_type"), F.col("inst").cast("string").alias("instance_id"),
        F.lit("").alias("endpoint"), F.encode("text", "UTF-8").alias("payload"), F.lit("prometheus").alias("protocol"), F.timestamp_seconds(F.col("day") * 86_400).alias("timestamp"),
        F.lit(None).cast("map<string,string>").alias("meta"), F.lit("v1").alias("schema_version"),
    )
    return normalize(raw, _many_templates()).records.select("record_id", "kpi_name", F.col("labels")["Instance"].alias("instance"), "value")


@query("path_split", _PATHS + " SELECT event_id, CASE f WHEN 2 THEN 3 ELSE 5 END AS n, 'pm' AS first FROM p")
def path_split(spark, sf_dir):
    s = paths.extraction_segments(F.col("path"))
    return _paths(spark, sf_dir).select("event_id", F.size(s).alias("n"), F.element_at(s, 1).alias("first"))


@query("absent_counter_zero", _NORMAL + " SELECT record_id, da AS value FROM v WHERE att IS NULL")
def absent_counter_zero(spark, sf_dir):
    raw = raw_scrapes(spark, sf_dir)
    absent = raw.where(~F.col("payload").cast("string").rlike('RegistrationRequest|status="attempted"|RegInitAttSum'))
    rows = normalize(raw, registry()).records.where("kpi_name = 'registration.attempt_count'")
    return rows.join(absent.select("record_id"), "record_id", "left_semi").select("record_id", "value")


@query("absent_gauge_error", _NORMAL + " SELECT record_id, 'metric not found' AS reason FROM v WHERE ue IS NULL")
def absent_gauge_error(spark, sf_dir):
    return normalize(raw_scrapes(spark, sf_dir), registry()).partial.where("kpi_name = 'ue.connected_count'").select("record_id", "reason")


@query("malformed_scrapes", _NORMAL.replace("AS d FROM g", "AS d FROM g WHERE record_id % 5 <> 3") + """
SELECT record_id, 'registration.attempt_count' AS what, da AS value FROM v UNION ALL SELECT record_id, 'unreadable', NULL FROM g WHERE record_id % 5 = 3""")
def malformed_scrapes(spark, sf_dir):
    """Every fifth scrape is an error page: it fails, and the counters go on from the scrape before it."""
    page = F.encode(F.lit("<html><body>502 Bad Gateway</body></html>\n"), "UTF-8")
    raw = raw_scrapes(spark, sf_dir).withColumn("payload", F.when(F.col("record_id") % 5 == 3, page).otherwise(F.col("payload")))
    found = normalize(raw, registry())
    good = found.records.where("kpi_name = 'registration.attempt_count'").select("record_id", F.col("kpi_name").alias("what"), "value")
    bad = found.failures.where("reason LIKE 'no sample in the payload%'").select("record_id", F.lit("unreadable").alias("what"), F.lit(None).cast("double").alias("value"))
    return good.unionByName(bad)


# -- counters ------------------------------------------------------------------

_LAG = "lag({0}) OVER (PARTITION BY inst, metric ORDER BY ts, event_id)"


def _deltas(spark, sf_dir, value: str, **options) -> DataFrame:
    return with_deltas(series(spark, sf_dir), ["inst", "metric"], ["ts", "event_id"], value, **options)


@query("counter_delta", f"WITH {SERIES} SELECT event_id, raw - coalesce({_LAG.format('raw')}, 0) AS delta FROM series")
def counter_delta(spark, sf_dir):
    return _deltas(spark, sf_dir, "raw").select("event_id", "delta")


@query("counter_delta_reset", f"WITH {SERIES}, l AS (SELECT *, {_LAG.format('raw_reset')} AS p FROM series) SELECT event_id, CASE WHEN p IS NULL OR raw_reset < p THEN raw_reset ELSE raw_reset - p END AS delta FROM l")
def counter_delta_reset(spark, sf_dir):
    return _deltas(spark, sf_dir, "raw_reset").select("event_id", "delta")


@query("counter_delta_not_reset_aware", f"WITH {SERIES} SELECT event_id, raw_reset - coalesce({_LAG.format('raw_reset')}, 0) AS delta FROM series")
def counter_delta_not_reset_aware(spark, sf_dir):
    return _deltas(spark, sf_dir, "raw_reset", reset_aware=False).select("event_id", "delta")


@query("counter_ttl", f"""WITH {SERIES}, l AS (SELECT *, {_LAG.format('raw')} AS p, {_LAG.format('ts')} AS pt FROM series)
SELECT event_id, CASE WHEN p IS NULL OR epoch(ts) - epoch(pt) >= 14400 THEN raw ELSE raw - p END AS delta FROM l""")
def counter_ttl(spark, sf_dir):
    return _deltas(spark, sf_dir, "raw", ttl_seconds=14_400).select("event_id", "delta")


@query("counter_reset_flag", f"WITH {SERIES}, l AS (SELECT *, {_LAG.format('raw_reset')} AS p FROM series) SELECT event_id FROM l WHERE raw_reset < p")
def counter_reset_flag(spark, sf_dir):
    return _deltas(spark, sf_dir, "raw_reset").where("reset").select("event_id")


@query("counter_ooo", f"""WITH {SERIES}, a AS (SELECT *, event_id + CASE WHEN event_id % 7 = 0 THEN 40 ELSE 0 END AS arrival FROM series),
l AS (SELECT *, lag(ts) OVER (PARTITION BY inst, metric ORDER BY arrival, event_id) AS pt FROM a) SELECT inst, metric, count(*) AS late FROM l WHERE ts < pt GROUP BY 1, 2""")
def counter_ooo(spark, sf_dir):
    s = series(spark, sf_dir).withColumn("arrival", F.col("event_id") + F.when(F.col("event_id") % 7 == 0, 40).otherwise(0))
    rows = with_deltas(s, ["inst", "metric"], ["arrival", "event_id"], "raw").where("late")
    return rows.groupBy("inst", "metric").agg(F.count("*").alias("late"))


def _transform(text: str, expr: str) -> None:
    name = f"transform_{text.split('(')[0]}"

    @query(name, f"WITH {SERIES}, l AS (SELECT *, {_LAG.format('value')} AS p FROM series) SELECT event_id, round({expr}, 6) AS out FROM l")
    def run(spark, sf_dir):
        out = compile_transform(text, F.col("value"), [F.col("inst"), F.col("metric")], [F.col("ts"), F.col("event_id")])
        return series(spark, sf_dir).select("event_id", _r(out, "out"))


_transform("identity", "value")
_transform("delta", "value - coalesce(p, 0)")
_transform("rate(30s)", "CASE WHEN p IS NULL THEN value ELSE (value - p) / 30 END")
_transform("ratio(0,1)", "coalesce(first(value) OVER w / nullif(nth_value(value, 2) OVER w, 0), CASE WHEN nth_value(value, 2) OVER w = 0 THEN 0 END)")
ORACLE["transform_ratio"] += " WINDOW w AS (PARTITION BY inst, metric ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


@query("transform_ratio_error", f"""WITH {SERIES} SELECT inst, metric, 'index of ratio(0,9) out of range for ' || count(*) || ' values' AS reason
FROM series GROUP BY inst, metric HAVING count(*) <= 9""")
def transform_ratio_error(spark, sf_dir):
    rows = series(spark, sf_dir).withColumn("reason", failure("ratio(0,9)", [F.col("inst"), F.col("metric")]))
    return rows.where("reason IS NOT NULL").select("inst", "metric", "reason").distinct()


# -- formulas ------------------------------------------------------------------

def _formula(name: str, text: str, sql: str) -> None:
    @query(name, f"WITH {SERIES}, {SCRAPES} SELECT plmn, hour, round({sql}, 6) AS out FROM scrapes")
    def run(spark, sf_dir):
        value = formula.to_column(formula.parse(text), lambda n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)))
        return scrapes(spark, sf_dir).select("plmn", "hour", F.when(formula.finite(value), _r(value, "x")).alias("out"))


_formula("formula_success_rate", "att > 0 ? (att - fail) / att : 0", "CASE WHEN att > 0 THEN (att - fail) / CAST(att AS DOUBLE) ELSE 0 END")
_formula("formula_loss_rate", "upf > 0 ? (upf - gnb) / upf : 0", "CASE WHEN coalesce(upf, 0) > 0 THEN (upf - coalesce(gnb, 0)) / upf ELSE 0 END")
_formula("formula_sla_boolean_product", "(sess <= gnb) * (upf >= gnb)", "CASE WHEN coalesce(sess, 0) <= coalesce(gnb, 0) AND coalesce(upf, 0) >= coalesce(gnb, 0) THEN 1.0 ELSE 0.0 END")
_formula("formula_nan_guard", "fail / (att - att) > 1 ? 5 : fail / att", "CASE WHEN att = 0 THEN NULL ELSE fail / CAST(att AS DOUBLE) END")


# -- correlation ---------------------------------------------------------------

_HEAD = f"WITH {SERIES}, {SCRAPES}, {WINDOWS}"


def _stats(spark, sf_dir):
    return correlate.sliding(window_samples(spark, sf_dir), "24 hours", "1 hour")


def _fired(spark, sf_dir):
    return correlate.events(_stats(spark, sf_dir)).withColumn("w", F.floor(seconds("window_start") / 3600).cast("bigint"))


@query("window_stats", _HEAD + " SELECT plmn, w, att_n, round(att_mean, 4) AS att_mean, round(att_sigma, 4) AS att_sigma, att_last, sess_n, round(sess_peak, 6) AS sess_peak, round(upf_mean, 6) AS upf_mean FROM stats")
def window_stats(spark, sf_dir):
    return _stats(spark, sf_dir).select(
        "plmn", F.floor(seconds("window_start") / 3600).cast("bigint").alias("w"), "att_n", F.round("att_mean", 4).alias("att_mean"), F.round("att_sigma", 4).alias("att_sigma"), "att_last", "sess_n", _r("sess_peak"), _r("upf_mean")
    )


_WIDE = f"""WITH {SERIES}, s AS (SELECT plmn, CAST(floor(epoch(ts)) AS BIGINT) AS t, 1e9 + iv % 7 AS value FROM series WHERE metric = 'signup')
SELECT plmn, w, count(*) AS att_n, round(avg(value - 1e9), 4) AS att_mean, round(stddev_pop(value - 1e9), 4) AS att_sigma
FROM s, LATERAL (SELECT unnest(range((t - 30 * 3600 + 7 * 3600) // (7 * 3600), t // (7 * 3600) + 1)) * 7 * 3600 AS w) WHERE w <= t AND t < w + 30 * 3600 GROUP BY plmn, w"""


@query("window_stats_uneven", _WIDE)
def window_stats_uneven(spark, sf_dir):
    """Windows whose slide does not divide their length, over values whose squares would lose their last digits."""
    s = series(spark, sf_dir).where("metric = 'signup'")
    rows = s.select("plmn", F.lit("").alias("slice_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"), F.lit("att").alias("metric"), (F.lit(1e9) + F.col("iv") % 7).alias("value"))
    stats = correlate.sliding(rows, "30 hours", "7 hours")
    return stats.select("plmn", seconds("window_start").alias("w"), "att_n", F.round(F.col("att_mean") - 1e9, 4).alias("att_mean"), F.round("att_sigma", 4).alias("att_sigma"))


def _rule(key: str, name: str) -> None:
    @query(key, _HEAD + f" SELECT rule_name, severity, nf, plmn, w FROM fired WHERE rule_name = '{name}'")
    def run(spark, sf_dir):
        return _fired(spark, sf_dir).where(F.col("rule_name") == name).select("rule_name", "severity", F.element_at("affected_nfs", 1).alias("nf"), "plmn", "w")


_rule("rule_registration_storm", "RegistrationStorm")
_rule("rule_session_drop", "SessionDrop")
_rule("rule_ran_core_divergence", "RANCoreDivergence")


@query("all_rules_union", _HEAD + " SELECT rule_name, severity, nf, plmn, w FROM fired")
def all_rules_union(spark, sf_dir):
    return _fired(spark, sf_dir).select("rule_name", "severity", F.element_at("affected_nfs", 1).alias("nf"), "plmn", "w")


@query("event_counts", _HEAD + " SELECT rule_name, severity, plmn, '' AS sst, '' AS sd, count(*) AS events FROM fired GROUP BY 1, 2, 3")
def event_counts(spark, sf_dir):
    return correlate.event_counts(_fired(spark, sf_dir))


@query("trailing_window_exact", f"""WITH {SERIES}, {SCRAPES}, t AS (SELECT DISTINCT hour // 6 * 6 AS tick FROM scrapes)
SELECT plmn, tick, count(*) AS att_n, round(avg(CAST(att AS DOUBLE)), 4) AS att_mean, max(CAST(att AS DOUBLE)) AS att_peak FROM t JOIN scrapes ON hour BETWEEN tick - 24 AND tick GROUP BY 1, 2""")
def trailing_window_exact(spark, sf_dir):
    rows = window_samples(spark, sf_dir)
    ticks = rows.select(F.timestamp_seconds(F.floor(seconds("ts") / 21_600) * 21_600).alias("tick")).distinct()
    stats = correlate.trailing(rows, ticks, 86_400)
    return stats.select("plmn", F.floor(seconds("window_end") / 3600).cast("bigint").alias("tick"), "att_n", F.round("att_mean", 4).alias("att_mean"), "att_peak")


# -- exposition and sinks --------------------------------------------------------

@query("prom_render", f"WITH {SERIES} SELECT inst, metric || '{{k=\"' || k || '\",plmn=\"' || plmn || '\"}} ' || CAST(max(iv) AS VARCHAR) AS line FROM series GROUP BY inst, metric, k, plmn")
def prom_render(spark, sf_dir):
    g = series(spark, sf_dir).groupBy("inst", "metric", "k", "plmn").agg(F.max("iv").alias("v"))
    labels = F.create_map(F.lit("plmn"), F.col("plmn"), F.lit("k"), F.col("k"))
    return g.select("inst", exposition.rendered(F.col("metric"), labels, F.col("v")).alias("line"))


@query("prom_parse_roundtrip", f"WITH {SERIES} SELECT inst, hour, metric AS name, k, CAST(raw AS DOUBLE) AS value FROM series")
def prom_parse_roundtrip(spark, sf_dir):
    s = series(spark, sf_dir)
    line = exposition.rendered(F.col("metric"), F.create_map(F.lit("k"), F.col("k")), F.col("raw"))
    text = s.groupBy("inst", "hour").agg(F.array_join(F.collect_list(line), "\n").alias("payload"))
    rows = text.select("inst", "hour", F.explode(exposition.series(F.col("payload"))).alias("x"))
    return rows.select("inst", "hour", "x.name", F.col("x.labels")["k"].alias("k"), "x.value")


@query("hist_sum_count", f"WITH {SERIES} SELECT inst, CAST(sum(iv) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS n FROM series GROUP BY inst")
def hist_sum_count(spark, sf_dir):
    g = series(spark, sf_dir).groupBy("inst").agg(F.sum("iv").alias("s"), F.count("*").alias("c"))
    text = F.concat(F.lit('# TYPE lat histogram\nlat_bucket{le="1"} 1\nlat_sum '), F.col("s").cast("string"), F.lit("\nlat_count "), F.col("c").cast("string"))
    found = g.select("inst", exposition.series(text).alias("x"))
    one = lambda n: F.filter("x", lambda s: s["name"] == n)[0]["value"]
    return found.where(F.size("x") == 2).select("inst", one("lat_sum").alias("total"), one("lat_count").alias("n"))


@query("latency_histogram", "SELECT event_type, le, count(*) FILTER (value <= b) AS count, count(*) AS total FROM events, (VALUES ('10.0', 10.0), ('50.0', 50.0), ('+Inf', 1e308)) x(le, b) GROUP BY 1, 2")
def latency_histogram(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return telemetry.histogram(e, ["event_type"], "value", (10.0, 50.0)).select("event_type", "le", "count", "total")


@query("latency_quantiles", """
WITH b AS (SELECT event_type, le, count(*) FILTER (value <= le) AS c FROM events, (VALUES (5.0), (10.0), (25.0), (50.0), (100.0), (250.0), (1e308)) x(le) GROUP BY 1, 2
), r AS (SELECT *, coalesce(lag(c) OVER w, 0) AS less, coalesce(lag(le) OVER w, 0.0) AS low, max(c) OVER (PARTITION BY event_type) AS total FROM b WINDOW w AS (PARTITION BY event_type ORDER BY le)
), h AS (SELECT event_type, q, min_by(struct_pack(le := le, c := c, less := less, low := low, total := total), le) AS x
         FROM r, (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) y(q) WHERE c >= q * total GROUP BY 1, 2)
SELECT event_type, q AS quantile,
  round(CASE WHEN x.le > 1e300 THEN CAST(x.low AS DOUBLE) WHEN x.c = x.less THEN x.le ELSE x.low + (x.le - x.low) * (q * x.total - x.less) / (x.c - x.less) END, 6) AS value FROM h""")
def latency_quantiles(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    of_series = telemetry.histogram(e, ["event_type", "user_id"], "value", (5.0, 10.0, 25.0, 50.0, 100.0, 250.0))
    return telemetry.quantiles(of_series, ["event_type"], (0.5, 0.9, 0.99)).select("event_type", "quantile", _r("value"))


@query("gauge_snapshot_latest", _NORMAL + """, u AS (SELECT inst, vendor, ue, day FROM v WHERE ue IS NOT NULL)
SELECT 'ran_amf_ue_connected_count' AS name, CAST(inst AS VARCHAR) AS nf_instance_id, vendor, round(arg_max(ue, day), 6) AS value FROM u GROUP BY inst, vendor""")
def gauge_snapshot_latest(spark, sf_dir):
    g = sinks.latest_gauges(normalize(raw_scrapes(spark, sf_dir), registry()).records.where("kpi_name = 'ue.connected_count'"))
    return g.select("name", "nf_instance_id", "vendor", _r("value"))


_OTLP = """, o AS (
  SELECT record_id, 'ran.amf.registration.attempt_count' AS name, 'count' AS unit, da AS value,
         {'nf.type': 'AMF', 'nf.vendor': vendor, 'nf.instance_id': CAST(inst AS VARCHAR), 'network.plmn_id': '', 'network.data_center': ''} AS a FROM v)
SELECT name, unit, value, u.key AS key, u.value AS attribute FROM o, LATERAL (SELECT unnest([
  {'key': 'nf.type', 'value': a['nf.type']}, {'key': 'nf.vendor', 'value': a['nf.vendor']}, {'key': 'nf.instance_id', 'value': a['nf.instance_id']},
  {'key': 'network.plmn_id', 'value': a['network.plmn_id']}, {'key': 'network.data_center', 'value': a['network.data_center']}]) AS u)"""


@query("otlp_projection", _NORMAL + _OTLP)
def otlp_projection(spark, sf_dir):
    """Every attribute of every exported data point, read back from the requests."""
    rows = sinks.otlp_requests(normalize(raw_scrapes(spark, sf_dir), registry()).records.where("kpi_name = 'registration.attempt_count'"))
    point = "struct<attributes:array<struct<key:string,value:struct<stringValue:string>>>,timeUnixNano:string,asDouble:double>"
    metric = f"struct<name:string,unit:string,gauge:struct<dataPoints:array<{point}>>>"
    sent = F.from_json("request", f"resourceMetrics array<struct<scopeMetrics:array<struct<metrics:array<{metric}>>>>>")
    metrics = rows.select(F.explode(sent["resourceMetrics"][0]["scopeMetrics"][0]["metrics"]).alias("m"))
    points = metrics.select("m.name", "m.unit", F.explode("m.gauge.dataPoints").alias("p"))
    return points.select("name", "unit", F.col("p.asDouble").alias("value"), F.explode("p.attributes").alias("a")).select("name", "unit", "value", "a.key", F.col("a.value.stringValue").alias("attribute"))


# -- evidence, tables, verdicts over the events' telemetry -----------------------------

_EVIDENCE = {
    "RegistrationStorm": ("attempt_count:att_last", "mean:att_mean", "stddev:att_sigma", "success_rate:reg_rate_last"),
    "SessionDrop": ("sessions:sess_last", "peak:sess_peak", "drop_ratio:(sess_peak - sess_last) / sess_peak", "success_rate:reg_rate_last"),
    "RANCoreDivergence": ("gnb_throughput:gnb_last", "gnb_drop_ratio:(gnb_peak - gnb_last) / gnb_peak", "upf_throughput:upf_last", "upf_shift_ratio:abs(upf_last - upf_mean) / upf_mean"),
}


@query("rules_from_files", _NORMAL + """
, x AS (SELECT inst, day, ue, CASE WHEN vendor <> 'ericsson_enm' THEN dd END AS dereg, CASE WHEN da > 0 THEN (da - df) / da ELSE 0 END AS rate FROM v
), m AS (SELECT x.*, w.w FROM x, LATERAL (SELECT unnest(range(x.day - 6, x.day + 1)) AS w) w
), st AS (SELECT inst, w, count(ue) AS ue_n, max(ue) AS ue_peak, arg_max(ue, day) AS ue_last, count(dereg) AS dereg_n, avg(dereg) AS dereg_mean,
                 arg_max(dereg, day) AS dereg_last, arg_max(rate, day) AS rate_last FROM m GROUP BY inst, w)
SELECT 'ConnectedUserFall' AS rule_name, 'warning' AS severity, CAST(inst AS VARCHAR) AS plmn, w, round(ue_last, 6) AS observed, round((ue_peak - ue_last) / ue_peak, 6) AS measure
FROM st WHERE ue_n >= 2 AND ue_last < 0.5 * ue_peak
UNION ALL SELECT 'DeregistrationSurge', 'critical', CAST(inst AS VARCHAR), w, round(dereg_last, 6), round(dereg_mean, 6)
FROM st WHERE dereg_n >= 2 AND dereg_last > 1.25 * dereg_mean AND rate_last < 0.9""")
def rules_from_files(spark, sf_dir):
    """The shipped rules and a user's, over windows of seven days of normalised scrapes; each instance stands for a network."""
    rules = Rules.load(SHIPPED_RULES, SHIPPED_RULES.with_name("capacity.yaml"))
    raw = raw_scrapes(spark, sf_dir).withColumn("meta", F.create_map(F.lit("plmn"), F.col("instance_id")))
    samples = correlate.samples(normalize(raw, registry()).records, registry().prefix, rules.series)
    found = correlate.events(correlate.sliding(samples, "7 days", "1 day", names=rules.series), rules.rules)
    day = F.floor(seconds("window_start") / 86_400).cast("bigint")
    return found.select("rule_name", "severity", "plmn", day.alias("w"), _r(F.col("evidence")["observed"], "observed"), _r(F.col("evidence")["measure"], "measure"))


@query("rule_evidence", _HEAD + ", ev AS (" + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule_name, '{x.split(':')[0]}' AS name, plmn, w, CAST({x.split(':')[1]} AS DOUBLE) AS value FROM stats" for rule, parts in _EVIDENCE.items() for x in parts
) + """) SELECT rule_name, plmn, '1:' || substr(plmn, 1, 3) AS slice_id, w, name, round(value, 4) AS value FROM fired JOIN ev USING (rule_name, plmn, w)""")
def rule_evidence(spark, sf_dir):
    sliced = window_samples(spark, sf_dir).withColumn("slice_id", correlate.slice_text(F.lit(1), F.left("plmn", F.lit(3))))
    found = correlate.events(correlate.sliding(sliced, "24 hours", "1 hour"))
    rows = found.select("rule_name", "plmn", "slice_id", F.floor(seconds("window_start") / 3600).cast("bigint").alias("w"), F.explode("evidence").alias("name", "value"))
    return rows.withColumn("value", F.round("value", 4))


@query("event_table", _HEAD + " SELECT w, rule_name, severity, plmn FROM fired ORDER BY w DESC, rule_name, plmn LIMIT 100")
def event_table(spark, sf_dir):
    """The dashboard's table: the 100 newest events, newest first."""
    return _fired(spark, sf_dir).select("w", "rule_name", "severity", "plmn").orderBy(F.desc("w"), "rule_name", "plmn").limit(100)


@query("sim_counter_ticks", f"""WITH {SERIES}, m AS (
  SELECT inst, metric, ts, event_id, raw, unnest(range(CAST(ceil(epoch_us(ts) / 86400e6) AS BIGINT), CAST(ceil((epoch_us(ts) + 432000000000) / 86400e6) AS BIGINT))) * 86400 AS step FROM series
) SELECT inst, metric, step, CAST(arg_max(raw, struct_pack(t := ts, e := event_id)) AS DOUBLE) AS value FROM m GROUP BY 1, 2, 3""")
def sim_counter_ticks(spark, sf_dir):
    """Counters read at regular ticks: each one's last value, if it is less than five days old."""
    return promql.at_steps(series(spark, sf_dir), ["inst", "metric"], 432_000, 86_400, "raw", tie="event_id")


@query("sim_gauge_override", f"""WITH {SERIES}, o AS (SELECT *, max(CASE WHEN metric = 'error' THEN ts END) OVER (PARTITION BY inst ORDER BY ts, event_id) AS since FROM series)
SELECT event_id, CASE WHEN since IS NOT NULL AND epoch(ts) - epoch(since) < 21600 THEN 2000.0 ELSE value END AS value FROM o WHERE metric = 'view'""")
def sim_gauge_override(spark, sf_dir):
    """Gauges under an override that starts with an error of the same instance and lasts six hours."""
    errors = F.max(F.when(F.col("metric") == "error", F.col("ts"))).over(Window.partitionBy("inst").orderBy("ts", "event_id"))
    second = lambda c: F.col(c).cast("timestamp").cast("double")
    rows = series(spark, sf_dir).withColumn("since", errors).where("metric = 'view'")
    return rows.select("event_id", F.when(F.coalesce(second("ts") - second("since") < 21_600, F.lit(False)), 2000.0).otherwise(F.col("value")).alias("value"))


@query("certify_matrix", _HEAD + """, s AS (SELECT DISTINCT plmn FROM scrapes), e(rule, severity) AS (VALUES ('RegistrationStorm', 'critical'), ('SessionDrop', 'critical'), ('RANCoreDivergence', 'warning'))
SELECT rule, 'network' AS base, count(*) FILTER (ok) AS passed, count(*) AS total, bool_and(ok) AS ok FROM (
  SELECT rule, plmn, EXISTS (SELECT 1 FROM fired f WHERE f.plmn = s.plmn AND f.rule_name = e.rule AND f.severity = e.severity) AS ok FROM s, e) GROUP BY rule""")
def certify_matrix(spark, sf_dir):
    """For each rule, how many networks show the event that is expected of them."""
    found = _fired(spark, sf_dir).select("*", F.col("plmn").alias("scenario"), F.col("w").cast("int").alias("at_sec"))
    wanted = ((0, "RegistrationStorm", "critical"), (1, "SessionDrop", "critical"), (2, "RANCoreDivergence", "warning"))
    bounds = "map<string,struct<gt:double,lt:double,gte:double,lte:double,eq:double>>"
    networks = scrapes(spark, sf_dir).select(F.col("plmn").alias("scenario"), F.col("plmn").alias("vendor")).distinct()
    each = networks.withColumn("e", F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(r).alias("rule"), F.lit(v).alias("severity")) for i, r, v in wanted])))
    expected = each.select("scenario", "vendor", "e.*", F.lit(2_000_000_000).alias("within_seconds"), F.array().cast("array<string>").alias("affected"), F.create_map().cast(bounds).alias("evidence"))
    results = simulate.assess(expected, found).withColumn("base", F.lit("network"))
    return simulate.matrix(results).select("rule", "base", "passed", "total", "ok")


@query("expected_vs_observed", _HEAD + """, e(id, rule, severity) AS (VALUES (0, 'SessionDrop', 'warning'), (1, 'SessionDrop', 'critical'), (2, 'RANCoreDivergence', NULL))
SELECT id, rule, min(w) IS NOT NULL AS passed, CAST(min(w) AS INTEGER) AS at_sec FROM e LEFT JOIN fired f ON e.rule = f.rule_name AND (e.severity IS NULL OR e.severity = f.severity) GROUP BY 1, 2""")
def expected_vs_observed(spark, sf_dir):
    found = _fired(spark, sf_dir).select("*", F.lit("events").alias("scenario"), F.col("w").cast("int").alias("at_sec"))
    wanted = [{"rule": "SessionDrop", "severity": "warning"}, {"rule": "SessionDrop", "severity": "critical"}, {"rule": "RANCoreDivergence"}]
    s = simulate.Scenario("events", 2_000_000_000, [{"vendor": "v"}], wanted)
    return simulate.assess(simulate.expectations(spark, [s]), found).select("id", "rule", "passed", "at_sec")


# -- sources, sets, dashboards -------------------------------------------------------

@query("scrape_error_class", """SELECT event_id, CASE WHEN s IN (401, 403) THEN 'auth' WHEN s > 0 THEN 'network' WHEN event_id % 2 = 0 THEN 'timeout' ELSE 'network' END AS class
FROM (SELECT event_id, [0, 401, 403, 500, 404][user_id % 5 + 1] AS s FROM events)""")
def scrape_error_class(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    status = F.element_at(F.array(*map(F.lit, (0, 401, 403, 500, 404))), (F.col("user_id") % 5 + 1).cast("int"))
    return e.select("event_id", error_class(status, F.col("event_id") % 2 == 0).alias("class"))


@query("state_key_parts", f"WITH {SERIES} SELECT DISTINCT vendor || ':' || metric || ':' || inst AS key, vendor, metric AS nf FROM series")
def state_key_parts(spark, sf_dir):
    key = series(spark, sf_dir).select(F.concat_ws(":", "vendor", "metric", F.col("inst").cast("string")).alias("key")).distinct()
    part = lambda i: F.coalesce(F.nullif(F.split_part("key", F.lit(":"), F.lit(i)), F.lit("")), F.lit("unknown"))
    return key.select("key", part(1).alias("vendor"), part(2).alias("nf"))


@query("promql_rate", f"""WITH {SERIES}, l AS (SELECT *, {_LAG.format('raw_reset')} AS p FROM series)
SELECT inst, metric, hour, round(sum(CASE WHEN p IS NULL THEN 0 WHEN raw_reset < p THEN raw_reset ELSE raw_reset - p END) / 3600.0, 6) AS rate FROM l GROUP BY 1, 2, 3""")
def promql_rate(spark, sf_dir):
    rows = promql.rate(series(spark, sf_dir), ["inst", "metric"], "1 hour", 3600, value="raw_reset")
    return rows.select("inst", "metric", F.floor(seconds("window_start") / 3600).cast("bigint").alias("hour"), _r("rate"))


@query("promql_increase", f"""WITH {SERIES}, l AS (SELECT *, {_LAG.format('raw_reset')} AS p FROM series)
SELECT inst, metric, hour, CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN raw_reset < p THEN raw_reset ELSE raw_reset - p END) AS DOUBLE) AS increase FROM l GROUP BY 1, 2, 3""")
def promql_increase(spark, sf_dir):
    rows = promql.increase(series(spark, sf_dir), ["inst", "metric"], "1 hour", value="raw_reset")
    return rows.select("inst", "metric", F.floor(seconds("window_start") / 3600).cast("bigint").alias("hour"), F.col("increase").cast("double").alias("increase"))


def _range_sql(value: str) -> str:
    """Every window's samples, each with the one before it inside the window."""
    return f"""WITH {SERIES}, m AS (
  SELECT inst, metric, ts, event_id, raw_reset, unnest(range(CAST(ceil(epoch_us(ts) / 86400e6) AS BIGINT), CAST(ceil((epoch_us(ts) + 864000000000) / 86400e6) AS BIGINT))) * 86400 AS step FROM series
), l AS (SELECT *, lag(raw_reset) OVER (PARTITION BY inst, metric, step ORDER BY ts, event_id) AS p FROM m)
SELECT inst, metric, step, {value} FROM l WHERE p IS NOT NULL GROUP BY 1, 2, 3"""


_RISE = "sum(CASE WHEN raw_reset < p THEN raw_reset ELSE raw_reset - p END)"


@query("promql_increase_range", _range_sql(f"CAST({_RISE} AS DOUBLE) AS increase"))
def promql_increase_range(spark, sf_dir):
    return promql.increase_over(series(spark, sf_dir), ["inst", "metric"], 864_000, 86_400, "raw_reset", tie="event_id")


@query("promql_rate_range", _range_sql(f"round({_RISE} / 864000.0, 9) AS rate"))
def promql_rate_range(spark, sf_dir):
    rows = promql.increase_over(series(spark, sf_dir), ["inst", "metric"], 864_000, 86_400, "raw_reset", tie="event_id")
    return rows.select("inst", "metric", "step", F.round(F.col("increase") / 864_000, 9).alias("rate"))


@query("promql_last_not_null", f"""WITH {SERIES} SELECT inst, metric, arg_max(iv, struct_pack(t := ts, e := event_id)) FILTER (k <> '3') AS value FROM series GROUP BY 1, 2
HAVING count(*) FILTER (k <> '3') > 0""")
def promql_last_not_null(spark, sf_dir):
    s = series(spark, sf_dir).withColumns({"at": F.struct("ts", "event_id"), "iv": F.when(F.col("k") != "3", F.col("iv"))})
    return promql.instant(s, ["inst", "metric"], "iv", "at").select("inst", "metric", "value")


#: Telemetry of collectors that each live for 2,000 events, two seconds apart: (metric, its value or increment, counter).
_SELF = (
    ("collector_scrape_success", "CASE WHEN event_id // 200 % 4 = 0 THEN 0 ELSE 1 END", False),
    ("collector_scrape_error_total", "CASE WHEN event_id // 500 % 2 = 0 THEN 1 ELSE 0 END", True),
    ("normalizer_worker_queue_depth", "CASE WHEN event_id // 300 % 3 = 0 THEN 250 ELSE 10 END", False),
    ("normalizer_worker_dispatch_skew", "event_id // 10 % 70", False),
    ("dead_letter_total", "CASE WHEN event_id // 400 % 3 = 1 THEN 1 ELSE 0 END", True),
    ("counter_store_errors_total", "CASE WHEN event_id % 90 = 0 THEN 2 ELSE 0 END", True),
    ("counter_reset_total", "CASE WHEN event_id // 250 % 5 = 2 THEN 30 ELSE 0 END", True),
    ("counter_ooo_total", "event_id // 100 % 20", True),
    ("correlator_events_total", "CASE WHEN event_id % 700 = 0 THEN 1 ELSE 0 END", True),
)
_OF_RULE = "CASE event_id // 2000 % 3 WHEN 0 THEN 'RegistrationStorm' WHEN 1 THEN 'SessionDrop' ELSE 'RANCoreDivergence' END"


def self_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's own metrics as samples (metric, labels, ts, value), derived from the events' numbers."""
    sql = lambda x: x.replace("//", "DIV")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.expr("event_id DIV 2000").alias("episode"))
    so_far = Window.partitionBy("episode").orderBy("event_id")  # 2,000 rows at most
    each = [F.expr(sql(x)).cast("double") for _, x, _ in _SELF]
    wide = promql.dealt(e, ["episode"]).select("event_id", "episode", F.expr(sql(_OF_RULE)).alias("rule"), *[(F.sum(x).over(so_far) if c else x).alias(m) for x, (m, _, c) in zip(each, _SELF, strict=True)])
    rows = wide.withColumn("metric", F.explode(F.array(*[F.lit(m) for m, _, _ in _SELF])))
    value = F.coalesce(*[F.when(F.col("metric") == m, F.col(m)) for m, _, _ in _SELF])
    labels = F.create_map(F.lit("collector"), F.col("episode").cast("string"), F.lit("rule_name"), F.col("rule"))
    return rows.select("metric", labels.alias("labels"), F.timestamp_seconds(F.col("event_id") * 2).alias("ts"), value.alias("value"))


_ALERTS_SQL = "WITH x AS (" + " UNION ALL ".join(f"SELECT event_id, '{m}' AS metric, CAST({x} AS DOUBLE) AS x, {str(c).upper()} AS counter FROM events" for m, x, c in _SELF) + f"""
), t AS (
  SELECT metric, event_id // 2000 AS collector, {_OF_RULE} AS rule, event_id * 2 AS ts,
         CASE WHEN counter THEN sum(x) OVER (PARTITION BY metric, event_id // 2000 ORDER BY event_id) ELSE x END AS value FROM x
), r(alert, metric, f, w, op, threshold, hold, severity, rule) AS (VALUES
  ('CollectorScrapeFailure', 'collector_scrape_success', 'instant', 300, '==', 0, 120, 'warning', NULL),
  ('CollectorHighErrorRate', 'collector_scrape_error_total', 'rate', 300, '>', 0.1, 300, 'warning', NULL),
  ('NormalizerQueueSaturated', 'normalizer_worker_queue_depth', 'instant', 300, '>', 200, 60, 'warning', NULL),
  ('NormalizerHighSkew', 'normalizer_worker_dispatch_skew', 'instant', 300, '>', 50, 300, 'warning', NULL),
  ('DeadLetterAccumulating', 'dead_letter_total', 'rate', 600, '>', 0, 600, 'warning', NULL),
  ('StoreErrors', 'counter_store_errors_total', 'rate', 300, '>', 0, 120, 'critical', NULL),
  ('CounterResetStorm', 'counter_reset_total', 'rate', 300, '>', 10, 60, 'warning', NULL),
  ('OOOTelemetry', 'counter_ooo_total', 'rate', 300, '>', 5, 300, 'warning', NULL),
  ('RegistrationStorm', 'correlator_events_total', 'increase', 300, '>', 0, 0, 'critical', 'RegistrationStorm'),
  ('SessionDrop', 'correlator_events_total', 'increase', 300, '>', 0, 0, 'warning', 'SessionDrop'),
  ('RANCoreDivergence', 'correlator_events_total', 'increase', 300, '>', 0, 0, 'warning', 'RANCoreDivergence')
), m AS (
  SELECT r.*, t.collector, t.rule AS of_rule, t.ts, t.value, unnest(range(CAST(ceil(t.ts / 30.0) AS BIGINT), CAST(ceil((t.ts + r.w) / 30.0) AS BIGINT))) * 30 AS step
  FROM t JOIN r ON t.metric = r.metric AND (r.rule IS NULL OR r.rule = t.rule)
), l AS (SELECT *, lag(value) OVER (PARTITION BY alert, collector, step ORDER BY ts) AS p FROM m
), v AS (
  SELECT alert, severity, op, threshold, hold, collector, of_rule, step,
         CASE f WHEN 'instant' THEN arg_max(value, ts) WHEN 'rate' THEN sum(CASE WHEN value < p THEN value ELSE value - p END) / w ELSE sum(CASE WHEN value < p THEN value ELSE value - p END) END AS value,
         count(p) + CASE f WHEN 'instant' THEN 1 ELSE 0 END AS enough
  FROM l GROUP BY alert, severity, op, threshold, hold, f, w, collector, of_rule, step
), h AS (SELECT *, step - 30 * row_number() OVER (PARTITION BY alert, collector ORDER BY step) AS island FROM v
  WHERE enough > 0 AND CASE op WHEN '==' THEN value = threshold ELSE value > threshold END)
SELECT alert, severity, 'collector=' || collector || ',rule_name=' || of_rule AS series, min(step) AS since, min(step) + hold AS fires_at, max(step) AS until, round(max(value), 6) AS peak
FROM h GROUP BY alert, severity, collector, of_rule, hold, island HAVING max(step) - min(step) >= hold"""


@query("alerts_shipped", _ALERTS_SQL)
def alerts_shipped(spark, sf_dir):
    return alerts.evaluate(self_telemetry(spark, sf_dir)).withColumn("peak", _r("peak"))


@query("promql_instant", f"WITH {SERIES} SELECT inst, metric, arg_max(raw, struct_pack(t := ts, e := event_id)) AS value FROM series GROUP BY 1, 2")
def promql_instant(spark, sf_dir):
    s = series(spark, sf_dir).withColumn("at", F.struct("ts", "event_id"))
    return promql.instant(s, ["inst", "metric"], "raw", "at").select("inst", "metric", "value")


@query("promql_ratio", f"""WITH {SERIES} SELECT inst, round(arg_max(raw, n) FILTER (metric = 'error') / nullif(CAST(arg_max(raw, n) FILTER (metric = 'signup') AS DOUBLE), 0), 6) AS value FROM series
GROUP BY 1 HAVING count(*) FILTER (metric = 'error') > 0 AND count(*) FILTER (metric = 'signup') > 0""")
def promql_ratio(spark, sf_dir):
    s = series(spark, sf_dir)
    part = lambda m: promql.instant(s.where(F.col("metric") == m), ["inst"], "raw", "n").select("inst", "value")
    return promql.divided(part("error"), part("signup"), ["inst"]).select("inst", _r("value"))


@query("promql_avg", f"WITH {SERIES} SELECT metric, round(avg(value), 6) AS value FROM series GROUP BY 1")
def promql_avg(spark, sf_dir):
    return series(spark, sf_dir).groupBy("metric").agg(_r(F.avg("value"), "value"))


@query("alert_for_duration", f"""WITH {SERIES}, {SCRAPES}, c AS (SELECT *, coalesce(att < 100000, FALSE) AS o FROM scrapes),
i AS (SELECT *, sum(CASE WHEN o THEN 0 ELSE 1 END) OVER (PARTITION BY plmn ORDER BY hour) AS g FROM c)
SELECT plmn, min(hour) AS start, max(hour) AS "end", count(*) AS samples FROM i WHERE o GROUP BY plmn, g HAVING max(hour) - min(hour) >= 2""")
def alert_for_duration(spark, sf_dir):
    s = scrapes(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.col("hour") * 3600))
    hour = lambda c: F.floor(seconds(c) / 3600).cast("bigint").alias(c)
    return promql.held_for(s, ["plmn"], F.col("att") < 100_000, 7200).select("plmn", hour("start"), hour("end"), "samples")


@query("worker_skew", "SELECT CAST(max(n) - min(n) AS BIGINT) AS skew FROM (SELECT user_id % 8 AS w, count(*) AS n FROM events GROUP BY 1)")
def worker_skew(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy((F.col("user_id") % 8).alias("w")).agg(F.count("*").alias("n"))
    return n.agg((F.max("n") - F.min("n")).alias("skew"))


@query("union_sources", f"WITH {SERIES} SELECT vendor, count(*) AS n FROM series GROUP BY vendor")
def union_sources(spark, sf_dir):
    s = series(spark, sf_dir)
    parts = [s.where(F.col("vendor") == v) for v in ("free5gc", "open5gs", "ericsson_enm")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("vendor").agg(F.count("*").alias("n"))


@query("subset_nfs", f"WITH {SERIES} SELECT inst FROM series GROUP BY inst HAVING count(DISTINCT metric) FILTER (metric IN ('click', 'error')) = 2")
def subset_nfs(spark, sf_dir):
    g = series(spark, sf_dir).groupBy("inst").agg(F.collect_set("metric").alias("seen"))
    return g.where(F.size(F.array_except(F.array(F.lit("click"), F.lit("error")), "seen")) == 0).select("inst")


@query("sorted_namespaces", _RECORDS + "SELECT CAST(row_number() OVER (ORDER BY namespace) - 1 AS INTEGER) AS i, namespace, count(*) AS records FROM r GROUP BY namespace")
def sorted_namespaces(spark, sf_dir):
    """Namespaces of the events in order; the window is over their names, of which a registry has a few."""
    names = split_handled(_as_records(spark, sf_dir), registry())
    rows = names[0].select("namespace").unionByName(names[1].select("namespace")).groupBy("namespace").agg(F.count("*").alias("records"))
    return rows.select((F.row_number().over(Window.orderBy("namespace")) - 1).alias("i"), "namespace", "records")


@query("sorted_collectors", _RECORDS + """SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS i, name, records FROM (
SELECT vendor || '-' || substr(namespace, 5) AS name, count(*) AS records FROM r GROUP BY 1) WHERE name IN ('free5gc-amf', 'free5gc-smf', 'free5gc-upf', 'open5gs-amf', 'open5gs-smf', 'open5gs-upf')""")
def sorted_collectors(spark, sf_dir):
    """Events of the collectors that ship, in order of name."""
    rows = _as_records(spark, sf_dir).groupBy(F.concat_ws("-", "vendor", F.lower("nf_type")).alias("name")).agg(F.count("*").alias("records"))
    held = rows.where(F.col("name").isin(COLLECTORS.names()))
    return held.select((F.row_number().over(Window.orderBy("name")) - 1).alias("i"), "name", "records")


@query("distinct_vendors", f"WITH {SERIES} SELECT count(DISTINCT vendor) AS vendors FROM series")
def distinct_vendors(spark, sf_dir):
    return series(spark, sf_dir).agg(F.count_distinct("vendor").alias("vendors"))


# -- streams -------------------------------------------------------------------------

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    e = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("inst"),
        F.when(F.col("user_id") % 2 == 0, "310-260").otherwise("311-480").alias("plmn"), F.col("event_type").alias("metric"), (F.round(F.col("value") * 100) % 1000).alias("v"),
    )


_STREAM = "e AS (SELECT event_id, ts, CAST(user_id AS VARCHAR) AS inst, CASE WHEN user_id % 2 = 0 THEN '310-260' ELSE '311-480' END AS plmn, event_type AS metric, round(value * 100) % 1000 AS v FROM events)"


_RELEASED = "(SELECT max(ts) - INTERVAL 60 SECOND FROM e)"


@query("stream_counter_state", f"""WITH {_STREAM}, l AS (SELECT *, lag(v) OVER (PARTITION BY inst, metric ORDER BY ts, event_id) AS p FROM e)
SELECT event_id, CASE WHEN p IS NULL OR v < p THEN v ELSE v - p END AS delta, coalesce(v < p, FALSE) AS reset, FALSE AS late FROM l WHERE ts <= {_RELEASED}""")
def stream_counter_state(spark, sf_dir):
    """Deltas of a stream whose samples arrive in the order of the file: those that event time has passed by the delay, in order of time."""
    rows = _event_stream(spark, sf_dir).select(F.col("inst").alias("source"), F.col("metric").alias("kpi"), "ts", F.col("event_id").alias("seq"), F.col("v").alias("value"))
    return drained(stream_deltas(rows, delay="60 seconds")).select(F.col("seq").alias("event_id"), "delta", "reset", "late")


@query("stream_sliding_rules", f"""WITH {_STREAM}, m AS (SELECT e.*, w.w FROM e, LATERAL (SELECT unnest(range(CAST(floor(epoch(ts) / 3600) AS BIGINT) - 23, CAST(floor(epoch(ts) / 3600) AS BIGINT) + 1)) AS w) w)
SELECT plmn, w, count(*) FILTER (metric = 'signup') AS att_n, round(avg(v) FILTER (metric = 'signup'), 4) AS att_mean, max(v) FILTER (metric = 'click') AS gnb_peak FROM m GROUP BY 1, 2""")
def stream_sliding_rules(spark, sf_dir):
    """Every window once: as the watermark closes it, the last ones when the stream ends."""
    names = F.create_map(*map(F.lit, ("signup", "att", "error", "reg_rate", "purchase", "sess", "click", "gnb", "view", "upf")))
    rows = _event_stream(spark, sf_dir).select("plmn", F.lit("").alias("slice_id"), "ts", F.col("event_id").alias("seq"), names[F.col("metric")].alias("metric"), F.col("v").alias("value"))
    rows, end = with_end(rows)
    stats = correlate.sliding(rows, "24 hours", "1 hour", watermark="1 day")
    hour = F.floor(seconds("window_start") / 3600).cast("bigint").alias("w")
    return drained(stats, end=end).select("plmn", hour, "att_n", F.round("att_mean", 4).alias("att_mean"), "gnb_peak")


@query("gnmi_decode", "SELECT event_id, '/gnb/' || event_type AS path, CAST(user_id % 8 AS VARCHAR) AS id, value FROM events")
def gnmi_decode(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    encode = F.pandas_udf(lambda m, i, v: m.combine(i, lambda a, b: (a, b)).combine(v, lambda a, b: gnmi.encode([(a[0], {"id": a[1]}, b)], prefix="/gnb")), "binary")
    rows = e.select("event_id", encode("event_type", (F.col("user_id") % 8).cast("string"), "value").alias("payload"))
    found = rows.select("event_id", F.explode(gnmi.series(F.col("payload"))["series"]).alias("s"))
    return found.select("event_id", F.col("s.name").alias("path"), F.col("s.labels")["id"].alias("id"), F.col("s.value").alias("value"))
