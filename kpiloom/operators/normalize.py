"""Raw scrapes to canonical KPI records; failures are rows.

A scrape stays one row until the end: the series that its KPIs read are found
while its payload is decoded, by an index of the registry (its size is that of
the YAML files), and only the counter delta shuffles, once, on the source: values
and labels of the KPIs, while units, references and names come from the registry again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import formula, paths
from kpiloom.operators import series_index
from kpiloom.operators.counters import delta
from kpiloom.registry import Registry

SOURCE = ("vendor", "nf_type", "instance_id")
#: A registry of up to so many mappings is broadcast.
BROADCAST_MAPPINGS = 20_000


@dataclass
class Normalized:
    """``records`` (facts), ``partial`` (a KPI failed) and ``failures`` (a whole scrape failed).

    ``outcomes`` has the rows of the first two in one pass, told apart by ``kind``.
    """

    records: DataFrame
    partial: DataFrame
    failures: DataFrame
    outcomes: DataFrame


def namespace(nf_type: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lower(nf_type))


def plans(spark, registry: Registry) -> DataFrame:
    """(namespace, vendor, protocol, plan): each base KPI with its mapping, null where the vendor has none."""
    mappings = registry.mapping_dim(spark)
    vendors = mappings.select("namespace", "vendor", F.col("protocol").alias("mapped_protocol")).distinct()
    kpis = registry.kpi_dim(spark).where(~F.col("derived")).join(vendors, "namespace")
    rows = kpis.join(mappings.withColumn("mapped", F.lit(True)), ["namespace", "vendor", "kpi"], "left")
    item = F.struct("ord", "kpi", "unit", "spec_ref", "mapped", "metric", "kind", "reset_aware", "strategy", "labels", "template", "captures", "extract")
    return rows.groupBy("namespace", "vendor").agg(F.array_sort(F.collect_list(item), lambda a, b: a["ord"] - b["ord"]).alias("plan"))


def _dimension(spark, registry: Registry) -> DataFrame:
    plan = plans(spark, registry)
    size = sum(len(ms) for n in registry.namespaces.values() for ms in n.mappings.values())
    return F.broadcast(plan) if size <= BROADCAST_MAPPINGS else plan


def split_handled(raw: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """(records with their plan, failures with reason): known namespace, mapped vendor, supported protocol."""
    dim = _dimension(raw.sparkSession, registry)
    found = raw.withColumn("namespace", namespace(F.col("nf_type"), registry.prefix)).join(dim, ["namespace", "vendor"], "left")
    known = F.col("namespace").isin(registry.names()) if registry.names() else F.lit(False)
    reason = (
        F.when(F.coalesce(~known, F.lit(True)), "unknown namespace")
        .when(F.col("plan").isNull(), "vendor not mapped")
        .when(~F.coalesce(F.col("protocol").isin("prometheus", "gnmi"), F.lit(False)), "unsupported protocol")
    )
    found = found.withColumn("failure", reason)
    return found.where("failure IS NULL").drop("failure"), found.where("failure IS NOT NULL").select("record_id", "namespace", *SOURCE, "timestamp", F.col("failure").alias("reason"))


def combined(hits: Column, p: Column) -> Column:
    """One value of the matching series: their sum for ``sum_by``, else the first."""
    total = F.aggregate(hits, F.lit(0.0), lambda a, s: a + s["value"])
    return F.when(F.size(hits) > 0, F.when((p["strategy"] == "sum_by") & p["template"].isNull(), total).otherwise(F.element_at(hits, 1)["value"]))


def extracted(hits: Column, p: Column) -> Column:
    """Labels of the first match: its own, then the extraction rules', then the template's captures."""
    first = F.try_element_at(hits, F.lit(1))
    name, none = first["name"], F.create_map().cast("map<string,string>")
    by_rule = F.transform_values(F.coalesce(p["extract"], F.create_map().cast("map<string,int>")), lambda _, i: F.when(i >= 0, F.try_element_at(paths.extraction_segments(name), i + 1)))
    caught = F.filter(F.zip_with(p["captures"], paths.segments(name), lambda k, v: F.struct(k.alias("key"), v.alias("value"))), lambda e: e["key"].isNotNull())
    captures = F.when(p["template"].isNotNull(), F.map_from_entries(caught))
    own = F.coalesce(first["labels"], none)
    plain = first.isNull() | (p["template"].isNull() & (F.coalesce(F.size(p["extract"]), F.lit(0)) <= 0))
    return F.when(plain, own).otherwise(paths.merged_maps(own, F.map_filter(by_rule, lambda _, v: v.isNotNull()), F.coalesce(captures, none)))


def prepared(raw: DataFrame, registry: Registry) -> tuple[DataFrame, DataFrame]:
    """(scrapes with ``found`` values and ``found_labels`` in the order of their plan, failures with reason); no state, so also on streams."""
    handled, refused = split_handled(raw, registry)
    read = handled.withColumn("_read", series_index.hits(registry, F.col("namespace"), F.col("vendor"), F.col("protocol"), F.col("payload"))).drop("payload")
    malformed = read.where("_read.error IS NOT NULL").select("record_id", "namespace", *SOURCE, "timestamp", F.col("_read.error").alias("reason"))

    def value(p: Column, hits: Column) -> Column:
        found = combined(hits, p)
        return F.when(p["kind"] == "counter", F.coalesce(found, F.lit(0.0))).otherwise(found)

    def labels(p: Column, hits: Column) -> Column:
        return F.when(p["mapped"], extracted(hits, p))

    good = read.where("_read.error IS NULL").withColumn("hits", F.col("_read.hits"))
    good = good.withColumns({"found": F.zip_with("plan", "hits", value), "found_labels": F.zip_with("plan", "hits", labels)}).drop("_read", "plan", "hits")
    return good, refused.unionByName(malformed)


def completed(staged: DataFrame, registry: Registry, failures: DataFrame) -> Normalized:
    """Records and failures of ``prepared`` scrapes with ``before``, the values that their source had last."""
    staged = staged.join(_dimension(staged.sparkSession, registry), ["namespace", "vendor"])

    def base(p: Column, i: Column) -> Column:
        now = F.get("found", i)
        return F.struct(
            p["kpi"].alias("kpi"), p["unit"].alias("unit"), p["spec_ref"].alias("spec_ref"), F.coalesce(p["mapped"], F.lit(False)).alias("mapped"), p["metric"].alias("metric"),
            F.when(p["kind"] == "counter", delta(now, F.get("before", i), p["reset_aware"])).otherwise(now).alias("value"), F.get("found_labels", i).alias("labels"),
        )

    staged = staged.withColumn("base", F.transform("plan", base)).drop("plan", "found", "found_labels", "before")
    return _with_derived(staged, registry, failures)


def normalize(raw: DataFrame, registry: Registry, ttl_seconds: float | None = None, order: tuple[str, ...] = ("timestamp", "record_id")) -> Normalized:
    """Records, partial failures and total failures of raw scrapes.

    An absent counter is 0 and goes into the counter's state as 0; an absent
    gauge is a partial failure; a KPI without mapping is unsupported.  Deltas
    follow ``order`` within a source.
    """
    good, failures = prepared(raw, registry)
    source = Window.partitionBy(*SOURCE).orderBy(*order)
    before, before_at = F.lag("found").over(source), F.lag("timestamp").over(source)
    if ttl_seconds is not None:
        gap = F.col("timestamp").cast("double") - before_at.cast("double")
        before = F.when(F.coalesce(gap >= ttl_seconds, F.lit(False)), None).otherwise(before)
    return completed(good.withColumn("before", before), registry, failures)


def _levels(registry: Registry) -> list[list[dict[str, tuple]]]:
    """The formulas by depth, those of one level depending on earlier ones only; of a level, one a namespace in each place."""
    depth: dict[tuple[str, str], int] = {}
    levels: list[dict[str, list[tuple]]] = []
    for ns, kpi, tree in registry.formulas():
        at = max((depth.get((ns, d), -1) for d in kpi.depends_on), default=-1) + 1
        depth[ns, kpi.name] = at
        levels += [{} for _ in range(at + 1 - len(levels))]
        levels[at].setdefault(ns, []).append((kpi, tree))
    return [[{ns: fs[i] for ns, fs in level.items() if i < len(fs)} for i in range(max(map(len, level.values())))] for level in levels]


def _by_namespace(branches: dict[str, Column]) -> Column:
    """The branch of the row's namespace, null in others."""
    out = F
    for ns, value in branches.items():
        out = out.when(F.col("namespace") == ns, value)
    return out


@dataclass
class _Place:
    """Where a KPI's value is, and whether it has none because the vendor does not report it."""

    value: Column
    unsupported: Column


def _value(registry: Registry, places: dict[str, _Place], ns: str, tree) -> Column:
    """A formula over the values known so far; NaN if it has a name that its namespace lacks."""
    if any(registry.kpi(ns, n) is None for n in formula.names(tree)):
        return F.lit(float("nan"))
    return formula.to_column(tree, lambda n: places[n].value if n in places else F.lit(None).cast("double"))


def _outcome(registry: Registry, places: dict[str, _Place], ns: str, kpi, tree, value: Column) -> Column:
    """A derived KPI's value, or why it has none: the first dependency that failed, else what is wrong with the value."""
    reason, unsupported = F, F
    for d in kpi.depends_on:
        reason = reason.when(places[d].value.isNull(), f"dependency failed: {d}")
        unsupported = unsupported.when(places[d].value.isNull(), places[d].unsupported)
    unknown = [n for n in sorted(formula.names(tree)) if registry.kpi(ns, n) is None]
    reason = reason.when(value.isNull(), "unknown identifier").when(~formula.finite(value), f"unknown identifier: {unknown[0]}" if unknown else "division by zero")
    return F.struct(
        F.lit(kpi.name).alias("kpi"), F.lit(kpi.unit).alias("unit"), F.lit(kpi.spec_ref).alias("spec_ref"), F.when(reason.isNull(), value).alias("value"),
        reason.alias("reason"), F.coalesce(unsupported, F.lit(False)).alias("unsupported"),
    )


def _with_derived(staged: DataFrame, registry: Registry, failures: DataFrame) -> Normalized:
    """Formulas read values by position: base KPIs from arrays, derived ones from the columns of earlier levels."""
    staged = staged.withColumns({"values": F.transform("base", lambda b: F.when(b["mapped"], b["value"])), "unmapped": F.transform("base", lambda b: ~b["mapped"])})
    places = {
        ns: {k: _Place(F.get("values", F.lit(i)), F.get("unmapped", F.lit(i))) for i, k in enumerate(k for k in n.order if not n.kpis[k].derived)}
        for ns, n in registry.namespaces.items()
    }
    results: list[Column] = []
    for level in _levels(registry):
        first = len(results)
        values = {f"value_{first + i}": _by_namespace({ns: _value(registry, places[ns], ns, tree) for ns, (_, tree) in of.items()}) for i, of in enumerate(level)}
        staged = staged.withColumns(values)
        named = {
            f"derived_{first + i}": _by_namespace({ns: _outcome(registry, places[ns], ns, kpi, tree, F.col(f"value_{first + i}")) for ns, (kpi, tree) in of.items()})
            for i, of in enumerate(level)
        }
        staged = staged.withColumns(named).drop(*values)
        for name, of in zip(named, level, strict=True):
            for ns, (kpi, _) in of.items():
                places[ns][kpi.name] = _Place(F.col(f"{name}.value"), F.col(f"{name}.unsupported"))
        results += map(F.col, named)
    base = F.transform(
        "base",
        lambda b: F.struct(
            b["kpi"].alias("kpi"), b["unit"].alias("unit"), b["spec_ref"].alias("spec_ref"), F.when(b["mapped"], b["value"]).alias("value"),
            F.when(~b["mapped"], "no mapping").when(b["value"].isNull(), "metric not found").alias("reason"), (~b["mapped"]).alias("unsupported"),
            b["labels"].alias("labels"), b["metric"].alias("raw"),
        ),
    )
    none = F.lit(None)
    derived = F.filter(F.array(*results), lambda d: d.isNotNull()) if results else None
    every = base if derived is None else F.concat(base, F.transform(derived, lambda d: d.withField("labels", none.cast("map<string,string>")).withField("raw", none.cast("string"))))
    late = F.col("late") if "late" in staged.columns else F.lit(False)
    rows = staged.select("record_id", "namespace", *SOURCE, "timestamp", "meta", "schema_version", late.alias("late"), F.explode(every).alias("k"))
    # non-finite base values cannot be told from failures downstream, so they are failures
    usable = F.coalesce(F.col("k.value").isNotNull() & formula.finite(F.col("k.value")), F.lit(False))
    kind = F.when(F.col("late"), "late").when(usable, "record").otherwise("partial")
    reason = F.when(F.col("late"), "out of order").when(~usable, F.coalesce("k.reason", F.lit("value is not finite")))
    outcomes = rows.select(
        kind.alias("kind"), "record_id", "namespace", *SOURCE, F.col("k.kpi").alias("kpi_name"), F.col("k.value").alias("value"), F.col("k.unit").alias("unit"), "timestamp",
        attributes().alias("attributes"), F.col("k.labels").alias("labels"), F.col("k.spec_ref").alias("spec_ref"), "schema_version",
        F.col("k.raw").alias("raw"), reason.alias("reason"), F.col("k.unsupported").alias("unsupported"),
    )
    return Normalized(records_of(outcomes), partial_of(outcomes), failures, outcomes)


def records_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("kind = 'record'").select("record_id", "namespace", "kpi_name", "value", "unit", "timestamp", "attributes", "labels", "spec_ref", "schema_version")


def partial_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("kind = 'partial'").select("record_id", "namespace", *SOURCE, "timestamp", "kpi_name", "raw", "reason", "unsupported")


def attributes() -> Column:
    """Resource attributes of a record; PLMN, data centre, slice and cell come from ``meta`` where it has them."""
    m = lambda k: F.try_element_at(F.col("meta"), F.lit(k))
    slice_id = F.when(m("sst").isNotNull(), F.struct(m("sst").try_cast("int").alias("sst"), F.coalesce(m("sd"), F.lit("")).alias("sd")))
    cell = F.when(m("cell").isNotNull(), F.struct(m("cell").alias("global_cell_id"), m("nci").try_cast("bigint").alias("nci"), m("tac").try_cast("bigint").alias("tac")))
    return F.struct(
        F.coalesce(m("plmn"), F.lit("")).alias("plmn_id"), F.col("instance_id").alias("nf_instance_id"), "nf_type",
        F.coalesce(m("data_center"), F.lit("")).alias("data_center"), slice_id.alias("slice_id"), cell.alias("cell_id"), "vendor",
    )
