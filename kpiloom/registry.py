"""The KPI registry: YAML files, validated and ordered on the driver, used as small dimension tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from kpiloom.functions import formula, paths

SHIPPED = Path(__file__).parent / "registry"
#: Each key of a file with the other spelling that it may have.
TOP = {"vendors": "mappings", "version": "schema_version", "namespace": None, "nf_type": None, "spec": None, "kpis": None, "gnmi_paths": None}
VENDOR = {"protocol": "source_protocol", "metrics": None}
MAPPING = {
    "metric": "prometheus_metric", "path": "gnmi_path", "template": "source_template", "strategy": "label_match_strategy", "extract": "label_extract",
    "labels": None, "type": None, "reset_aware": None, "transform": None,
}


class RegistryError(ValueError):
    """The registry's files contradict themselves."""


@dataclass(frozen=True)
class Kpi:
    name: str
    unit: str
    spec_ref: str
    formula: str | None = None
    depends_on: tuple[str, ...] = ()

    @property
    def derived(self) -> bool:
        return self.formula is not None


@dataclass(frozen=True)
class Mapping:
    """How a vendor reports a KPI: by metric name and labels, by path, or by template."""

    metric: str
    kind: str
    reset_aware: bool = False
    strategy: str = "exact"
    labels: dict = field(default_factory=dict)
    template: str | None = None
    transform: str | None = None
    extract: dict = field(default_factory=dict)


@dataclass
class Namespace:
    name: str
    version: str
    kpis: dict[str, Kpi]
    order: list[str]
    protocols: dict[str, str]
    mappings: dict[str, dict[str, Mapping]]


def _spelt(where: str, content: dict, keys: dict[str, str | None]) -> dict:
    """``content`` under our keys; a key that is not known, or given in both spellings, is an error."""
    ours = {other or key: key for key, other in keys.items()} | {key: key for key in keys}
    out = {}
    for key, value in content.items():
        if key not in ours:
            raise RegistryError(f"{where}: unknown key {key!r}")
        if ours[key] in out:
            raise RegistryError(f"{where}: {ours[key]!r} is given twice")
        out[ours[key]] = value
    return out


def _extraction(rules: dict | list) -> dict[str, int]:
    """Label to number of its segment; a list has an item with ``segment`` and ``label`` for each."""
    return {r["label"]: r["segment"] for r in rules} if isinstance(rules, list) else rules


def _namespace(content: dict) -> Namespace:
    name = content.get("namespace")
    if not name:
        raise RegistryError("a registry file without namespace")
    content = _spelt(name, content, TOP)
    if "vendors" not in content:
        raise RegistryError(f"{name}: no mappings")
    kpis = {}
    for k in content["kpis"]:
        if not k.get("spec_ref"):
            raise RegistryError(f"{name}/{k['name']}: no spec_ref")
        if ("formula" in k) != bool(k.get("depends_on")) or k.get("derived") and "formula" not in k:
            raise RegistryError(f"{name}/{k['name']}: a derived KPI needs formula and depends_on")
        kpis[k["name"]] = Kpi(k["name"], k.get("unit", ""), k["spec_ref"], k.get("formula"), tuple(k.get("depends_on", ())))
    for k in kpis.values():
        for d in k.depends_on:
            if d not in kpis:
                raise RegistryError(f"{name}/{k.name}: depends on unknown {d}")
    protocols, mappings = {}, {}
    for vendor, v in (content["vendors"] or {}).items():
        v = _spelt(f"{name}/{vendor}", v, VENDOR)
        protocols[vendor] = v["protocol"]
        mappings[vendor] = {
            kpi: Mapping(
                m["template"] if paths.literal(m.get("template")) else m.get("metric") or m.get("path") or m.get("template", ""),
                m["type"],
                m.get("reset_aware", False),
                m.get("strategy", "exact"),
                m.get("labels", {}),
                m.get("template"),
                m.get("transform"),
                _extraction(m.get("extract", {})),
            )
            for kpi, given in v["metrics"].items()
            for m in [_spelt(f"{name}/{vendor}/{kpi}", given, MAPPING)]
        }
    return Namespace(name, content.get("version", ""), kpis, _ordered(name, kpis), protocols, mappings)


def _ordered(namespace: str, kpis: dict[str, Kpi]) -> list[str]:
    """Dependencies before dependents, else in the file's order; a cycle is an error that names its path."""
    out: dict[str, None] = {}

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise RegistryError(f"{namespace}: circular dependency {' -> '.join((*path[path.index(name):], name))}")
        if name not in out:
            for d in kpis[name].depends_on:
                visit(d, (*path, name))
            out[name] = None

    for k in kpis:
        visit(k, ())
    return list(out)


class Registry:
    """All namespaces, by name with the prefix."""

    def __init__(self, namespaces: Iterable[Namespace], prefix: str = "ran."):
        self.prefix = prefix
        self.namespaces = {prefix + n.name: n for n in namespaces}

    @staticmethod
    def load(directory: str | Path = SHIPPED, prefix: str = "ran.") -> Registry:
        """Every ``*.yaml`` of a directory; of one namespace the last file counts, and no file is an error.

        Namespaces may be written out with their prefix (``net.core.amf``); all
        files then have the same one, and it takes the place of ``prefix``.
        """
        files = sorted(Path(directory).glob("*.yaml"))
        if not files:
            raise RegistryError(f"no registry files in {directory}")
        found = [_namespace(yaml.safe_load(f.read_text()) or {}) for f in files]
        prefixes = {n.name[: n.name.rfind(".") + 1] for n in found}
        if len(prefixes) > 1:
            raise RegistryError(f"namespaces with different prefixes: {sorted(prefixes)}")
        own = prefixes.pop()
        for n in found:
            n.name = n.name.removeprefix(own)
        return Registry(found, own or prefix)

    def kpi(self, namespace: str, name: str) -> Kpi | None:
        n = self.namespaces.get(namespace)
        return n.kpis.get(name) if n else None

    def mapping(self, namespace: str, vendor: str, name: str) -> Mapping | None:
        n = self.namespaces.get(namespace)
        return n.mappings.get(vendor, {}).get(name) if n else None

    def evaluation_order(self, namespace: str) -> list[str] | None:
        n = self.namespaces.get(namespace)
        return list(n.order) if n else None

    def names(self) -> list[str]:
        return sorted(self.namespaces)

    def formulas(self) -> list[tuple[str, Kpi, formula.Node]]:
        """(namespace, KPI, tree) of every derived KPI, in an order that respects dependencies."""
        return [(ns, n.kpis[k], formula.parse(n.kpis[k].formula)) for ns, n in self.namespaces.items() for k in n.order if n.kpis[k].derived]

    def kpi_dim(self, spark: SparkSession) -> DataFrame:
        rows = [
            (ns, n.version, i, k, n.kpis[k].unit, n.kpis[k].spec_ref, n.kpis[k].derived, n.kpis[k].formula, list(n.kpis[k].depends_on))
            for ns, n in self.namespaces.items()
            for i, k in enumerate(n.order)
        ]
        return spark.createDataFrame(
            rows,
            "namespace string, version string, ord int, kpi string, unit string, spec_ref string, derived boolean, formula string, depends_on array<string>",
        )

    def mapping_dim(self, spark: SparkSession) -> DataFrame:
        rows = [
            (ns, v, n.protocols[v], k, m.metric, m.kind, m.reset_aware, "exact" if paths.literal(m.template) else m.strategy, m.labels, [s for s, _ in t] if t else None, [x for _, x in t] if t else None, m.transform, m.extract)
            for ns, n in self.namespaces.items()
            for v, ms in n.mappings.items()
            for k, m in ms.items()
            for t in [paths.template_segments(m.template) if m.template and not paths.literal(m.template) else None]
        ]
        return spark.createDataFrame(
            rows,
            "namespace string, vendor string, protocol string, kpi string, metric string, kind string, reset_aware boolean,"
            " strategy string, labels map<string,string>, template array<string>, captures array<string>, transform string, extract map<string,int>",
        )
