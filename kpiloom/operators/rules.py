"""Anomaly rules from YAML files: conditions and evidence in the formula language over window statistics.

A file names series (a KPI of a namespace) and rules.  A rule's ``when`` is one
condition or a list, all of which must hold; a name in it is ``series.statistic``.
The statistics that windows compute follow from the rules' series, so a rule on
another KPI is another file and no other code.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions import formula

SHIPPED = Path(__file__).parent.parent / "rules" / "shipped.yaml"
#: What windows know of a series.
STATISTICS = ("n", "mean", "sigma", "peak", "last")


class RuleError(ValueError):
    """A rule file that cannot be run."""


def _statistic(name: str) -> Column:
    return F.col(name.replace(".", "_")).cast("double")


@dataclass(frozen=True)
class Rule:
    """A condition over a window's statistics, with what it reports."""

    name: str
    severity: str
    affected: tuple[str, ...]
    when: tuple[formula.Node, ...]
    reports: tuple[tuple[str, formula.Node], ...]

    def condition(self) -> Column:
        """Whether every part holds; one that has no value (an empty series, a division by zero) does not."""
        held = F.lit(True)
        for part in self.when:
            value = formula.to_column(part, _statistic)
            held = held & (value != 0) & ~F.isnan(value)
        return F.coalesce(held, F.lit(False))

    def evidence(self) -> dict[str, Column]:
        return {k: formula.to_column(v, _statistic) for k, v in self.reports}

    def series(self) -> set[str]:
        return {n.split(".")[0] for tree in (*self.when, *(v for _, v in self.reports)) for n in formula.names(tree)}


@dataclass(frozen=True)
class Rules:
    """Rules, and the (namespace, KPI) of each series that they read."""

    rules: tuple[Rule, ...]
    series: dict[str, tuple[str, str]]

    @staticmethod
    def load(*paths: str | Path) -> Rules:
        """The rules of all files together; a rule or series that two files define differently is an error."""
        rules: dict[str, Rule] = {}
        series: dict[str, tuple[str, str]] = {}
        for path in paths or (SHIPPED,):
            try:
                content = yaml.safe_load(Path(path).read_text()) or {}
                own = {k: (v["namespace"], v["kpi"]) for k, v in (content.get("series") or {}).items()}
                found = [_rule(r, own) for r in content.get("rules") or []]
            except (yaml.YAMLError, KeyError, TypeError, AttributeError, formula.FormulaError) as e:
                raise RuleError(f"{path}: {e!r}") from e
            if not found:
                raise RuleError(f"{path}: no rules")
            for r in found:
                if r.name in rules:
                    raise RuleError(f"{path}: rule {r.name} is there already")
                rules[r.name] = r
                for s in sorted(r.series()):
                    if series.setdefault(s, own[s]) != own[s]:
                        raise RuleError(f"{path}: series {s} is {series[s]} in another file")
        return Rules(tuple(rules.values()), series)


def _rule(content: dict, series: Iterable[str]) -> Rule:
    when = content["when"] if isinstance(content["when"], list) else [content["when"]]
    evidence = content.get("evidence") or {}
    rule = Rule(
        content["name"], content.get("severity", "warning"), tuple(content.get("affected") or ()),
        tuple(formula.parse(str(w)) for w in when), tuple((k, formula.parse(str(v))) for k, v in evidence.items()),
    )
    for tree in (*rule.when, *(v for _, v in rule.reports)):
        for name in sorted(formula.names(tree)):
            of, _, statistic = name.partition(".")
            if of not in series or statistic not in STATISTICS:
                raise RuleError(f"{rule.name}: {name} is no statistic of a series")
    if not rule.when or not rule.series():
        raise RuleError(f"{rule.name}: no condition")
    return rule
