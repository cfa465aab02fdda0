"""Metric paths and source templates: segments, wildcards and captures."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_VARIABLE = re.compile(r"\{\{\s*\.(\w+)\s*\}\}")


def variables(template: str) -> list[str]:
    """All variable names of a template, in order."""
    return _VARIABLE.findall(template)


def split_path(path: str) -> list[str]:
    """Segments at ``/``, or at ``:`` where there is no ``/``; empty ones left out."""
    sep = ":" if ":" in path and "/" not in path else "/"
    return [s for s in path.split(sep) if s]


def template_segments(template: str) -> list[tuple[str | None, str | None]]:
    """(literal, variable) of each segment; a segment with a variable matches anything."""
    out = []
    for s in split_path(template):
        found = _VARIABLE.findall(s)
        out.append((None, found[0]) if found else (s, None))
    return out


def literal(template: str | None) -> bool:
    """Whether a template has no variables: a path then meets it only by equality, as it is spelt."""
    return template is not None and not variables(template)


def expand(template: str, values: dict[str, str]) -> str:
    """The template with its variables filled in; a missing one is an error."""
    missing = [v for v in variables(template) if v not in values]
    if missing:
        raise KeyError(f"no value for {missing[0]}")
    return _VARIABLE.sub(lambda m: values[m[1]], template)


def segments(path: Column) -> Column:
    """``split_path`` as a column."""
    sep = F.when(F.contains(path, F.lit("/")) | ~F.contains(path, F.lit(":")), F.lit("/")).otherwise(F.lit(":"))
    return F.filter(F.split(path, sep), lambda s: s != "")


def extraction_segments(path: Column) -> Column:
    """Segments for label extraction: at ``/``, else ``:``, else ``_``; only ``_`` keeps empty ones."""
    by = lambda sep: F.split(path, sep)
    return (
        F.when(F.contains(path, F.lit("/")), F.filter(by("/"), lambda s: s != ""))
        .when(F.contains(path, F.lit(":")), F.filter(by(":"), lambda s: s != ""))
        .otherwise(by("_"))
    )


def matches(template: Column, path: Column) -> Column:
    """Whether a path's segments meet a template given as an array of literals with nulls for wildcards.

    For templates with a variable; a ``literal`` one is compared as a whole.
    """
    s = segments(path)
    same = F.forall(F.zip_with(template, s, lambda t, x: t.isNull() | (t == x)), lambda ok: F.coalesce(ok, F.lit(False)))
    return (F.size(template) == F.size(s)) & same


def superset(labels: Column, required: Column) -> Column:
    """Whether ``labels`` hold every required pair; a missing label reads as empty."""
    held = F.coalesce(labels, F.create_map().cast("map<string,string>"))
    return F.forall(F.map_entries(required), lambda e: F.coalesce(F.try_element_at(held, e["key"]), F.lit("")) == e["value"])


def merged_maps(*maps: Column) -> Column:
    """Maps laid over each other, later ones winning."""
    out, *rest = maps
    for over in rest:
        under = out
        out = F.map_concat(F.map_filter(under, _absent_from(over)), over)
    return out


def _absent_from(over: Column):
    return lambda k, _: ~F.array_contains(F.map_keys(over), k)
