"""Transforms over a series: ``identity``, ``delta``, ``rate(30s)``, ``ratio(a,b)``."""

from __future__ import annotations

import re

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}
_RATIO = re.compile(r"ratio\(\s*(\d+)\s*,\s*(\d+)\s*\)")
_DURATION = re.compile(r"(\d+\.?\d*|\.\d+)(ns|us|µs|ms|s|m|h)")


def seconds(text: str) -> float:
    """A duration such as ``1h2m3.5s`` in seconds."""
    parts = _DURATION.findall(text)
    if not parts or "".join(a + b for a, b in parts) != text.strip():
        raise ValueError(f"no duration: {text!r}")
    return sum(float(a) * _UNITS[b] for a, b in parts)


def compile_transform(text: str | None, value: Column, partition: list[Column], order: list[Column]) -> Column:
    """The transform as a column over the series that ``partition`` and ``order`` give.

    ``delta`` and ``rate`` take the first sample as it is; ``rate`` divides by
    the duration written, not by the time that passed; ``ratio`` is null where
    ``failure`` has a reason.
    """
    name = (text or "identity").strip()
    window = Window.partitionBy(*partition).orderBy(*order)
    before = F.lag(value).over(window)
    if name == "identity":
        return value
    if name == "delta":
        return value - F.coalesce(before, F.lit(0.0))
    if m := re.fullmatch(r"rate\((.+)\)", name):
        return F.when(before.isNull(), value).otherwise((value - before) / F.lit(seconds(m[1])))
    if m := _RATIO.fullmatch(name):
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        a, b = (F.nth_value(value, int(i) + 1).over(whole) for i in m.groups())
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    raise ValueError(f"unknown transform: {text!r}")


def failure(text: str | None, partition: list[Column]) -> Column:
    """Why a transform has no value over a series: an index of ``ratio`` beyond its samples; null where it has one."""
    if not (m := _RATIO.fullmatch((text or "").strip())):
        return F.lit(None).cast("string")
    n = F.count(F.lit(1)).over(Window.partitionBy(*partition))
    return F.when(n <= max(map(int, m.groups())), F.concat(F.lit(f"index of ratio({m[1]},{m[2]}) out of range for "), n.cast("string"), F.lit(" values")))
