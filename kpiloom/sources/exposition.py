"""Prometheus exposition text to series, an Arrow batch of payloads at a time, and back."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.schema import SERIES

_LINE = re.compile(r"([A-Za-z_:][A-Za-z0-9_:]*)\s*(\{.*\})?\s+(\S+)(?:\s+-?\d+)?\s*", re.ASCII)
_LABEL = re.compile(r'([A-Za-z_][A-Za-z0-9_]*)\s*=\s*"((?:[^"\\]|\\.)*)"', re.ASCII)
_TYPE = re.compile(r"#\s*TYPE\s+(\S+)\s+(\S+)", re.ASCII)
_ESCAPE = re.compile(r'\\([\\n"])')
_NUMBER = re.compile(r"[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|inf|infinity|nan)", re.IGNORECASE | re.ASCII)
_FAMILY = re.compile("_(?:sum|count|bucket)$")
SAMPLE = pa.struct([("seq", pa.int32()), ("name", pa.string()), ("labels", pa.map_(pa.string(), pa.string())), ("value", pa.float64()), ("type", pa.string())])
_ARROW = pa.struct([("series", pa.list_(SAMPLE)), ("error", pa.string())])


def read(text: str) -> tuple[list[tuple], str | None]:
    """The samples that are kept, (seq, name, labels, value, type) each, and why the text cannot be read.

    One pass over the lines and one over the samples.  A text is unreadable if
    it has lines other than comments, and none of them is a sample.
    """
    types: dict[str, str] = {}
    found, other = [], None
    for line in re.split("\r?\n", text):
        if line.startswith("#"):
            if head := _TYPE.match(line):
                types.setdefault(head[1], head[2].lower())
        elif sample := _LINE.fullmatch(line):
            found.append(sample.groups())
        elif line.strip():
            other = other or line
    if other and not found:
        return [], f"no sample in the payload: {other[:80]}"
    out = []
    for seq, (name, block, value) in enumerate(found):
        own, family = types.get(name), _FAMILY.sub("", name)
        of_family = types.get(family) if family != name else None
        grouped = of_family in ("histogram", "summary")
        if not _NUMBER.fullmatch(value) or own == "summary" or grouped and name.endswith("_bucket"):
            continue
        unescape = lambda m: "\n" if m[1] == "n" else m[1]
        labels = {k: _ESCAPE.sub(unescape, v) for k, v in _LABEL.findall(block)} if block else None
        out.append((seq, name, labels and list(labels.items()) or (None if labels is None else []), float(value), of_family if grouped else own or "untyped"))
    return out, None


def samples(text: str) -> list[tuple]:
    """The samples of ``read``."""
    return read(text)[0]


def _parsed(payloads: pa.Array) -> pa.Array:
    found = [read(p.decode("utf-8", "replace") if p else "") for p in payloads.to_pylist()]
    names = ("seq", "name", "labels", "value", "type")
    return pa.array([{"series": [dict(zip(names, s, strict=True)) for s in kept], "error": error} for kept, error in found], type=_ARROW)


def parsed(payload: Column) -> Column:
    """``series`` of a payload, and ``error`` where it cannot be read: a struct."""
    return F.arrow_udf(_parsed, f"series {SERIES}, error string")(payload.cast("binary"))


def series(payload: Column) -> Column:
    """An array of (seq, name, labels, value, type) in the order of the text.

    Counters, gauges and untyped metrics give a row a line; of histograms and
    summaries only ``_sum`` and ``_count`` are kept.  Lines that are no samples
    are skipped.  Time is linear in the text's length.
    """
    return parsed(payload)["series"]


def general(value: Column) -> Column:
    """A double's shortest decimal in ``%g`` notation: an exponent below -4 or from 6 on is written out."""
    text = F.abs(value.cast("double")).cast("string")
    mantissa, power = F.substring_index(text, "E", 1), F.when(F.contains(text, F.lit("E")), F.substring_index(text, "E", -1).cast("int")).otherwise(0)
    whole = F.substring_index(mantissa, ".", 1)
    every = F.concat(whole, F.substring_index(mantissa, ".", -1))
    digits = F.regexp_replace(every, "^0+|0+$", "")
    first = F.length(every) - F.length(F.regexp_replace(every, "^0+", ""))
    e = F.length(whole) - 1 - first + power
    rest = F.substr(digits, F.lit(2))
    written = F.concat(
        F.left(digits, F.lit(1)), F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""),
        F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"),
    )
    long = F.concat(digits, F.repeat(F.lit("0"), F.greatest(e + 1 - F.length(digits), F.lit(0))))
    fraction = F.substr(long, e + 2)
    plain = F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)).otherwise(
        F.concat(F.left(long, e + 1), F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))
    )
    sign = F.when(value < 0, "-").otherwise("")
    number = F.when(digits == "", "0").otherwise(F.when((e < -4) | (e >= 6), written).otherwise(plain))
    return F.when(F.isnan(value.cast("double")), "NaN").when(text == "Infinity", F.when(value < 0, "-Inf").otherwise("+Inf")).otherwise(F.concat(sign, number))


def sanitised(name: Column) -> Column:
    return F.replace(name, F.lit("."), F.lit("_"))


def rendered(name: Column, labels: Column, value: Column) -> Column:
    """One exposition line; labels in order of name, escaped."""
    escape = lambda v: F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit('="'), escape(e["value"]), F.lit('"')))
    block = F.when(F.size(labels) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    return F.concat(name, block, F.lit(" "), general(value))
