"""Which series of a scrape each base KPI reads: one pass over the series, probing an index of the registry.

Names are found by hash; templates in a trie by the number of their segments,
then a segment at a time.  Time is linear in the number of series plus that of
mappings, whatever both are.  The index is as large as the YAML files.
"""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions import paths
from kpiloom.registry import Registry
from kpiloom.schema import SERIES
from kpiloom.sources import exposition, gnmi

_HITS = pa.struct([("hits", pa.list_(pa.list_(exposition.SAMPLE))), ("error", pa.string())])
_END = 0  # key of a trie node's positions; other keys are segments, or None for any


class VendorIndex:
    """A vendor's mappings in one namespace; a position is that of the base KPI in order of evaluation."""

    def __init__(self, mappings: list):
        self.size = len(mappings)
        self.by_name: dict[str, list[tuple[int, list[tuple[str, str]]]]] = {}
        self.tries: dict[int, dict] = {}
        for at, m in enumerate(mappings):
            if m is None:
                continue
            if m.template and not paths.literal(m.template):
                segments = [s for s, _ in paths.template_segments(m.template)]
                node = self.tries.setdefault(len(segments), {})
                for s in segments:
                    node = node.setdefault(s, {})
                node.setdefault(_END, []).append(at)
            else:
                self.by_name.setdefault(m.metric, []).append((at, list(m.labels.items())))

    def by_template(self, name: str) -> list[int]:
        """The positions whose template a name meets."""
        if not self.tries:
            return []
        segments = paths.split_path(name)
        nodes = [self.tries[len(segments)]] if len(segments) in self.tries else []
        for s in segments:
            nodes = [n[k] for n in nodes for k in (s, None) if k in n]
        return [at for n in nodes for at in n.get(_END, ())]

    def hits(self, series: list[tuple]) -> list[list[tuple]]:
        """For each position its series, (seq, name, labels, value, type), in order; labels are pairs or none."""
        found: list[list[tuple]] = [[] for _ in range(self.size)]
        for s in series:
            named = self.by_name.get(s[1])
            if named:
                held = dict(s[2] or ())
                for at, required in named:
                    if all(held.get(k, "") == v for k, v in required):
                        found[at].append(s)
            for at in self.by_template(s[1]):
                found[at].append(s)
        return found


def build(registry: Registry) -> dict[tuple[str, str], VendorIndex]:
    """The index of each (namespace, vendor)."""
    base = {ns: [k for k in n.order if not n.kpis[k].derived] for ns, n in registry.namespaces.items()}
    return {(ns, v): VendorIndex([ms.get(k) for k in base[ns]]) for ns, n in registry.namespaces.items() for v, ms in n.mappings.items()}


def _decoded(protocol: str, payload: bytes | None) -> tuple[list[tuple], str | None]:
    if protocol == "prometheus":
        return exposition.read(payload.decode("utf-8", "replace") if payload else "")
    try:
        return [(seq, name, labels and list(labels.items()), value, kind) for seq, name, labels, value, kind in gnmi.decode(payload or b"")], None
    except (ValueError, struct.error) as e:
        return [], f"gnmi: {e}"


def hits(registry: Registry, namespace: Column, vendor: Column, protocol: Column, payload: Column) -> Column:
    """A struct of ``hits``, for each base KPI in order the series that it reads, and ``error`` of a malformed payload.

    An unknown namespace or vendor, and a protocol other than ``prometheus`` and
    ``gnmi``, give null.  Not deterministic for the optimiser, so that a filter on
    the error does not decode every payload a second time.
    """
    index = build(registry)
    names = ("seq", "name", "labels", "value", "type")

    def probe(namespaces: pa.Array, vendors: pa.Array, protocols: pa.Array, payloads: pa.Array) -> pa.Array:
        out = []
        for ns, v, protocol, payload in zip(*(a.to_pylist() for a in (namespaces, vendors, protocols, payloads)), strict=True):
            if (ns, v) not in index or protocol not in ("prometheus", "gnmi"):
                out.append(None)
                continue
            series, error = _decoded(protocol, payload)
            found = [] if error else index[ns, v].hits(series)
            out.append({"hits": [[dict(zip(names, s, strict=True)) for s in each] for each in found], "error": error})
        return pa.array(out, type=_HITS)

    return F.arrow_udf(probe, f"hits array<{SERIES}>, error string").asNondeterministic()(namespace, vendor, protocol, payload.cast("binary"))
