"""Counter deltas on streams: the last value of each source and KPI is keyed state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

from kpiloom.streaming.ordering import InOrder, in_order, total

OUTPUT = "source string, kpi string, ts timestamp, seq long, value double, delta double, reset boolean, late boolean"


class Deltas(InOrder):
    """First sample as it is, then differences; a decrease starts anew if ``reset_aware``, a gap of ``ttl_seconds`` of event time always."""

    sources = {"source": "string", "kpi": "string"}
    payload, kept = {"value": "double"}, {"value": "double"}

    def __init__(self, reset_aware: bool = True, delay: str = "10 seconds", grace: str = "0 seconds", ttl_seconds: float | None = None):
        super().__init__(delay, grace, ttl_seconds)
        self.reset_aware = reset_aware

    def step(self, before, sample):
        value = sample[2]
        if before is None:
            return (value,), (value, False, False)
        reset = value < before[0]
        return (value,), (value if reset and self.reset_aware else value - before[0], reset, False)

    def missed(self, sample):
        return None, False, True

    def rows(self, keys, samples, found):
        ts = pd.to_datetime(pd.Series([s[0] for s in samples]), unit="us")
        out = pd.DataFrame({"source": [k[0] for k in keys], "kpi": [k[1] for k in keys], "ts": ts, "seq": [s[1] for s in samples], "value": [s[2] for s in samples]})
        return out.assign(delta=pd.Series([f[0] for f in found], dtype=float), reset=[f[1] for f in found], late=[f[2] for f in found])


def stream_deltas(samples: DataFrame, reset_aware: bool = True, ttl_seconds: float | None = None, delay: str = "10 seconds", grace: str = "0 seconds") -> DataFrame:
    """``samples`` (source, kpi, ts, seq, value) with delta, reset and late; needs the RocksDB state store.

    What has arrived within ``delay`` of the newest time seen is put in order
    first.  A task holds the samples of one group of sources (``ordering.GROUPS``)
    of a micro-batch; bound these by the source's ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``.
    """
    return in_order(samples.withWatermark("ts", total(delay, grace)), Deltas(reset_aware, delay, grace, ttl_seconds), OUTPUT)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
