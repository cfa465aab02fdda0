"""Samples of a stream in order of time, whatever order they arrive in.

A sample is held in state until event time has passed it by the allowed delay,
then released in order by a timer.  One that arrives after a later one of its
source was released is late: it is flagged and changes nothing.  Past ``grace``
more, Spark drops it and counts it in the query's progress.

A source that sent nothing for ``ttl_seconds`` of event time is forgotten: the
next sample would count as its first anyway, so its state is removed by a timer.

Sources are dealt into groups by hash, and a group's samples are held as chunks
of columns: each call of state and each timer costs far more than a sample, so
their number must not follow that of the sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups of sources.  As the number of state partitions, a checkpoint keeps the one it began with.
GROUPS = 4096
#: Rows at most in a piece of output.
PIECE = 10_000


def milliseconds(interval: str) -> int:
    return pd.Timedelta(interval) // pd.Timedelta("1ms")


def total(*intervals: str) -> str:
    """The sum of lengths of time, as Spark writes them."""
    return f"{sum(map(milliseconds, intervals))} milliseconds"


class InOrder(StatefulProcessor):
    """Calls ``step`` for a source's samples in order of (time, number).

    ``sources`` are the columns that name a source, ``at`` and ``number`` the two
    of the order; ``payload`` are the columns that are kept with a sample, in
    chunks of ``chunk`` rows at most, and ``kept`` those that the state of a
    source has.
    """

    at, number = "ts", "seq"
    sources: dict[str, str] = {}
    payload: dict[str, str] = {}
    kept: dict[str, str] = {}
    chunk = 1000

    def __init__(self, delay: str = "10 seconds", grace: str = "0 seconds", ttl_seconds: float | None = None):
        self.wait, self.ttl_ms = milliseconds(grace), None if ttl_seconds is None else int(ttl_seconds * 1000)

    def step(self, before: tuple | None, sample: tuple) -> tuple[tuple, tuple]:
        """(what the source keeps, output columns) for a ``sample`` after what was kept ``before`` (None: nothing)."""
        raise NotImplementedError

    def missed(self, sample: tuple) -> tuple:
        """Output columns for a late sample."""
        raise NotImplementedError

    def rows(self, keys: list[tuple], samples: list[tuple], found: list[tuple]) -> pd.DataFrame:
        """The output of samples (time in microseconds, number, payload) of the sources ``keys``."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", ", ".join(f"{k} {t}" for k, t in {**self.sources, "at": "long", "number": "long", **self.kept}.items()))
        self.held = handle.getListState("held", ", ".join(f"{k} array<{t}>" for k, t in {**self.sources, "at": "long", "number": "long", **self.payload}.items()))

    def _due(self, at: int) -> int:
        """The watermark, in milliseconds, from which a sample of this time is released."""
        return max(1, -(-at // 1000) - self.wait)

    def _lasts(self) -> dict[tuple, tuple]:
        """What each source of the group keeps, with the time and number of its last sample."""
        n = len(self.sources)
        return {tuple(s[:n]): tuple(s[n:]) for s in self.last.get()} if self.last.exists() else {}

    def _chunks(self, keys: list[tuple], samples: list[tuple]) -> list[tuple]:
        n = range(0, len(samples), self.chunk)
        return [tuple(map(list, zip(*(k + s for k, s in zip(keys[i : i + self.chunk], samples[i : i + self.chunk], strict=True)), strict=True))) for i in n]

    def _pieces(self, keys: list[tuple], samples: list[tuple], found: list[tuple]) -> Iterator[pd.DataFrame]:
        for i in range(0, len(samples), PIECE):
            yield self.rows(keys[i : i + PIECE], samples[i : i + PIECE], found[i : i + PIECE])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lasts = self._lasts()
        first = None
        for b in rows:
            at = b[self.at].to_numpy(dtype="datetime64[us]").astype(np.int64).tolist()
            keys = list(zip(*[[None if pd.isna(x) else x for x in b[c].tolist()] for c in self.sources], strict=True))
            values = [[x.tolist() if isinstance(x, np.ndarray) else x for x in b[c]] for c in self.payload]
            samples = list(zip(at, b[self.number].tolist(), *values, strict=True))
            late = [k in lasts and s[:2] <= lasts[k][:2] for k, s in zip(keys, samples, strict=True)]
            if any(late):
                missed = [s for s, x in zip(samples, late, strict=True) if x]
                yield self.rows([k for k, x in zip(keys, late, strict=True) if x], missed, [self.missed(s) for s in missed])
                keys, samples = ([v for v, x in zip(c, late, strict=True) if not x] for c in (keys, samples))
            if samples:
                self.held.appendList(self._chunks(keys, samples))
                least = min(s[0] for s in samples)
                first = least if first is None else min(first, least)
        if first is not None:
            self.handle.registerTimer(self._due(first))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        n = len(self.sources)
        held = [s for chunk in self.held.get() for s in zip(*chunk, strict=True)] if self.held.exists() else []
        held.sort(key=lambda s: s[n : n + 2])
        ready = sum(self._due(s[n]) <= now for s in held)  # the first so many
        lasts = self._lasts()
        known = len(lasts)
        if ready:
            keys, samples, out = [s[:n] for s in held[:ready]], [s[n:] for s in held[:ready]], []
            for k, s in zip(keys, samples, strict=True):
                last = lasts.get(k)
                before = None if last is None or self.ttl_ms is not None and s[0] - last[0] >= 1000 * self.ttl_ms else last
                kept, found = self.step(before and before[2:], s)
                lasts[k] = (*s[:2], *kept)
                out.append(found)
            rest = held[ready:]
            if rest:
                self.held.put(self._chunks([s[:n] for s in rest], [s[n:] for s in rest]))
                self.handle.registerTimer(self._due(rest[0][n]))
            else:
                self.held.clear()
            yield from self._pieces(keys, samples, out)
        if self.ttl_ms is not None:
            waiting = {s[:n] for s in held[ready:]}
            lasts = {k: v for k, v in lasts.items() if k in waiting or self._due(v[0]) + self.ttl_ms > now}
            ends = [self._due(v[0]) + self.ttl_ms for k, v in lasts.items() if k not in waiting]
            if ends:
                self.handle.registerTimer(min(ends))
        if lasts and (ready or len(lasts) < known):
            self.last.put([k + v for k, v in lasts.items()])
        elif known and not lasts:
            self.last.clear()

    def close(self) -> None:
        pass


def in_order(samples: DataFrame, processor: InOrder, output: str) -> DataFrame:
    """What ``processor`` gives for ``samples``, which have a watermark, as columns ``output``."""
    grouped = samples.withColumn("group_of_sources", F.pmod(F.xxhash64(*processor.sources), F.lit(GROUPS)))
    return grouped.groupBy("group_of_sources").transformWithStateInPandas(statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime")
