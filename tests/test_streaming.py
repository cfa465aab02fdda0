"""Streams give what batches give."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import sinks
from kpiloom.operators.counters import with_deltas
from kpiloom.plans import catalog
from kpiloom.streaming.counters import Deltas, stream_deltas

SCHEMA = "source string, kpi string, ts timestamp, seq long, value double"


def write(spark, path, rows):
    spark.createDataFrame(rows, "source string, kpi string, s long, seq long, value double").select("source", "kpi", F.timestamp_seconds(F.col("s") + 1_000_000).alias("ts"), "seq", "value").coalesce(1).write.mode("append").parquet(path)


def run(spark, path, out, checkpoint, **options):
    stream = stream_deltas(spark.readStream.schema(SCHEMA).parquet(path), **options)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def deltas(df):
    return {(r.source, r.seq): (r.delta, r.reset) for r in df.where("source <> 'flush' AND NOT late").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_deltas_equal_the_batch_in_any_order_of_arrival(spark, tmp_path, seed):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "cp"))
    rng = random.Random(seed)
    rows = [("ab"[i % 2], "k", 5 * i, i, float(rng.choice([100, 110, 120, 130, 5]) + i)) for i in range(24)]
    arrival = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 30))
    for part in (arrival[:9], arrival[9:16], arrival[16:]):
        write(spark, source, part)
        run(spark, source, out, checkpoint, delay="40 seconds", ttl_seconds=60)
    write(spark, source, [("flush", "k", 10_000, 99, 0.0)])
    run(spark, source, out, checkpoint, delay="40 seconds", ttl_seconds=60)
    batch = with_deltas(spark.read.schema(SCHEMA).parquet(source), ["source", "kpi"], ["ts", "seq"], ttl_seconds=60)
    assert deltas(spark.read.parquet(out)) == deltas(batch)


def test_counter_state_survives_restarts_flags_late_samples_and_expires(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / p) for p in ("in", "out", "cp"))

    def states():
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load().count()

    for rows in ([("a", "k", 0, 1, 10.0), ("b", "k", 0, 2, 5.0), ("a", "k", 5, 3, 15.0)], [("b", "k", 30, 5, 9.0), ("a", "k", 30, 6, 3.0)]):
        write(spark, source, rows)
        run(spark, source, out, checkpoint, delay="10 seconds", grace="1 hour", ttl_seconds=100)
    write(spark, source, [("a", "k", 4, 4, 12.0)])  # after the one at 5 s was released
    run(spark, source, out, checkpoint, delay="10 seconds", grace="1 hour", ttl_seconds=100)
    assert states() == 2
    write(spark, source, [("c", "k", 60, 7, 1.0)])
    run(spark, source, out, checkpoint, delay="10 seconds", grace="1 hour", ttl_seconds=100)
    got = {(r.source, r.seq): (r.delta, r.reset, r.late) for r in spark.read.parquet(out).collect()}
    assert got["a", 1] == (10.0, False, False) and got["a", 3] == (5.0, False, False) and got["a", 6] == (3.0, True, False)
    assert got["b", 5] == (4.0, False, False) and got["a", 4] == (None, False, True)
    for at in (10_000, 20_000):
        write(spark, source, [("d", "k", at, at, 1.0)])
        run(spark, source, out, checkpoint, delay="10 seconds", grace="1 hour", ttl_seconds=100)
    assert states() == 1  # a, b and c have long been silent


class Counted:
    """A list state, or the handle of a group, that counts its calls."""

    def __init__(self):
        self.values, self.calls, self.states = [], 0, {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, Counted())

    def _call(self, values=None):
        self.calls += 1
        if values is not None:
            self.values = list(values)

    def registerTimer(self, at):
        self._call()

    def exists(self):
        self._call()
        return bool(self.values)

    def get(self):
        self._call()
        return iter(self.values)

    def put(self, values):
        self._call(values)

    def appendList(self, values):
        self._call(self.values + values)

    def clear(self):
        self._call([])


def test_calls_of_state_do_not_follow_the_sources():
    handle, processor = Counted(), Deltas(delay="10 seconds", ttl_seconds=60)
    processor.init(handle)
    sources, seq = [f"s{i % 500}" for i in range(2000)], list(range(2000))
    rng = random.Random(4)
    rng.shuffle(seq)
    batch = pd.DataFrame({"source": [sources[i] for i in seq], "kpi": "k", "ts": pd.to_datetime([i // 500 for i in seq], unit="s"), "seq": seq, "value": [float(i) for i in seq]})
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 3_000)
    assert list(processor.handleInputRows((1,), iter([batch[:900], batch[900:]]), clock)) == []
    out = pd.concat(processor.handleExpiredTimer((1,), clock, None))
    assert len(out) == 2000 and (out.delta[out.seq >= 500] == 500).all() and (out.delta[out.seq < 500] == out.value[out.seq < 500]).all()
    late = pd.concat(processor.handleInputRows((1,), iter([batch[:2].assign(seq=-1, ts=pd.to_datetime([0, 0], unit="s"))]), clock))
    assert list(late.late) == [True, True]
    assert len(handle.states["last"].values) == 500
    assert handle.calls + sum(s.calls for s in handle.states.values()) < 20
    list(processor.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: 63_000), None))
    assert handle.states["last"].values == []


def test_windows_of_a_stream_are_all_given(spark):
    sf = "/root/testdata/sf0.001"
    e = spark.read.parquet(f"{sf}/events.parquet")
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)
    held = e.select((F.col("user_id") % 2).alias("p"), F.explode(F.sequence(hour - 23, hour)).alias("w"), "event_type")
    want = held.groupBy("p", "w").agg(F.count_if(F.col("event_type") == "signup").alias("n")).collect()
    got = catalog.stream_sliding_rules(spark, sf).collect()
    assert sorted((r.plmn, r.w, r.att_n) for r in got) == sorted((("310-260", "311-480")[r.p], r.w, r.n) for r in want)


def test_fan_out_goes_on_after_an_error(spark):
    seen, errors = [], []

    def broken(batch, _):
        raise RuntimeError("down")

    write = sinks.fan_out([broken, lambda b, i: seen.append((b.count(), i))], lambda name, e: errors.append((name, str(e))))
    write(spark.range(3).toDF("x"), 7)
    assert seen == [(3, 7)] and errors == [("broken", "down")]
