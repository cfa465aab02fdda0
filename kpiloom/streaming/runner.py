"""The pipeline as streams: sources, counter state, normalisation, windows with rules, sinks.

Every query hands over by Spark's file sink, whose log names the files of each
finished micro-batch: a batch that is run again after a crash is written once,
files of one that did not finish are not read, and streams that read the folder
take each file once.  One query keeps each source's last values as keyed state
and writes the outcomes of its scrapes; one writes what could not be read at
all; one takes the records through the sliding windows and rules to events.  Each
way out (``published``, ``exported``) is a query of its own over these folders,
with its own progress, so one that fails neither stops nor loses anything of the
others.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kpiloom.operators import correlate
from kpiloom.operators.normalize import SOURCE, completed, partial_of, prepared, records_of
from kpiloom.operators.rules import Rules
from kpiloom.registry import Registry
from kpiloom.schema import ATTRIBUTES, EVENT
from kpiloom.sources.scrape import to_bus
from kpiloom.streaming.counters import ROCKSDB
from kpiloom.streaming.ordering import InOrder, in_order, total

Writer = Callable[[DataFrame, int], None]
OUTCOMES = (
    "record_id long, namespace string, vendor string, nf_type string, instance_id string, kpi_name string, value double, unit string, timestamp timestamp,"
    f" attributes {ATTRIBUTES}, labels map<string,string>, spec_ref string, schema_version string, raw string, reason string, unsupported boolean, kind string"
)
FAILURES = "record_id long, namespace string, vendor string, nf_type string, instance_id string, timestamp timestamp, reason string"


class LastValues(InOrder):
    """Gives each scrape the values of its source's last one, in order of time."""

    at, number = "timestamp", "record_id"
    sources = dict.fromkeys(SOURCE, "string")
    chunk = 10  # a scrape is large
    payload, kept = {"counters": "array<double>", "rest": "string"}, {"found": "array<double>"}

    def step(self, before, sample):
        return ([float(x) for x in sample[2]],), (None if before is None else np.asarray(before[0], dtype=float), False)

    def missed(self, sample):
        return None, True

    def rows(self, keys, samples, found):
        times = pd.to_datetime(pd.Series([s[0] for s in samples]), unit="us")
        out = pd.DataFrame({**dict(zip(SOURCE, map(list, zip(*keys, strict=True)), strict=True)), "timestamp": times, "record_id": [s[1] for s in samples]})
        return out.assign(before=pd.Series([f[0] for f in found], dtype=object), late=[f[1] for f in found], rest=[s[3] for s in samples])


def with_last_values(good: DataFrame, ttl_seconds: float | None = None, delay: str = "10 seconds", grace: str = "1 minute") -> DataFrame:
    """``prepared`` scrapes of a stream with ``before`` and ``late``."""
    rest = T.StructType([f for f in good.schema if f.name not in (*SOURCE, "timestamp", "record_id")])
    # gauges may lack a value; what they had last is not used
    counters = F.transform("found", lambda x: F.coalesce(x, F.lit(0.0)))
    packed = good.select(*SOURCE, "timestamp", "record_id", counters.alias("counters"), F.to_json(F.struct(*rest.names)).alias("rest"))
    staged = in_order(
        packed.withWatermark("timestamp", total(delay, grace)), LastValues(delay, grace, ttl_seconds),
        "vendor string, nf_type string, instance_id string, timestamp timestamp, record_id long, before array<double>, late boolean, rest string",
    )
    return staged.withColumn("rest", F.from_json("rest", rest)).select(*SOURCE, "timestamp", "record_id", "before", "late", "rest.*")


def _made(spark: SparkSession, path: str) -> str:
    """``path``, made if it is missing: streams cannot read a folder before it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)
    return path


def _to_files(rows: DataFrame, path: str, name: str, trigger: dict, by: tuple[str, ...] = ()) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", _made(rows.sparkSession, f"{path}/{name}"))
    return writer.partitionBy(*by).option("checkpointLocation", f"{path}/checkpoints/{name}").trigger(**trigger).start()


def normalised(raw: DataFrame, registry: Registry, path: str, ttl_seconds: float | None = None, delay: str = "10 seconds", grace: str = "1 minute", trigger: dict | None = None) -> list[StreamingQuery]:
    """Starts the queries that write ``path``/outcomes (records, partial failures and late samples, by kind) and ``path``/failures."""
    raw.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    trigger = trigger or {"processingTime": "15 seconds"}
    good, failures = prepared(raw, registry)
    done = completed(with_last_values(good, ttl_seconds, delay, grace), registry, failures)
    return [_to_files(done.outcomes, path, "outcomes", trigger, ("kind",)), _to_files(failures, path, "failures", trigger)]


def outcomes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """What ``normalised`` has written under ``path``."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(OUTCOMES).parquet(_made(spark, f"{path}/outcomes"))


def records(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return records_of(outcomes(spark, path, streaming))


def partial(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return partial_of(outcomes(spark, path, streaming))


def events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """What ``correlated`` has written under ``path``."""
    return (spark.readStream if streaming else spark.read).schema(EVENT).parquet(_made(spark, f"{path}/events"))


def correlated(spark: SparkSession, path: str, length: str = "30 seconds", slide: str = "5 seconds", late: str = "10 seconds", prefix: str = "ran.", trigger: dict | None = None, rules: Rules = correlate.SHIPPED) -> StreamingQuery:
    """Starts the query from the records to ``path``/events, an event for each window and rule that fires."""
    samples = correlate.samples(records(spark, path, streaming=True), prefix, rules.series)
    found = correlate.events(correlate.sliding(samples, length, slide, late, rules.series), rules.rules)
    return _to_files(found, path, "events", trigger or {"processingTime": slide})


def published(rows: DataFrame, topic: str, path: str, kind: str = "file", prefix: str = "", trigger: dict | None = None, **options) -> StreamingQuery:
    """Starts the query that publishes a stream as JSON messages of a topic: a Kafka topic, or a folder of ``path`` whose readers see each once.

    A Kafka topic may get the messages of a batch that is run again twice.
    """
    name = f"{prefix}.{topic}" if prefix else topic
    if kind not in ("kafka", "file"):
        raise ValueError(f"unknown bus {kind!r}")
    writer = to_bus(rows).writeStream.option("checkpointLocation", f"{path}/checkpoints/topic-{name}").trigger(**(trigger or {"processingTime": "5 seconds"}))
    if kind == "kafka":
        return writer.format("kafka").option("topic", name).options(**options).start()
    return writer.format("text").option("path", _made(rows.sparkSession, f"{path}/{name}")).start()


def exported(rows: DataFrame, name: str, writer: Writer, path: str, retries: int = 3, pause: float = 0.5, trigger: dict | None = None) -> StreamingQuery:
    """Starts the query that gives each batch of a stream to ``writer``.

    A batch that fails is tried again ``retries`` times, then put aside under
    ``path``/dead_letters/``name``, and the query goes on; ``dead_letters`` reads
    them.  What a writer has taken before it failed, it gets again.
    """

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for attempt in range(retries + 1):
                try:
                    return writer(held, number)
                except Exception as e:  # noqa: BLE001
                    if attempt < retries:
                        time.sleep(pause * 2**attempt)
                    else:
                        why = str(e)[:1000]
            put = held.withColumn("dead_reason", F.lit(why))
            put.write.mode("overwrite").parquet(f"{path}/dead_letters/{name}/batch={number}")
        finally:
            held.unpersist()

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoints/export-{name}")
    return query.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def dead_letters(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows that a writer would not take, with ``dead_reason`` and ``batch``."""
    return spark.read.parquet(f"{path}/dead_letters/{name}")
