"""What leaves the pipeline: gauges, exposition text, OTLP-shaped JSON, reports."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.sources.exposition import rendered, sanitised
from kpiloom.sources.scrape import to_bus

LABELS = ("vendor", "nf_type", "nf_instance_id", "plmn_id", "data_center", "slice_sst", "slice_sd", "cell_id")


def label_columns() -> list[Column]:
    """The exported labels of a record; those without a value are empty."""
    a = F.col("attributes")
    text = {
        "vendor": a["vendor"], "nf_type": a["nf_type"], "nf_instance_id": a["nf_instance_id"], "plmn_id": a["plmn_id"], "data_center": a["data_center"],
        "slice_sst": a["slice_id"]["sst"].cast("string"), "slice_sd": a["slice_id"]["sd"], "cell_id": a["cell_id"]["global_cell_id"],
    }
    return [F.coalesce(text[k], F.lit("")).alias(k) for k in LABELS]


def latest_gauges(records: DataFrame) -> DataFrame:
    """(name, labels, value): of each metric and label tuple the last written value."""
    rows = records.select(sanitised(F.concat_ws(".", "namespace", "kpi_name")).alias("name"), *label_columns(), "value", F.struct("timestamp", "record_id").alias("at"))
    return rows.groupBy("name", *LABELS).agg(F.max_by("value", "at").alias("value"))


def exposition_lines(gauges: DataFrame) -> DataFrame:
    """One ``line`` a gauge."""
    labels = F.create_map(*[x for k in LABELS for x in (F.lit(k), F.col(k))])
    return gauges.select(rendered(F.col("name"), labels, F.col("value")).alias("line"))


def otlp_attributes() -> Column:
    """A record's attributes as OTLP key-values; those of slice and cell only where there is one (an array of JSON objects)."""
    a = F.col("attributes")
    s, c = a["slice_id"], a["cell_id"]
    # fixed values: the names that collectors know
    named = [
        ("nf.type", a["nf_type"], None), ("nf.vendor", a["vendor"], None), ("nf.instance_id", a["nf_instance_id"], None), ("network.plmn_id", a["plmn_id"], None),
        ("network.data_center", a["data_center"], None), ("network.slice.sst", s["sst"].cast("string"), s), ("network.slice.sd", s["sd"], s), ("network.cell.id", c["global_cell_id"], c),
    ]
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), F.struct(F.coalesce(v, F.lit("")).alias("stringValue")).alias("value"))
    return F.filter(F.array(*[pair(k, v) if of is None else F.when(of.isNotNull(), pair(k, v)) for k, v, of in named]), lambda e: e.isNotNull())


def otlp(records: DataFrame) -> DataFrame:
    """Each record as the JSON of an OTLP gauge with one data point."""
    at = F.format_string("%d000", F.unix_micros("timestamp"))
    point = F.struct(otlp_attributes().alias("attributes"), at.alias("timeUnixNano"), F.col("value").alias("asDouble"))
    metric = F.struct(
        F.concat_ws(".", "namespace", "kpi_name").alias("name"), F.col("spec_ref").alias("description"), F.col("unit"),
        F.struct(F.array(point).alias("dataPoints")).alias("gauge"),
    )
    return records.select(F.to_json(metric).alias("value"))


def _requests(size: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def request(metrics: list[str]) -> pd.DataFrame:
        body = f'{{"resourceMetrics":[{{"resource":{{}},"scopeMetrics":[{{"scope":{{}},"metrics":[{",".join(metrics)}]}}]}}]}}'
        return pd.DataFrame({"request": [body], "points": [len(metrics)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[str] = []
        for b in batches:
            held += b["value"].tolist()
            while len(held) >= size:
                yield request(held[:size])
                held = held[size:]
        if held:
            yield request(held)

    return run


#: Data points in an export request.
OTLP_BATCH = 100


def otlp_requests(records: DataFrame, size: int = OTLP_BATCH) -> DataFrame:
    """(request, points): export requests of ``size`` points each; a partition's last may have fewer."""
    return otlp(records).mapInPandas(_requests(size), "request string, points int")


def otlp_writer(endpoint: str, size: int = OTLP_BATCH, headers: dict[str, str] | None = None, timeout: float = 10.0, retries: int = 3) -> Callable[[DataFrame, int], None]:
    """A batch writer that posts ``otlp_requests`` to a collector's JSON endpoint, from the executors.

    A request that fails is sent again by itself, so one refusal does not repeat
    the requests before it.
    """
    sent = {"Content-Type": "application/json"} | (headers or {})

    def post(rows: Iterator) -> None:
        for r in rows:
            for attempt in range(retries + 1):
                try:
                    with urllib.request.urlopen(urllib.request.Request(endpoint, r.request.encode(), sent), timeout=timeout):
                        break
                except OSError:
                    if attempt == retries:
                        raise
                    time.sleep(0.1 * 2**attempt)

    def write(batch: DataFrame, _: int) -> None:
        otlp_requests(batch, size).foreachPartition(post)

    return write


def bus_writer(topic: str, kind: str = "file", prefix: str = "", **options) -> Callable[[DataFrame, int], None]:
    """A batch writer that publishes rows as JSON messages: to Kafka where its connector is installed, else to a folder for each topic."""
    name = f"{prefix}.{topic}" if prefix else topic
    if kind not in ("kafka", "file"):
        raise ValueError(f"unknown bus {kind!r}")

    def write(batch: DataFrame, number: int) -> None:
        messages = to_bus(batch)
        if kind == "kafka":
            messages.write.format("kafka").option("topic", name).options(**options).save()
        else:  # a batch that is run again replaces itself
            messages.write.mode("overwrite").text(f"{options['path']}/{name}/batch={number}")

    return write


def fan_out(writers: list[Callable[[DataFrame, int], None]], on_error: Callable[[str, Exception], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that gives each batch to every writer; one's error does not stop the others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for w in writers:
                try:
                    w(held, batch_id)
                except Exception as e:  # noqa: BLE001
                    on_error(getattr(w, "__name__", "writer"), e)
        finally:
            held.unpersist()

    return write
