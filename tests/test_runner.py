"""The running pipeline: streams give what the batch gives; configuration, export and sources."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from kpiloom.config import Config, ConfigError
from kpiloom.operators import alerts, promql, sinks
from kpiloom.operators.normalize import normalize
from kpiloom.registry import Registry
from kpiloom.schema import RAW
from kpiloom.sources.exposition import general, samples, series
from kpiloom.sources.http import ScrapeSource, ScrapeStream
from kpiloom.streaming import runner


def raw(spark, rows):
    """rows: (record_id, instance, second, text)."""
    made = spark.createDataFrame(rows, "record_id long, instance_id string, s long, text string")
    return made.selectExpr("record_id", "'open5gs' AS vendor", "'AMF' AS nf_type", "instance_id", "'' AS endpoint", "encode(text, 'UTF-8') AS payload", "'prometheus' AS protocol", "timestamp_seconds(s) AS timestamp", "map('plmn', '1-1') AS meta", "'v1' AS schema_version")


def scrape(attempts, failures, users):
    gauge = f"open5gs_amf_ue_connected {users}\n" if users is not None else ""
    return f'open5gs_amf_registration_total{{status="attempted"}} {attempts}\nopen5gs_amf_registration_total{{status="failed"}} {failures}\n{gauge}'


NOW = {"availableNow": True}


def ran(spark, source, out, **options):
    stream = spark.readStream.schema(RAW).parquet(source)
    for q in runner.normalised(stream, Registry.load(), out, trigger=NOW, **options):
        q.awaitTermination()


def outcome_rows(df):
    return sorted(map(str, df.select("record_id", "kpi_name", "value", "labels", "attributes").collect()))


def test_streams_give_the_batch_s_records_and_events_in_any_order_of_arrival(spark, tmp_path):
    source, out = str(tmp_path / "raw"), str(tmp_path / "out")
    first = [(i, f"i{i % 2}", 1_700_000_000 + 5 * i, scrape(10 * i, i, None if i == 3 else 7)) for i in (0, 1, 4, 3, 6, 7)]
    second = [(i, f"i{i % 2}", 1_700_000_000 + 5 * i, scrape(10 * i, i, 7)) for i in (5, 2)]  # within the allowed delay of the newest
    third = [(8, "i0", 1_700_000_045, scrape(5, 1, 9)), (9, "i1", 1_700_000_050, scrape(900, 800, 9)), (10, "i1", 1_700_000_055, "<html>\n"), (11, "i1", 1_700_000_060, scrape(910, 800, 9))]
    flush = [(99, "flush", 1_700_001_000, "")]
    for rows in (first, second, third, flush):
        raw(spark, rows).coalesce(1).write.mode("append").parquet(source)
        ran(spark, source, out, delay="30 seconds")
    whole = normalize(spark.read.schema(RAW).parquet(source).where("record_id <> 99"), Registry.load())
    assert outcome_rows(runner.records(spark, out)) == outcome_rows(whole.records)
    assert runner.partial(spark, out).count() == whole.partial.count()
    assert [r.record_id for r in spark.read.parquet(f"{out}/failures").collect()] == [10]
    seen = []
    runner.exported(runner.records(spark, out, streaming=True), "count", lambda b, n: seen.append(b.count()), out, trigger=NOW).awaitTermination()
    assert sum(seen) == whole.records.count()
    runner.correlated(spark, out, "60 seconds", "30 seconds", trigger=NOW).awaitTermination()
    assert all(r.plmn == "1-1" for r in runner.events(spark, out).collect())
    runner.published(runner.records(spark, out, streaming=True), "records", str(tmp_path / "bus"), trigger=NOW).awaitTermination()
    assert spark.read.text(str(tmp_path / "bus" / "records")).count() == sum(seen)


@pytest.mark.parametrize("written", [True, False])
def test_a_batch_that_runs_again_is_handed_over_once(spark, tmp_path, written):
    """The query stops before its last batch is committed: after the sink's log has it (written), or before."""
    source, out = str(tmp_path / "raw"), str(tmp_path / "out")
    bus, seen = str(tmp_path / "bus"), []

    def downstream():
        runner.correlated(spark, out, "60 seconds", "30 seconds", trigger=NOW).awaitTermination()
        runner.exported(runner.records(spark, out, streaming=True), "seen", lambda b, n: seen.extend(r.record_id for r in b.where("kpi_name = 'ue.connected_count'").collect()), out, trigger=NOW).awaitTermination()
        runner.published(runner.records(spark, out, streaming=True), "records", bus, trigger=NOW).awaitTermination()

    for k in range(2):
        rows = [(100 * k + i, "i", 1_700_000_000 + 200 * k + 5 * i, scrape(10 * i, i, 7)) for i in range(5)]
        raw(spark, rows).coalesce(1).write.mode("append").parquet(source)
        ran(spark, source, out)
        downstream()
        last = lambda folder: max((p for p in folder.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        for folder in [tmp_path / "out" / "checkpoints" / "outcomes" / "commits"] + ([] if written else [tmp_path / "out" / "outcomes" / "_spark_metadata"]):
            gone = last(folder)
            gone.unlink()
            crc = folder / f".{gone.name}.crc"
            if crc.exists():
                crc.unlink()
        ran(spark, source, out)
        downstream()
    got = [r.record_id for r in runner.records(spark, out).where("kpi_name = 'ue.connected_count'").collect()]
    assert sorted(got) == sorted(set(got)) == [0, 1, 2, 3, 4, 100, 101, 102]  # what the newest has not passed yet is held
    assert sorted(set(seen)) == sorted(got)
    assert spark.read.text(f"{bus}/records").where("value LIKE '%ue.connected_count%'").count() >= len(got)
    if written:  # readers never saw a batch that was not finished
        assert sorted(seen) == sorted(got) and spark.read.text(f"{bus}/records").where("value LIKE '%ue.connected_count%'").count() == len(got)


def test_what_a_writer_will_not_take_is_put_aside_and_the_rest_goes_on(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    calls, taken = [], []

    def flaky(batch, number):
        calls.append(number)
        if number == 0 or calls.count(number) < 2:
            raise RuntimeError("down")
        taken.append(batch.count())

    for n in (3, 4):
        spark.range(n).coalesce(1).write.mode("append").parquet(source)
        runner.exported(spark.readStream.schema("id long").parquet(source), "flaky", flaky, out, retries=1, pause=0, trigger=NOW).awaitTermination()
    assert taken == [4] and calls == [0, 0, 1, 1]
    dead = runner.dead_letters(spark, out, "flaky").collect()
    assert len(dead) == 3 and all("down" in r.dead_reason and r.batch == 0 for r in dead)


def test_configuration(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("schema_dir: s\ncollectors:\n- {name: open5gs-amf, endpoint: 'http://x', interval: 5s}\noutput: {otlp: {endpoint: 'http://o', batch_size: 3}}\ncorrelator: {window_size: 1m}\n")
    c = Config.load(path)
    assert (c.schema_dir, c.collectors[0].nf_type, c.window, c.slide, c.listen, c.otlp_batch, c.correlate) == ("s", "AMF", 60, 5, ":8080", 3, True)
    for bad in ("collectors: [{name: open5gs-amf, endpoint: x}]", "schema_dir: s", "schema_dir: s\ncollectors: [{name: nobody, endpoint: x}]", "schema_dir: s\ncollectors: [{name: open5gs-amf}]", "schema_dir: s\ncollectors: [{name: open5gs-amf, endpoint: x}]\noutput: {otlp: {}}", "a: ["):
        path.write_text(bad)
        with pytest.raises(ConfigError):
            Config.load(path)


def test_export_requests_are_posted_in_batches(spark):
    got = []

    class Collector(BaseHTTPRequestHandler):
        def do_POST(self):
            got.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(200)
            self.end_headers()

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Collector)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    records = normalize(raw(spark, [(i, "i", 1_700_000_000 + i, scrape(i, 0, 3)) for i in range(4)]), Registry.load()).records.where("kpi_name = 'ue.connected_count'").coalesce(1)
    sinks.otlp_writer(f"http://127.0.0.1:{server.server_port}", size=3)(records, 0)
    server.shutdown()
    sizes = [len(g["resourceMetrics"][0]["scopeMetrics"][0]["metrics"]) for g in got]
    assert sum(sizes) == 4 and max(sizes) <= 3
    point = got[0]["resourceMetrics"][0]["scopeMetrics"][0]["metrics"][0]
    assert point["description"] == "3GPP TS 28.552 §5.1.1.8" and point["gauge"]["dataPoints"][0]["asDouble"] == 3


def test_a_stream_scrapes_once_an_interval():
    reader = ScrapeSource({"endpoints": "http://a,http://b", "interval": "10s"}).streamReader(None)
    assert isinstance(reader, ScrapeStream)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert len(reader.partitions(start, end)) == 2 and reader.partitions(end, end) == []


def test_large_scrapes_are_parsed_in_linear_time(spark):
    import time

    text = "".join(f'# TYPE m{i} counter\nm{i}{{a="x\\"{i}",b="\\\\n"}} {i}.5 17\n' for i in range(10_000))
    began = time.time()
    found = samples(text)
    assert time.time() - began < 2 and len(found) == 10_000 and found[7] == (7, "m7", [("a", 'x"7'), ("b", "\\n")], 7.5, "counter")
    row = spark.createDataFrame([(text,), (None,), ("# TYPE s summary\ns{quantile=\"1\"} 2\ns_sum +Inf\nh_count nan\nbad\nx 1_0",)], "t string").select(series(F.col("t")).alias("s")).collect()
    assert [len(r.s) for r in row] == [10_000, 0, 2] and row[2].s[0].value == float("inf") and row[2].s[0].type == "summary"


def test_numbers_are_written_as_percent_g(spark):
    numbers = {0.0: "0", 7.0: "7", 123456.0: "123456", 1e6: "1e+06", 1234567.5: "1.2345675e+06", 0.0001: "0.0001", 0.00001234: "1.234e-05", -2.5: "-2.5", 1e100: "1e+100", float("inf"): "+Inf", float("-inf"): "-Inf", 0.1: "0.1", 100.25: "100.25"}
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select("x", general(F.col("x")).alias("t")).collect()
    assert {r.x: r.t for r in rows} == numbers


def test_a_template_without_variables_is_compared_as_it_is_spelt(tmp_path, spark):
    (tmp_path / "a.yaml").write_text("namespace: amf\nkpis: [{name: a, unit: u, spec_ref: r}]\nvendors: {v: {protocol: prometheus, metrics: {a: {template: /a/b, type: gauge}}}}\n")
    dim = Registry.load(tmp_path).mapping_dim(spark).first()
    assert (dim.metric, dim.template, dim.strategy) == ("/a/b", None, "exact")


def test_islands_that_cross_stretches_are_one(spark):
    rows = [("a", s, s not in (50, 51, 200)) for s in range(0, 260)] + [("b", s, s >= 60) for s in range(0, 120)]
    df = spark.createDataFrame(rows, "k string, s long, ok boolean").selectExpr("k", "timestamp_seconds(s) AS ts", "ok")
    got = {(r.k, r.start.timestamp(), r.end.timestamp(), r.samples) for r in promql.held_for(df, ["k"], F.col("ok"), 40, stretch="30 seconds").collect()}
    assert got == {("a", 0, 49, 50), ("a", 52, 199, 148), ("a", 201, 259, 59), ("b", 60, 119, 60)}


def test_alerts_hold_before_they_fire(spark):
    rows = [("collector_scrape_success", {"collector": "x"}, s, 0.0 if 300 <= s < 600 else 1.0) for s in range(0, 900, 15)]
    rows += [("collector_scrape_success", {"collector": "y"}, s, 0.0 if 300 <= s < 360 else None) for s in range(0, 900, 15)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, s long, value double").selectExpr("metric", "labels", "timestamp_seconds(s) AS ts", "value")
    got = sorted((r.series, r.since, r.fires_at, r.until) for r in alerts.evaluate(df).collect())
    assert got == [("collector=x", 300, 420, 570), ("collector=y", 300, 420, 630)]
