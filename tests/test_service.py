"""The service: from a configuration file to records, events, exports and its own telemetry."""

from __future__ import annotations

import json
import os
import signal
import subprocess
import sys
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import pytest

from kpiloom.config import Config, ConfigError
from kpiloom.operators import alerts, telemetry
from kpiloom.registry import SHIPPED
from kpiloom.streaming.service import LANDED, Service
from kpiloom.streaming import runner


@pytest.fixture
def network():
    """A metrics endpoint whose counter grows by 10 a scrape, and a collector that takes exports."""
    seen = {"scrapes": 0, "posts": []}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen["scrapes"] += 1
            n = seen["scrapes"]
            self.send_response(200)
            self.end_headers()
            self.wfile.write(f'open5gs_amf_registration_total{{status="attempted"}} {10 * n}\nopen5gs_amf_registration_total{{status="failed"}} {n}\nopen5gs_amf_ue_connected 5\n'.encode())

        def do_POST(self):
            seen["posts"].append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(200)
            self.end_headers()

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    seen["url"] = f"http://127.0.0.1:{server.server_port}"
    yield seen
    server.shutdown()


def configured(tmp_path, url):
    path = tmp_path / "config.yaml"
    path.write_text(
        f"schema_dir: {SHIPPED}\ncollectors:\n- {{name: open5gs-amf, endpoint: '{url}', interval: 1s, extra: {{plmn: 1-1, instance_id: amf-1}}}}\n"
        f"- {{name: free5gc-smf, endpoint: 'http://127.0.0.1:9', interval: 1s}}\noutput: {{otlp: {{endpoint: '{url}/v1/metrics', batch_size: 4}}}}\ncorrelator: {{window_size: 10s, eval_interval: 5s}}\n"
    )
    return path


def points(seen):
    return [m["name"] for p in seen["posts"] for m in p["resourceMetrics"][0]["scopeMetrics"][0]["metrics"]]


def test_a_service_runs_from_its_file_and_stops(spark, tmp_path, network):
    service, stopped = Service(spark, Config.load(configured(tmp_path, network["url"])), str(tmp_path / "out"), delay="1 second", grace="0 seconds", pace="1 second"), threading.Event()
    thread = threading.Thread(target=service.run, args=(stopped,))
    thread.start()
    until = time.time() + 150
    while time.time() < until and thread.is_alive() and points(network).count("ran.amf.registration.attempt_count") < 3:
        time.sleep(0.5)
    stopped.set()
    thread.join(60)
    assert not thread.is_alive() and not spark.streams.active
    records = runner.records(spark, service.path).where("kpi_name = 'registration.attempt_count'").orderBy("timestamp").collect()
    assert len(records) >= 3 and all(r.value > 0 and r.value % 10 == 0 for r in records) and records[0].attributes.plmn_id == "1-1"
    assert points(network).count("ran.amf.registration.attempt_count") >= 3
    raw = service.raw().collect()
    good = [r for r in raw if r.payload is not None]
    assert {r.instance_id for r in good} == {"amf-1"} and {r.vendor for r in raw if r.payload is None} == {"free5gc"}
    own = service.telemetry().collect()
    last = {}
    for r in sorted(own, key=lambda r: r.ts):
        last[r.metric, r.labels.get("collector") or r.labels.get("namespace")] = r.value
    assert last["collector_scrape_success", "open5gs-amf"] == 1 and last["collector_scrape_success", "free5gc-smf"] == 0
    assert last["collector_scrape_total", "open5gs-amf"] == len(good) and last["collector_scrape_error_total", "free5gc-smf"] == len(raw) - len(good)
    assert last["normalizer_records_total", "ran.amf"] == runner.records(spark, service.path).count()
    assert alerts.evaluate(service.telemetry()).columns[0] == "alert"


def test_a_subscription_without_folder_starts_nothing(spark, tmp_path, network):
    path = tmp_path / "c.yaml"
    path.write_text(f"schema_dir: {SHIPPED}\ncollectors:\n- {{name: open5gs-amf, endpoint: '{network['url']}'}}\n- {{name: gnmi-gnb, endpoint: x, extra: {{gnmi_paths: [/a]}}}}\n")
    with pytest.raises(ConfigError, match="landing"):
        Service(spark, Config.load(path), str(tmp_path / "out")).start()
    assert not spark.streams.active


def test_the_command_stops_on_a_signal(tmp_path, network):
    repo = Path(__file__).parent.parent
    command = [sys.executable, "-m", "kpiloom.cli", "serve", str(configured(tmp_path, network["url"])), "--path", str(tmp_path / "out"), "--delay", "1 second", "--grace", "0 seconds", "--pace", "1 second", "--seconds", "120"]
    process = subprocess.Popen(command, cwd=repo, env=os.environ | {"PYTHONPATH": str(repo), "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=2 pyspark-shell"}, stderr=subprocess.PIPE, stdout=subprocess.DEVNULL, text=True)
    until = time.time() + 100
    while time.time() < until and process.poll() is None and not network["posts"]:
        time.sleep(0.5)
    process.send_signal(signal.SIGTERM)
    assert process.wait(60) == 0, process.stderr.read()[-2000:]
    assert network["posts"]


def test_own_telemetry_counts_by_step_and_feeds_the_alerts(spark):
    at = lambda c: f"timestamp_seconds({c}) AS timestamp"
    raw = spark.createDataFrame([(i, "v", "AMF", "i", s, b"x" if s >= 300 else None, 403) for i, s in enumerate(range(0, 600, 15))], "record_id long, vendor string, nf_type string, instance_id string, s long, payload binary, status int").selectExpr("record_id", "vendor", "nf_type", "instance_id", "'' AS endpoint", "payload", "'prometheus' AS protocol", at("s"), "CAST(NULL AS MAP<STRING,STRING>) AS meta", "'v1' AS schema_version", "status", "false AS timed_out")
    assert raw.schema.simpleString() == spark.createDataFrame([], LANDED).schema.simpleString()
    outcomes = spark.createDataFrame([(1, "record", False, 3), (1, "partial", False, 3), (1, "partial", True, 3), (2, "late", False, 20), (2, "late", False, 20)], "record_id long, kind string, unsupported boolean, s long").selectExpr("*", "'v' AS vendor", "'AMF' AS nf_type", "'i' AS instance_id", "'ran.amf' AS namespace", at("s"))
    failures = spark.createDataFrame([], runner.FAILURES)
    events = spark.createDataFrame([("SessionDrop", "warning", s) for s in (40, 41, 400)], "rule_name string, severity string, s long").selectExpr("rule_name", "severity", at("s"))
    own = telemetry.of_run(raw, outcomes, failures, events)
    got = {}
    for r in own.where("metric <> 'collector_scrape_success'").collect():
        got.setdefault(r.metric, []).append((int(r.ts.timestamp()), r.value))
    assert sorted(got["correlator_events_total"]) == [(30, 0), (45, 2), (405, 3)]
    assert sorted(got["counter_ooo_total"]) == [(15, 0), (30, 1)] and sorted(got["normalizer_partial_failures_total"]) == sorted(got["normalizer_records_total"]) == [(0, 0), (15, 1)]
    assert max(v for _, v in got["collector_scrape_error_total"]) == 20 and max(v for _, v in got["collector_scrape_total"]) == 40 and "normalizer_total_failures_total" not in got
    fired = {r.alert for r in alerts.evaluate(own).collect()}
    assert {"CollectorScrapeFailure", "SessionDrop"} <= fired and "RegistrationStorm" not in fired
