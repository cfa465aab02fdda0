from __future__ import annotations

import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from kpiloom.operators.normalize import normalize
from kpiloom.registry import Registry
from kpiloom.sources.http import ScrapeReader, ScrapeSource
from kpiloom.sources.scrape import error_class


class Metrics(BaseHTTPRequestHandler):
    def do_GET(self):
        ok = self.path == "/good/metrics"
        self.send_response(200 if ok else 403)
        self.end_headers()
        self.wfile.write(b"open5gs_amf_ue_connected 3\n" if ok else b"")

    def log_message(self, *args):
        pass


def test_scrapes_become_records_and_failures_rows(spark):
    server = HTTPServer(("127.0.0.1", 0), Metrics)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(ScrapeSource)
    rows = spark.read.format("kpiloom-scrape").option("endpoints", f"{base}/good,{base}/bad,http://127.0.0.1:9").option("vendor", "open5gs").option("nf_type", "AMF").load().collect()
    server.shutdown()
    df = spark.createDataFrame(rows, ScrapeSource({}).schema())
    classes = {r.endpoint[-4:]: r.c for r in df.where("payload IS NULL").select("endpoint", error_class(df["status"], df["timed_out"]).alias("c")).collect()}
    assert classes == {"/bad": "auth", ".1:9": "network"}
    good = df.where("status = 200").drop("status", "timed_out")
    assert normalize(good, Registry.load()).records.where("kpi_name = 'ue.connected_count'").first().value == 3


def test_options_are_checked():
    for bad in ({}, {"endpoints": "x", "interval": "0s"}):
        with pytest.raises(ValueError):
            ScrapeReader(bad)
