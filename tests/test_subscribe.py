"""Subscriptions over a socket: updates only, whole messages, and a new connection where one is lost."""

from __future__ import annotations

import socket
import threading
import time

import pytest

from kpiloom.operators.normalize import normalize
from kpiloom.registry import Registry
from kpiloom.sources import gnmi, subscribe
from kpiloom.sources.subscribe import SubscriptionReader, SubscriptionSource, SubscriptionStream

PATHS = ("/gnb/cell/prb/utilization", "/gnb/handover/attempts")
SYNC = bytes([3 << 3, 1])


def update(value: float) -> bytes:
    return gnmi.encode([(PATHS[0], {}, value), (PATHS[1], {}, 100 * value)])


class Target:
    """Answers each connection with the next of ``scripts``, the last one again and again, and keeps the requests."""

    def __init__(self, *scripts: bytes):
        self.scripts, self.asked = list(scripts), []
        self.server = socket.create_server(("127.0.0.1", 0))
        self.endpoint = f"127.0.0.1:{self.server.getsockname()[1]}"
        threading.Thread(target=self.serve, daemon=True).start()

    def serve(self):
        while True:
            try:
                connection, _ = self.server.accept()
            except OSError:
                return
            self.asked.append(connection.recv(4096))
            script = self.scripts.pop(0) if len(self.scripts) > 1 else self.scripts[0]
            connection.sendall(script)
            if len(self.asked) > 1:  # the first connection is lost, later ones stay open
                threading.Timer(5, connection.close).start()
            else:
                connection.close()


def options(endpoint: str, **more: str) -> dict[str, str]:
    return {"endpoints": endpoint, "paths": ",".join(PATHS), "interval": "1500ms"} | more


def test_request_lists_every_path_as_a_sampled_subscription():
    # written out by hand: a list of one subscription to /a/b, sampled each second
    assert subscribe.request(["/a/b"], 1.0) == bytes([10, 22, 18, 20, 10, 10, 26, 3, 10, 1, 97, 26, 3, 10, 1, 98, 16, 2, 24, 128, 148, 235, 220, 3])


def test_lost_connection_is_made_again_and_only_updates_are_kept(spark):
    lost = subscribe.delimited(SYNC) + subscribe.delimited(update(0.5)) + subscribe.delimited(update(0.7))[:9]
    target = Target(lost, subscribe.delimited(update(0.6)) + subscribe.delimited(SYNC))
    spark.dataSource.register(SubscriptionSource)
    rows = spark.read.format("kpiloom-subscribe").options(**options(f"{target.endpoint},127.0.0.1:9")).load().collect()
    target.server.close()
    good = sorted((r for r in rows if r.status == 200), key=lambda r: r.timestamp)
    assert [bytes(r.payload) for r in good] == [update(0.5), update(0.6)] and len(target.asked) == 2
    assert [(r.endpoint, r.payload) for r in rows if r.status == 0] == [("127.0.0.1:9", None)]
    found = normalize(spark.createDataFrame(good, SubscriptionSource({}).schema()).drop("status", "timed_out"), Registry.load()).records
    assert [r.value for r in found.where("kpi_name = 'handover.attempt_count'").orderBy("timestamp").collect()] == pytest.approx([50, 10])


def test_a_stream_listens_once_an_interval(spark):
    target = Target(subscribe.delimited(update(0.5)), subscribe.delimited(update(0.6)))
    spark.dataSource.register(SubscriptionSource)
    query = spark.readStream.format("kpiloom-subscribe").options(**options(target.endpoint)).load().writeStream.format("memory").queryName("subscribed").start()
    until = time.time() + 60
    while spark.table("subscribed").count() < 3 and time.time() < until and query.isActive:
        time.sleep(0.5)
    query.stop()
    target.server.close()
    payloads = [bytes(r.payload) for r in spark.table("subscribed").orderBy("timestamp").collect()]
    assert payloads[:3] == [update(0.5), update(0.6), update(0.6)]
    stream = SubscriptionStream(options("a:1"))
    assert stream.partitions({"interval": 4}, {"interval": 4}) == [] and len(stream.partitions({"interval": 4}, {"interval": 9})) == 1


def test_lengths_beyond_the_protocol_end_a_connection():
    for script in (b"\xff" * 8, gnmi.varint(subscribe.LONGEST + 1) + b"x"):
        a, b = socket.socketpair()
        b.sendall(script)
        with pytest.raises(ConnectionError):
            list(subscribe.messages(a, time.monotonic() + 1))
        a.close(), b.close()


def test_options_are_checked():
    for bad in ({}, options(""), options("a:1", paths=""), options("a:1", interval="0s"), options("a:1", sample_interval="0s")):
        with pytest.raises(ValueError):
            SubscriptionReader(bad)
