"""gNMI subscriptions as a Spark data source, over plain sockets.

    spark.dataSource.register(SubscriptionSource)
    spark.readStream.format("kpiloom-subscribe").option("endpoints", "gnb1:9339,gnb2:9339")
         .option("paths", "/gnb/cell/prb/utilization,/gnb/handover/attempts").load()

Messages are protocol buffers, each after its length as a varint; what speaks
gRPC is reached through a relay that takes its frames off.  One partition an
endpoint, all of whose paths are in one request, so that a response holds all
values of a sample.  A read listens for ``interval`` and connects again where a
connection is lost; sampled subscriptions send their values on connecting, so
only samples between connections are missed.  Responses other than updates are
dropped.  An endpoint that could never be reached gives a row without payload.
"""

from __future__ import annotations

import datetime as dt
import socket
import time
import uuid
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from kpiloom.functions.transforms import seconds
from kpiloom.schema import RAW
from kpiloom.sources import gnmi

#: Fixed values of the protocol: sampled subscriptions, and the longest message that a receiver takes.
SAMPLE_MODE = 2
LONGEST = 4 << 20
PAUSE = 0.2


def request(paths: list[str], sample_seconds: float) -> bytes:
    """A request to stream samples of all paths."""
    subscriptions = b""
    for path in paths:
        parts = b"".join(gnmi.field(3, gnmi.field(1, p.encode())) for p in path.split("/") if p)
        every = bytes([3 << 3]) + gnmi.varint(round(sample_seconds * 1e9))
        subscriptions += gnmi.field(2, gnmi.field(1, parts) + bytes([2 << 3, SAMPLE_MODE]) + every)
    return gnmi.field(1, subscriptions)


def delimited(message: bytes) -> bytes:
    return gnmi.varint(len(message)) + message


def messages(connection: socket.socket, until: float) -> Iterator[bytes]:
    """Whole messages until the time is over; a lost connection is an ``OSError``."""

    def take(n: int) -> bytes:
        out = b""
        while len(out) < n:
            connection.settimeout(max(until - time.monotonic(), 1e-3))
            more = connection.recv(n - len(out))
            if not more:
                raise ConnectionError("connection lost")
            out += more
        return out

    while True:
        length = shift = 0
        while True:
            b = take(1)[0]
            length |= (b & 127) << shift
            shift += 7
            if b < 128:
                break
            if shift > 28:
                raise ConnectionError("not a length")
        if length > LONGEST:
            raise ConnectionError("message too long")
        yield take(length)


def is_update(message: bytes) -> bool:
    """Whether a response carries an update; one that cannot be read goes on, to fail as a scrape."""
    try:
        return any(number == 1 and kind == 2 for number, kind, _ in gnmi.fields(message))
    except ValueError:
        return True


class Target(InputPartition):
    def __init__(self, endpoint: str):
        super().__init__(endpoint)
        self.endpoint = endpoint


class Subscriber:
    """What batch and stream readers share."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        listed = lambda key: [x.strip() for x in options.get(key, "").split(",") if x.strip()]
        self.endpoints, self.paths = listed("endpoints"), listed("paths")
        self.interval = seconds(options.get("interval", "15s"))
        self.sample = seconds(options.get("sample_interval") or options.get("interval", "15s"))
        if not self.endpoints or not self.paths:
            raise ValueError("a subscription needs endpoints and paths")
        if self.interval <= 0 or self.sample <= 0:
            raise ValueError("interval must be positive")

    def read(self, partition: Target) -> Iterator[tuple]:
        until, reached, last = time.monotonic() + self.interval, False, dt.datetime.min.replace(tzinfo=dt.timezone.utc)
        host, _, port = partition.endpoint.rpartition(":")
        while (left := until - time.monotonic()) > 0:
            try:
                with socket.create_connection((host, int(port)), timeout=left) as connection:
                    reached = True
                    connection.sendall(delimited(request(self.paths, self.sample)))
                    for message in messages(connection, until):
                        if is_update(message):
                            last = max(dt.datetime.now(dt.timezone.utc), last + dt.timedelta(microseconds=1))
                            yield self._row(partition.endpoint, message, last, 200)
            except OSError:
                time.sleep(min(PAUSE, max(until - time.monotonic(), 0)))
        if not reached:
            yield self._row(partition.endpoint, None, dt.datetime.now(dt.timezone.utc), 0)

    def _row(self, endpoint: str, payload: bytes | None, at: dt.datetime, status: int) -> tuple:
        o = self.options
        return (uuid.uuid4().int >> 65, o.get("vendor") or "oai", o.get("nf_type") or "gNB", o.get("instance_id") or endpoint, endpoint, payload, "gnmi", at, None, o.get("schema_version", "v1"), status, False)


class SubscriptionReader(Subscriber, DataSourceReader):
    def partitions(self) -> list[Target]:
        return [Target(e) for e in self.endpoints]


class SubscriptionStream(Subscriber, DataSourceStreamReader):
    """An offset is the number of the interval that now is; a batch listens to every endpoint for one interval."""

    def initialOffset(self) -> dict:
        return {"interval": int(time.time() // self.interval) - 1}

    def latestOffset(self) -> dict:
        return {"interval": int(time.time() // self.interval)}

    def partitions(self, start: dict, end: dict) -> list[Target]:
        return [Target(e) for e in self.endpoints] if end["interval"] > start["interval"] else []


class SubscriptionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kpiloom-subscribe"

    def schema(self) -> str:
        return f"{RAW}, status int, timed_out boolean"

    def reader(self, schema) -> SubscriptionReader:
        return SubscriptionReader(self.options)

    def streamReader(self, schema) -> SubscriptionStream:
        return SubscriptionStream(self.options)
