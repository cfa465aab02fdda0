"""Scraping metric endpoints as a Spark data source.

    spark.dataSource.register(ScrapeSource)
    spark.read.format("kpiloom-scrape").option("endpoints", "http://a:9100,http://b:9100")
         .option("vendor", "open5gs").option("nf_type", "AMF").load()

One partition an endpoint, so executors scrape in parallel.  A failed scrape is
a row without payload, with its status and whether it timed out.  ``readStream``
scrapes once in each ``interval``; what a stream missed is not to be had later.
"""

from __future__ import annotations

import datetime as dt
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from kpiloom.functions.transforms import seconds
from kpiloom.schema import RAW


class Endpoint(InputPartition):
    def __init__(self, url: str):
        super().__init__(url)
        self.url = url


class Scraper:
    """What batch and stream readers share."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.endpoints = [e.strip() for e in options.get("endpoints", "").split(",") if e.strip()]
        if not self.endpoints:
            raise ValueError("no endpoints")
        #: A scrape may take half the interval.
        self.interval = seconds(options.get("interval", "15s"))
        self.timeout = self.interval / 2
        if self.timeout <= 0:
            raise ValueError("interval must be positive")

    def read(self, partition: Endpoint) -> Iterator[tuple]:
        url, now = partition.url, dt.datetime.now(dt.timezone.utc)
        payload, status, timed_out = None, 0, False
        try:
            with urllib.request.urlopen(url.rstrip("/") + "/metrics", timeout=self.timeout) as r:
                status = r.status
                payload = r.read() if status == 200 else None
        except urllib.error.HTTPError as e:
            status = e.code
        except TimeoutError:
            timed_out = True
        except urllib.error.URLError as e:
            timed_out = isinstance(e.reason, TimeoutError)
        o = self.options
        record_id = int(now.timestamp() * 1000) << 20 | zlib.crc32(url.encode()) & 0xFFFFF
        yield (
            record_id, o.get("vendor", ""), o.get("nf_type", ""), o.get("instance_id") or url, url, payload, "prometheus", now, None, o.get("schema_version", "v1"), status, timed_out,
        )


class ScrapeReader(Scraper, DataSourceReader):
    def partitions(self) -> list[Endpoint]:
        return [Endpoint(e) for e in self.endpoints]


class ScrapeStream(Scraper, DataSourceStreamReader):
    """An offset is the number of the interval that now is; a batch scrapes every endpoint once, however many have passed."""

    def initialOffset(self) -> dict:
        return {"interval": int(time.time() // self.interval) - 1}

    def latestOffset(self) -> dict:
        return {"interval": int(time.time() // self.interval)}

    def partitions(self, start: dict, end: dict) -> list[Endpoint]:
        return [Endpoint(e) for e in self.endpoints] if end["interval"] > start["interval"] else []


class ScrapeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kpiloom-scrape"

    def schema(self) -> str:
        return f"{RAW}, status int, timed_out boolean"

    def reader(self, schema) -> ScrapeReader:
        return ScrapeReader(self.options)

    def streamReader(self, schema) -> ScrapeStream:
        return ScrapeStream(self.options)
