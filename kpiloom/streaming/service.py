"""The whole pipeline from a configuration file: collectors, normalisation, rules and export as running queries.

Scrapes cannot be asked for again, so one query lands them as they come, failed
ones too; all others read what has landed, and each goes on where it stopped
when the service is started again on the same folder.
"""

from __future__ import annotations

import threading
import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiloom.config import Config, ConfigError
from kpiloom.operators import sinks, telemetry
from kpiloom.operators.correlate import SHIPPED
from kpiloom.operators.rules import Rules
from kpiloom.registry import Registry
from kpiloom.schema import RAW
from kpiloom.sources.http import ScrapeSource
from kpiloom.sources.scrape import Collector, landed
from kpiloom.sources.subscribe import SubscriptionSource
from kpiloom.streaming import runner

LANDED = f"{RAW}, status int, timed_out boolean"
#: What a collector's ``extra`` may say about the network that it watches.
META = ("plmn", "data_center", "sst", "sd", "cell", "nci", "tac")


class ServiceError(RuntimeError):
    """A query of the service ended by itself."""


def collected(spark: SparkSession, collector: Collector) -> DataFrame:
    """A collector's stream: scrapes of its endpoint, a subscription to it, or the files of its ``landing`` folder where it has one."""
    extra = collector.extra
    if collector.protocol == "prometheus":
        spark.dataSource.register(ScrapeSource)
        options = {"endpoints": collector.endpoint, "vendor": collector.vendor, "nf_type": collector.nf_type, "interval": collector.interval}
        if "instance_id" in extra:
            options["instance_id"] = extra["instance_id"]
        rows = spark.readStream.format(ScrapeSource.name()).options(**options).load()
    elif "landing" in extra:
        rows = landed(spark, extra["landing"], collector, streaming=True).withColumns({"status": F.lit(200), "timed_out": F.lit(False)})
    elif collector.endpoint.rpartition(":")[2].isdigit() and "/" not in collector.endpoint:
        spark.dataSource.register(SubscriptionSource)
        options = {"endpoints": collector.endpoint, "paths": ",".join(collector.paths), "vendor": collector.vendor, "nf_type": collector.nf_type, "interval": collector.interval}
        options |= {k: str(extra[k]) for k in ("instance_id", "sample_interval") if k in extra}
        rows = spark.readStream.format(SubscriptionSource.name()).options(**options).load()
    else:
        raise ConfigError(f"{collector.name}: a subscription needs host:port or a landing folder")
    known = [x for k in META if k in extra for x in (F.lit(k), F.lit(str(extra[k])))]
    return rows.withColumn("meta", F.create_map(*known)) if known else rows


class Service:
    """The queries of a configuration under the folder ``path``, which all executors share."""

    def __init__(self, spark: SparkSession, config: Config, path: str, rules: Rules = SHIPPED, delay: str = "10 seconds", grace: str = "1 minute", pace: str = "5 seconds"):
        self.spark, self.config, self.path, self.rules = spark, config, path, rules
        self.delay, self.grace, self.trigger = delay, grace, {"processingTime": pace}
        self.queries: dict[str, StreamingQuery] = {}

    def raw(self, streaming: bool = False) -> DataFrame:
        """All scrapes that have landed."""
        reader = self.spark.readStream if streaming else self.spark.read
        return reader.schema(LANDED).parquet(runner._made(self.spark, f"{self.path}/raw"))

    def start(self) -> None:
        """Starts every query; if one cannot start, none is left running."""
        config, spark, path = self.config, self.spark, self.path
        registry = Registry.load(config.schema_dir)
        try:
            every = reduce(DataFrame.unionByName, [collected(spark, c) for c in config.collectors])
            self.queries["raw"] = runner._to_files(every, path, "raw", self.trigger)
            scraped = self.raw(streaming=True).where("payload IS NOT NULL").drop("status", "timed_out")
            done = runner.normalised(scraped, registry, path, config.key_ttl, self.delay, self.grace, self.trigger)
            self.queries |= dict(zip(("outcomes", "failures"), done, strict=True))
            if config.correlate:
                length, slide = (f"{x} seconds" for x in (config.window, config.slide))
                self.queries["events"] = runner.correlated(spark, path, length, slide, self.delay, registry.prefix, self.trigger, self.rules)
            if config.otlp_endpoint:
                writer = sinks.otlp_writer(config.otlp_endpoint, config.otlp_batch, config.otlp_headers)
                self.queries["otlp"] = runner.exported(runner.records(spark, path, streaming=True), "otlp", writer, path, trigger=self.trigger)
        except BaseException:
            self.stop(0)
            raise

    def stop(self, patience: float = 30.0) -> None:
        """Stops the queries in the order of the flow; together they get ``patience`` seconds to finish the batch that they are at."""
        until = time.monotonic() + patience
        for query in self.queries.values():
            while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
                time.sleep(0.05)
            query.stop()
        self.queries = {}

    def run(self, stopped: threading.Event, patience: float = 30.0) -> None:
        """Runs until ``stopped`` is set; a query that ends by itself ends all."""
        self.start()
        try:
            while not stopped.wait(0.5):
                for name, query in self.queries.items():
                    if not query.isActive:
                        raise ServiceError(f"{name} has stopped: {query.exception()}")
        finally:
            self.stop(patience)

    def telemetry(self, step: int = 15) -> DataFrame:
        """The run's own metrics, as ``alerts.evaluate`` takes them."""
        spark, path = self.spark, self.path
        failures = spark.read.schema(runner.FAILURES).parquet(runner._made(spark, f"{path}/failures"))
        return telemetry.of_run(self.raw(), runner.outcomes(spark, path), failures, runner.events(spark, path), step)
