"""Where raw records come from: collector options, landing files, bus messages, error classes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.transforms import seconds
from kpiloom.schema import RAW_JSON


@dataclass(frozen=True)
class Collector:
    """A configured source of one vendor's network function."""

    vendor: str
    nf_type: str
    endpoint: str
    interval: str = "15s"
    protocol: str = "prometheus"
    paths: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.endpoint:
            raise ValueError(f"{self.name}: no endpoint")
        if seconds(self.interval) <= 0:
            raise ValueError(f"{self.name}: interval must be positive")
        if self.protocol == "gnmi" and not self.paths:
            raise ValueError(f"{self.name}: gnmi needs paths")

    @property
    def name(self) -> str:
        return f"{self.vendor}-{self.nf_type.lower()}"


class Collectors:
    """Collector kinds by name; a name registered again replaces the earlier one."""

    def __init__(self) -> None:
        self._by_name: dict[str, dict] = {}

    def register(self, name: str, **options) -> None:
        self._by_name[name] = options

    def get(self, name: str, **options) -> Collector:
        if name not in self._by_name:
            raise KeyError(f"unknown collector {name!r}")
        return Collector(**(self._by_name[name] | options))

    def names(self) -> list[str]:
        return sorted(self._by_name)


#: The collectors that ship: two scraped vendors with three functions each, and one subscribed.
COLLECTORS = Collectors()
for _vendor in ("free5gc", "open5gs"):
    for _nf in ("AMF", "SMF", "UPF"):
        COLLECTORS.register(f"{_vendor}-{_nf.lower()}", vendor=_vendor, nf_type=_nf)
COLLECTORS.register("gnmi-gnb", vendor="oai", nf_type="gNB", protocol="gnmi")


def error_class(status: Column, timed_out: Column) -> Column:
    """auth (401, 403), network (any other status, or none), timeout (no status and timed out)."""
    return (
        F.when(status.isin(401, 403), "auth").when(status > 0, "network").when(F.coalesce(timed_out, F.lit(False)), "timeout").otherwise("network")
    )


def landed(spark: SparkSession, path: str, collector: Collector, streaming: bool = False) -> DataFrame:
    """Raw records from a landing folder of payload files, one scrape a file.

    The instance is the file's folder, so that two instances of a function keep
    apart; the file's time is the scrape's.
    """
    reader = spark.readStream if streaming else spark.read
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = reader.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.xxhash64("path", "modificationTime").alias("record_id"),
        F.lit(collector.vendor).alias("vendor"),
        F.lit(collector.nf_type).alias("nf_type"),
        F.element_at(F.split("path", "/"), -2).alias("instance_id"),
        F.lit(collector.endpoint).alias("endpoint"),
        F.col("content").alias("payload"),
        F.lit(collector.protocol).alias("protocol"),
        F.col("modificationTime").alias("timestamp"),
        F.lit(None).cast("map<string,string>").alias("meta"),
        F.lit("v1").alias("schema_version"),
    )


def from_bus(messages: DataFrame, value: str = "value") -> DataFrame:
    """Raw records from JSON messages of a bus (Kafka's ``value`` column, or a file's lines)."""
    r = F.from_json(F.col(value).cast("string"), RAW_JSON)
    return messages.select(F.xxhash64(value).alias("record_id"), r.alias("r")).select(
        "record_id",
        F.col("r.Source.Vendor").alias("vendor"),
        F.col("r.Source.NFType").alias("nf_type"),
        F.col("r.Source.InstanceID").alias("instance_id"),
        F.col("r.Source.Endpoint").alias("endpoint"),
        F.unbase64("r.Payload").alias("payload"),
        F.col("r.Protocol").alias("protocol"),
        F.col("r.Timestamp").alias("timestamp"),
        F.col("r.Meta").alias("meta"),
        F.col("r.SchemaVersion").alias("schema_version"),
    )


def bus(spark: SparkSession, topic: str, kind: str = "file", prefix: str = "", streaming: bool = True, **options) -> DataFrame:
    """Messages of a topic: Kafka where its connector is installed, else a folder of JSON lines per topic."""
    reader = spark.readStream if streaming else spark.read
    name = f"{prefix}.{topic}" if prefix else topic
    if kind == "kafka":
        return reader.format("kafka").option("subscribe", name).options(**options).load()
    if kind == "file":
        return reader.format("text").load(f"{options['path']}/{name}")
    raise ValueError(f"unknown bus {kind!r}")


def to_bus(rows: DataFrame) -> DataFrame:
    """Rows as one JSON ``value`` column."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))
