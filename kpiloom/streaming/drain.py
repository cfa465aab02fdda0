"""Running a stream over what is there, for tests, backfills and queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.streaming.counters import ROCKSDB

#: Later than any sample and its windows.
END = "9000-01-01 00:00:00"


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kpiloom-")
    return f"{base}/stream-{uuid.uuid4().hex}"


def with_end(stream: DataFrame, ts: str = "ts") -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` with a second source, and the function by which that source sends its one row, all null but the time ``END``.

    The row takes the watermark past everything else that was read, so what
    waits for event time is given; the row itself stays in state.
    """
    spark = stream.sparkSession
    path = f"{_folder(spark)}/end"
    # columns that are never null in the stream may be null here
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    last = spark.range(1).select(*[(F.lit(END) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in stream.schema])
    last.limit(0).write.parquet(path)
    return stream.unionByName(spark.readStream.schema(schema).parquet(path)), lambda: last.write.mode("append").parquet(path)


def drained(stream: DataFrame, mode: str = "append", end: Callable[[], None] | None = None) -> DataFrame:
    """What a stream yields from its present input: its rows, or in ``complete`` mode its last result.

    With ``end``, from ``with_end``, it is run to the end of its input first, then ended and run on.
    State, checkpoints and rows lie under ``spark.checkpoint.dir``; a local
    folder serves only where that is unset.
    """
    spark = stream.sparkSession
    path = _folder(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer = writer.format("parquet").option("path", f"{path}/rows")
    else:
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/rows"))
    writer.start().awaitTermination()
    if end is not None:
        end()
        writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
