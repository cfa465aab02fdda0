"""Cutting lineage in storage that every executor can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset and Spark runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark not in _own:
        _own[spark] = tempfile.mkdtemp(prefix="kpiloom-")
    return _own[spark]


_own: dict[SparkSession, str] = {}


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back.

    A lost executor then costs a reread, not a recomputation, and the reread
    table has a known size, so Spark may broadcast it when it is small.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kpiloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(name: str, columns: Iterable[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


#: Rows and bytes at most in a batch of texts that goes to Python.
TEXT_BATCH, TEXT_BYTES = 1000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to TEXT_BATCH rows and TEXT_BYTES bytes, for this query and later ones.

    Spark reads these settings when a query is planned, so they belong to the
    session.  The default of 10,000 rows suits numbers; of texts it is tens of
    megabytes and more, which the executor and its Python worker each hold more
    than once.
    """
    for name, most in (("maxRecordsPerBatch", TEXT_BATCH), ("maxBytesPerBatch", TEXT_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(spark.conf.get(name).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))
