"""Contiguous shards of near equal byte size, cut at equal targets of a global prefix sum.

Rows are put in order of key, text checksum and size, and move once, to ranges
of that order.  Inside its range each task adds up sizes as it goes; what comes
before a range is the sum of the totals of the ranges before it, one number a
range.  A row belongs to the shard in which the middle of its bytes falls, so a
shard's size is off its target by at most half a row at each end.

Copies of one row are told apart by their place in the input, so a key or text
that a third of all rows have is spread over many ranges.

Defined results: a null text has no bytes and size 1; rows without key come
last; rows equal in key, checksum and size are interchangeable; repeated rows
are kept; an empty table gives no rows; a row larger than a shard's target may
leave shards empty.  Columns of ``docs`` named like those that are added
(``shard``, ``slot``, in any case) are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._store import stored

ADDED = ("shard", "slot")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text, and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def checksum(text: Column) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _running(sizes: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """What comes before each row in its partition: bytes and rows."""
    total = rows = 0
    for batch in sizes:
        n = batch.to_numpy(dtype=np.int64)
        ends = total + np.cumsum(n)
        yield pd.DataFrame({"before": ends - n, "at": rows + np.arange(len(n))})
        total, rows = int(ends[-1]) if len(n) else total, rows + len(n)


def sharded(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot``, a row's gapless place in its shard in the global order."""
    spark, t = docs.sparkSession, F.col(text).cast("string")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("k"), checksum(t).alias("c"), byte_size(t).alias("n"), F.monotonically_increasing_id().alias("tie")
    )
    running = F.pandas_udf(_running, "before long, at long").asNondeterministic()
    order = (F.col("k").asc_nulls_last(), "c", "n", "tie")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ranged.select("row", "n", F.spark_partition_id().alias("part"), running("n").alias("p")).select("row", "n", "part", "p.*"))
    totals = placed.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).orderBy("part").collect()  # one row a partition
    offsets, total, count = [], 0, 0
    for p in totals:
        offsets.append((p["part"], total, count))
        total, count = total + p["n"], count + p["rows"]
    known = spark.createDataFrame(offsets, "part int, bytes_before long, rows_before long")
    middle = "(CAST(before + bytes_before AS DECIMAL(20, 0)) * 2 + n)"  # twice the middle
    shard = F.least(F.lit(shards - 1), F.expr(f"CAST({middle} * {shards} div {2 * max(total, 1)} AS INT)"))
    cut = placed.join(F.broadcast(known), "part").withColumns({"shard": shard, "place": F.col("at") + F.col("rows_before")})
    first = cut.groupBy("shard").agg(F.min("place").alias("first"))  # one row a shard
    slot = F.col("place") - F.col("first")
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ADDED]
    return cut.join(F.broadcast(first), "shard").select(*own, "shard", slot.alias("slot"))


def manifest(assigned: DataFrame, text: str = "text") -> DataFrame:
    """(shard, rows, bytes) of ``sharded`` documents."""
    return assigned.groupBy("shard").agg(F.count("*").alias("rows"), F.sum(byte_size(F.col(text).cast("string"))).alias("bytes"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes ``path``/shard=N in the order of slots and returns the manifest of what was written."""
    sharded(docs, shards, key, text).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return manifest(docs.sparkSession.read.parquet(path), text)
