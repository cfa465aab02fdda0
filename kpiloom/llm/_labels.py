"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int, key: str = "doc_id") -> DataFrame:
    """(key, label) of the learning folds, one row a key; of repeated keys the larger label counts."""
    return (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where(F.col("key").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("key"), folds) != held_out))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )


def sample(training: DataFrame, rows: int, by_class: bool) -> DataFrame:
    """At most ``rows`` labelled keys (of each class, if asked), those with the smallest key hashes."""
    order = (F.xxhash64("key"), F.col("key"))
    if not by_class:
        return training.orderBy(*order).limit(rows)
    parts = [training.where(F.col("label") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    return parts[0].unionByName(parts[1])
