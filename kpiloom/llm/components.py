"""Connected components of a graph given by its links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._store import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node.

    Self-links and repeated links are allowed.  Groups are reduced by minima
    that combine before the shuffle, and every round is written to shared
    storage, so neither a large component nor a lost executor stops it.
    """
    now = stored(links.where("a <> b").select("a", "b").distinct())
    alone = links.where("a = b").select("a").distinct()
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).alias("m")
    last = None
    while True:
        seen = now.select(mark).first()["m"]
        if seen == last or not seen["n"]:
            break
        last = seen
        now = stored(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("a")).distinct()
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("root"))
    )
    rest = alone.join(out.select(F.col("node").alias("a")), "a", "left_anti")
    return out.unionByName(rest.select(F.col("a").alias("node"), F.col("a").alias("root")))
