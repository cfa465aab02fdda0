"""Exact top-k inner products by norm-bucketed retrieval.

Components x become floor(256 * x).  Candidates are sorted by length into
buckets of at most ``BUCKET`` vectors, queries into blocks of at most
``BLOCK``.  Buckets are numbered as they are written, so their number need not
be known beforehand.

The k-th score of a query within the buckets of longest vectors bounds its
answer from below.  That bound, divided by the query's length, is the length a
candidate must have.  Tables of one row a block and one row a bucket are joined
on classes of that length, and only pairs of block and bucket that may hold an
answer get their vectors.  In a bucket, the bound divided by the lengths is the
cosine a candidate must reach: above ``COORDINATE`` candidates are pruned by the
query's strongest coordinate, whose value must lie in a range that the cosine
allows; otherwise by length alone.  The products of what remains are computed
and verified exactly.

Defined results: vectors that are null, or hold a null, NaN or infinite
component, take no part, nor do rows without vec_id; a missing component of a
shorter vector counts as 0; ties go to the smaller vec_id; rows with the query's
vec_id are its own and no candidates; queries with fewer candidates return them
all; repeated rows are candidates each, and a repeated query is answered once;
components beyond a long's range count as its limits, and so do scores; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm._store import stored

SCALE = 256
BUCKET = 4096
BLOCK = 1024
COORDINATE = 0.8
#: Up to this product of lengths float64 sums of integers are exact.
EXACT = float(1 << 52)
LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v, norm) of the vectors that take part; v is the array of floor(256 * x)."""
    def finite(c):
        return F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))

    return (
        vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))
        .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE).cast("double")).alias("v"))
        .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, c: total + c * c)))
    )


#: Buckets and blocks are told apart by classes of length, eight to each doubling.
_CLASSES = 8


def _class(norm: Column) -> Column:
    """A whole number that grows with the length; all lengths below 1 share one."""
    return F.when(norm > 1, F.floor(F.log2(norm) * _CLASSES)).otherwise(0).cast("int")


def _matrix(m: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(m, np.dtype(kind)).reshape(n, -1).astype(np.float64)


def _blocks(size: int):
    """Each partition's rows packed, in their order, into blocks of at most ``size`` vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), size):
                c = b.iloc[at : at + size]
                m = np.zeros((len(c), max(map(len, c["v"]))))
                for row, v in zip(m, c["v"], strict=True):
                    row[: len(v)] = v
                kind = "<i2" if not m.size or np.abs(m).max() < 1 << 15 else "<f8"
                packed = [c[x].to_numpy(dtype=t).tobytes() for x, t in (("vec_id", np.int64), ("norm", np.float64), ("least", np.float64))]
                norm, least = c["norm"].to_numpy(dtype=float), c["least"].to_numpy(dtype=float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where((least > 0) & (norm > 0), least / norm, np.where(least > 0, np.inf, 0.0)).min()
                yield pd.DataFrame(
                    [(packed[0], m.astype(kind).tobytes(), kind, packed[1], packed[2], len(c), norm.max(), need)],
                    columns=["ids", "m", "kind", "norms", "least", "n", "longest", "need"],
                )

    return run


_PACKED = "ids binary, m binary, kind string, norms binary, least binary, n int, longest double, need double"


def best(q: np.ndarray, q_id: int, q_norm: float, m: np.ndarray, ids: np.ndarray, norms: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
    """(score, vec_id) of the k best candidates of a bucket that score ``least`` or more.

    The bucket's rows are in falling order of length.
    """
    if not len(ids):
        return []
    width = min(len(q), m.shape[1])
    q, m = q[:width], m[:, :width]
    if least > 0 and q_norm > 0:
        need = least / q_norm
        cosine = need / norms[0] if norms[0] > 0 else np.inf
        if cosine > 1 + 1e-9:
            return []
        long_enough = int(np.searchsorted(-norms, -need * (1 - 1e-12), side="right"))
        m, ids, norms = m[:long_enough], ids[:long_enough], norms[:long_enough]
        if cosine >= COORDINATE and width:
            f = int(np.argmax(np.abs(q)))
            x = q[f] / q_norm
            slack = np.sqrt(max(0.0, 1 - cosine * cosine) * max(0.0, 1 - x * x)) + 1e-9
            unit = m[:, f] / np.maximum(norms, 1e-300)
            # of unit vectors with that cosine, coordinate f lies within slack of cosine * x, or beyond it on x's side
            low = cosine * x - slack if x >= 0 or -x < cosine else -1.0
            high = cosine * x + slack if x < 0 or x < cosine else 1.0
            rows = np.flatnonzero((unit >= low - 1e-9) & (unit <= high + 1e-9))
            m, ids = m[rows], ids[rows]
    if not len(ids):
        return []
    if q_norm * norms.max() <= EXACT:
        scores = m @ q
    else:
        whole = [int(c) for c in q]
        exact = (sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in m)
        scores = np.array([min(max(x, -LONG - 1), LONG) for x in exact], dtype=object)
    keep = ids != q_id
    scores, ids = scores[keep], ids[keep]
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= max(kth, least))
        if len(at) > 4 * k:  # many ties: the smallest ids of them
            tied, more = at[scores[at] == kth], at[scores[at] > kth]
            tied = tied[np.argpartition(ids[tied], min(k, len(tied) - 1))[:k]]
            at = np.concatenate([more, tied])
        scores, ids = scores[at], ids[at]
    found = sorted(((int(s), int(i)) for s, i in zip(scores, ids, strict=True)), key=lambda t: (-t[0], t[1]))
    return [t for t in found if t[0] >= least][:k]


def _searched(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                q_ids, q, q_norms = np.frombuffer(r.q_ids, np.int64), _matrix(r.q_m, r.q_kind, r.q_n), np.frombuffer(r.q_norms, np.float64)
                ids, m, norms = np.frombuffer(r.ids, np.int64), _matrix(r.m, r.kind, r.n), np.frombuffer(r.norms, np.float64)
                rows = [
                    (int(i), vec_id, score)
                    for i, v, norm, low in zip(q_ids, q, q_norms, np.frombuffer(r.q_least, np.float64), strict=True)
                    for score, vec_id in best(v, i, norm, m, ids, norms, k, low)
                ]
                if rows:
                    yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of ``vectors`` for every row of ``queries``."""
    rows = stored(quantised(vectors, key, vector))
    asked = stored(quantised(queries, key, vector).dropDuplicates(["vec_id"]))
    parts = max(1, -(-rows.count() // BUCKET))
    query_parts = max(1, -(-asked.count() // BLOCK))
    no_bound = F.lit(float("-inf")).alias("least")
    buckets = stored(
        rows.repartitionByRange(parts, F.desc("norm"), "vec_id")
        .sortWithinPartitions(F.desc("norm"), "vec_id")
        .select("*", no_bound)
        .mapInPandas(_blocks(BUCKET), _PACKED)
        .drop("least", "need")
        .withColumn("bucket", F.monotonically_increasing_id())
    )
    sizes = buckets.select("bucket", "n", "longest")

    def search(bounded: DataFrame, pairs) -> DataFrame:
        blocks = stored(bounded.mapInPandas(_blocks(BLOCK), _PACKED).withColumn("block", F.monotonically_increasing_id()))
        held = blocks.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "m", "kind", "norms", "least", "n")], "block")
        met = pairs(blocks.select("block", "need")).join(held, "block").join(buckets, "bucket")
        return met.mapInPandas(_searched(k), "query_id long, vec_id long, score long")

    # the longest buckets that hold k candidates besides the query itself: each has one vector or more, so k + 1 are enough
    top, held = [], 0
    for r in sizes.orderBy(F.desc("longest"), "bucket").limit(k + 1).collect():
        if held <= k:
            top.append(r["bucket"])
            held += r["n"]
    first = F.explode(F.array(*map(F.lit, top)) if top else F.array().cast("array<long>"))
    found = stored(search(asked.select("*", no_bound).repartition(query_parts, "vec_id"), lambda b: b.select("block", first.alias("bucket"))))
    kth = found.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))  # k of each of k + 1 buckets at most
    bound = F.coalesce(F.get("s", F.lit(k - 1)).cast("double"), F.lit(float("-inf")))
    bounded = asked.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select(*asked.columns, bound.alias("least"))
    ordered = bounded.repartitionByRange(query_parts, F.col("least") / F.greatest("norm", F.lit(1.0)), "vec_id")
    rest = sizes.where(~F.col("bucket").isin(top)).withColumn("class", _class(F.col("longest")))
    classes = sorted(r["class"] for r in rest.select("class").distinct().collect())  # a few hundred at most: the range of doubles

    def surviving(blocks: DataFrame) -> DataFrame:
        reached = F.filter(F.array(*map(F.lit, classes)), lambda c: c >= _class(F.col("need")))
        met = blocks.select("block", "need", F.explode(reached).alias("class")).join(rest, "class")
        return met.where(F.col("longest") >= F.col("need") * (1 - 1e-9)).select("block", "bucket")

    if classes:
        found = found.unionByName(search(ordered, surviving))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
