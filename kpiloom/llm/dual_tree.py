"""Centroid clustering by dual-tree Lloyd rounds, exact in integers.

Vectors are put into blocks once; a block is one row with its vectors in the
order of a cover tree over them, and is read again each round.  A round builds a
cover tree over the centroids and walks both trees together: a centroid node is
dropped for a vector node if even its nearest possible centroid is farther from
every vector than another centroid surely is.  A vector node with one centroid
left goes to it as a whole, by its sums; leaf pairs are compared exactly.  What
leaves a task is a count and a sum for each centroid.

Distances between nodes are floating-point bounds, widened by ``SLACK``; every
comparison that decides is in integers, so ties go to the smaller number.

Defined results: vectors of another length, with a null or non-finite component
or with a scaled component of ``LIMIT`` or more (whose distances no long holds)
take no part; vectors without id take part but never start a centroid; repeated
rows are vectors of their own; with fewer vectors than centroids there are as
many centroids as vectors; an empty table gives no rows.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._store import small_batches, stored

BLOCK, LEAF, LIMIT, SLACK = 1024, 16, 1 << 27, 1e-9


@dataclass
class CoverTree:
    """Nodes in depth-first order over rows ``order``: node i holds order[start[i]:end[i]] within ``radius[i]`` of row ``centre[i]``.

    ``skip[i]`` is the node after the subtree of i; i is a leaf if that is i + 1.
    """

    order: np.ndarray
    centre: np.ndarray
    start: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    skip: np.ndarray

    def children(self, i: int) -> list[int]:
        out, at = [], i + 1
        while at < self.skip[i]:
            out.append(at)
            at = int(self.skip[at])
        return out


def cover_tree(vectors: np.ndarray, leaf: int = LEAF, worth: int = 4) -> CoverTree:
    """A cover tree: a node's children lie within a power of two below its radius, and their centres farther apart than that.

    The first child keeps its parent's centre.  A node stays a leaf if it has up
    to ``leaf`` rows, all alike, or would have more than one child for ``worth``
    rows, as vectors without structure do.
    """
    centre, start, end, radius, skip, order = [], [], [], [], [], []
    values = vectors.astype(np.float64)

    def add(rows: np.ndarray, far: np.ndarray) -> None:
        """``rows`` with the first as centre, at distances ``far`` from it."""
        i, most = len(centre), float(far.max())
        centre.append(int(rows[0]))
        start.append(len(order))
        radius.append(most)
        end.append(0)
        skip.append(0)
        nets = []
        if len(rows) > leaf and most > 0:
            within = 2.0 ** (np.ceil(np.log2(most)) - 1)
            rest, apart = rows, far
            while len(rest) and len(nets) <= len(rows) // worth:
                near = apart <= within
                nets.append((rest[near], apart[near]))
                rest = rest[~near]
                if len(rest):
                    apart = np.sqrt(((values[rest] - values[rest[0]]) ** 2).sum(axis=1))
            if len(rest):
                nets = []
        if nets:
            for part in nets:
                add(*part)
        else:
            order.extend(rows.tolist())
        end[i], skip[i] = len(order), len(centre)

    rows = np.arange(len(vectors))
    add(rows, np.sqrt(((values - values[0]) ** 2).sum(axis=1)))
    return CoverTree(np.array(order), np.array(centre), np.array(start), np.array(end), np.array(radius), np.array(skip))


def nearest(vectors: np.ndarray, tree: CoverTree, centroids: np.ndarray) -> Iterator[tuple[int, int, int | np.ndarray]]:
    """(start, end, number or numbers) over the rows of ``vectors``, which lie in the order of ``tree``: their nearest centroids.

    A single number stands for all of a node's rows.
    """
    numbers = np.sort(np.unique(centroids, axis=0, return_index=True)[1])  # of equal centroids the smallest number wins
    points = centroids[numbers]
    upper = cover_tree(points, leaf=1, worth=1)
    floats, place = points.astype(np.float64), np.argsort(tree.order)
    stack = [(0, np.array([0]))]
    while stack:
        q, nodes = stack.pop()
        centre, r = vectors[place[tree.centre[q]]].astype(np.float64), tree.radius[q]
        while True:
            far = np.sqrt(((floats[upper.centre[nodes]] - centre) ** 2).sum(axis=1))
            sure = (far.min() + r) * (1 + SLACK) + SLACK
            nodes = nodes[far - r - upper.radius[nodes] <= sure]
            wide = (upper.skip[nodes] > nodes + 1) & (upper.radius[nodes] >= r)
            if not wide.any():
                break
            nodes = np.concatenate([nodes[~wide], *[upper.children(int(c)) for c in nodes[wide]]]).astype(np.int64)
        left = np.concatenate([upper.order[upper.start[c] : upper.end[c]] for c in nodes])
        lo, hi = int(tree.start[q]), int(tree.end[q])
        if len(left) == 1:
            yield lo, hi, int(numbers[left[0]])
        elif tree.skip[q] > q + 1:
            stack += [(c, nodes) for c in tree.children(q)]
        else:
            left = np.sort(left)
            apart = ((vectors[lo:hi, None, :] - points[left][None]) ** 2).sum(axis=2)
            yield lo, hi, numbers[left[apart.argmin(axis=1)]]


PACKED = "n int, ids binary, known binary, vectors binary, centre binary, start binary, end binary, radius binary, skip binary"


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Vectors (id, known, v) as blocks, each in the order of its tree."""

    def block(ids: list, known: list, vectors: list) -> pd.DataFrame:
        v = np.stack(vectors).astype(np.int64)
        t = cover_tree(v)
        rows = np.argsort(t.order)  # places in the block
        ints = {k: a.astype(np.int32).tobytes() for k, a in (("centre", rows[t.centre]), ("start", t.start), ("end", t.end), ("skip", t.skip))}
        one = {
            "n": len(v), "ids": np.array(ids, dtype=np.int64)[t.order].tobytes(), "known": np.array(known, dtype=bool)[t.order].tobytes(),
            "vectors": v[t.order].astype(np.int32).tobytes(), "radius": t.radius.tobytes(), **ints,
        }
        return pd.DataFrame([one])[["n", "ids", "known", "vectors", "centre", "start", "end", "radius", "skip"]]

    ids, known, vectors = [], [], []
    for b in batches:
        ids += b["id"].tolist()
        known += b["known"].tolist()
        vectors += b["v"].tolist()
        while len(ids) >= BLOCK:
            yield block(ids[:BLOCK], known[:BLOCK], vectors[:BLOCK])
            ids, known, vectors = ids[BLOCK:], known[BLOCK:], vectors[BLOCK:]
    if ids:
        yield block(ids, known, vectors)


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, CoverTree]]:
    for b in batches:
        for r in b.itertuples(index=False):
            ints = {k: np.frombuffer(getattr(r, k), dtype=np.int32).astype(np.int64) for k in ("centre", "start", "end", "skip")}
            vectors = np.frombuffer(r.vectors, dtype=np.int32).reshape(r.n, -1).astype(np.int64)
            tree = CoverTree(np.arange(r.n), radius=np.frombuffer(r.radius), **ints)
            yield np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.known, dtype=bool), vectors, tree


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = np.zeros(len(centroids), dtype=np.int64), np.zeros_like(centroids)
        for _, _, vectors, tree in _unpacked(batches):
            upto = np.concatenate([np.zeros((1, vectors.shape[1]), dtype=np.int64), np.cumsum(vectors, axis=0)])
            for lo, hi, found in nearest(vectors, tree, centroids):
                if isinstance(found, int):
                    count[found] += hi - lo
                    total[found] += upto[hi] - upto[lo]
                else:
                    np.add.at(count, found, 1)
                    np.add.at(total, found, vectors[lo:hi])
        held = np.flatnonzero(count)
        yield pd.DataFrame({"cluster": held, "n": count[held], "total": list(total[held])})

    return run


def _assigned(centroids: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, known, vectors, tree in _unpacked(batches):
            cluster = np.zeros(len(ids), dtype=np.int64)
            for lo, hi, found in nearest(vectors, tree, centroids):
                cluster[lo:hi] = found
            key = pd.array(ids, dtype="Int64")
            key[~known] = pd.NA
            yield pd.DataFrame({"id": key, "cluster": cluster, "distance": ((vectors - centroids[cluster]) ** 2).sum(axis=1)})

    return run


def kept(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", dims: int = 64, scale: float = 64.0) -> DataFrame:
    """(id, v) of the vectors that take part: floor(``scale`` * component) as integers."""
    scaled = vectors.select(F.col(key).cast("long").alias("id"), F.transform(column, lambda x: F.lit(scale) * x.cast("double")).alias("v"))
    usable = (F.size("v") == dims) & F.forall("v", lambda x: F.coalesce((F.abs(x) < LIMIT) & ~F.isnan(x), F.lit(False)))
    return scaled.where(F.coalesce(usable, F.lit(False))).select("id", F.transform("v", lambda x: F.floor(x).cast("int")).alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str = "1:") -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest SHA-256 after ``salt``, in that order."""
    rank = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    return np.array([r["v"] for r in vectors.where("id IS NOT NULL").orderBy(rank, "v").limit(k).collect()], dtype=np.int64)  # k rows


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, key: str = "vec_id", column: str = "embedding", dims: int = 64, scale: float = 64.0) -> DataFrame:
    """key, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector that takes part.

    Each of ``rounds`` assigns vectors to the nearest centroid and moves
    centroids that have any to the floor of their mean; then vectors are
    assigned once more.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    points = kept(vectors, key, column, dims, scale)
    known = points.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("known"), "v")
    blocks = stored(known.mapInPandas(_packed, PACKED))
    centroids = seeds(points, k)
    if not len(centroids):
        empty = f"`{key}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], empty)
    total = [F.sum(F.get("total", F.lit(j)).cast("decimal(38,0)")) for j in range(dims)]
    for _ in range(rounds):
        parts = blocks.mapInPandas(_sums(centroids), "cluster int, n long, total array<long>")
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*total).alias("total")).collect():  # a row a centroid
            centroids[r["cluster"]] = [int(x) // r["n"] for x in r["total"]]
    placed = stored(blocks.mapInPandas(_assigned(centroids), "id long, cluster int, distance long"))
    by_cluster = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row a centroid
    every = sum(r["cluster_inertia"] for r in by_cluster)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame(
        [(r["cluster"], r["cluster_inertia"], every, digest[r["cluster"]]) for r in by_cluster], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(known), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
