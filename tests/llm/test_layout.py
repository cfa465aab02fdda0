"""Shards, prefix tries and centroids against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import dual_tree, prefix_trie, sharding

# -- shards -----------------------------------------------------------------------------------------


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("partitions", [1, 7])
def test_shards_are_contiguous_and_of_near_equal_size(spark, partitions):
    rng = random.Random(3)
    docs = [(i, "é" * rng.randrange(50) if i % 3 else "copy") for i in range(600)] + [(7, "hot") for _ in range(300)]
    docs += [(None, "no key"), (5, None), (6, ""), (8, "x" * 900)]
    df = spark.createDataFrame([(*d, 9, "s") for d in docs], "doc_id long, text string, Shard int, part string").repartition(partitions)
    out = sharding.sharded(df, 8)
    assert out.columns == ["doc_id", "text", "part", "shard", "slot"]
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, zlib.crc32((d[1] or "").encode()), len((d[1] or "").encode())))
    size = [len((t or "").encode()) + 1 for _, t in order]
    total, before, want, places = sum(size), 0, [], [0] * 8
    for (i, t), n in zip(order, size, strict=True):
        k = min(7, (2 * before + n) * 8 // (2 * total))
        want.append((i, t, k, places[k]))
        places[k] += 1
        before += n
    text = lambda rows: sorted(map(str, rows))
    assert text(rows_of(out, "doc_id", "text", "shard", "slot")) == text(want)
    held = {r.shard: r.bytes for r in sharding.manifest(out).collect()}
    assert max(abs(b - total / 8) for b in held.values()) <= 901 / 2 + 901 / 2
    assert sharding.sharded(df.limit(0)).count() == 0


def test_shards_are_written_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * (i % 13)) for i in range(200)], "doc_id long, text string")
    found = sharding.write_shards(docs, str(tmp_path / "out"), 4)
    assert sum(r.rows for r in found.collect()) == 200 and found.count() == 4
    for k in range(4):
        ids = [r.doc_id for r in spark.read.parquet(str(tmp_path / "out" / f"shard={k}")).orderBy("slot").collect()]
        assert ids == list(range(ids[0], ids[0] + len(ids)))


# -- prefix trie --------------------------------------------------------------------------------------


def plain_trie(conversations, group=1, head=0):
    turns = {}
    for c, turn, role, text in conversations:
        if c is not None:
            role, text = role or "", text or ""
            label = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append(((turn is not None, turn or 0, label), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % head if head else 0
        made[c] = own.get(c - c % group, [])[:h] + ts[h:]
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    out = []
    for n, held in members.items():
        under = [m for m in members if m[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(held) if len(made[c]) == len(n))
        out.append((
            min(held), len(n), min(members[n[:-1]]) if n else None, len(held), len(children.get(n, [])), sum(m not in children for m in under),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in under if m), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(map(str, out))


NODE = ("conv_id", "depth", "parent_conv_id", *prefix_trie.FIGURES, "ends_sha256")


@pytest.mark.parametrize(("most", "partitions", "group", "head"), [(100_000, 1, 1, 0), (7, 5, 1, 0), (1, 3, 1, 0), (40, 4, 5, 9)])
def test_tries_equal_a_plain_one(spark, monkeypatch, most, partitions, group, head):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rng = random.Random(most)
    say = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["é", "bb", "ccc", None]))
    rows = []
    for c in range(60):
        turns = [say() for _ in range(rng.choice([1, 1, 2, 3, 5]))]
        turns = [("user", "hot"), ("assistant", "hot too")] if c % 3 == 0 else turns
        rows += [(c * 2, i, *t) for i, t in enumerate(turns)]
    rows += [(999, i, "user", "long") for i in range(30)] + [(5, None, "user", "first"), (None, 1, "user", "lost"), (8, 1, "user", "x"), (8, 1, "user", "x"), (8, 1, "user", "y")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn int, role string, text string, id int, path string").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = prefix_trie.trie(prefix_trie.turn_lists(df, group=group, head=head), most)
        assert sorted(str(tuple(r)) for r in got.select(*NODE).collect()) == plain_trie(rows, group, head)
        assert prefix_trie.trie(prefix_trie.turn_lists(df.limit(0), group=group, head=head)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_louds_gives_back_parents_and_degrees():
    rng = random.Random(1)
    parents = np.array(sorted(rng.randrange(max(1, i // 2)) for i in range(1, 200)))
    trie = prefix_trie.Louds(parents, np.zeros((199, 2)))
    assert len(trie) == 200 and (trie.parents() == parents).all()
    assert (trie.degrees() == np.bincount(parents, minlength=200)).all() and trie.bits.sum() == 200


# -- centroids ----------------------------------------------------------------------------------------


def plain_lloyd(vectors, k=16, rounds=3):
    """(id, cluster, distance, inertia of the cluster, inertia, digest) of vectors (id, integers)."""
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)
    centroids = [list(v) for _, v in order[:k]]

    def assign():
        apart = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in vectors]
        return [(d.index(min(d)), min(d)) for d in apart]

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (a, _) in zip(vectors, found, strict=True) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    total = {c: sum(d for a, d in found if a == c) for c, _ in found}
    return sorted(str((i, c, d, total[c], sum(total.values()), digest[c])) for (i, _), (c, d) in zip(vectors, found, strict=True))


def test_centroids_equal_plain_rounds(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK", 100)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 64)) * 0.5
    vectors = [(i, (centres[i % 6] + rng.normal(size=64) * (0.02 if i % 2 else 0.3)).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(200)] + [(7, vectors[3][1]), (7, vectors[4][1]), (None, vectors[5][1])]
    bad = [(2000, None), (2001, [0.0] * 63), (2002, [0.0] * 63 + [None]), (2003, [0.0] * 63 + [float("nan")]), (2004, [float("inf")] + [0.0] * 63), (2005, [1e30] * 64)]
    df = spark.createDataFrame([(*v, 1, 2) for v in vectors + bad], "vec_id long, embedding array<double>, cluster int, id int").repartition(3)
    want = plain_lloyd([(i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors])
    got = dual_tree.cluster(df)
    assert sorted(str(tuple(r)) for r in got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()) == want
    assert dual_tree.cluster(df.limit(0)).count() == 0
    few = df.where(F.col("vec_id").isin(1, 2, 3))
    assert {r.distance for r in dual_tree.cluster(few).collect()} == {0}


def test_trees_cover_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 64)) * 60
    v = np.floor(centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 64)) * 2).astype(np.int64)
    v[100:200] = v[0]
    tree = dual_tree.cover_tree(v)
    assert sorted(tree.order.tolist()) == list(range(900))
    for i in range(len(tree.centre)):
        held = tree.order[tree.start[i] : tree.end[i]]
        far = np.sqrt(((v[held] - v[tree.centre[i]]) ** 2).sum(axis=1))
        assert far.max() == tree.radius[i] and tree.centre[i] in held
        kids = tree.children(i)
        if kids:
            assert kids[0] == i + 1 and tree.centre[kids[0]] == tree.centre[i]  # nesting
            scale = 2.0 ** (np.ceil(np.log2(tree.radius[i])) - 1)
            tops = v[tree.centre[kids]].astype(float)
            apart = np.sqrt(((tops[:, None] - tops[None]) ** 2).sum(axis=2))[np.triu_indices(len(kids), 1)]
            assert max(tree.radius[k] for k in kids) <= scale and (apart > scale).all()
    centroids = np.concatenate([np.floor(centres).astype(np.int64), np.floor(centres[:2]).astype(np.int64), v[:2]])
    ordered, compared = v[tree.order], 0
    for lo, hi, found in dual_tree.nearest(ordered, tree, centroids):
        apart = ((ordered[lo:hi, None] - centroids[None]) ** 2).sum(axis=2)
        assert (apart.argmin(axis=1) == found).all()
        compared += 0 if isinstance(found, int) else hi - lo
    assert compared < 450
