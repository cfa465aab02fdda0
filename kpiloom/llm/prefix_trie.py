"""Prefix trie of conversations: succinct level-order tries of prefix shards, merged where they meet.

Conversations are sorted by their turns, over ranges that Spark cuts, so all
that begin alike are neighbours, and copies that a third of all conversations
are spread over as many tasks as they fill.  A task cuts its range into prefix
shards of at most ``TURNS`` turns and builds of each a LOUDS bitvector with
arrays of labels, counts and bytes; what a node's subtree holds is added up by
reverse breadth-first ``add.at``.

In sorted order a node is new at the first conversation that has it, so every
figure is a sum over conversations: each adds its count, the bytes of the nodes
that are new with it, and one leaf if none that follows goes on from it.  A node
that two shards share (the upper levels, and the turns of frequent copies) is
therefore given as a partial row by both, and one grouping merges them.  Only
the ends of Spark's own ranges do not see their neighbours; a correction a range
takes back what was counted twice.

Turns are known by the MD5 of role and text.  A conversation's turns (16 bytes
and a size each) must fit a task; the ids of those that end in a frequent node
need not, they are hashed as a stream.

Defined results: rows without conversation id are left out; turns are in order
of their number (null first), then of their MD5; repeated rows are turns of
their own; null roles and texts are empty; an empty table has no nodes, not even
a root.  Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm._store import stored

#: Turns at most in a prefix shard; one longer conversation is a shard of its own.
TURNS = 100_000
#: Ids in one piece of a long list.
PIECE = 5_000
LABEL = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
SHARED = "id binary, parent_id binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
BUILT = f"kind string, {SHARED}, parent_conv_id long, ends string, part int, path binary, sizes array<long>"


def turn_lists(conversations: DataFrame, key: str = "conv_id", group: int = 1, head: int = 0) -> DataFrame:
    """(conv, path, sizes) of every conversation: the labels of its turns, joined, and the bytes of their texts.

    With ``head``, conversation c takes over the first h turns of conversation
    c - c % ``group`` for its own first h; h is crc32(c as text) % ``head``.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    label = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    conv = F.col(key).cast("long")
    turn = F.struct(F.col("turn").cast("long").alias("turn"), label.alias("label"), F.octet_length(text).cast("long").alias("n"))
    turns = conversations.where(conv.isNotNull()).select(conv.alias("conv"), (conv - conv % group).alias("lead"), turn.alias("t"))
    # one shuffle: a conversation lies with the one it takes turns from
    own = turns.repartition("lead").groupBy("lead", "conv").agg(F.sort_array(F.collect_list("t")).alias("own"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % head).cast("int") if head else F.lit(0)
    taken = F.max(F.when(F.col("conv") == F.col("lead"), F.slice("own", 1, max(head - 1, 0)))).over(Window.partitionBy("lead"))
    made = own.withColumns({"h": h, "taken": taken}).select(
        "conv", F.concat(F.slice(F.coalesce("taken", F.slice("own", 1, 0)), F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))).alias("t")
    )
    return made.select("conv", F.unhex(F.array_join(F.transform("t", lambda t: t["label"]), "")).alias("path"), F.transform("t", lambda t: t["n"]).alias("sizes"))


class Louds:
    """A trie in level order: bitvector, and a label for each node but the root.

    The bits are those of a super-root (10), then of each node a one for each
    child and a zero.
    """

    def __init__(self, parents: np.ndarray, labels: np.ndarray):
        """``parents`` of nodes 1, 2, ... in level order (not falling), and their ``labels``."""
        n = len(parents) + 1
        self.bits = np.zeros(2 * n + 1, dtype=bool)
        self.bits[0] = True
        self.bits[2 + np.arange(n - 1) + parents] = True
        self.labels = labels

    def __len__(self) -> int:
        return len(self.bits) // 2

    def parents(self) -> np.ndarray:
        """Parents of nodes 1, 2, ...: of the one numbered v at place p, zeros before p, less the super-root's."""
        ones = np.flatnonzero(self.bits)[1:]
        return ones - np.arange(1, len(ones) + 1) - 1

    def degrees(self) -> np.ndarray:
        """Children of every node: the ones between two zeros."""
        zeros = np.flatnonzero(~self.bits)
        return np.diff(zeros) - 1


def shared_labels(a: bytes, b: bytes) -> int:
    """How many leading labels two paths share."""
    n = min(len(a), len(b)) // LABEL
    x, y = (np.frombuffer(p, dtype=np.uint64, count=2 * n).reshape(n, 2) for p in (a, b))
    apart = np.flatnonzero((x != y).any(axis=1))
    return int(apart[0]) if len(apart) else n


def prefix_ids(path: bytes) -> list[bytes]:
    """An id for each prefix of a path, from the root's on."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for at in range(0, len(path), LABEL):
        h.update(path[at : at + LABEL])
        out.append(h.digest())
    return out


def _neighbours(labels: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Leading labels that each path but the first shares with the one before."""
    n = np.minimum(lens[1:], lens[:-1])
    begins = np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n
    place = np.arange(n.sum()) - np.repeat(begins, n)
    a, b = (labels[np.repeat(s, n) + place] for s in (starts[:-1], starts[1:]))
    out = n.copy()
    apart = np.flatnonzero((a != b).any(axis=1))
    np.minimum.at(out, np.repeat(np.arange(len(n)), n)[apart], place[apart])
    return out


class Shard:
    """The trie of some sorted conversations, of which those before and after share ``left`` and ``right`` labels with its ends (None: unknown)."""

    def __init__(self, convs: np.ndarray, paths: list[bytes], sizes: list[np.ndarray], left: int | None, right: int | None):
        self.convs, self.paths = convs, paths
        self.lens = np.array([len(p) // LABEL for p in paths], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(self.lens)[:-1]])
        labels = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
        held = np.concatenate([np.asarray(s, dtype=np.int64) for s in sizes]) if len(sizes) else np.zeros(0, dtype=np.int64)
        self.like_before = np.concatenate([[-1], _neighbours(labels, starts, self.lens)])
        m = len(paths)
        at = np.zeros(m, dtype=np.int64)  # each conversation's node on the level reached
        alive, offset = np.arange(m), 1
        parents, firsts, tops, self.levels = [np.zeros(0, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)], [0, 1]
        counts, least = [np.array([m])], [np.array([convs.min()])]
        self.leftmost, self.rightmost = [0], [0]
        for d in range(1, int(self.lens.max(initial=0)) + 1):
            alive = alive[self.lens[alive] >= d]
            new = self.like_before[alive] < d
            node = np.cumsum(new) - 1
            parents.append(at[alive[new]])
            firsts.append(alive[new])
            tops.append(starts[alive[new]] + d - 1)
            at[alive] = offset + node
            counts.append(np.bincount(node))
            low = np.full(len(counts[-1]), np.iinfo(np.int64).max)
            np.minimum.at(low, node, convs[alive])
            least.append(low)
            if alive[0] == 0:
                self.leftmost.append(offset)
            offset += len(low)
            if alive[-1] == m - 1:
                self.rightmost.append(offset - 1)
            self.levels.append(offset)
        self.ends = at
        top = np.concatenate(tops[1:]) if len(tops) > 1 else np.zeros(0, dtype=np.int64)
        self.trie = Louds(np.concatenate(parents), labels[top])
        self.counts, self.least = np.concatenate(counts), np.concatenate(least)
        self.depths = np.repeat(np.arange(len(self.levels) - 1), np.diff(self.levels))
        size = np.concatenate([[0], held[top]])
        # new: no conversation before has the node
        new = (np.concatenate(firsts) > 0) | (self.depths > (-1 if left is None else left))
        follows = np.concatenate([self.like_before[1:], [-1 if right is None else right]])
        self.parents = self.trie.parents()
        self.children = np.zeros(len(size), dtype=np.int64)
        np.add.at(self.children, self.parents, new[1:].astype(np.int64))
        self.leaves = np.zeros(len(size), dtype=np.int64)
        np.add.at(self.leaves, self.ends, (follows < self.lens).astype(np.int64))
        self.saved = (self.counts - new) * size
        self._roll_up(self.leaves)
        self._roll_up(self.saved)
        self.left = int(self.lens[0]) if left is None else left
        self.right = int(self.lens[-1]) if right is None else right

    def _roll_up(self, values: np.ndarray) -> None:
        """Adds every node's value to its parent's, from the deepest level up."""
        for lo, hi in zip(self.levels[-2:0:-1], self.levels[:1:-1], strict=True):
            np.add.at(values, self.parents[lo - 1 : hi - 1], values[lo:hi])

    def shared(self) -> dict[int, bytes]:
        """Nodes that other shards may have too, with their ids."""
        out = {}
        for nodes, path, depth in ((self.leftmost, self.paths[0], self.left), (self.rightmost, self.paths[-1], self.right)):
            out |= dict(zip(nodes[: depth + 1], prefix_ids(path[: depth * LABEL]), strict=True))
        return out

    def runs(self) -> Iterator[tuple[int, np.ndarray]]:
        """(node, ids of the conversations that end there, ascending)."""
        starts = np.flatnonzero(np.concatenate([[True], self.ends[1:] != self.ends[:-1]]))
        for s, e in zip(starts, [*starts[1:], len(self.ends)], strict=True):
            yield int(self.ends[s]), self.convs[s:e]

    def rows(self) -> Iterator[pd.DataFrame]:
        ids = self.shared()
        sha, pieces = np.full(len(self.counts), NO_ENDS, dtype=object), []
        for node, convs in self.runs():
            if node in ids:
                pieces += [(ids[node], int(convs[i]), ",".join(map(str, convs[i : i + PIECE].tolist()))) for i in range(0, len(convs), PIECE)]
            else:
                sha[node] = hashlib.sha256(",".join(map(str, convs.tolist())).encode()).hexdigest()
        n = len(self.counts)
        parent = np.concatenate([[-1], self.parents])
        is_shared = np.zeros(n, dtype=bool)
        is_shared[list(ids)] = True
        of_shared = (parent >= 0) & is_shared[parent]
        above = pd.array(np.where(parent < 0, 0, self.least[parent]), dtype="Int64")
        above[is_shared | of_shared | (parent < 0)] = pd.NA
        yield pd.DataFrame(
            {
                "kind": np.where(is_shared, "shared", "node"), "id": [ids.get(v) for v in range(n)], "parent_id": [ids.get(p) for p in parent.tolist()], "conv_id": self.least,
                "depth": self.depths, "n_convs": self.counts, "n_children": self.children, "n_leaves": self.leaves, "saved_tokens": self.saved,
                "parent_conv_id": above, "ends": np.where(is_shared, None, sha), "part": None, "path": None, "sizes": None,
            }
        )
        if pieces:
            yield _table("piece", id=[p[0] for p in pieces], conv_id=[p[1] for p in pieces], ends=[p[2] for p in pieces])


def _table(kind: str, **columns: list) -> pd.DataFrame:
    """Rows of BUILT with some of its columns."""
    out = pd.DataFrame({"kind": kind, **columns})
    for c in ("id", "parent_id", "conv_id", "depth", *FIGURES, "parent_conv_id", "ends", "part", "path", "sizes"):
        if c not in out:
            out[c] = None
    return out[["kind", "id", "parent_id", "conv_id", "depth", *FIGURES, "parent_conv_id", "ends", "part", "path", "sizes"]]


def _shards(most: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Tries of a range of sorted conversations (conv, path, sizes), a shard of ``most`` turns at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        turns, before = 0, None

        def cut(after: tuple | None) -> Iterator[pd.DataFrame]:
            left = None if before is None else shared_labels(before[1], held[0][1])
            right = None if after is None else shared_labels(held[-1][1], after[1])
            yield from Shard(np.array([h[0] for h in held], dtype=np.int64), [h[1] for h in held], [h[2] for h in held], left, right).rows()

        for b in batches:
            for row in zip(b["conv"].tolist(), b["path"].tolist(), b["sizes"].tolist(), strict=True):
                row = (row[0], bytes(row[1]), row[2])
                if not held and before is None:
                    yield _table("first", part=[part], path=[row[1]], sizes=[row[2]])
                elif turns + len(row[1]) // LABEL + 1 > most:
                    yield from cut(row)
                    before, held, turns = held[-1], [], 0
                held.append(row)
                turns += len(row[1]) // LABEL + 1
        if held:
            yield from cut(None)
            yield _table("last", part=[part], path=[held[-1][1]], sizes=[held[-1][2]])

    return run


def _corrections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What two neighbouring ranges counted twice: nodes new in both, and a leaf that goes on in the next."""
    for b in batches:
        for last, first, sizes in zip(b["last"].tolist(), b["first"].tolist(), b["sizes"].tolist(), strict=True):
            n, size = shared_labels(last, first), np.asarray(sizes, dtype=np.int64)
            more = np.concatenate([np.cumsum(size[:n][::-1])[::-1], [0]]) if n else np.zeros(1, dtype=np.int64)
            saved = np.concatenate([[more[0]], more[:n]]).astype(np.int64)
            leaf = -1 if n == len(last) // LABEL else 0
            yield pd.DataFrame(
                {"id": prefix_ids(first[: n * LABEL]), "n_convs": 0, "n_children": [-1] * n + [0], "n_leaves": leaf, "saved_tokens": saved}
            )


def _streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, ends_sha256) of pieces in order of id and place; no list is held as a whole."""
    now, h = None, None
    for b in batches:
        done = []
        for node, ends in zip(b["id"].tolist(), b["ends"].tolist(), strict=True):
            node = bytes(node)
            if node != now:
                if h is not None:
                    done.append((now, h.hexdigest()))
                now, h = node, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ends.encode())
        yield pd.DataFrame(done, columns=["id", "ends_sha256"])
    if h is not None:
        yield pd.DataFrame([(now, h.hexdigest())], columns=["id", "ends_sha256"])


def trie(lists: DataFrame, most: int = TURNS) -> DataFrame:
    """The nodes of the prefix trie of ``turn_lists``.

    Of each: conv_id (its smallest member), depth, parent_conv_id (null: the
    root), n_convs, n_children, n_leaves and saved_tokens (of its subtree), and
    ends_sha256 (of the ids, joined by commas, that end there).
    """
    ranged = lists.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    built = stored(ranged.mapInPandas(_shards(most), BUILT))
    # two rows a range of Spark's
    edges = built.where("kind = 'first'").select("part", F.col("path").alias("first"), "sizes").join(built.where("kind = 'last'").select("part", F.col("path").alias("last")), "part")
    before = edges.withColumn("last", F.lag("last").over(Window.orderBy("part"))).where("last IS NOT NULL")
    twice = before.select("last", "first", "sizes").mapInPandas(_corrections, "id binary, n_convs long, n_children long, n_leaves long, saved_tokens long")
    partial = built.where("kind = 'shared'").select("id", "parent_id", "conv_id", "depth", *FIGURES)
    every = partial.unionByName(twice, allowMissingColumns=True)
    merged = every.groupBy("id").agg(F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in FIGURES])
    pieces = built.where("kind = 'piece'").select("id", "conv_id", "ends").repartition("id").sortWithinPartitions("id", "conv_id")
    upper = stored(merged.join(pieces.mapInPandas(_streamed, "id binary, ends_sha256 string"), "id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))))
    above = upper.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    out = ("conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256")
    lower = built.where("kind = 'node'").withColumnRenamed("ends", "ends_sha256")
    return (
        upper.join(above, "parent_id", "left").select(*out)
        .unionByName(lower.where("parent_id IS NULL").select(*out))
        .unionByName(lower.where("parent_id IS NOT NULL").drop("parent_conv_id").join(above, "parent_id").select(*out))
    )
