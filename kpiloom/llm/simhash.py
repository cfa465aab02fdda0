"""SimHash near-duplicate detection with Golay fuzzy hashing.

Every text gets a 64-bit fingerprint.  It is cut into segments of 23, 23 and 18
bits.  Fingerprints that differ in at most 2 bits agree on one whole segment,
and the next segment differs in at most 2 bits, so they share one of its Golay
keys: (whole segment, key of the next) is a join key.  Members of a bucket are
verified in linear time.

Equal fingerprints are merged before anything is joined, so groups of copies
cost one row.  Fingerprints that share a bucket with another are candidates.
They are verified without forming the pairs of a bucket, however full: two
fingerprints differ in at most 2 bits if and only if a word lies within one bit
of both, so each candidate meets the others at its 65 words, of which none has
more than 65 fingerprints.

Defined results: null and empty texts have fingerprint zero and are linked like
any others; repeated rows are kept; rows with a null key are linked too and
give no component id (a component without any key has a null id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm import golay
from kpiloom.llm._store import free_name, stored
from kpiloom.llm._tokens import mixed
from kpiloom.llm.components import components

BITS, DISTANCE, SEED = 64, 2, 42
_CUTS = (0, 23, 46, 64)


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included, of the text with A-Z lowered.

    Words are split at spaces and bytes 9 to 13; fewer words make one shingle, none make none.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(parts)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.array([digest(joined[s:e], seed) for s, e in spans], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp) of every row; fp is the fingerprint's 64 bits as a long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(shingle_hashes(t, words)) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(key).alias("key"), run(F.coalesce(F.col(text), F.lit(""))).alias("fp"))


def _bucket_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = b["fp"].to_numpy(dtype=np.int64)
        word = fp.view(np.uint64)
        segments = [
            (word >> np.uint64(lo) & np.uint64((1 << hi - lo) - 1)).astype(np.int64)
            for lo, hi in zip(_CUTS, _CUTS[1:], strict=False)
        ]
        for i, whole in enumerate(segments):
            place, key = golay.keys(segments[(i + 1) % len(segments)])
            yield pd.DataFrame({"k": i << 40 | whole[place] << 12 | key, "fp": fp[place]})


def _ball(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(BITS, dtype=np.uint64)]).astype(np.uint64)
    for b in batches:
        fp = b["fp"].to_numpy(dtype=np.int64)
        yield pd.DataFrame({"w": (fp.view(np.uint64)[:, None] ^ flips).ravel().view(np.int64), "fp": np.repeat(fp, len(flips))})


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) of fingerprints ``fp`` that differ in at most 2 bits: enough of them to connect all such pairs."""
    keyed = distinct.select("fp").mapInPandas(_bucket_keys, "k long, fp long")
    full = keyed.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k")
    candidates = keyed.join(full, "k").select("fp").distinct()
    words = candidates.mapInPandas(_ball, "w long, fp long")
    least = F.min("fp").over(Window.partitionBy("w"))  # of 65 fingerprints at most
    return words.select(F.col("fp").alias("a"), least.alias("b")).where("a <> b").distinct()


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(key, fp, component) of every row; component is the smallest key its fingerprint reaches."""
    prints = stored(fingerprints(docs, key, text, words))
    nodes = stored(prints.groupBy("fp").agg(F.min("key").alias("first")))
    roots = components(links(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return prints.join(rooted.join(least, "root").select("fp", "component"), "fp").select("key", "fp", "component")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    return groups(docs, key, text, words).select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


# -- similar documents: sets of five-word shingles with a Jaccard similarity of 0.8 or more -----------

#: Words in a shingle of the fingerprint whose Golay keys choose pairs.
PRINT_WORDS = 3
WIDE = 256
#: Sets of Jaccard similarity 0.8 have cosine 8/9, so a bit differs with probability acos(8/9) / pi = 0.151
#: (up to 0.19 in sets of a few shingles).  Pairs of that similarity are within this distance but for one in 10,000.
WIDE_DISTANCE = 72
#: Pairs meet if all minima of one of the bands agree: at similarity 0.8 with probability 1 - (1 - 0.8**4)**20 = 0.99997.
BANDS, BAND = 20, 4
#: Rounds of peeling at most; each only spares comparisons.
PEELS = 10
#: Classes of shingles by which the pairs that are left are told apart.
CLASSES = 64
_SALTS = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_FACTORS = mixed(np.arange(1, BANDS * BAND + 1, dtype=np.uint64)) | np.uint64(1)
_W = [f"w{i}" for i in range(4)]


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles."""
    return np.unique(shingle_hashes(text, words))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """256 bits of a set of shingles as four words."""
    counts = np.zeros(WIDE, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 12):
        h = mixed(hashes[at : at + (1 << 12), None] ^ _SALTS)
        counts += np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of minima over a set of shingles; an empty set has none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        np.minimum(least, (_FACTORS[:, None] * hashes[at : at + (1 << 10)]).min(axis=1), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, BAND).T:
        keys = mixed(keys ^ column) + column
    return keys


def set_name(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set of shingles."""
    return xxhash.xxh128_digest(hashes.tobytes(), SEED)


def text_name(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text.cast("binary")))


def wide_prints(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, content, node, fp, n, w0..w3, keys) of every row; content is a hash of the text, fp its fingerprint, node a hash of its set of n shingles."""

    @F.pandas_udf("node binary, fp long, n long, w0 long, w1 long, w2 long, w3 long, keys array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            nodes, prints, sizes, bits, keys = [], [], [], [], []
            for t in texts:
                prints.append(fingerprint(shingle_hashes(t, PRINT_WORDS)))
                found = shingle_set(t, words)
                nodes.append(set_name(found))
                sizes.append(len(found))
                bits.append(wide_fingerprint(found))
                keys.append(band_keys(found).view(np.int64))
            w = np.array(bits, dtype=np.uint64).reshape(-1, 4).view(np.int64)
            yield pd.DataFrame({"node": nodes, "fp": np.array(prints, dtype=np.uint64).view(np.int64), "n": sizes, **{f"w{i}": w[:, i] for i in range(4)}, "keys": keys})

    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), text_name(t).alias("content"), run(t).alias("p")).select("key", "content", "p.*")


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (a, b) of ``pairs`` with near fingerprints, the smaller node first."""
    words = nodes.select("node", F.array(*_W).alias("w"))
    apart = F.aggregate(F.zip_with("wa", "wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return (
        pairs.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
        .join(words.select(F.col("node").alias("a"), F.col("w").alias("wa")), "a")
        .join(words.select(F.col("node").alias("b"), F.col("w").alias("wb")), "b")
        .where(apart <= WIDE_DISTANCE)
        .select("a", "b")
    )


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of ``pairs`` whose sets have a Jaccard similarity of 0.8 or more: 9 times what they share is 4 times both sizes."""
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
        .where(9 * shared >= 4 * (F.size("sa") + F.size("sb")))
        .select("a", "b")
    )


def _several_roots(members: DataFrame) -> DataFrame:
    """(k) of the buckets whose members lie in different components."""
    return members.groupBy("k").agg((F.min("root") < F.max("root")).alias("apart")).where("apart").select("k")


def _peeled(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (k, node, root, n) that may yet be similar to one of another component, and their contested shingles (node, s).

    A shingle is contested if sets of two components hold it.  A set of n
    shingles shares 4/5 n of them or more with any that is similar, so sets with
    fewer contested ones leave.  What leaves makes other shingles uncontested:
    this is repeated while it removes any, set by set; only then are the buckets
    of those that are left looked at again.
    """
    live = members.select("node", "root", "n").distinct().join(sets, "node").select("node", "root", "n", "s")
    before = None
    for _ in range(PEELS):
        one = live.select("node", "root", "n", F.explode("s").alias("h"))
        contested = one.groupBy("h").agg((F.min("root") < F.max("root")).alias("contested")).where("contested").select("h")
        left = one.join(contested, "h").groupBy("node", "root", "n").agg(F.collect_list("h").alias("s"))
        live = stored(left.where(5 * F.size("s") >= 4 * F.col("n")))
        now = live.count()
        if now in (0, before):
            break
        before = now
    may = members.join(live.select("node"), "node", "left_semi")
    members = stored(may.join(_several_roots(may), "k"))
    return members, live.join(members.select("node").distinct(), "node", "left_semi").select("node", "s")


def _rarely_met(members: DataFrame, contested: DataFrame) -> DataFrame:
    """(node) of members that share one of their rarest contested shingles with a member of another component.

    Of two sets of similarity 0.8 or more each shares 4/5 of its shingles with
    the other, all of them contested.  So with the contested shingles in one
    order of all, rarest first, both hold one of those that are left of each set
    when the last 4/5 n are put aside.
    """
    one = stored(contested.select("node", F.explode("s").alias("h")))
    often = one.groupBy("h").agg(F.count("*").alias("often"))
    ranked = one.join(often, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "h"))).alias("s"))
    few = F.size("s") - F.ceil(F.col("n") * 4 / 5 - 1e-6).cast("int") + 1
    rare = ranked.join(members.select("node", "root", "n").distinct(), "node").where(few > 0).select("node", "root", F.explode(F.slice("s", F.lit(1), few)).alias("x"))
    rare = stored(rare.select("node", "root", F.col("x.h").alias("h")))
    met = rare.groupBy("h").agg((F.min("root") < F.max("root")).alias("apart")).where("apart").select("h")
    return rare.join(met, "h").select("node").distinct()


def _across(members: DataFrame, contested: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one bucket and different components whose sets may share enough.

    Contested shingles fall into ``CLASSES`` by hash.  Two sets share no more of
    a class than the smaller number that either has of it; pairs whose sum over
    the classes is too small for a similarity of 0.8 are left out.
    """

    @F.pandas_udf("array<int>")
    def by_class(sets: pd.Series) -> pd.Series:
        return pd.Series([np.bincount(np.asarray(x, dtype=np.int64) % CLASSES, minlength=CLASSES).astype(np.int32) for x in sets])

    members = members.join(_rarely_met(members, contested), "node", "left_semi")
    names = [f"c{j}" for j in range(CLASSES)]
    counted = contested.select("node", by_class("s").alias("v")).select("node", *[F.get("v", F.lit(j)).alias(c) for j, c in enumerate(names)])
    measured = stored(members.join(counted, "node").select("k", "node", "root", "n", *names))
    count = measured.groupBy("k", "root").count()
    main = count.groupBy("k").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    minority = measured.join(main, "k").where("root <> main").drop("main")
    x, y = (t.select("k", *[F.col(c).alias(f"{c}_{i}") for c in ("node", "root", "n", *names)]) for i, t in enumerate((minority, measured)))
    bound = F.lit(0)
    for c in names:
        bound = bound + F.least(f"{c}_0", f"{c}_1")
    met = x.join(y, "k").where((F.col("root_0") != F.col("root_1")) & (9 * bound >= 4 * (F.col("n_0") + F.col("n_1"))))
    return met.select(F.col("node_0").alias("a"), F.col("node_1").alias("b"))


def golay_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes whose fingerprints ``fp`` differ in at most 2 bits, by their Golay keys: enough of them to connect all such nodes."""
    ones = stored(nodes.groupBy("fp").agg(F.min("node").alias("one")))
    same = nodes.join(ones, "fp").where("node <> one").select(F.col("node").alias("a"), F.col("one").alias("b"))
    x, y = (ones.select(F.col("fp").alias(c), F.col("one").alias(f"node_{c}")) for c in "ab")
    near = links(ones).join(x, "a").join(y, "b").select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return same.unionByName(near)


def wide_components(nodes: DataFrame, shingles) -> DataFrame:
    """(node, root) of nodes that pairs of Jaccard similarity 0.8 or more connect; ``shingles`` gives the sets of a table's nodes.

    Nodes that ``golay_pairs`` finds are compared first.  At a similarity of 0.8
    most fingerprints are further apart, so bands of minima give further buckets.

    In each bucket the member that shares its keys with the most others is the
    pivot, and is compared with all: of a group of near copies this connects
    nearly all members, in one comparison each.  Among the rest, sets that no
    set of another component can resemble are peeled off, as are those that share
    none of their rarest contested shingles with one, and the pairs that their
    contested shingles by class do not rule out are compared.  So no pair that
    shares a key and is similar stays apart, and no bucket forms all pairs of its
    members.
    """
    keyed = nodes.select("node", "n", F.explode("keys").alias("k"))
    size = keyed.groupBy("k").agg(F.count("*").alias("held")).where("held > 1")
    keyed = stored(keyed.join(size, "k"))
    golay = stored(golay_pairs(nodes))
    sought = keyed.select("node").unionByName(golay.select(F.col("a").alias("node"))).unionByName(golay.select(F.col("b").alias("node")))
    sets = stored(shingles(sought.distinct()))
    met = keyed.groupBy("node").agg(F.sum("held").alias("met"))
    pivots = stored(keyed.join(met, "node").groupBy("k").agg(F.max_by("node", F.struct("met", "node")).alias("one")))
    members = keyed.select("k", "node", "n").join(pivots, "k").where("node <> one")
    pairs = _close(members.select(F.col("node").alias("a"), F.col("one").alias("b")), nodes).unionByName(golay)
    similar = stored(_similar(pairs, sets))
    roots = stored(components(similar))
    placed = members.drop("one").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members, contested = _peeled(placed.join(_several_roots(placed), "k"), sets)
    if members.isEmpty():
        return roots
    more = _similar(_close(_across(members, contested), nodes), sets)
    return stored(components(similar.unionByName(stored(more))))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """``docs`` with one row of each group of similar texts: the one with the smallest key.

    Texts are linked if their sets of ``words``-word shingles have a Jaccard
    similarity of 0.8 or more, and groups are connected.  Golay keys of the
    fingerprints, bands of minima and 256-bit fingerprints only choose the pairs whose sets are compared.  A null
    key counts as larger than any; of rows with equal key and text one stays.
    """
    prints = stored(wide_prints(docs, key, text, words))
    order = F.struct(F.col("key").isNull().alias("last"), "key", "content")
    nodes = stored(
        prints.groupBy("node").agg(F.min(order).alias("first"), F.min("fp").alias("fp"), F.min("n").alias("n"), *[F.min(w).alias(w) for w in _W], F.min("keys").alias("keys"))
    )

    def shingles(wanted: DataFrame) -> DataFrame:
        @F.pandas_udf("array<long>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([shingle_set(t, words).view(np.int64) for t in texts])

        first = nodes.join(wanted, "node").select("node", "first.content")
        t = F.coalesce(F.col(text), F.lit(""))
        texts = docs.select(text_name(t).alias("content"), t.alias("t")).join(first, "content")
        return texts.groupBy("node").agg(F.min("t").alias("t")).select("node", run("t").alias("s"))

    roots = wide_components(nodes, shingles)
    rooted = nodes.select("node", "first").join(roots, "node", "left")
    chosen = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("f")).select("f.key", "f.content")
    names = [free_name(f"kept_{c}", docs.columns) for c in ("key", "content")]
    kept = stored(chosen.toDF(*names))
    same = F.col(key).eqNullSafe(F.col(names[0])) & (text_name(F.coalesce(F.col(text), F.lit(""))) == F.col(names[1]))
    out = docs.join(kept, same, "left_semi")
    repeated = prints.groupBy("key", "content").count().where("count > 1").select("key", "content")
    if repeated.join(chosen, (repeated["key"].eqNullSafe(chosen["key"])) & (repeated["content"] == chosen["content"]), "left_semi").isEmpty():
        return out
    return out.dropDuplicates([key, text])
