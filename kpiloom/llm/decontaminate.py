"""Benchmark decontamination by spaced seeds.

A mask marks which of a window's tokens a seed reads; the others may differ.
Seed hashes of benchmark and training texts are equi-joined; each hit fixes a
diagonal (document position minus item position), along which the longest
substitution-tolerant overlap is found and checked.  A hit carries the tokens
around it as far as the longest item reaches, so overlaps are never cut.

Training hashes meet a Bloom filter of the benchmark's first.  Its size follows
the number of seeds, up to ``MAX_BLOOM_BITS``, so it can be broadcast whatever
the benchmark's size; a fuller filter lets more through to the join and never
loses a hit.  The join itself carries no hint: Spark broadcasts the benchmark
side only when its measured size allows and otherwise shuffles, splitting hot
hashes.

Items of fewer than ``LONG`` tokens are too short for the masks to hit every
passage the check accepts.  An overlap that the check accepts lacks at most so
many of their tokens; cut into one part more, the item has a part that it holds
whole, so each part is a seed.

Defined results: null and empty texts hold no tokens and match nothing; items
of fewer than five tokens match their exact copies only; repeated documents each
get their rows, except that rows with the same id and item are merged into one;
a repeated item is one item, and of items with one id and different texts each
is sought; of several overlaps the one with most matches counts, then the
earliest; texts are used whole, in pieces of about a million characters; empty
tables give no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._store import free_name, stored
from kpiloom.llm._tokens import mixed, slices, token_hashes

#: Fixed masks: 1 reads a token, 0 ignores it.  Chosen by enumeration: together they hit every passage of 14 tokens with
#: two substitutions and of 15 and 16 with three, and 99.9 % of those of 20 with four.
MASKS = ("111011011", "111000010111", "11110111", "11011000111", "1101010111", "11101101001")
#: Items of fewer tokens are sought by their parts.
LONG = 15
#: Bits of the filter for each seed, and limits of its size (a power of two): at most 32 MB are broadcast.
BLOOM_RATIO, MIN_BLOOM_BITS, MAX_BLOOM_BITS = 64, 1 << 20, 1 << 28
#: A seed sets the bits that its hash names after each of these shifts: one position in 80,000 passes by chance.
BLOOM_SHIFTS = (0, 12, 24, 36)
MIN_MATCHED = 12
MIN_OVERLAP = 0.8


def seeds(hashes: np.ndarray, offsets: np.ndarray, mask: str, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(seed hash, position) of each window of ``mask`` that lies inside one text."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    h = np.full(n, salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1, dtype=np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            h = (h ^ hashes[j : j + n]) * np.uint64(0x2545F4914F6CDD1D)
            h ^= h >> np.uint64(29)
    at = np.arange(n)
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + len(mask) <= offsets[text + 1]
    return mixed(h[inside]), at[inside]


def needed(n: int, min_matched: int, min_overlap: float) -> int:
    """Tokens of an item of ``n`` that an overlap has to match."""
    return min(min_matched, math.ceil(min_overlap * n - 1e-9))


def parts(n: int, min_matched: int, min_overlap: float) -> list[tuple[int, int]]:
    """(start, length) of consecutive parts, one more than the tokens that an overlap with ``n`` tokens may lack."""
    count = n - needed(n, min_matched, min_overlap) + 1
    cuts = [n * i // count for i in range(count + 1)]
    return [(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False)]


def _item_rows(masks: Sequence[str], min_matched: int, min_overlap: float):
    long = max(LONG, *map(len, masks))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes, offsets = token_hashes(b["text"].tolist())
            rows = []
            for i, item in enumerate(b["item"]):
                own = hashes[offsets[i] : offsets[i + 1]]
                if not len(own):
                    continue
                if len(own) >= long:
                    sought = [(0, len(own), mask, k + 1) for k, mask in enumerate(masks)]
                else:
                    sought = [(at, n, "1" * n, -n) for at, n in parts(len(own), min_matched, min_overlap)]
                found = [
                    (int(h), int(p) + at)
                    for at, n, mask, salt in sought
                    for h, p in zip(*seeds(own[at : at + n], np.array([0, n]), mask, salt), strict=True)
                ]
                rows.append((item, own.view(np.int64), [h - (1 << 64) if h >> 63 else h for h, _ in found], [p for _, p in found]))
            yield pd.DataFrame(rows, columns=["item", "item_tokens", "h", "off"])

    return run


def _bloom_words(seed_hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter's 64-bit words; at most bits / 64 rows reach the driver."""
    places = F.explode(F.array(*[F.shiftrightunsigned("h", n) for n in BLOOM_SHIFTS]))
    rows = (
        seed_hashes.select(places.alias("p"))
        .select(F.expr(f"cast(p & {bits - 1} as int)").alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, p & 63)")).alias("v"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.int64)
    words[rows["word"].to_numpy(dtype=np.int64)] = rows["v"].to_numpy(dtype=np.int64)
    return words.view(np.uint64)


def _in_bloom(words: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    def probe(p: np.ndarray) -> np.ndarray:
        p = p & np.uint64(bits - 1)
        return (words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1

    found = np.arange(len(h))
    for n in BLOOM_SHIFTS:
        found = found[probe(h[found] >> np.uint64(n))]
    return found


def _regions(masks: Sequence[str], lengths: Sequence[int], words, bits: int, context: int):
    """Per document, token regions around seeds (masks, and parts of ``lengths``) that pass the filter, ``context`` tokens wide on each side."""
    use = [*((mask, k + 1) for k, mask in enumerate(masks)), *(("1" * n, -n) for n in lengths)]
    widest = max(len(mask) for mask, _ in use)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = words.value
        for b in batches:
            texts, keys = b["text"].tolist(), b["key"].tolist()
            rows = []
            for lo, hi in slices(texts):
                hashes, offsets = token_hashes(texts[lo:hi])
                hs, ps = [], []
                for mask, salt in use:
                    h, p = seeds(hashes, offsets, mask, salt)
                    hit = _in_bloom(bloom, h, bits)
                    hs.append(h[hit])
                    ps.append(p[hit])
                h, p = np.concatenate(hs), np.concatenate(ps)
                if not len(p):
                    continue
                order = np.argsort(p, kind="stable")
                h, p = h[order], p[order]
                text = np.searchsorted(offsets, p, side="right") - 1
                new = np.flatnonzero((np.diff(p, prepend=-1 - 4 * context) > 2 * context) | (np.diff(text, prepend=-1) != 0))
                for s, e in zip(new, [*new[1:], len(p)], strict=True):
                    t = text[s]
                    a = max(offsets[t], p[s] - context)
                    z = min(offsets[t + 1], p[e - 1] + widest + context)
                    rows.append((keys[lo + t], int(a - offsets[t]), hashes[a:z].view(np.int64), h[s:e].view(np.int64), (p[s:e] - offsets[t]).astype(np.int32)))
            if rows:
                yield pd.DataFrame(rows, columns=["key", "region_at", "tokens", "h", "pos"])

    return run


def longest_overlap(same: np.ndarray, min_overlap: float) -> tuple[int, int, int]:
    """(start, end, matches) of the segment with the most matches of those that match ``min_overlap`` of their length.

    It begins and ends with a match.
    """
    sums = np.concatenate([[0.0], np.cumsum(same - min_overlap)])
    low = np.minimum.accumulate(sums)
    start = np.minimum(np.searchsorted(-low, -sums - 1e-9), np.arange(len(sums)))
    count = np.concatenate([[0], np.cumsum(same)])
    matched = count - count[start]
    end = int(np.argmax(matched))
    inside = np.flatnonzero(same[start[end] : end]) + start[end]
    return (int(inside[0]), int(inside[-1]) + 1, len(inside)) if len(inside) else (0, 0, 0)


def _overlaps(min_matched: int, min_overlap: float):
    @F.pandas_udf("start int, length int, matched int")
    def run(tokens: pd.Series, region_at: pd.Series, item: pd.Series, diagonal: pd.Series) -> pd.DataFrame:
        rows = []
        for t, at, it, d in zip(tokens, region_at, item, diagonal, strict=True):
            lo, hi = max(at, d), min(at + len(t), d + len(it))
            same = np.asarray(t)[lo - at : hi - at] == np.asarray(it)[lo - d : hi - d]
            s, e, m = longest_overlap(same, min_overlap) if hi > lo else (0, 0, 0)
            rows.append((lo + s, e - s, m))
        return pd.DataFrame(rows, columns=["start", "length", "matched"])

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    masks: Sequence[str] = MASKS,
    min_matched: int = MIN_MATCHED,
    min_overlap: float = MIN_OVERLAP,
) -> DataFrame:
    """A row per (document, item) that overlap: key, item, start, length, matched, spans.

    An overlap is a stretch of one diagonal.  It counts if it matches ``min_matched`` tokens, or ``min_overlap`` of
    a shorter item's, and at least ``min_overlap`` of its length.  ``start`` and ``length``
    are of the document's longest overlap with the item, in tokens.
    """
    spark = docs.sparkSession
    items = stored(
        benchmark.select(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).distinct().mapInPandas(
            _item_rows(masks, min_matched, min_overlap),
            f"item {benchmark.schema[item].dataType.simpleString()}, item_tokens array<long>, h array<long>, off array<int>",
        )
        .withColumn("iid", F.monotonically_increasing_id())
    )
    item_seeds = items.select("iid", F.explode(F.arrays_zip("h", "off")).alias("s")).select("iid", "s.h", "s.off")
    long = max(LONG, *map(len, masks))
    short = [r[0] for r in items.select(F.size("item_tokens").alias("n")).where(F.col("n") < long).distinct().collect()]
    lengths = sorted({n for x in short for _, n in parts(x, min_matched, min_overlap)})
    size = items.agg(F.sum(F.size("h")).alias("seeds"), F.max(F.size("item_tokens")).alias("longest")).first()
    bits = min(MAX_BLOOM_BITS, max(MIN_BLOOM_BITS, 1 << (BLOOM_RATIO * (size["seeds"] or 1)).bit_length()))
    words = spark.sparkContext.broadcast(_bloom_words(item_seeds, bits))
    regions = stored(
        docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .mapInPandas(
            _regions(masks, lengths, words, bits, size["longest"] or 1),
            f"key {docs.schema[key].dataType.simpleString()}, region_at int, tokens array<long>, h array<long>, pos array<int>",
        )
        .withColumn("rid", F.monotonically_increasing_id())
    )
    hits = (
        regions.select("rid", F.explode(F.arrays_zip("h", "pos")).alias("s"))
        .select("rid", "s.h", "s.pos")
        .join(item_seeds, "h")
        .select("rid", "iid", (F.col("pos") - F.col("off")).alias("diagonal"))
        .distinct()
    )
    verified = _overlaps(min_matched, min_overlap)
    least = F.least(F.lit(min_matched), F.ceil(F.lit(min_overlap) * F.col("n") - 1e-9))
    checked = (
        hits.join(regions.select("rid", "key", "region_at", "tokens"), "rid")
        .join(items.select("iid", "item", "item_tokens"), "iid")
        .select("key", "item", F.size("item_tokens").alias("n"), verified("tokens", "region_at", "item_tokens", "diagonal").alias("v"))
        .select("key", "item", "n", "v.*")
        .where(
            (F.col("matched") >= least) & (F.col("matched") >= F.lit(min_overlap) * F.col("length") - 1e-9)
        )
    )
    best = F.max_by(F.struct("start", "length", "matched"), F.struct("matched", -F.col("start"))).alias("b")
    return (
        checked.groupBy("key", "item")
        .agg(best, F.count_distinct("start").alias("spans"))
        .select(F.col("key").alias(key), F.col("item").alias(item), "b.*", "spans")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item; clean rows stay as they are.

    Rows are told apart by their text alone (a 64-bit hash of it), so null and
    repeated ids do no harm, and a text that many rows hold is sought once.
    """
    content = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    mark = free_name("contaminated_content", docs.columns)
    texts = docs.select(content.alias(mark), F.col(text))
    # written out, its size is known when the join is planned: a short list is broadcast and the texts stay where they are
    found = stored(contaminated(texts, benchmark, mark, text, **options).select(mark).distinct())
    return docs.join(found, content == F.col(mark), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
