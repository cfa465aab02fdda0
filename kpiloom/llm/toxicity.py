"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled documents (``EXAMPLES`` of each
class).  All their words are indexed.  A word weighs
(1 + ln tf) * idf * |phi|: term frequencies cover whole texts, document
frequencies cover all documents, and phi is the correlation of its presence with
the label over the examples, without which ordinary words, being most of a text,
decide who is near.  Words that no example holds would only scale a text's
cosines and are left out.

The examples form an inverted index cut into blocks of ``BLOCK``; each word
keeps its largest weight in each block, so the sum of these bounds a block's
scores.  The most promising blocks are scored first, then those whose bound
reaches the k-th score so far; the others are skipped.  The k nearest vote with
weight cosine**2, shrunk to the base rate, and a logistic curve fitted on
leave-one-out votes calibrates the score.

Defined results: null and empty texts, and texts without indexed words, have no
neighbours and get the calibrated base rate; ties between neighbours go to the
example that stands first in the index; without labelled rows every score is 0;
repeated rows each get their score; of several documents with one labelled id
the smallest text is the example; texts are used whole, in pieces of about a
million characters; an empty table gives an empty result; other columns are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._labels import fold, sample, training_labels
from kpiloom.llm._store import stored
from kpiloom.llm._tokens import slices, token_hashes

#: At most so many labelled documents of each class are examples; their words, no more, reach the driver.
EXAMPLES = 2000
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that are scored before any is skipped.
FIRST_BLOCKS = 4
PRIOR_WEIGHT = 0.5


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per example, its distinct words' hashes and how often each occurs."""
    for b in batches:
        texts = b["text"].tolist()
        for lo, hi in slices(texts):
            hashes, offsets = token_hashes(texts[lo:hi])
            bags = [np.unique(hashes[x:y], return_counts=True) for x, y in zip(offsets[:-1], offsets[1:], strict=True)]
            part = b[["key", "label"]].iloc[lo:hi]
            yield part.assign(words=[w.view(np.int64) for w, _ in bags], tf=[n.astype(np.int32) for _, n in bags])


def _indexed(words: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place among the sorted ``words``, occurrences) of every indexed word of ``texts``, by text and place."""
    hashes, offsets = token_hashes(texts)
    place = np.searchsorted(words, hashes)
    hit = np.flatnonzero(words[np.minimum(place, len(words) - 1)] == hashes) if len(words) else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, hit, side="right") - 1
    pair, tf = np.unique(text * (len(words) + 1) + place[hit], return_counts=True)
    return pair // (len(words) + 1), pair % (len(words) + 1), tf


def _document_counts(held):
    """How many of a partition's documents hold each indexed word; word -1 counts all documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = held.value
        total, n = np.zeros(len(words), dtype=np.int64), 0
        for b in batches:
            texts = b["text"].tolist()
            n += len(texts)
            for lo, hi in slices(texts):
                total += np.bincount(_indexed(words, texts[lo:hi])[1], minlength=len(words))
        found = np.flatnonzero(total)
        yield pd.DataFrame({"word": np.append(found, -1).astype(np.int32), "n": np.append(total[found], n)})

    return run


def correlation(n_words: int, bags: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """|phi| of each word's presence in a bag and the bag's label; 0 where either is constant."""
    n, n1 = len(labels), float(labels.sum())
    both, one = np.zeros(n_words), np.zeros(n_words)
    for at, y in zip(bags, labels, strict=True):
        one[at] += 1
        both[at] += y
    spread = one * (n - one) * n1 * (n - n1)
    return np.where(spread > 0, np.abs(n * both - one * n1) / np.sqrt(np.maximum(spread, 1)), 0.0)


def weigh(weight: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """The unit vector of a bag; all zero if no word of it weighs anything."""
    w = (1 + np.log(tf)) * weight[terms]
    norm = np.sqrt((w * w).sum())
    return w / norm if norm > 0 else w


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    n = ends - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


@dataclass
class BlockMaxIndex:
    """Postings of the examples' unit vectors by word, and each word's maximum in each block it occurs in."""

    weight: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    places: np.ndarray = field(repr=False)  # postings, by word and place: the example and its weight
    values: np.ndarray = field(repr=False)
    first: np.ndarray = field(repr=False)  # of each word, its first entry below
    block: np.ndarray = field(repr=False)  # entries, by word and block: the block, its maximum, its postings
    top: np.ndarray = field(repr=False)
    start: np.ndarray = field(repr=False)
    end: np.ndarray = field(repr=False)

    @staticmethod
    def build(weight: np.ndarray, rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> BlockMaxIndex:
        """``rows``: (id, label, words, tf); examples that share their strongest word stand together."""
        units = [weigh(weight, t, f) for _, _, t, f in rows]
        strongest = [int(t[np.argmax(w)]) if len(t) else -1 for (_, _, t, _), w in zip(rows, units, strict=True)]
        order = sorted(range(len(rows)), key=lambda i: (strongest[i], rows[i][0]))
        none = np.zeros(0, np.int64)
        word = np.concatenate([none, *(rows[i][2] for i in order)]).astype(np.int64)
        value = np.concatenate([np.zeros(0), *(units[i] for i in order)])
        place = np.repeat(np.arange(len(order)), [len(rows[i][2]) for i in order])
        by = np.argsort(word, kind="stable")
        word, value, place = word[by], value[by], place[by]
        entry = word * (len(order) // BLOCK + 1) + place // BLOCK
        start = np.flatnonzero(np.diff(entry, prepend=-1))
        return BlockMaxIndex(
            weight,
            np.array([rows[i][0] for i in order], dtype=object),
            np.array([rows[i][1] for i in order], dtype=float),
            place.astype(np.int32),
            value,
            np.searchsorted(word[start], np.arange(len(weight) + 1)),
            (place[start] // BLOCK).astype(np.int64),
            np.maximum.reduceat(value, start) if len(start) else value,
            start,
            np.append(start[1:], len(word)).astype(np.int64),
        )

    def _scored(self, q: np.ndarray, entries: np.ndarray, but: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the examples in some entries' postings; ``q`` is the query's weight for each entry."""
        at = _ranges(self.start[entries], self.end[entries])
        weights = np.repeat(q, self.end[entries] - self.start[entries]) * self.values[at]
        scores = np.bincount(self.places[at], weights=weights, minlength=len(self.ids))
        places = np.flatnonzero(scores > 0)
        places = places[places != but]
        return places, scores[places]

    def nearest(self, terms: np.ndarray, tf: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k examples with the largest positive cosine, without place ``but``."""
        q = weigh(self.weight, terms, tf)
        entries = _ranges(self.first[terms], self.first[terms + 1])
        q = np.repeat(q, self.first[terms + 1] - self.first[terms])
        block = self.block[entries]
        bounds = np.bincount(block, weights=q * self.top[entries])
        first = np.zeros(len(bounds), dtype=bool)
        first[np.argsort(-bounds, kind="stable")[:FIRST_BLOCKS]] = True
        use = first[block] if len(block) else np.zeros(0, dtype=bool)
        places, scores = self._scored(q[use], entries[use], but)
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 0.0
        more = ~first & (bounds > 0) & (bounds >= least - 1e-9)
        if more.any():
            use = more[block]
            others, theirs = self._scored(q[use], entries[use], but)
            places, scores = np.concatenate([places, others]), np.concatenate([scores, theirs])
        best = np.lexsort((places, -np.round(scores, 12)))[:k]
        return places[best], scores[best]


@dataclass
class Voter:
    """Distance-weighted votes and their calibration."""

    index: BlockMaxIndex
    rate: float
    class_weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        y = self.index.labels[places]
        w = cosines**2 * self.class_weights[y.astype(int)]
        return float((w @ y + PRIOR_WEIGHT * self.rate) / (w.sum() + PRIOR_WEIGHT))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        v = np.clip(votes, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log(v / (1 - v)) + self.shift, -40, 40)))

    def fit(self, examples: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Slope and shift by Newton steps on the leave-one-out votes of the examples in index order."""
        votes = np.array([self.vote(*self.index.nearest(t, f, NEIGHBOURS, but=i)) for i, (t, f) in enumerate(examples)])
        v = np.clip(votes, 1e-6, 1 - 1e-6)
        x, y = np.stack([np.log(v / (1 - v)), np.ones(len(v))]), self.index.labels
        w = self.class_weights[y.astype(int)]
        at = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(at @ x, -40, 40)))
            pull = x @ (w * (p - y)) + 0.1 * (at - [1.0, 0.0])
            bend = (x * (w * p * (1 - p))) @ x.T + 0.1 * np.eye(2)
            step = np.linalg.solve(bend, pull)
            at = at - np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = float(at[0]), float(at[1])


def _scored(held, words):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        voter: Voter = held.value
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in slices(texts):
                of, terms, tf = _indexed(words.value, texts[lo:hi])
                cuts = np.searchsorted(of, np.arange(hi - lo + 1))
                votes, seen = np.zeros(hi - lo), []
                for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    places, cosines = voter.index.nearest(terms[x:y], tf[x:y], NEIGHBOURS)
                    votes[i] = voter.vote(places, cosines)
                    seen.append(",".join(f"{voter.index.ids[p]}:{c:.4f}" for p, c in zip(places[:3], cosines[:3], strict=True)))
                yield pd.DataFrame({"key": b["key"].iloc[lo:hi].to_numpy(), "score": voter.calibrated(votes), "evidence": seen})

    return run


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held_out: int = 0, threshold: float = 0.5, key: str = "doc_id", text: str = "text", examples: int = EXAMPLES) -> DataFrame:
    """key, held_out, score, predicted and evidence (nearest ids with cosines) of every row of ``docs``."""
    context = docs.sparkSession.sparkContext
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    training = stored(training_labels(labels, label, folds, held_out, key))
    totals = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    chosen = stored(sample(training, examples, by_class=True))
    fitted = own.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))  # two samples at most
    bags = fitted.mapInPandas(_bags, f"key {kind}, label int, words array<long>, tf array<int>").toPandas().sort_values("key")
    hashes = [np.asarray(w, dtype=np.int64).view(np.uint64) for w in bags["words"]]
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]))
    held_words = context.broadcast(words)
    counted = own.select("text").mapInPandas(_document_counts(held_words), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    n, df = 0, np.zeros(len(words))
    for word, c in zip(counted["word"], counted["n"], strict=True):  # a row for each word of the examples
        if word < 0:
            n = c
        else:
            df[word] = c
    places = [np.searchsorted(words, h) for h in hashes]
    truth = bags["label"].to_numpy(dtype=float)
    weight = (np.log((1 + n) / (1 + df)) + 1e-3) * correlation(len(words), places, truth)
    rows = [(i, int(y), at, np.asarray(f, dtype=np.int64)) for i, y, at, f in zip(bags["key"].tolist(), truth, places, bags["tf"], strict=True)]
    index = BlockMaxIndex.build(weight, rows)
    counts = {y: int((truth == y).sum()) for y in (0, 1)}
    rate = totals.get(1, 0) / max(1, sum(totals.values()))
    share = [totals.get(y, 0) / max(1, counts[y]) for y in (0, 1)]
    voter = Voter(index, rate, np.array(share) / max(1e-9, sum(share)) * 2)
    if 0 < rate < 1 and rows:
        by_id = {r[0]: (r[2], r[3]) for r in rows}
        voter.fit([by_id[i] for i in index.ids])
    scored = own.mapInPandas(_scored(context.broadcast(voter), held_words), f"key {kind}, score double, evidence string")
    return scored.select(
        F.col("key").alias(key),
        F.coalesce(fold(F.col("key"), folds) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
