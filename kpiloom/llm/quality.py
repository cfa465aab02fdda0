"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its hashed words, word pairs and
character n-grams; a softmax layer over that average gives its class.  Vectors
and layer are learned together by stochastic gradient descent in numpy on a
bounded sample of labelled documents (``SAMPLE`` rows).  The output layer is
linear in the average, so for scoring each vector is folded with the layer into
one number a bucket, and a document's logit is the mean of its features' numbers.

The average is damped by ``DAMPING`` empty features, so that a few words cannot
outweigh the bias.

Defined results: null and empty texts have no features and get the bias's
score; without labelled rows every score is 0.5; repeated rows each get their
score; of several documents with one labelled id the smallest text is fitted;
texts are used whole, in pieces of about a million characters; an empty table
gives an empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._labels import fold, sample, training_labels
from kpiloom.llm._tokens import slices

#: At most so many labelled documents are fitted on.
SAMPLE = 2000
BUCKETS = 1 << 16
DIMENSION = 12
NGRAMS = (3, 4)
EPOCHS = 6
#: Features without weight that every average includes.
DAMPING = 60
RATE = 0.5

_SPACE = np.zeros(128, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_K = np.uint32(0x9E3779B1)


def _bucket(h: np.ndarray, order: int) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + np.uint32(order * 0x27D4EB2F & 0xFFFFFFFF)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE3D)
    return (h ^ (h >> np.uint32(16))) & np.uint32(BUCKETS - 1)


def features(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text of each) in groups: words, word pairs, pairs of equal words, n-grams of each length.

    A word that follows itself, at once or after one other, is a feature
    whatever the word, besides the pair: no sample holds every word's.

    Every text is framed by spaces; an n-gram may begin or end with a space and
    has none inside.
    """
    codes = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = _SPACE[np.minimum(codes, 127)]
    codes = np.where(space, np.uint32(32), codes)
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    edge = np.diff((~space).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(s):
        at = np.arange(len(codes), dtype=np.uint32)
        mixed = (codes + np.uint32(0x165667B1)) * _K
        mixed ^= mixed >> np.uint32(14)
        first = np.repeat(np.concatenate([[0], s]), np.diff([0, *s, len(codes)])).astype(np.uint32)
        offset = at - first
        mixed *= offset * np.uint32(2) + np.uint32(0x9E3779B1)
        mixed[space] = 0
        words = np.add.reduceat(mixed, s) + (e - s).astype(np.uint32)
        of = np.searchsorted(ends, s, side="right") - 1
        yield _bucket(words, 1), of
        for gap in (1, 2):
            inside = np.flatnonzero(of[gap:] == of[:-gap])
            left, right = words[inside], words[inside + gap]
            repeated = inside[left == right]
            if gap == 1:
                yield _bucket(left * _K ^ right, 2), of[inside]
            yield _bucket(np.full(len(repeated), gap, dtype=np.uint32), 5), of[repeated]
    text = np.repeat(np.arange(len(texts)), np.diff(ends)) if texts else np.zeros(0, np.int64)
    for n in NGRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        inner = space[1 : 1 + m].copy()
        for j in range(2, n - 1):
            inner |= space[j : j + m]
        h = codes[:m].copy()
        for j in range(1, n):
            h = h * _K + codes[j : j + m]
        keep = np.flatnonzero(~inner)
        keep = keep[keep < len(text)]
        yield _bucket(h[keep], n), text[keep]


@dataclass
class Model:
    """Weight of each bucket on the logit of class 1, and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for lo, hi in slices(texts):
            part = texts[lo:hi]
            total, count = np.zeros(len(part)), np.zeros(len(part))
            for buckets, text in features(part):
                total += np.bincount(text, weights=self.weights[buckets], minlength=len(part))
                count += np.bincount(text, minlength=len(part))
            out[lo:hi] = total / (count + DAMPING)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -40, 40)))


def train(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """``rows``: (buckets, their shares in the average, label) of each document."""
    if not rows:
        return Model(np.zeros(BUCKETS), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS, DIMENSION))
    layer, bias = np.zeros((DIMENSION, 2)), np.zeros(2)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            buckets, share, y = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            hidden = share @ vectors[buckets]
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= rate * np.outer(hidden, p)
            bias -= rate * p
            # a bucket's share is small, so its step is scaled by the number of buckets
            vectors[buckets] -= rate * np.outer(share * len(buckets) ** 0.5, back)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for text, label in zip(b["text"], b["label"], strict=True):
            parts = [f for f, _ in features([text])]
            buckets, n = np.unique(np.concatenate(parts or [np.zeros(0, np.uint32)]), return_counts=True)
            if len(buckets):
                share = n / (n.sum() + DAMPING)
                rows.append((label, buckets.astype(np.uint16).tobytes(), share.astype(np.float32).tobytes()))
        if rows:
            yield pd.DataFrame(rows, columns=["label", "buckets", "share"])


def fit(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, key: str = "doc_id", text: str = "text", rows: int = SAMPLE) -> Model:
    """A model fitted on at most ``rows`` labelled documents outside the held-out fold."""
    chosen = sample(training_labels(labels, label, folds, held_out, key), rows, by_class=False)
    found = (
        docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "key")
        .groupBy("key", "label")
        .agg(F.min("text").alias("text"))  # one text an id: never more than ``rows``
        .select("text", "label")
        .mapInPandas(_counted, "label int, buckets binary, share binary")
        .toArrow()
    )
    triples = [
        (np.frombuffer(b.as_buffer(), dtype=np.uint16), np.frombuffer(s.as_buffer(), dtype=np.float32), y.as_py())
        for y, b, s in zip(*(found.column(c) for c in ("label", "buckets", "share")), strict=True)
    ]
    triples.sort(key=lambda t: (t[2], len(t[0]), zlib.crc32(t[0]), zlib.crc32(t[1])))  # as rows come in any order
    return train(triples)


def score(model: Model, text: Column, spark) -> Column:
    """The probability of class 1 for a text column."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(held.value.scores(texts.tolist()))

    return run(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2, threshold: float = 0.7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted (1 from ``threshold`` on) of every row of ``docs``."""
    model = fit(docs, labels, label, folds, held_out, key, text)
    return docs.select(
        F.col(key),
        F.coalesce(fold(F.col(key), folds) == held_out, F.lit(False)).alias("held_out"),
        score(model, F.col(text), docs.sparkSession).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
