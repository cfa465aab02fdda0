"""Language identification by Bayesian fusion of evidence.

posterior(l) is proportional to
    P(l | host) * P(text | l)^t * P(declared | l) * P(suffix | l)

* text: naive Bayes over hashed letter trigrams, with counts by language over
  all labelled documents; its log-likelihood is tempered, as neighbouring
  trigrams are not independent.  A language ``und`` with uniform trigrams stands
  for text that resembles none of the others.
* declared and suffix: how often each markup language and each address suffix
  occurs with each language, from grouped sums of text posteriors.
* host: shares of languages among a host's pages, smoothed towards its
  domain's, which are smoothed towards the corpus's.  A page's own text
  posterior is taken out of its host's and domain's sums.

All sums are grouped aggregations that combine before the shuffle, so a host
with a third of all pages costs a row a task.

Defined results: null and empty texts have no text evidence; a missing host,
declaration or suffix is an empty string and counts like any value; ties go to
the alphabetically first language; without labelled documents every text is
``und``; ``identify`` never drops a row, and repeated rows are each decided;
texts are used whole, in pieces of about a million characters; an empty table
gives an empty result; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm._store import free_name, stored
from kpiloom.llm._tokens import slices

BUCKETS = 1 << 14
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.01
#: Trigram evidence counts as n / (1 + n / TEMPER) independent trigrams.
TEMPER = 60.0
#: A text with fewer trigrams is not rejected for what it resembles.
ENOUGH = 20
SMOOTH_DOMAIN, SMOOTH_HOST, SMOOTH_VALUE = 20.0, 10.0, 2.0

_OPEN = re.compile(r"(?i)<(script|style)\b|<!--")
_CLOSE = {"script": re.compile(r"(?i)</script\s*>"), "style": re.compile(r"(?i)</style\s*>"), "--": re.compile("-->")}
_TAG = re.compile(r"<[^>]*>")


def page_text(page: str) -> str:
    """A page without scripts, styles, comments and tags, entities resolved.

    What is opened and never closed is no block, and is sought no further after
    the first failure, so the time is linear in the page's length.
    """
    out, at, unclosed = [], 0, set()
    opened = _OPEN.search(page)
    while opened:
        kind, look = (opened[1] or "--").lower(), opened.end()
        closed = None if kind in unclosed else _CLOSE[kind].search(page, look)
        if closed:
            out.append(page[at : opened.start()])
            at = look = closed.end()
        else:
            unclosed.add(kind)
        opened = None if len(unclosed) == len(_CLOSE) else _OPEN.search(page, look)
    kept = " ".join([*out, page[at:]])
    last = kept.rfind(">") + 1
    return html.unescape(_TAG.sub(" ", kept[:last]) + kept[last:])


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every trigram of letters and word edges, in lower case."""
    codes = np.frombuffer(" ".join(["", *(t.lower() for t in texts), ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 0xC0)
    codes = np.where(letter, codes, np.uint32(32))
    ends = np.cumsum([0, *(len(t.lower()) + 1 for t in texts)])
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(letter[1:-1])
    h = (codes[at] * np.uint32(0x9E3779B1) + codes[at + 1]) * np.uint32(0x85EBCA77) + codes[at + 2]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    bucket = ((h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int64)
    return bucket, np.searchsorted(ends, at, side="right") - 1


def _counts(languages: Sequence[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}  # of the languages that the task meets
        for b in batches:
            texts, of = b["text"].tolist(), np.array([place[x] for x in b["label"]], dtype=np.int64)
            for lo, hi in slices(texts):
                bucket, text = trigrams(texts[lo:hi])
                met, at = np.unique(of[lo:hi], return_inverse=True)
                found = np.bincount(at[text] * BUCKETS + bucket, minlength=len(met) * BUCKETS).reshape(len(met), BUCKETS)
                for i, n in zip(met.tolist(), found, strict=True):
                    totals[i] = totals[i] + n if i in totals else n.copy()
        for i, n in totals.items():
            bucket = np.flatnonzero(n)
            yield pd.DataFrame({"lang": np.int32(i), "bucket": bucket.astype(np.int32), "n": n[bucket]})

    return run


class Model:
    """Log-probabilities of trigram buckets by language, ``und`` last."""

    def __init__(self, languages: Sequence[str], counts: np.ndarray):
        self.languages = [*languages, UNKNOWN]
        p = counts + 0.5
        uniform = np.full((1, BUCKETS), 1.0 / BUCKETS)
        # buckets by languages, so that one row has a trigram's whole evidence
        self.logs = np.ascontiguousarray(np.log(np.concatenate([p / p.sum(axis=1, keepdims=True), uniform])).T.astype(np.float32))

    def evidence(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tempered log-likelihoods by text and language, trigrams by text)."""
        out, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), dtype=np.int64)
        for lo, hi in slices(texts):
            bucket, text = trigrams(texts[lo:hi])
            n[lo:hi] = np.bincount(text, minlength=hi - lo)
            for i in range(len(self.languages)):
                out[lo:hi, i] = np.bincount(text, weights=self.logs[bucket, i], minlength=hi - lo)
        return out / (1 + n / TEMPER)[:, None], n


def fit(docs: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """Trigram counts over all documents with a label, of every label."""
    labelled = docs.select(F.col(label).alias("label"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        F.col("label").isNotNull() & (F.col("label") != UNKNOWN)
    )
    languages = sorted(r["label"] for r in labelled.select("label").distinct().collect())
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        rows = (
            labelled.mapInPandas(_counts(languages), "lang int, bucket int, n long")
            .groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n"))
            .toPandas()  # at most BUCKETS rows a language
        )
        counts[rows["lang"], rows["bucket"]] = rows["n"]
    return Model(languages, counts)


def _normal(logs: np.ndarray) -> np.ndarray:
    """Probabilities of rows of logarithms."""
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


VALUES = ("declared", "suffix", "domain", "host")


def _grouped_by(declared: Column | None, address: Column | None, host: Column | None) -> Column:
    """A struct of the values whose sums are evidence."""
    empty = F.lit("")
    address = F.lower(F.coalesce(address, empty)) if address is not None else empty
    return F.struct(
        (F.coalesce(declared, empty) if declared is not None else empty).alias("declared"),
        F.substring_index(address, ".", -1).alias("suffix"),
        F.substring_index(address, ".", -2).alias("domain"),
        (F.coalesce(host, empty) if host is not None else address).alias("host"),
    )


def _flat_prior(n: int) -> np.ndarray:
    flat = np.full(n, np.log((1 - UNKNOWN_PRIOR) / max(1, n - 1)))
    flat[-1] = np.log(UNKNOWN_PRIOR)
    return flat


def _evidence(model: Model, spark: SparkSession, text: Column) -> Column:
    """A struct of the text's log-likelihoods, trigrams and posterior under the flat prior."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("logs array<double>, trigrams long, soft array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        flat = _flat_prior(len(held.value.languages))
        for texts in batches:
            logs, count = held.value.evidence(texts.tolist())
            yield pd.DataFrame({"logs": list(logs), "trigrams": count, "soft": list(_normal(logs + flat))})

    return run(F.coalesce(text, F.lit("")))


def _smoothed(counts: np.ndarray, towards: np.ndarray, weight: float) -> np.ndarray:
    return (counts + weight * towards) / (counts.sum(axis=1, keepdims=True) + weight)


def _fused(logs: np.ndarray, soft: np.ndarray, given: dict[str, np.ndarray], sums: dict[str, np.ndarray], share: np.ndarray) -> np.ndarray:
    """Posteriors by row and language; a row's own share is taken out of the sums first."""
    rest = {by: np.maximum(c - soft, 0.0) for by, c in sums.items()}
    fused = logs + np.log(_smoothed(rest["host"], _smoothed(rest["domain"], share, SMOOTH_DOMAIN), SMOOTH_HOST))
    for by, there in given.items():
        # log P(value | l), less what is equal for all l: how much likelier l is with the value than in the corpus
        fused += np.where(there[:, None], np.log(_smoothed(rest[by], share, SMOOTH_VALUE) / share), 0.0)
    return _normal(fused)


def _weighed(rows: DataFrame, values: Column, seen: DataFrame, model: Model, evidence: Sequence[Column], decision: str) -> DataFrame:
    """``rows`` with a struct ``decision``: lang, confidence, text_lang, trigrams.

    ``values`` are the row's, ``seen`` (values, soft) gives the sums.
    ``evidence`` is either the text or what ``_evidence`` has made of it: the
    text is then weighed where the decision is made, in one Python step.
    """
    spark, n = rows.sparkSession, len(model.languages)
    totals = [F.sum(F.get("soft", F.lit(i))).alias(f"s{i}") for i in range(n)]
    total = np.array([float(x or 0.0) for x in seen.agg(*totals).first()])
    share = (total + 1.0) / (total.sum() + n)
    mark = free_name("langid_values", rows.columns)
    out = rows.withColumn(mark, values)
    names = {by: free_name(f"langid_{by}_sums", rows.columns) for by in VALUES}
    for by, name in names.items():
        grouped = seen.groupBy(F.col(f"values.{by}").alias("langid_by")).agg(*totals)
        # written out, its size is known when the join is planned: small sums are broadcast and the texts stay where they are
        grouped = stored(grouped.select("langid_by", F.array(*[f"s{i}" for i in range(n)]).alias(name)))
        by_name = free_name("langid_by", out.columns)
        grouped = grouped.withColumnRenamed("langid_by", by_name)
        out = out.join(grouped, F.col(f"{mark}.{by}") == F.col(by_name)).drop(by_name)
    held = spark.sparkContext.broadcast(model)

    def decided(batches: Iterator[tuple[pd.Series, ...]], take: int, weigh) -> Iterator[pd.DataFrame]:
        for columns in batches:
            if not len(columns[0]):
                continue
            logs, count, soft = weigh(*columns[:take])
            given = {by: c.to_numpy(dtype=bool) for by, c in zip(VALUES[:2], columns[take:], strict=False)}
            sums = {by: np.stack(c) for by, c in zip(VALUES, columns[take + 2 :], strict=True)}
            p = _fused(logs, soft, given, sums, share)
            yield pd.DataFrame({"place": p.argmax(axis=1), "p": p.max(axis=1), "text_place": soft.argmax(axis=1), "trigrams": count})

    def from_text(texts: pd.Series):
        logs, count = held.value.evidence(texts.tolist())
        return logs, count, _normal(logs + _flat_prior(n))

    def from_evidence(logs: pd.Series, count: pd.Series, soft: pd.Series):
        return np.stack(logs), count.to_numpy(), np.stack(soft)

    take, weigh = len(evidence), from_text if len(evidence) == 1 else from_evidence

    @F.pandas_udf("place int, p double, text_place int, trigrams long")
    def decide(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        return decided(batches, take, weigh)

    inputs = [*evidence, *[F.col(f"{mark}.{by}") != "" for by in VALUES[:2]], *[F.col(names[by]) for by in VALUES]]
    languages = F.array(*map(F.lit, model.languages))
    p = free_name("langid_p", out.columns)
    found = F.struct(
        F.get(languages, F.col(f"{p}.place")).alias("lang"),
        F.round(F.col(f"{p}.p"), 6).alias("confidence"),
        F.when(F.col(f"{p}.trigrams") > 0, F.get(languages, F.col(f"{p}.text_place"))).otherwise(UNKNOWN).alias("text_lang"),
        F.col(f"{p}.trigrams").alias("trigrams"),
    )
    return out.withColumn(p, decide(*inputs)).withColumn(decision, found).drop(p, mark, *names.values())


def identify(
    rows: DataFrame,
    model: Model,
    key: str,
    text: Column,
    declared: Column | None = None,
    address: Column | None = None,
    host: Column | None = None,
) -> DataFrame:
    """key, lang, confidence, text_lang and trigrams of every row of ``rows``.

    ``declared`` is the markup's language, ``address`` a host name whose last
    label is the suffix and last two the domain, ``host`` what shares a prior
    (``address`` if not given).  Whatever is missing gives no evidence.
    """
    seen = stored(
        rows.select(F.col(key).alias("key"), _grouped_by(declared, address, host).alias("values"), _evidence(model, rows.sparkSession, text).alias("e")).select("key", "values", "e.*")
    )
    found = _weighed(seen.select("key", "values", "logs", "trigrams", "soft"), F.col("values"), seen, model, [F.col("logs"), F.col("trigrams"), F.col("soft")], "found")
    return found.select(F.col("key").alias(key), "found.*")


def identify_pages(pages: DataFrame, docs: DataFrame, key: str = "page_id") -> DataFrame:
    """``identify`` for raw pages (url, html), with trigrams learned from labelled documents."""
    strip = F.pandas_udf(lambda s: s.map(page_text), "string")
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/:?#]*)", 1)
    opened = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b([^>]*+)", 1)
    declared = F.lower(F.regexp_extract(opened, r"(?i)\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    rows = pages.select(F.col(key), "url", "html")
    return identify(rows, fit(docs), key, strip(F.coalesce("html", F.lit(""))), declared, host)


def keep_identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", least: float = 0.5) -> DataFrame:
    """``docs`` in an identified language, with ``lang`` set to it.

    A document goes if it has no letters, or if it resembles no language
    (``und``) or its language's posterior is below ``least``.  Fewer than
    ``ENOUGH`` trigrams are too little to reject a text on: undecided, it keeps
    its declared language.  ``lang`` is the declared language, and ``source``
    shares a prior.
    """
    model = fit(docs, text, lang)
    values = _grouped_by(F.col(lang), None, F.col(source))
    # the texts are weighed again for the decision: their evidence is longer than many of them, and is not kept
    seen = stored(docs.select(values.alias("values"), _evidence(model, docs.sparkSession, F.col(text)).alias("e")).select("values", "e.soft"))
    mark = free_name("langid_found", docs.columns)
    found = _weighed(docs, values, seen, model, [F.coalesce(F.col(text), F.lit(""))], mark)
    decided, trigrams = F.col(f"{mark}.lang"), F.col(f"{mark}.trigrams")
    sure = (decided != UNKNOWN) & (F.col(f"{mark}.confidence") >= least)
    kept = found.where((trigrams > 0) & (sure | (trigrams < ENOUGH)))
    named = F.when(sure, decided).otherwise(F.col(lang))
    return kept.select(*[named.alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns])
