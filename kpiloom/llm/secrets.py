"""Secret scanning: pattern rules plus sliding-window entropy over candidate strings.

Three base patterns (``assign``, ``access``, ``hex``) give spans; the entropy
method adds ``entropy`` spans.  A candidate is a maximal run of token
characters.  For every character class a window slides over the runs of that
class inside the candidate; its Shannon entropy is kept by incremental counts
(one character enters, one leaves).  Windows at or over the class's threshold
are merged into a span, unless the allow-list suppresses it.

Runs of ``MIN_CANDIDATE`` characters up to a window's length are one window,
with the threshold lowered in proportion to what their length can reach.

Defined results: a null text is an empty text and has no spans; a repeated row
is scanned again and kept; whole texts are scanned, whatever their length; equal
spans of one kind count once, and spans with one start are ordered by kind; an
empty table gives an empty result; other columns stay as they are, whatever
their names.  Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm._store import free_name

KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_KEYWORDS = (b"passw", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")


@dataclass(frozen=True)
class CharClass:
    """A character class with its window length and entropy threshold in bits."""

    name: str
    run: str
    window: int
    threshold: float

    def fitted(self, length: int) -> tuple[int, float]:
        """Window and threshold for a run: one shorter than the window is one window, and can reach log2 of its length."""
        if length >= self.window:
            return self.window, self.threshold
        return length, self.threshold * math.log2(length) / math.log2(self.window)


#: Sixteen symbols can reach 4 bits and 64 symbols 6 bits, but a window of n
#: characters reaches log2(n) at most; thresholds sit below a random window's mean.
CLASSES = (
    CharClass("hex", r"[0-9a-fA-F]+", 20, 3.0),
    CharClass("base64", r"[A-Za-z0-9+/_=-]+", 24, 4.0),
)
MIN_CANDIDATE = 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE)

#: Candidates that look random and are no secrets.
ALLOW = (
    r"[0-9]+",  # plain numbers
    r"[A-Za-z]+",  # words
    r"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",  # UUIDs
    r"(?i).*(example|sample|dummy|placeholder|changeme|xxxx).*",
    r"(?i).*(abcdefghij|0123456789).*",  # alphabets
    r"[A-Za-z]+([-_/][A-Za-z]+)+[0-9]{0,4}",  # slugs and paths of words
)


def entropy_runs(text: str, window: int, threshold: float) -> list[tuple[int, int]]:
    """Maximal unions of windows of ``text`` whose Shannon entropy reaches ``threshold``.

    H = log2(w) - (1/w) * sum(c * log2(c)); moving the window by one changes
    two counts, so each step costs O(1).
    """
    n = len(text)
    if n < window:
        return []
    part = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    out: list[list[int]] = []
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        total += part[c + 1] - part[c]
        counts[ch] = c + 1
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += part[c - 1] - part[c]
            counts[old] = c - 1
        if i >= window - 1 and math.log2(window) - total / window >= threshold - 1e-9:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1][1] = i + 1
            else:
                out.append([start, i + 1])
    return [(a, b) for a, b in out]


class Scanner:
    """Compiled rules, built once in each Python worker."""

    def __init__(self, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ALLOW):
        self.classes = [(c, re.compile(c.run)) for c in classes]
        self.allow = [re.compile(a) for a in allow]

    def allowed(self, candidate: str) -> bool:
        return any(a.fullmatch(candidate) for a in self.allow)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, kind index, end), in order."""
        out: list[tuple[int, int, int]] = []
        low = text.encode("utf-8", "surrogatepass").lower()
        if any(k in low for k in _KEYWORDS):
            out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        base = sorted((s, e) for s, _, e in out)
        starts, reach = [s for s, _ in base], list(accumulate((e for _, e in base), max))
        found: set[tuple[int, int, int]] = set()
        for m in _CANDIDATE.finditer(text):
            if self.allowed(m[0]):
                continue
            for c, run in self.classes:
                for r in run.finditer(m[0]):
                    if self.allowed(r[0]):
                        continue
                    if len(r[0]) < MIN_CANDIDATE:
                        continue
                    window, threshold = c.fitted(len(r[0]))
                    for a, b in entropy_runs(r[0], window, threshold):
                        s, e = m.start() + r.start() + a, m.start() + r.start() + b
                        earlier = bisect_right(starts, s)
                        if not earlier or reach[earlier - 1] < e:  # no base span holds it
                            found.add((s, 3, e))
        return sorted(out + list(found))


def joined(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every (merged) span replaced by a marker."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[SECRET:{KINDS[k]}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


_SCAN = (
    "n_assign long, n_access long, n_hex long, n_entropy long,"
    " base_sha256 string, spans string, redacted string"
)


def scan(text: Column, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ALLOW) -> Column:
    """A struct of counts, digest, spans and (where it differs) redacted text for a text column."""
    classes, allow = tuple(classes), tuple(allow)

    @F.pandas_udf(_SCAN)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(classes, allow)
        for texts in batches:
            rows = []
            for t in texts:
                spans = scanner.spans(t)
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                base = joined(x for x in spans if x[1] < 3)
                digest = hashlib.sha256(base.encode()).hexdigest()
                rows.append((*n, digest, joined(spans), redacted(t, spans) if spans else None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCAN.split(",")])

    return run(F.coalesce(text, F.lit("")))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, counts by kind, base digest and all spans."""
    out = docs.select(F.col(key).alias("key"), scan(F.col(text)).alias("scan"))
    return out.select(F.col("key").alias(key), "scan.*").drop("redacted")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by markers; all rows and columns stay.

    A text without secrets stays as it is, null included.
    """
    mark = free_name("scan_of_secrets", docs.columns)
    out = docs.withColumn(mark, scan(F.col(text)))
    changed = F.coalesce(F.col(f"{mark}.redacted"), F.col(text))
    return out.withColumn(text, changed).drop(mark).select(*[F.col(f"`{c}`") for c in docs.columns])
