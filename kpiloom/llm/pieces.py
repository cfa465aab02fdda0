"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file gives the pieces, their scores, the normaliser's switches and
byte fallback.  Compiled together they are one transducer: it reads characters,
writes piece ids, and a state is the last piece written.  Its arcs are the
pieces and, for characters that no piece covers, their bytes' pieces (or the
unknown piece).  An arc's weight in the tropical semiring is the piece's cost
plus the cost of the pair (last piece, piece):

* unigram model: a piece costs minus its score and a pair nothing, so the
  shortest path is the most probable segmentation;
* BPE model: a piece costs nothing, and a pair costs nothing if merging its two
  texts by the model's merges gives back the pair, else infinity.  Every text
  has one path of finite cost, the BPE segmentation, since a segmentation is
  the one that merging yields exactly if all its neighbours are.

The normaliser is the transducer's first stage; as the model's character map is
the identity, all that it does is to squeeze, prefix and mark spaces, which is
compiled to string operations.  A user-defined piece is always one arc: nothing
else passes its place.  Composing the rest with an input and relaxing arcs from
left to right takes the shortest path.  No piece has a space mark after another
character, so an input is cut before each run of marks, and equal parts are
looked up.

Defined results: a null or empty text has no tokens and decodes to an empty
text; decoding gives back the text (the dummy prefix is taken off again), except
that the mark U+2581, which the model does not tell from a space, comes back as
one, and lone surrogates, which are no text, as what their bytes decode to; runs
of spaces are kept or squeezed as the model's normaliser says; of paths that
cost the same the one with the longer last piece is taken; repeated rows are
each encoded; texts are used whole; an empty table gives an empty result;
``encode_documents`` keeps all columns but ``text``, and replaces one named as
its result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.llm._tokens import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITE = float("inf")
#: The text that an arc reads, its length, its cost, the ids it writes.
Arc = tuple[str, int, float, tuple[int, ...]]
_START: Arc = ("", 0, 0.0, ())
#: Parts kept with their ids, and pairs kept with their weights, in each Python worker.
KEPT, KEPT_PAIRS = 100_000, 200_000


def _fields(buffer: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = buffer[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(buffer):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, buffer[at : at + size]
        at += size


@dataclass(frozen=True)
class Spec:
    """What a model file declares."""

    pieces: tuple[tuple[str, float, int], ...]
    kind: int
    byte_fallback: bool
    dummy_prefix: bool
    squeeze: bool
    escape: bool

    @staticmethod
    def parse(model: bytes) -> Spec:
        pieces, kind, fallback = [], UNIGRAM, False
        switches = {3: 1, 4: 1, 5: 1}
        for number, value in _fields(model):
            if number == 1:
                piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == 2:
                trainer = dict(_fields(value))
                kind, fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
            elif number == 3:
                normaliser = dict(_fields(value))
                if normaliser.get(2):
                    raise ValueError("character maps other than identity are not supported")
                switches |= {k: v for k, v in normaliser.items() if k in switches}
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {kind} is not supported")
        return Spec(tuple(pieces), kind, fallback, bool(switches[3]), bool(switches[4]), bool(switches[5]))


class Transducer:
    """A compiled model."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.ids: dict[str, int] = {}
        self.cost: list[float] = []
        self.unknown = 0
        byte_ids: dict[int, int] = {}
        for i, (piece, score, kind) in enumerate(spec.pieces):
            self.cost.append(-score)
            if kind in (NORMAL, USER):
                self.ids[piece] = i
            elif kind == BYTE:
                byte_ids[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
        self.bytes = [byte_ids.get(b, self.unknown) for b in range(256)] if spec.byte_fallback else None
        self.covered = {p for p in self.ids if len(p) == 1}
        self.dear = 10.0 - min((s for _, s, k in spec.pieces if k == NORMAL), default=0.0)  # what an uncovered character costs
        #: Finds every arc that an input spells.
        self.lexicon = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.lexicon.add_word(piece, (piece, len(piece), 0.0 if spec.kind == BPE else self.cost[i], (i,)))
        self.lexicon.make_automaton()
        whole = sorted((p for p, _, k in spec.pieces if k == USER), key=len, reverse=True)
        self.whole = re.compile("(" + "|".join(map(re.escape, whole)) + ")") if whole else None
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode() if k in (NORMAL, USER) else b" \xe2\x81\x87 " if k == UNKNOWN else b""
            for p, _, k in spec.pieces
        ]
        split = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.part = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if split else re.compile(r"(?s).+")
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- normaliser ---------------------------------------------------------
    def normalise(self, text: str) -> str:
        if self.spec.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        if self.spec.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.spec.escape else text

    # -- pair weights of BPE models ----------------------------------------
    def merged(self, text: str) -> list[str]:
        """``text`` after the model's merges: the best-scored neighbours first, of equals the leftmost."""
        parts = list(text)
        get, costs = self.ids.get, self.cost
        while len(parts) > 1:
            best, at = INFINITE, -1
            for i in range(len(parts) - 1):
                p = get(parts[i] + parts[i + 1])
                if p is not None and costs[p] < best:
                    best, at = costs[p], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def pair_fits(self, left: str, right: str) -> bool:
        """Whether merging keeps the pair as it is; ``left`` is empty at the start."""
        pair = (left, right)
        found = self.fits.get(pair)
        if found is None:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            found = self.fits[pair] = self.merged(left + right) == [p for p in pair if p]
        return found

    # -- shortest path ------------------------------------------------------
    def fallback(self, char: str) -> Arc:
        """The arc of a character that no piece covers."""
        ids = [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")] if self.bytes else [self.unknown]
        return char, 1, 0.0 if self.spec.kind == BPE else self.dear, tuple(ids)

    def shortest(self, part: str) -> list[Arc]:
        """Arcs along the shortest path through ``part``.

        Arcs are relaxed in order of the place where they end, and one state
        survives at each place: of a BPE model no other has finite cost, of a
        unigram model pairs cost nothing, so only the cheapest matters.
        """
        n = len(part)
        arcs = self.lexicon.iter(part)
        if not self.covered.issuperset(part):
            bare = [(k, self.fallback(c)) for k, c in enumerate(part) if c not in self.covered]
            arcs = sorted([*arcs, *bare], key=lambda arc: arc[0])
        best: list = [None] * (n + 1)
        best[0] = _START
        if self.spec.kind == BPE:  # costs are 0 or infinite: what is reached costs nothing, and no arc improves on it
            fits, pair_fits = self.fits, self.pair_fits
            for at, arc in arcs:
                if best[at + 1] is None:
                    before = best[at + 1 - arc[1]]
                    if before is not None:
                        fit = fits.get((before[0], arc[0]))
                        if pair_fits(before[0], arc[0]) if fit is None else fit:
                            best[at + 1] = arc
        else:
            cost = [0.0] + [INFINITE] * n
            for at, arc in arcs:
                step = cost[at + 1 - arc[1]] + arc[2]
                if step < cost[at + 1]:
                    cost[at + 1], best[at + 1] = step, arc
        out, end = [], n
        while end:
            out.append(best[end])
            end -= best[end][1]
        return out[::-1]

    def part_ids(self, part: str) -> list[int]:
        if self.whole and self.whole.fullmatch(part):
            return [self.ids[part]]
        out: list[int] = []
        for *_, ids in self.shortest(part):
            if ids != (self.unknown,) or not out or out[-1] != self.unknown:
                out += ids
        return out

    def parts(self, text: str) -> Iterator[str]:
        """User-defined pieces, and what lies between them cut before each run of marks."""
        if self.whole is None:
            yield from self.part.findall(text)
            return
        for k, between in enumerate(self.whole.split(text)):
            if k % 2:
                yield between
            else:
                yield from self.part.findall(between)

    def encode_packed(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        known, out = self.known, []
        for part in self.parts(self.normalise(text)):
            packed = known.get(part)
            if packed is None:
                packed = self.older.get(part)
                if packed is None:
                    ids = self.part_ids(part)
                    packed = struct.pack(f"<{len(ids)}i", *ids)
                if len(part) <= 64:
                    if len(known) >= KEPT:  # what was not used since the last change goes
                        self.older, self.known = known, {}
                        known = self.known
                    known[part] = packed
            out.append(packed)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        packed = self.encode_packed(text)
        return list(struct.unpack(f"<{len(packed) // 4}i", packed))

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.spec.dummy_prefix and text.startswith(" ") else text


def _compiled(model: str, spark: SparkSession):
    """The model's bytes, read on the driver, for every worker (a vocabulary file, whatever the corpus's size)."""
    with open(model, "rb") as f:
        content = f.read()
    Spec.parse(content)
    return spark.sparkContext.broadcast(content)


_worker: dict[int, Transducer] = {}


def _transducer(content: bytes) -> Transducer:
    """One compiled transducer for each model in a worker, kept between tasks."""
    key = xxhash.xxh64_intdigest(content)
    if key not in _worker:
        _worker[key] = Transducer(Spec.parse(content))
    return _worker[key]


def decoded(ids: Column, spark: SparkSession, model: str = MODEL) -> Column:
    """The text of an array of piece ids; null stays null."""
    held = _compiled(model, spark)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        t = _transducer(held.value)
        for rows in batches:
            yield pd.Series([None if x is None else t.decode(x) for x in rows])

    return run(ids)


def encode_documents(docs: DataFrame, text: str = "text", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``docs`` with column ``ids``, an array of ints, in place of ``text``.

    Results leave in slices of about a million characters, so that a worker
    holds no more ids than that at once.
    """
    kept = docs.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    held = _compiled(model, docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = _transducer(held.value)
        for b in batches:
            for lo, hi in slices(b[text].tolist()):
                part = b.iloc[lo:hi]
                found = [np.frombuffer(t.encode_packed(x), dtype="<i4") for x in part[text]]
                yield part.drop(columns=[text]).assign(**{ids: found})[schema.names]

    # names are told apart as Spark does, without case
    schema = T.StructType([f for f in docs.schema if f.name.lower() not in (text.lower(), ids.lower())] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return kept.drop(ids).mapInPandas(run, schema)


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """key, n_tokens, ids_xxh64, n_chars and round_trip of every row: encoded, then decoded again.

    ``ids_xxh64`` is the hash of the ids as little-endian 32-bit integers, and
    ``round_trip`` whether decoding them gives the text.
    """
    held = _compiled(model, docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_xxh64 string, n_chars long, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        t = _transducer(held.value)
        for texts in batches:
            rows = []
            for x in texts:
                packed = t.encode_packed(x)
                back = t.decode(struct.unpack(f"<{len(packed) // 4}i", packed))
                rows.append((len(packed) // 4, xxhash.xxh64_hexdigest(packed), len(back), back == x))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_xxh64", "n_chars", "round_trip"])

    return docs.select(F.col(key), run(F.coalesce(F.col(text), F.lit(""))).alias("d")).select(key, "d.*")
