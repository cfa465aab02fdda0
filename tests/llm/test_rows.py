"""Operators that work row by row: secrets, pieces, personal data."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import pieces, pii, secrets

DOCS = "doc_id long, text string, spans string"
ODD = [(1, None, "x"), (2, "", "x"), (3, "plain words", None), (3, "plain words", None), (None, "token=abcdef123", "y"), (4, "ä " * 20000, "z")]


def windows_by_brute_force(text, window, threshold):
    hot = set()
    for i in range(len(text) - window + 1):
        c = Counter(text[i : i + window])
        h = -sum(n / window * math.log2(n / window) for n in c.values())
        if h >= threshold - 1e-9:
            hot |= set(range(i, i + window))
    return hot


@given(st.text("ab01XYZ", max_size=60))
@settings(max_examples=60, deadline=None)
def test_entropy_runs_are_the_windows_over_the_threshold(text):
    found = secrets.entropy_runs(text, 8, 2.0)
    assert {i for a, b in found for i in range(a, b)} == windows_by_brute_force(text, 8, 2.0)


def base_secrets(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_secrets_equal_the_plain_patterns(spark):
    random.seed(4)
    parts = ['token = "', "secret:", "API_key= ", "AKIA", "0123456789abcdef", "ABCDEF012345", "x1=", "ſecret=abcdef99", " ", "\n", "é", '"', "passwd", "zz", "token=token : abcdef"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(400)]
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        want = base_secrets(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        kept = [x for x in r.spans.split(",") if x and not x.startswith("entropy")]
        assert ",".join(kept) == joined
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in want) for x in secrets.KINDS[:3])


def test_entropy_adds_random_strings_and_spares_the_allow_list():
    s = secrets.Scanner()
    assert any(k == 3 for _, k, _ in s.spans("key Zx8qP2vLm9Kd4Rt7Wy1Bn6Hs3Jf5 end"))
    for clean in ("abcdefghijklmnopqrstuvwxyz0123456789", "123e4567-e89b-12d3-a456-426614174000", "example-Zx8qP2vLm9Kd4Rt7Wy1Bn6Hs3Jf5", "antidisestablishmentarianism", "9" * 40):
        assert not [x for x in s.spans(clean) if x[1] == 3]


def test_secret_rows_are_all_kept_and_clashing_columns_stay(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    assert secrets.find_secrets(docs).count() == len(ODD)
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == len(ODD)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[None] == "[SECRET:assign]" and texts[1] is None and texts[3] == "plain words"
    assert secrets.find_secrets(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def both():
    with open(pieces.MODEL, "rb") as f:
        ours = pieces.Transducer(pieces.Spec.parse(f.read()))
    return ours, sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@given(st.text(st.characters(codec="utf-8", exclude_characters="▁"), max_size=40) | st.text("ab  theingr\n.é中", max_size=80))
@settings(max_examples=300, deadline=None)
def test_pieces_are_the_library_s_and_decode_to_the_text(both, text):
    ours, theirs = both
    ids = ours.encode(text)
    assert ids == theirs.encode(text)
    assert ours.decode(ids) == text


def test_long_runs_of_spaces_and_letters(both):
    ours, theirs = both
    for text in (" " * 500, "x" * 500, "  a   b" * 50, "aaa" * 99 + "\x00😀"):
        assert ours.encode(text) == theirs.encode(text)


def test_unigram_paths_are_the_cheapest(both):
    spec = pieces.Spec((("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -3.0, 1), ("▁ab", -3.5, 1), ("bb", -5.0, 1)), pieces.UNIGRAM, False, True, False, True)
    t = pieces.Transducer(spec)
    assert [text for text, *_ in t.shortest("▁abb")] == ["▁ab", "b"] and t.encode("ab") == [5] and t.encode("abb") == [5, 3]
    assert t.encode("az") == [1, 2, 0]


def test_user_pieces_are_kept_whole():
    with open(pieces.MODEL, "rb") as f:
        model = f.read()
    for name in (b"<sep>", b"the<sep>q"):
        field = b"\x0a" + bytes([len(name)]) + name + b"\x15\x00\x00\x00\x00\x18\x04"
        model += b"\x0a" + bytes([len(field)]) + field
    ours, theirs = pieces.Transducer(pieces.Spec.parse(model)), sentencepiece.SentencePieceProcessor(model_proto=model)
    for text in ("a<sep>b", "<sep>", "x <sep><sep> y", "the<sep>quick the<sep> quick", "<se p>"):
        assert ours.encode(text) == theirs.encode(text), text
        assert ours.decode(ours.encode(text)) == text


def test_the_mark_comes_back_as_a_space(both):
    ours, theirs = both
    for text in ("a▁b", "▁", "▁▁ x"):
        assert ours.encode(text) == theirs.encode(text) and ours.decode(ours.encode(text)) == text.replace("▁", " ")


def test_encoding_replaces_a_column_of_its_name(spark):
    df = spark.createDataFrame([(1, "ab cd", 5), (2, None, 6)], "doc_id long, text string, Ids int")
    out = pieces.encode_documents(df)
    assert out.columns == ["doc_id", "ids"] and {r.doc_id: len(r.ids) > 0 for r in out.collect()} == {1: True, 2: False}


def test_piece_digest_keeps_every_row(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    rows = pieces.digest(docs).collect()
    assert len(rows) == len(ODD) and all(r.round_trip or r.doc_id == 1 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    out = pieces.encode_documents(docs)
    assert out.columns == ["doc_id", "spans", "ids"] and out.count() == len(ODD)
    back = out.select(pieces.decoded(out["ids"], spark).alias("t"), "doc_id").collect()
    assert {r.t for r in back if r.doc_id == 4} == {"ä " * 20000}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def base_pii(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_pii_equals_the_plain_patterns(spark):
    random.seed(5)
    parts = ["a@b.co", "x.y@", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111", "+1 (555) 123-4567", "+", "12", " ", "é", "_", "😀", "n", "-", "c@d.e@f.g"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(400)]
    for r in pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        want = base_pii(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in want) for x in PLAIN)


def test_terms_that_reveal_an_entity_are_found_and_removed(spark):
    rows = [(i, f"Zorbax called 10.1.2.{i % 2} today about the weather") for i in range(4)] + [(i, "the weather today is fine about now called off") for i in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    assert "term:0:6" in got[0].spans and got[10].n_term == 0
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[0].endswith(" [IP] today about the weather") and "Zorbax" not in clean[0] and clean[10] == rows[4][1]


def test_pii_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    assert pii.report(docs).count() == len(ODD)
    assert pii.report(docs.limit(0)).count() == 0
    assert pii.report(spark.createDataFrame([(1, "1" * 50000), (2, "a" * 50000 + "@b.c")], "doc_id long, text string")).count() == 2


def test_sanitising_tells_rows_apart_by_content(spark):
    rows = [(None, "mail bob@x.org now"), (1, "aaaa bob@x.org bbb"), (1, "nothing personal here"), (1, "ring +1 555 123 4567 😀 é"), (2, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in pii.sanitised(docs).collect()]
    want = [(None, "mail [EMAIL] now"), (1, "aaaa [EMAIL] bbb"), (1, "nothing personal here"), (1, "ring [PHONE] 😀 é"), (2, None), (2, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.sanitised(docs.limit(0)).count() == 0


def test_very_many_matches_in_one_text_take_seconds(spark):
    n = 100_000
    docs = spark.createDataFrame([(1, " é ".join(f"u{i}@x.org" for i in range(n)))], "doc_id long, text string")
    import time

    began = time.time()
    row = docs.select(pii.base_matches(docs["text"], "email").alias("m")).first()
    assert time.time() - began < 10 and len(row.m) == n
    text = docs.first().text
    assert all(text[x.start : x.end] == x.m for x in row.m)


def test_terms_never_overlap_base_spans(spark):
    rows = [(i, "Zorbax zorbax@zorbax.org Zorbax 10.1.2.3 zorbaxİ") for i in range(3)] + [(i, f"other words {i}") for i in range(10, 60)]
    for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        spans = [(k, int(a), int(z)) for k, a, z in (x.split(":") for x in r.spans.split(",") if x)]
        base = [s for s in spans if s[0] != "term"]
        assert not [1 for k, a, z in spans if k == "term" for _, s, e in base if a < e and s < z]
        assert r.n_term == (3 if r.doc_id < 3 else 0)
