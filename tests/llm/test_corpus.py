"""Operators that look across documents, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from kpiloom.llm import components, decontaminate, golay, langid, quality, simhash, topk, toxicity, warc

VOCABULARY = [a + b for a in ("ba", "de", "ki", "lo", "mu", "ne", "pa", "ro") for b in ("st", "nd", "ll", "rk", "mp", "zz")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randint(0, 9)) for _ in range(n))


def test_golay_words_within_two_bits_share_a_key():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 23, 300)
    for flips in (0, 1, 2):
        v = u.copy()
        for i in range(len(v)):
            for b in rng.choice(23, flips, replace=False):
                v[i] ^= 1 << int(b)
        (pu, ku), (pv, kv) = golay.keys(u), golay.keys(v)
        for i in range(len(u)):
            assert set(ku[pu == i]) & set(kv[pv == i])
    assert set(np.bincount(golay.keys(u)[0])) <= {1, 6}


def fingerprint_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def linked(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    base = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    texts = base + [t + rng.choice(["", " x", "!"]) for t in base] + ["", None, "One", "one", "ÄB ÄB", "äb äb"]
    long = prose(rng, 900).split()
    texts += [" ".join(long[:i] + ["changed"] + long[i + 1 :]) for i in range(0, 900, 40)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, fp string")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [fingerprint_by_hand(t) for t in texts]
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in range(len(texts))] == linked(prints, 2)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_full_buckets_are_linked_without_their_pairs(spark):
    rng = np.random.default_rng(4)
    flips = np.uint64(1) << rng.integers(0, 64, (6000, 4)).astype(np.uint64)
    near = np.bitwise_xor.reduce(np.where(rng.random((6000, 4)) < 0.7, flips, 0), axis=1) ^ np.uint64(0x0123456789ABCDEF)
    prints = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 300).astype(np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    got = {(r.a, r.b) for r in simhash.links(df).collect()}
    assert all((a ^ b).bit_count() <= 2 for a, b in ((a % 2**64, b % 2**64) for a, b in got)) and len(got) < 65 * len(prints)
    root = {int(x): int(x) for x in prints.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in got:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    held = np.array([find(int(x)) for x in prints.view(np.int64)])
    for i, p in enumerate(prints):  # every pair within 2 bits is connected
        assert (held[np.bitwise_count(prints ^ p) <= 2] == held[i]).all()


def test_near_duplicates_of_null_repeated_and_long_rows(spark):
    rng = random.Random(16)
    long = prose(rng, 300_000)
    rows = [(None, "a b c"), (None, "a b c"), (9, "A B C"), (4, "other words here"), (4, "a b c"), (None, "alone here now"), (7, long), (8, long + " x")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, node long, component string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    prints = [fingerprint_by_hand(t) for _, t in rows]
    root = linked(prints, 2)
    least = {r: min((k for (k, _), x in zip(rows, root) if x == r and k is not None), default=None) for r in root}
    assert got == sorted(((k, f"{p:016x}", least[r]) for (k, _), p, r in zip(rows, prints, root)), key=str)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 40)]
    rows = spark.createDataFrame([*chain, *star, (900, 900), (5, 6)], "a long, b long")
    got = {r.node: r.root for r in components.components(rows).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(5, 40)} == {5} and got[900] == 900


def test_one_of_each_group_stays(spark):
    rng = random.Random(3)
    base = [prose(rng, 200) for _ in range(12)]
    near = []
    for t in base[:6]:
        w = t.split()
        w[7] = "other"
        near.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(base + near + base[:2])] + [(3, base[3]), (None, base[4])]
    out = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in out) == list(range(12))


def test_one_of_each_with_clashing_columns(spark):
    rows = [(1, "a b c d e f g", 1, "k", "c", 2), (2, "a b c d e f g", 1, "k", "c", 2), (3, "h i j k l m n", 1, "k", "c", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_key int, Kept_Content string, content string, node int")
    out = simhash.one_of_each(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {1, 3}


@pytest.mark.parametrize("peels", [6, 1])
def test_similar_texts_are_linked_by_exact_similarity(spark, monkeypatch, peels):
    monkeypatch.setattr(simhash, "PEELS", peels)
    rng = random.Random(8)
    rows, want = [], set()
    for g in range(40):
        words = prose(rng, 104).split()  # 100 shingles, of which a changed end of m words changes m
        rows.append((10 * g, " ".join(words)))
        want.add(10 * g)
        for at, m in ((1, 11), (2, 12)):  # similarities 89/111 and 88/112
            rows.append((10 * g + at, " ".join([*words[:-m], *prose(rng, m).split()])))
        want.add(10 * g + 2)
    line = prose(rng, 30)
    for i in range(1000, 1040):  # alike in one line, never similar
        rows.append((i, f"{line} {prose(rng, 12)}"))
        want.add(i)
    out = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in out} == want and len(out) == len(want)


def test_pairs_by_golay_keys_of_the_fingerprints_are_compared(spark):
    word = 0x0F0F_3355_77AA_1234
    sets = {"a": range(100), "b": range(100), "c": range(2, 102), "d": range(50, 150), "e": range(500, 600)}
    prints = {"a": word, "b": word, "c": word ^ (1 << 40 | 1 << 3), "d": word ^ 1, "e": word ^ (7 << 20)}  # d is near but not similar
    nodes = spark.createDataFrame([(k.encode(), prints[k], 100, 0, 0, 0, 0, []) for k in sets], "node binary, fp long, n long, w0 long, w1 long, w2 long, w3 long, keys array<long>")
    held = spark.createDataFrame([(k.encode(), list(v)) for k, v in sets.items()], "node binary, s array<long>")
    roots = simhash.wide_components(nodes, lambda wanted: held.join(wanted, "node"))
    assert {(bytes(r.node), bytes(r.root)) for r in roots.collect()} == {(b"a", b"a"), (b"b", b"a"), (b"c", b"a")}


def clouds(rng):
    """Texts that differ from a few base texts in anything from one word to a third of all; some clouds share half a text."""
    shared = prose(rng, 70).split()
    texts = []
    for g in range(5):
        base = [*shared, *prose(rng, 50).split()] if g < 3 else prose(rng, 120).split()
        for _ in range(70):
            words = list(base)
            for _ in range(rng.randint(0, 9)):
                at = rng.randrange(len(words))
                words[at : at + 1] = rng.choice([[], ["swapped" + str(rng.randint(0, 3))], [words[at], prose(rng, 1)]])
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("peels", [6, 1])
def test_clouds_of_near_copies_equal_all_pairs_by_true_similarity(spark, monkeypatch, peels):
    monkeypatch.setattr(simhash, "PEELS", peels)
    texts = clouds(random.Random(11))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    kept = simhash.one_of_each(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({find(i) for i in range(len(texts))})


def test_decontamination_tolerates_substitutions_and_spares_the_rest(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 20 + i)) for i in range(10)] + [(10, "six words make one short item"), (11, "too short"), (12, None)]
    rows, want = [], set()
    for d in range(120):
        text = prose(rng, 150)
        if d % 3 == 0:
            i = d // 3 % 11
            words = items[i][1].split()
            if d % 2 and i < 10:
                words[9] = "swapped"
            text, _ = f"{text[:300]} {' '.join(words).upper()} {text[300:]}", want.add((d, i))
        rows.append((d, text, "clash"))
    docs = spark.createDataFrame([*rows, (500, None, ""), (501, "", "")], "doc_id long, text string, item string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == want
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_short_items_are_found_with_every_substitution(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    items, rows, want = [], [], set()
    for n in range(1, 15):
        item = [words.pop() for _ in range(n)]
        items.append((n, " ".join(item)))
        need = min(12, -(-4 * n // 5))
        lacks = [(), *((i,) for i in range(n)), *((i, j) for i in range(n) for j in range(i))]
        for places in [*lacks, "head", "tail"]:
            copy = item[:need] if places == "head" else item[-need:] if places == "tail" else ["swapped" if i in places else x for i, x in enumerate(item)]
            d = len(rows)
            rows.append((d, f"{prose(rng, 20)} {' '.join(copy)} {prose(rng, 20)}"))
            same = [x == y for x, y in zip(copy, item if places != "tail" else item[-need:])]
            if any(sum(same[a:z]) >= max(need, 0.8 * (z - a)) for a in range(len(same)) for z in range(a + 1, len(same) + 1)):
                want.add((d, n))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()} == want


def overlap_by_hand(doc, item):
    """Matches of the best stretch over all diagonals that the stated rule accepts, 0 if none."""
    need, best = min(12, -(-4 * len(item) // 5)), 0
    for d in range(1 - len(item), len(doc)):
        same = [0 <= d + i < len(doc) and doc[d + i] == x for i, x in enumerate(item)]
        if sum(same) < need:
            continue
        at = [i for i, x in enumerate(same) if x]
        for a in range(len(at)):
            for z in range(a, len(at)):
                if z - a + 1 >= need and 5 * (z - a + 1) >= 4 * (at[z] - at[a] + 1):
                    best = max(best, z - a + 1)
    return best


def test_overlaps_equal_all_diagonals_by_the_stated_rule(spark):
    rng = random.Random(13)
    items = [(i, prose(rng, rng.choice([5, 8, 12, 14, 15, 16, 20, 40, 150]))) for i in range(40)]
    rows = []
    for d in range(250):
        words = prose(rng, rng.choice([0, 10, 60])).split()
        item = items[rng.randrange(40)][1].split()
        a = rng.randrange(max(1, len(item) - 11)) if rng.random() < 0.5 else 0
        z = rng.randint(a + 1, len(item)) if rng.random() < 0.3 else len(item)
        part = item[a:z]
        for i in rng.sample(range(len(part)), int(len(part) * rng.choice([0, 0.1, 0.2, 0.25]))):
            part[i] = "swapped"
        rows.append((d, " ".join([*words, *part, *prose(rng, 10).split()])))
    want = {}
    for d, t in rows:
        for i, x in items:
            if n := overlap_by_hand(t.split(), x.split()):
                want[d, i] = n
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want) and len(want) > 100
    assert all(r.matched == want[k] and 5 * r.matched >= 4 * r.length for k, r in got.items())


def test_decontamination_tells_rows_apart_by_text(spark):
    rng = random.Random(14)
    item = prose(rng, 30)
    rows = [(None, f"{prose(rng, 20)} {item}"), (1, prose(rng, 50)), (1, f"{item} {prose(rng, 20)}"), (None, prose(rng, 20)), (2, prose(rng, 60_000) + " " + item), (3, None)]
    docs = spark.createDataFrame([(*r, "x", i) for i, r in enumerate(rows)], "doc_id long, text string, contaminated_content string, iid int")
    bench = spark.createDataFrame([(7, item, "y"), (7, item, "y"), (7, prose(rng, 30), "y"), (8, None, "y")], "item_id long, text string, doc_id string")
    assert sorted(r.iid for r in decontaminate.decontaminate(docs, bench).collect()) == [1, 3, 5]


def brute_top(rows, ids, k):
    vs = {i: [int(np.floor(256 * float(x))) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in ids:
        if q in vs:
            scored = sorted(((-sum(a * b for a, b in zip(vs[q], v)), i) for i, v in vs.items() if i != q))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("bucket, parts", [(4096, 0), (32, 0), (32, 97)])
def test_top_k_equals_brute_force(spark, monkeypatch, bucket, parts):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    if parts:  # a cluster may deal out more partitions than asked for
        monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda self, n, *cols, f=type(spark.range(0)).repartitionByRange: f(self, max(n, parts), *cols))
    monkeypatch.setattr(topk, "BLOCK", 8)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8) * rng.choice([0.05, 1, 6])]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (2200, [0.0] * 8), (2250, [3.0, 1.0])]
    rows += [(2300, [1e9] * 8), (2350, [-1e9] * 8)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, norm string")
    got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5).select("query_id", "rank", "vec_id", "score").collect()}
    assert got == brute_top(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_top_k_of_repeated_rows_few_rows_and_huge_components(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1e20, 0.0]), (3, [-1e20, 0.0]), (None, [9.0, 9.0]), (50, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), 5).select("query_id", "rank", "vec_id", "score").collect())
    top, low = (1 << 63) - 1, -(1 << 63)
    assert got == [(0, 1, 2, top), (0, 2, 1, 131072), (0, 3, 1, 131072), (0, 4, 50, 0), (0, 5, 3, low), (50, 1, 0, 0), (50, 2, 0, 0), (50, 3, 1, 0), (50, 4, 1, 0), (50, 5, 2, 0)]
    one = df.where("vec_id = 50")
    assert topk.top_k(one, one, 5).count() == 0


def test_revisits_equal_a_plain_search(spark, monkeypatch):
    monkeypatch.setattr(warc, "SLICE", 5)
    rng = random.Random(9)
    recs = []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "revisit"])
        headers = {"etag": rng.choice(['"a"', 'W/"a"', '"b"']), "server": str(i), "date": str(i)}
        if rng.random() < 0.3:
            headers = {"last-modified": rng.choice(["x", "y"])}
        url = rng.choice(["http://www.h.com/hot/", "https://h.com/hot?utm_source=q", "http://h.com/b?z=1&a=2#f", "http://h.com:80/b?a=2&z=1"])
        recs.append((i, url, 1_700_000_000 + rng.randint(0, 60), kind, headers, f"d{i}" if kind == "response" else None))
    recs.append((900, None, 5, "revisit", {}, None))
    df = spark.createDataFrame(recs, "record_id long, url string, t long, kind string, headers map<string,string>, payload_digest string").selectExpr("*", "timestamp_seconds(t) AS ts")
    got = {r.record_id: r for r in warc.resolve(df).collect()}
    bare = lambda e: e and e.removeprefix("W/")
    group = lambda u: u and ("hot" if "hot" in u else "b")
    for i, url, t, kind, h, _ in recs:
        if kind != "revisit":
            assert i not in got
            continue
        before = [r for r in recs if r[3] == "response" and group(r[1]) == group(url) and r[2] < t]
        r = max(before, key=lambda r: (r[2], r[0])) if before else None
        e, m = bare(h.get("etag")), h.get("last-modified")
        if r is None:
            status = "orphan"
        elif e and r[4].get("etag"):
            status = "resolved" if e == bare(r[4]["etag"]) else "mismatch"
        elif m and r[4].get("last-modified"):
            status = "resolved" if m == r[4]["last-modified"] else "mismatch"
        else:
            status = "unvalidated"
        assert (got[i].status, got[i].response_id) == (status, r and r[0]), (i, status)
        if status == "resolved":
            assert got[i].headers == {**r[4], **{k: v for k, v in h.items() if k in warc.PERMITTED}}
            assert got[i].payload_digest == r[5]
    assert warc.resolve(df.limit(0)).count() == 0


def test_repeated_revisits_are_each_resolved_once(spark):
    at = "TIMESTAMP'2024-01-01 00:00:00'"
    rows = [(1, "http://h/a", 0, "response", {"etag": "x"}, "p")] * 2 + [(1, "http://h/a", 0, "response", None, "q"), (2, "http://h/a", 9, "revisit", {"etag": "x"}, None), (2, "http://h/a", 9, "revisit", {"etag": "x"}, None)]
    rows += [(None, "http://h/a", 9, "revisit", {"etag": None}, None), (None, "http://h/a", 9, "revisit", None, None), (3, "http://h/a", 0, "revisit", {"etag": "x"}, None), (4, None, 9, "revisit", {}, None), (5, "http://h/a", None, "revisit", {}, None), (6, "http://h/a", 9, None, {}, None)]
    df = spark.createDataFrame(rows, "record_id long, url string, s int, kind string, headers map<string,string>, payload_digest string").selectExpr("*", f"{at} + make_dt_interval(0, 0, 0, s) AS ts", "1 AS row", "'x' AS match")
    got = sorted(((r.record_id, r.status, r.response_id, r.payload_digest) for r in warc.resolve(df).collect()), key=str)
    assert got == sorted([(2, "resolved", 1, "p"), (2, "resolved", 1, "p"), (None, "unvalidated", 1, None), (None, "unvalidated", 1, None), (3, "orphan", None, None), (4, "orphan", None, None), (5, "orphan", None, None)], key=str)


def test_header_blocks(spark):
    row = spark.createDataFrame([("HTTP/1.1 200 OK\r\nETag: a\r\nServer : x\r\netag: b",)], "b string").select(warc.headers_of("b").alias("h")).first()
    assert row.h == {"etag": "b", "server": "x"}


LANGUAGES = {"aa": "the and of to in is that for with was", "bb": "der die und das ist nicht ein mit von auf"}


def test_language_evidence_is_fused(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choices(LANGUAGES[x].split(), k=40)), x, f"src-{x}") for i, x in enumerate(["aa", "bb"] * 60)]
    df = spark.createDataFrame([*docs, (900, None, "aa", None), (901, "", "bb", "s"), (902, "77 88 !!", "aa", "s"), (903, "the", "aa", "src-aa"), (904, "қҗғ " * 99, None, "s"), (905, "zqx", "bb", "s")], "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.lang for r in langid.keep_identified(df).collect()}
    assert kept == {i: x for i, _, x, _ in docs} | {903: "aa", 905: "bb"}
    assert langid.keep_identified(df.limit(0)).count() == 0
    pages = spark.createDataFrame([(i, f"http://www.{x}.example.{x}/p", f'<html lang="{x}"><script>und</script><p>{t}</p>') for i, t, x, _ in docs] + [(800, "http://bb.example.bb/q", "<html><p>zq</p>"), (801, None, None)], "page_id long, url string, html string")
    found = {r.page_id: r for r in langid.identify_pages(pages, df).collect()}
    assert all(found[i].lang == x for i, _, x, _ in docs)
    assert found[800].lang == "bb" and len(found) == len(docs) + 2


def trigrams_by_hand(text):
    low = [ord(c) for c in (text or "").lower()]
    codes = [32, *(c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in low), 32]
    out = []
    for i in range(1, len(codes) - 1):
        if codes[i] != 32:
            h = 0
            for c, k in zip(codes[i - 1 : i + 2], (0x9E3779B1, 0x85EBCA77, 1)):
                h = (h + c) * k & 0xFFFFFFFF
            h = (h ^ h >> 15) * 0xC2B2AE3D & 0xFFFFFFFF
            out.append((h ^ h >> 13) & (langid.BUCKETS - 1))
    return out


def language_by_hand(docs, rows):
    """docs: (text, lang); rows: (key, text, declared, suffix, domain, host).  Returns key -> (lang, confidence, text_lang)."""
    import math
    from collections import Counter, defaultdict

    names = sorted({x for _, x in docs})
    counts = {x: Counter() for x in names}
    for t, x in docs:
        counts[x].update(trigrams_by_hand(t))
    names.append("und")
    logs, soft = [], []
    for _, t, *_ in rows:
        grams = trigrams_by_hand(t)
        v = []
        for x in names:
            if x == "und":
                v.append(-len(grams) * math.log(langid.BUCKETS))
            else:
                total = sum(counts[x].values()) + 0.5 * langid.BUCKETS
                v.append(sum(math.log((counts[x][g] + 0.5) / total) for g in grams))
        v = [y / (1 + len(grams) / langid.TEMPER) for y in v]
        logs.append(v)
        w = [y + math.log(0.01 if x == "und" else 0.99 / (len(names) - 1)) for x, y in zip(names, v)]
        e = [math.exp(y - max(w)) for y in w]
        soft.append([y / sum(e) for y in e])
    n = range(len(names))
    total = [sum(s[i] for s in soft) for i in n]
    share = [(total[i] + 1) / (sum(total) + len(names)) for i in n]
    sums = [defaultdict(lambda: [0.0] * len(names)) for _ in range(4)]
    for row, s in zip(rows, soft):
        for by in range(4):
            sums[by][row[2 + by]] = [a + b for a, b in zip(sums[by][row[2 + by]], s)]
    out = {}
    for row, v, s in zip(rows, logs, soft):
        rest = [[max(a - b, 0) for a, b in zip(sums[by][row[2 + by]], s)] for by in range(4)]

        def smooth(c, towards, w):
            return [(x + w * y) / (sum(c) + w) for x, y in zip(c, towards)]

        fused = [a + math.log(b) for a, b in zip(v, smooth(rest[3], smooth(rest[2], share, 20), 10))]
        for by in (0, 1):
            if row[2 + by]:
                fused = [a + math.log(b / c) for a, b, c in zip(fused, smooth(rest[by], share, 2), share)]
        e = [math.exp(y - max(fused)) for y in fused]
        best = max(n, key=lambda i: (round(e[i], 12), -i))
        text_best = max(n, key=lambda i: (round(s[i], 12), -i))
        out[row[0]] = (names[best], e[best] / sum(e), names[text_best] if trigrams_by_hand(row[1]) else "und")
    return out


def test_page_languages_equal_plain_dictionaries(spark):
    rng = random.Random(12)
    words = {x: w.split() for x, w in LANGUAGES.items()} | {"cc": "el la los que en un por con una las".split()}
    docs = [(" ".join(rng.choices(words[x], k=rng.randint(1, 30))), x) for x in words for _ in range(30)] + [("", "aa"), ("the the", "bb")]
    pages, rows = [], []
    for i in range(200):
        x, y = rng.choice(list(words)), rng.choice(list(words))
        text = " ".join(rng.choices(words[x], k=rng.choice([0, 1, 2, 5, 40]))) if rng.random() < 0.9 else "zq" * rng.randint(0, 60)
        declared = rng.choice(["", x, x, y])
        suffix, site = rng.choice(["", x, "com"]), rng.choice(["hot", "b", "c"])
        host = f"{rng.choice(['www.', 'a.', ''])}{site}.{suffix}" if suffix else ""
        url = f"https://{host.upper()}:80/p?q={i}" if suffix else rng.choice([None, "", "no address"])
        host = host.removeprefix("www.")
        pages.append((i, url, f"<HTML class=x lang='{declared}'>" * bool(declared) + f"<script>der die das</script><!-- the --><p>{text}</p> &eacute;<", "clash"))
        rows.append((i, text + " é", declared, suffix, f"{site}.{suffix}" if suffix else "", host))
    rows = [(k, t, d, s, ".".join(h.split(".")[-2:]), h) for k, t, d, s, _, h in rows]
    pages += [(500, None, None, None), (0, pages[0][1], pages[0][2], None)]
    rows += [(500, "", "", "", "", ""), rows[0]]
    want = language_by_hand(docs, rows)
    df = spark.createDataFrame(docs, "text string, lang string")
    found = langid.identify_pages(spark.createDataFrame(pages, "page_id long, url string, html string, langid_values string"), df).collect()
    assert len(found) == len(pages)
    for r in found:
        lang, p, text_lang = want[r.page_id]
        assert (r.lang, r.text_lang) == (lang, text_lang) and abs(r.confidence - p) < 1e-3, r


def test_a_page_with_unclosed_tags_takes_linear_time():
    import time

    began = time.time()
    for piece in ("<script ", "<!-- ", "<style><p", "<", "<a ", "</script", "<script></script"):
        langid.page_text(piece * 200_000)
    assert time.time() - began < 10
    assert langid.page_text("a<script>x</SCRIPT >b<!-- c -->d<p>e<b f &amp; g") == "a b d e<b f & g"
    assert langid.page_text("a<script>x<style>y</style>z") == "a x z"


def test_every_labelled_language_is_kept(spark):
    rng = random.Random(10)
    docs = []
    for i in range(70):  # two letters of its own each
        a, b = chr(0x4E00 + 2 * i), chr(0x4E01 + 2 * i)
        for j in range(2 if i == 69 else 4):
            docs.append((len(docs), " ".join("".join(rng.choice((a, b)) for _ in range(4)) for _ in range(20)), f"l{i:02d}", f"s{i}"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.lang for r in langid.keep_identified(df).collect()} == {i: x for i, _, x, _ in docs}


def labelled(rng, n=400):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        if bad:
            words[5:5] = ["vile", "scum"]
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, 1 if bad else 0))
    return docs, labels


@pytest.mark.parametrize("module, name, threshold, rem", [(quality, "quality", 0.7, (4, 2)), (toxicity, "toxic", 0.5, (5, 0))])
def test_classifiers_on_the_held_out_fold(spark, module, name, threshold, rem):
    import zlib

    docs, labels = labelled(random.Random(2))
    odd = [(9001, None), (9002, ""), (9001, None), (9003, "a " * 30000), (None, "x")]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (1, 0, 0), (7777, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = module.classify(df, lab).collect()
    assert len(rows) == len(docs) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    truth = {i: (q if name == "quality" else t) for i, q, t in labels}
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 9000 and zlib.crc32(str(r.doc_id).encode()) % rem[0] == rem[1]]
    assert all(r.held_out for r in held) and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert module.classify(df, lab.limit(0)).count() == len(rows)
    assert module.classify(df.limit(0), lab).count() == 0


def test_quality_features_equal_a_plain_count():
    texts = ["The cat the cat", "", "  a\tbb  ccc ", "x x y x"]
    groups = list(quality.features(texts))
    by_text = lambda g, t: g[0][g[1] == t]
    words, pairs, twice, apart, three, four = groups
    assert [len(by_text(words, t)) for t in range(4)] == [4, 0, 3, 4] and [len(by_text(pairs, t)) for t in range(4)] == [3, 0, 2, 3]
    assert [len(by_text(twice, t)) for t in range(4)] == [0, 0, 0, 1] and [len(by_text(apart, t)) for t in range(4)] == [1, 0, 0, 1]
    assert by_text(words, 0)[1] == by_text(words, 0)[3] != by_text(words, 0)[0] and by_text(words, 3)[0] == by_text(words, 3)[1]
    grams = lambda t, n: [g for g in (f" {' '.join(t.split())} "[i : i + n] for i in range(len(" ".join(t.split())) + 3 - n)) if " " not in g[1:-1]]
    assert [len(by_text(three, t)) for t in (0, 3)] == [len(grams(texts[t], 3)) for t in (0, 3)]
    assert [len(by_text(four, t)) for t in (0, 3)] == [len(grams(texts[t], 4)) for t in (0, 3)]
    alone = [by_text(g, 3) for g in groups]
    assert all((a == b).all() for a, b in zip(alone, (g for g, _ in quality.features([texts[3]]))))


def test_quality_training_equals_plain_gradient_steps(monkeypatch):
    import math

    for name, value in (("BUCKETS", 8), ("DIMENSION", 3), ("EPOCHS", 3)):
        monkeypatch.setattr(quality, name, value)
    rows = [(np.array([0, 2, 5]), np.array([0.2, 0.1, 0.3]), 1), (np.array([1, 2]), np.array([0.3, 0.3]), 0), (np.array([5, 7]), np.array([0.1, 0.5]), 1)]
    rng = np.random.default_rng(7)
    vectors = rng.uniform(-1 / 3, 1 / 3, (8, 3)).tolist()
    layer, bias, step = [[0.0, 0.0] for _ in range(3)], [0.0, 0.0], 0
    for _ in range(3):
        for i in rng.permutation(3):
            buckets, share, y = rows[i]
            rate, step = 0.5 * (1 - step / 9), step + 1
            hidden = [sum(s * vectors[b][d] for b, s in zip(buckets, share)) for d in range(3)]
            z = [math.exp(sum(hidden[d] * layer[d][c] for d in range(3)) + bias[c]) for c in (0, 1)]
            slope = [z[c] / sum(z) - (c == y) for c in (0, 1)]
            back = [sum(layer[d][c] * slope[c] for c in (0, 1)) for d in range(3)]
            for c in (0, 1):
                bias[c] -= rate * slope[c]
                for d in range(3):
                    layer[d][c] -= rate * hidden[d] * slope[c]
            for b, s in zip(buckets, share):
                for d in range(3):
                    vectors[b][d] -= rate * s * math.sqrt(len(buckets)) * back[d]
    model = quality.train(rows)
    assert np.allclose(model.weights, [sum(v[d] * (layer[d][1] - layer[d][0]) for d in range(3)) for v in vectors]) and math.isclose(model.bias, bias[1] - bias[0])


def test_labelled_ids_that_repeat_give_one_example(spark):
    docs, labels = labelled(random.Random(3), 80)
    docs += [(i, "zz other text") for i in range(0, 80, 3)] + [(None, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    shuffled = [spark.createDataFrame(random.Random(s).sample(docs, len(docs)), "doc_id long, text string").selectExpr("*", "1 AS label", "'c' AS key", "2 AS words").repartition(3) for s in (1, 2)]
    for module in (quality, toxicity):
        a, b = (sorted(((r.doc_id, round(r.score, 9)) for r in module.classify(df, lab).collect()), key=str) for df in shuffled)
        assert a == b and len(a) == len(docs)


def test_block_max_search_equals_all_products():
    rng = np.random.default_rng(3)
    idf = rng.uniform(0.1, 3, 80)
    rows = []
    for i in range(300):
        t = np.sort(rng.choice(80, rng.integers(1, 12), replace=False))
        rows.append((i, int(rng.integers(0, 2)), t, rng.integers(1, 5, len(t))))
    rows += [(300 + i, 1, rows[0][2], rows[0][3]) for i in range(30)]
    index = toxicity.BlockMaxIndex.build(idf, rows)
    by_id = {r[0]: r for r in rows}
    for _, _, t, f in rows[::7]:
        places, cosines = index.nearest(t, f, 15)
        q = np.zeros(80)
        q[t] = toxicity.weigh(idf, t, f)
        every = []
        for p, i in enumerate(index.ids):
            v = np.zeros(80)
            v[by_id[i][2]] = toxicity.weigh(idf, by_id[i][2], by_id[i][3])
            every.append((-round(float(q @ v), 12), p))
        assert [p for _, p in sorted(every)[:15] if _ < 0] == list(places)
        assert np.allclose(cosines, [-s for s, _ in sorted(every)[: len(cosines)]])
