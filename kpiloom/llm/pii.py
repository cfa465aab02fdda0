"""Personal data and the terms that reveal it, with DataFrame functions only.

Base spans come from four patterns: email, ip, card, phone.  Their values are
the protected entities.  Corpus co-occurrence then tells how strongly a term
reveals an entity: with p over documents, pointwise mutual information
PMI(c; t) = ln(p(c, t) / (p(c) p(t))) against the entity's own information
IC(c) = -ln p(c).  A term reaches the disclosure threshold if
PMI >= IC / ALPHA, with at least ``SUPPORT`` documents holding both.  In
documents that hold such an entity the term's occurrences become ``term``
spans: removed where it all but names the entity (p(c | t) >= ``REMOVE``),
else generalised.

Counts cover all documents.  Terms are joined only for texts with a recurring
entity, once for each distinct text, so a group of copies costs one text.  A
term in more than n_c ** (1 / ALPHA) * n ** (1 - 1 / ALPHA) of the n documents
cannot reach an entity's threshold, even if it stands in all n_c documents that
hold it; such terms leave before terms and entities are paired.

The patterns are the plain ones with possessive quantifiers and guards at run
starts, which match the same spans in linear time and without recursion.
Positions come from running sums taken in blocks of the root of the number of
matches, so very long texts with very many matches stay far from quadratic.

Defined results: a null text is empty (``sanitised`` leaves it null); rows are
never told apart by their key, so null and repeated keys do no harm; repeated
rows count as documents each and each get their spans; terms are runs of three
or more letters, compared in lower case; term spans never overlap base spans;
spans are ordered by start, then kind, so there are no ties; positions are code
points, ends exclusive; an empty table gives an empty result; other columns are
neither read nor returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm._store import stored

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT, ALPHA, REMOVE = 2, 1.5, 0.9

_LOCAL = "[A-Za-z0-9._%+-]"
#: kind -> (cheap test, pattern)
PATTERNS = {
    "email": ("@", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": ("[0-9](?:[ -]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_TERM = r"\p{L}{3,}"
_MATCH = "array<struct<start:int,end:int,m:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, fold) -> Column:
    """For each of an array of integers, ``fold`` (associative, from 0) over all before it."""

    def whole(a: Column, start: Column) -> Column:
        return F.aggregate(a, start, lambda x, y: fold(x, y))

    def blocks(v: Column, size: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / size).cast("int")), lambda j: whole(F.slice(v, F.lit(1), j * size), F.lit(0)))
        place = lambda i: F.floor(i / size).cast("int")
        return _let(before, lambda at: F.transform(v, lambda _, i: whole(F.slice(v, place(i) * size + 1, i % size), F.get(at, place(i)))))

    return _let(values, lambda v: _let(F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1)), lambda size: blocks(v, size)))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, m): the leftmost non-overlapping matches, from the gaps between them."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"))

    def placed(found: Column) -> Column:
        lengths = F.transform(found, lambda x: F.length(x["gap"]) + F.length(x["m"]))
        starts = _running(lengths, lambda x, y: x + y)
        at = lambda x, s: s + F.length(x["gap"])
        return F.zip_with(found, starts, lambda x, s: F.struct(at(x, s).alias("start"), (at(x, s) + F.length(x["m"])).alias("end"), x["m"].alias("m")))

    return _let(F.filter(parts, lambda x: x["m"].isNotNull()), placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(back, F.lit(0), lambda a, x: a + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda m: F.length(_digits(m)).between(14, 19) & _luhn(_digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}
_VALUE = {"email": F.lower, "ip": lambda m: m, "card": _digits, "phone": _digits}


def base_matches(text: Column, kind: str) -> Column:
    """The valid matches of a kind; texts that cannot hold one skip the search."""
    test, pattern = PATTERNS[kind]
    found = F.filter(matches(text, pattern), lambda x: _VALID[kind](x["m"]))
    return F.when(text.rlike(test), found).otherwise(F.array().cast(_MATCH))


def _spans(column: Column | str, kind: int) -> Column:
    return F.transform(column, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda x: F.concat(F.lit(f"{kind}:"), _VALUE[kind](x["m"])))


def _edits(column: str, by) -> Column:
    return F.transform(column, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), by(x).alias("by")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of (start, kind, end), comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def _revealing(entities: DataFrame, terms: DataFrame, term_counts: DataFrame, n: int) -> DataFrame:
    """(tkey, term, removed): terms of each text at or over the threshold for one of its entities."""
    known = entities.groupBy("entity").agg(F.sum("copies").alias("n_c"))
    held = entities.join(known, "entity")
    most = held.groupBy("tkey").agg(F.max("n_c").alias("most"))
    # PMI >= IC / ALPHA with n_ct = n_c, solved for n_t
    reach = lambda n_c: F.pow(n_c, 1 / ALPHA) * float(n) ** (1 - 1 / ALPHA) * (1 + 1e-6)
    rare = terms.join(term_counts, "term").join(most, "tkey").where(F.col("n_t") <= reach(F.col("most"))).drop("most")
    both = stored(rare.join(held, "tkey").where(F.col("n_t") <= reach(F.col("n_c"))))
    joint = both.groupBy("entity", "term").agg(F.sum("copies").alias("n_ct"), F.first("n_c").alias("n_c"), F.first("n_t").alias("n_t"))
    pmi = F.log(F.col("n_ct") * F.lit(float(n)) / (F.col("n_c") * F.col("n_t").cast("double")))
    ic = F.log(F.lit(float(n)) / F.col("n_c"))
    reveals = joint.where((F.col("n_ct") >= SUPPORT) & (pmi >= ic / ALPHA - 1e-9)).select(
        "entity", "term", (F.col("n_ct") >= REMOVE * F.col("n_t")).alias("removed")
    )
    return both.select("tkey", "entity", "term").join(reveals, ["entity", "term"]).groupBy("tkey", "term").agg(F.max("removed").alias("removed"))


def _words(texts: DataFrame) -> DataFrame:
    """(tkey, term, start, end) of every term of every text."""
    gap, word = F.split("text", _TERM, -1), F.regexp_extract_all("text", F.lit(_TERM), 0)
    rows = texts.select("tkey", F.posexplode(F.arrays_zip(gap.alias("gap"), word.alias("word"))).alias("i", "x"))
    rows = rows.where(F.col("x.word").isNotNull()).select("tkey", "i", F.length("x.gap").alias("g"), F.length("x.word").alias("w"), F.lower("x.word").alias("term"))
    in_text = Window.partitionBy("tkey").orderBy("i")  # the words of one text
    end = F.sum(F.col("g") + F.col("w")).over(in_text).cast("int")
    return rows.select("tkey", "term", (end - F.col("w")).alias("start"), end.alias("end"))


_SPAN = "array<struct<start:int,end:int,removed:boolean>>"


def _clear(terms: str) -> Column:
    """The term spans that overlap no base span: of the bases that start before a term ends, none ends after it starts."""
    base = F.transform(F.concat(*map(F.col, _VALUE)), lambda b: F.struct(b["start"].alias("at"), F.lit(0).alias("term"), b["start"].alias("start"), b["end"].alias("end"), F.lit(False).alias("removed")))
    own = F.transform(terms, lambda t: F.struct((t["end"] - 1).alias("at"), F.lit(1).alias("term"), t["start"].alias("start"), t["end"].alias("end"), t["removed"].alias("removed")))

    def kept(spans: Column) -> Column:
        reached = _running(F.transform(spans, lambda x: F.when(x["term"] == 0, x["end"]).otherwise(0)), lambda x, y: F.greatest(x, y))
        return F.filter(F.zip_with(spans, reached, lambda x, r: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["removed"].alias("removed"), ((x["term"] == 1) & (r <= x["start"])).alias("ok"))), lambda x: x["ok"])

    return F.array_sort(F.transform(_let(F.array_sort(F.concat(base, own)), kept), lambda x: x.dropFields("ok")))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", every_text: bool = False) -> DataFrame:
    """key, text, the base matches by kind, and ``term`` spans (start, end, removed) of every row of ``docs``.

    ``text`` is null in rows without base matches, unless ``every_text`` asks for it.
    """
    text_column = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(key).alias("key"), text_column.alias("text"), F.col(text).alias("given"))
    matched = source.select("key", "text", "given", *[base_matches(F.col("text"), k).alias(k) for k in _VALUE])
    values = [_entities(k) for k in _VALUE]
    with_values = matched.withColumn("entities", F.array_distinct(F.concat(*values)))
    has = F.size("entities") > 0
    kept_text = F.col("given") if every_text else F.when(has, F.col("text"))
    base = stored(with_values.select("key", *_VALUE, "entities", kept_text.alias("text"), F.when(has, F.sha2("text", 256)).alias("tkey")))
    n = base.count()
    held = base.where("tkey IS NOT NULL").select("tkey", F.explode("entities").alias("entity"))
    recurring = held.groupBy("entity").count().where(F.col("count") >= SUPPORT).select("entity")
    entities = stored(held.groupBy("tkey", "entity").agg(F.count("*").alias("copies")).join(recurring, "entity"))
    texts = stored(
        base.where("tkey IS NOT NULL").join(entities.select("tkey").distinct(), "tkey", "left_semi")
        .groupBy("tkey").agg(F.first("text").alias("text"))
    )

    def term_set(column: str) -> Column:
        return F.explode(F.array_distinct(F.transform(F.regexp_extract_all(column, F.lit(_TERM), 0), F.lower)))

    terms = stored(texts.select("tkey", term_set("text").alias("term")))
    term_counts = source.select(term_set("text").alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    revealing = stored(_revealing(entities, terms, term_counts, n))
    words = _words(texts.join(revealing.select("tkey").distinct(), "tkey", "left_semi"))
    term_spans = (
        words.join(revealing, ["tkey", "term"])
        .groupBy("tkey")  # at most the words of one text
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "removed"))).alias("term"))
    )
    none = F.array().cast(_SPAN)
    plain = base.where("tkey IS NULL").withColumn("term", none)
    revealed = base.where("tkey IS NOT NULL").join(term_spans, "tkey", "left")
    revealed = revealed.withColumn("term", F.when(F.col("term").isNull(), none).otherwise(_clear("term")))
    return plain.unionByName(revealed.select(*plain.columns)).drop("tkey", "entities")


def _edited() -> Column:
    """``text`` with base spans as their kind in brackets and revealing terms removed or as ``[TERM]``.

    Of overlapping spans the one that starts first stands for both.
    """
    marks = [_edits(k, lambda x, mark=f"[{k.upper()}]": F.lit(mark)) for k in _VALUE]
    terms = _edits("term", lambda x: F.when(x["removed"], "").otherwise("[TERM]"))
    edits = F.array_sort(F.concat(*marks, terms))

    def applied(edits: Column, chars: Column) -> Column:
        reached = _running(F.transform(edits, lambda x: x["end"]), lambda x, y: F.greatest(x, y))
        cut = lambda a, z: F.array_join(F.slice(chars, a + 1, F.greatest(z - a, F.lit(0))), "")
        pieces = F.zip_with(edits, reached, lambda x, at: F.when(x["start"] < at, "").otherwise(F.concat(cut(at, x["start"]), x["by"])))
        last = F.array_max(F.transform(edits, lambda x: x["end"]))
        return F.concat(F.array_join(pieces, ""), cut(last, F.size(chars)))

    changed = _let(edits, lambda e: _let(F.regexp_extract_all("text", F.lit("(?s)."), 0), lambda chars: applied(e, chars)))
    return F.when(F.size(edits) > 0, changed).otherwise(F.col("text"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, counts by kind, base digest, all spans, removed terms, and the digest of the sanitised text (null: unchanged)."""
    found = find(docs, key, text)
    base = F.array_sort(F.concat(*[_spans(k, i) for i, k in enumerate(_VALUE)]))
    every = F.array_sort(F.concat(*[_spans(k, i) for i, k in enumerate(KINDS)]))
    return found.select(
        F.col("key").alias(key),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in _VALUE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        F.size("term").cast("long").alias("n_term"),
        F.size(F.filter("term", lambda t: t["removed"])).cast("long").alias("n_removed"),
        F.sha2(_edited(), 256).alias("sanitised_sha256"),
    )


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text of every row: base spans become their kind in brackets, revealing terms go or become ``[TERM]``."""
    return find(docs, key, text, every_text=True).select(F.col("key").alias(key), _edited().alias(text))
