"""Not-modified revisits of a web archive, resolved to the responses they stand for.

A revisit (304) record takes the latest full response (200) of its canonical
URL that is strictly earlier.  Its validators must agree with that response's;
then the response's payload stands for it, with the headers that a 304 may
update laid over the response's.

All records of one URL and instant have the same answer, so records first become
instants, a maximum that combines before the shuffle.  The as-of join over these
is cut by time: instants fall into ranges of roughly ``SLICE`` rows, a window
looks back inside (URL, range), and the last response of each (URL, range) is
carried to later ranges.  A URL with a third of all records is thus spread over
the ranges, of which there are as many as the rows ask for.

Defined results: ``status`` is ``resolved``; ``mismatch`` (validators differ);
``unvalidated`` (the revisit names none, or the response lacks the one named);
``orphan`` (no earlier response).  An ETag decides before Last-Modified; weak
marks are ignored.  Of responses at one instant the larger record id is the
latest, of repeated ids the one with the larger validators.  Records without URL
or time are orphans, null kinds are no records; repeated records, null ids
among them, are each resolved once; payloads, header maps and their values may be null, empty or
long; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm._store import stored

#: Instants in a range of time, about.
SLICE = 1 << 17
#: Response headers that a 304 may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that name no content.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|ref)="


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www`` and default ports, path without closing slashes,
    query sorted and without tracking parameters; no scheme, no fragment."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z]+://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www[0-9]*\.", ""), r":(80|443)$", "")
    rest = F.regexp_extract(u, r"^[A-Za-z]+://[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(host, path, asked)


def _bare(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def headers_of(block: Column) -> Column:
    """A record's header block as a map with names in lower case; of repeated names the last counts."""
    lines = F.filter(F.split(block, r"\r?\n"), lambda x: F.instr(x, ":") > 1)
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("key"), F.trim(x.substr(F.instr(x, ":") + 1, F.length(x))).alias("value")))
    last = F.filter(pairs, lambda p, i: F.size(F.filter(pairs, lambda q, j: (q["key"] == p["key"]) & (j > i))) == 0)
    return F.map_from_entries(last)


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers with the revisit's permitted ones laid over them."""
    over = F.map_filter(revisit, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(response, lambda k, _: ~F.array_contains(F.map_keys(over), k))
    return F.map_concat(kept, over)


def _latest_responses(events: DataFrame) -> DataFrame:
    """(url, ts, match): of every URL and instant, the last response before it, null if there is none."""
    as_response = F.when(F.col("kind") == "response", F.struct("ts", "record_id", "etag", "last_modified", "row"))
    instants = stored(events.groupBy("url", "ts").agg(F.max(as_response).alias("response")))
    slices = -(-instants.count() // SLICE) or 1
    cut = stored(instants.repartitionByRange(slices, "ts").withColumn("slice", F.spark_partition_id()))  # rises with ts
    own = Window.partitionBy("url", "slice").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    near = cut.withColumn("near", F.max("response").over(own)).drop("response")
    last = cut.groupBy("url", "slice").agg(F.max("response").alias("last"))
    before = Window.partitionBy("url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("far", F.max("last").over(before)).drop("last")
    return near.join(carried, ["url", "slice"]).select("url", "ts", F.coalesce("near", "far").alias("match"))


def resolve(records: DataFrame) -> DataFrame:
    """A row for each revisit of ``records``.

    ``records``: record_id, url, ts (timestamp), kind (``response`` or
    ``revisit``), headers (map, names in lower case), payload_digest.
    Returned: record_id, url (canonical), status, response_id, age_s, headers
    (merged, of resolved ones), payload_digest.
    """
    base = stored(
        records.select(
            "record_id",
            canonical_url(F.col("url")).alias("url"),
            F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
            "kind",
            "headers",
            _bare(F.col("headers")["etag"]).alias("etag"),
            F.col("headers")["last-modified"].alias("last_modified"),
            "payload_digest",
            F.monotonically_increasing_id().alias("row"),  # fixed as it is written: tells repeated records apart
        )
    )
    timed = base.where(F.col("ts").isNotNull() & (F.col("url") != "")).select("row", "record_id", "url", "ts", "kind", "etag", "last_modified")
    matched = _latest_responses(timed).where(F.col("match").isNotNull())
    revisits = base.where(F.col("kind") == "revisit").drop("kind", "payload_digest", "row")
    e, m = F.col("etag"), F.col("last_modified")
    r = F.col("match")
    status = (
        F.when(r.isNull(), "orphan")
        .when(e.isNotNull() & r["etag"].isNotNull(), F.when(e == r["etag"], "resolved").otherwise("mismatch"))
        .when(m.isNotNull() & r["last_modified"].isNotNull(), F.when(m == r["last_modified"], "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    judged = revisits.join(matched, ["url", "ts"], "left").select(
        "record_id",
        "url",
        status.alias("status"),
        r["record_id"].alias("response_id"),
        ((F.col("ts") - r["ts"]) / 1_000_000).cast("long").alias("age_s"),
        F.col("headers").alias("own"),
        r["row"].alias("row"),
    )
    responses = base.where(F.col("kind") == "response").select("row", F.col("headers").alias("theirs"), "payload_digest")
    good = F.col("status") == "resolved"
    return judged.join(responses, "row", "left").select(
        "record_id",
        "url",
        "status",
        "response_id",
        "age_s",
        F.when(good, merged_headers(F.col("theirs"), F.col("own"))).alias("headers"),
        F.when(good, F.col("payload_digest")).alias("payload_digest"),
    )


def crawl_log(pages: DataFrame) -> DataFrame:
    """A deterministic log of captures of ``pages``: a response, a later and an earlier revisit for each.

    The table has no revisits, so a page's id decides when it was fetched and
    what its revisits declare; a page without id was never fetched and gives no
    record.
    """
    n = F.col("page_id")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + (n * 7919) % 2_592_000)
    etag, modified = F.concat(F.lit('"'), F.md5("html"), F.lit('"')), F.concat(F.lit("day "), (n % 9).cast("string"))
    page = pages.where(n.isNotNull()).select("page_id", "url", at.alias("at"), etag.alias("tag"), modified.alias("mod"), F.md5(F.coalesce("html", F.lit(""))).alias("digest"))
    said = F.when(n % 4 == 0, F.concat(F.lit("W/"), F.col("tag"))).when(n % 4 == 2, F.lit('"stale"'))
    full = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), F.col("tag"), F.lit("last-modified"), F.col("mod"), F.lit("date"), F.col("at").cast("string"), F.lit("server"), F.lit("a"))
    short = F.create_map(F.lit("date"), F.col("when").cast("string"), F.lit("etag"), said, F.lit("last-modified"), F.when(n % 4 == 1, F.col("mod")), F.lit("server"), F.lit("b"), F.lit("cache-control"), F.lit("max-age=60"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(d).alias("days")) for k, d in ((0, 0), (1, 1), (2, -1))]))
    steps = page.select("*", kinds.alias("s")).withColumn("when", F.col("at") + F.make_dt_interval(F.col("s.days")))
    is_full = F.col("s.step") == 0
    return steps.where((F.col("s.step") < 2) | (n % 5 == 0)).select(
        (n * 4 + F.col("s.step")).alias("record_id"),
        "url",
        F.col("when").alias("ts"),
        F.when(is_full, "response").otherwise("revisit").alias("kind"),
        F.map_filter(F.when(is_full, full).otherwise(short), lambda _, v: v.isNotNull()).alias("headers"),
        F.when(is_full, F.col("digest")).alias("payload_digest"),
    )


def flat(resolved: DataFrame) -> DataFrame:
    """Headers as one string, ``name: value`` lines in order of name."""
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda h: F.concat(h["key"], F.lit(": "), h["value"])))
    return resolved.withColumn("headers", F.array_join(lines, "\n"))
