"""The numbered operators bound to their tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import decontaminate, dual_tree, langid, pieces, pii, prefix_trie, quality, secrets, sharding, simhash, topk, toxicity, warc
from kpiloom.llm._store import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in ("documents", "pages"):
        small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.flat(warc.resolve(warc.crawl_log(pages)))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("text", "lang")
    return langid.identify_pages(_table(spark, sf_dir, "pages"), docs)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, _table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, _table(spark, sf_dir, "labels"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = sharding.sharded(_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return docs.select(
        "doc_id", sharding.byte_size(F.col("text")).alias("size"), sharding.checksum(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.turn_lists(_table(spark, sf_dir, "conversations"), group=5, head=9))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16, rounds=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_secret_scan": op6_secret_scan,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_sharding": op11_sharding,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op7_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL["op2_warc_revisits"] = r"""
WITH parts AS (
  SELECT page_id, html, regexp_replace(coalesce(url, ''), '#.*$', '') AS u FROM pages WHERE page_id IS NOT NULL
), cut AS (
  SELECT page_id, html,
         regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z]+://([^/?]*)', 1)), '^www[0-9]*\.', ''), ':(80|443)$', '') AS host,
         regexp_extract(u, '^[A-Za-z]+://[^/?]*(.*)$', 1) AS rest
  FROM parts
), canon AS (
  SELECT page_id, html, host || regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', '') ||
         CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
               lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|ref)='))) AS q FROM cut)
), page AS (
  SELECT page_id, url, 1700000000 + (page_id * 7919) % 2592000 AS t, '"' || md5(html) || '"' AS tag,
         'day ' || (page_id % 9) AS mod, md5(coalesce(html, '')) AS digest FROM canon
), response AS (
  SELECT page_id * 4 AS response_id, url, t, tag, mod, digest FROM page WHERE url <> ''
), latest AS (
  SELECT * FROM response QUALIFY row_number() OVER (PARTITION BY url, t ORDER BY response_id DESC) = 1
), revisit AS (
  SELECT page_id * 4 + step AS record_id, url, t + days * 86400 AS t,
         CASE page_id % 4 WHEN 0 THEN tag WHEN 2 THEN '"stale"' END AS tag,
         CASE page_id % 4 WHEN 0 THEN 'W/' || tag WHEN 2 THEN '"stale"' END AS sent,
         CASE page_id % 4 WHEN 1 THEN mod END AS mod
  FROM page, (VALUES (1, 1), (2, -1)) AS s(step, days) WHERE step = 1 OR page_id % 5 = 0
), judged AS (
  SELECT v.record_id, v.url, v.t, v.sent, r.response_id, r.t AS r_at, r.tag AS r_tag, r.mod AS r_mod, r.digest,
         CASE WHEN r.response_id IS NULL THEN 'orphan'
              WHEN v.tag IS NOT NULL AND r.tag IS NOT NULL THEN CASE WHEN v.tag = r.tag THEN 'resolved' ELSE 'mismatch' END
              WHEN v.mod IS NOT NULL THEN CASE WHEN v.mod = r.mod THEN 'resolved' ELSE 'mismatch' END
              ELSE 'unvalidated' END AS status
  FROM revisit v ASOF LEFT JOIN latest r ON v.url = r.url AND v.t > r.t
)
SELECT record_id, url, status, response_id, CAST(t - r_at AS BIGINT) AS age_s,
       CASE WHEN status = 'resolved' THEN
         'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10) ||
         'date: ' || strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') || chr(10) ||
         'etag: ' || coalesce(sent, r_tag) || chr(10) || 'last-modified: ' || r_mod || chr(10) || 'server: a' END AS headers,
       CASE WHEN status = 'resolved' THEN digest END AS payload_digest
FROM judged
"""


def _sql_matches(kind: str, pattern: str, valid: str) -> str:
    """DuckDB: (row, kind, start, end, m) of a pattern's valid matches in ``d``."""
    return f"""
  SELECT row, '{kind}' AS kind, s AS start, s + length(m) AS stop, m FROM (
    SELECT row, unnest(list_transform(range(1, len(found) + 1), lambda i:
             CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) AS BIGINT)
             + coalesce(CAST(list_sum(list_transform(found[1:i - 1], lambda x: length(x))) AS BIGINT), 0))) AS s,
           unnest(found) AS m
    FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM d)
  ) WHERE {valid}"""


_LUHN = """list_sum(list_transform(range(1, len(x) + 1), lambda i:
    CASE WHEN i % 2 = 1 THEN CAST(x[len(x) - i + 1] AS INT)
         ELSE CAST(x[len(x) - i + 1] AS INT) * 2 - CASE WHEN CAST(x[len(x) - i + 1] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""

ORACLE_SQL["op3_pii"] = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS row, doc_id, coalesce(text, '') AS text FROM documents
), m AS MATERIALIZED (
  {_sql_matches("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "TRUE")}
  UNION ALL {_sql_matches("ip", "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+", "len(list_filter(string_split(m, '.'), lambda p: CAST(p AS HUGEINT) > 255)) = 0")}
  UNION ALL {_sql_matches("card", "[0-9](?:[ -]?[0-9])+", f"length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 14 AND 19 AND (SELECT {_LUHN} FROM (SELECT regexp_replace(m, '[^0-9]', '', 'g') AS x))")}
  UNION ALL {_sql_matches("phone", "[+][0-9][ ().0-9-]+[0-9]", "length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 10 AND 15")}
), held AS MATERIALIZED (
  SELECT DISTINCT row, kind || ':' || CASE WHEN kind = 'email' THEN lower(m) WHEN kind = 'ip' THEN m
         ELSE regexp_replace(m, '[^0-9]', '', 'g') END AS entity FROM m
), recurring AS MATERIALIZED (
  SELECT entity, count(*) AS n_c FROM held GROUP BY 1 HAVING count(*) >= {pii.SUPPORT}
), terms AS MATERIALIZED (
  SELECT row, unnest(list_distinct(list_transform(regexp_extract_all(text, '\\p{{L}}{{3,}}'), lambda m: lower(m)))) AS term FROM d
), n AS (SELECT count(*) AS n FROM d), counts AS (SELECT term, count(*) AS n_t FROM terms GROUP BY 1
), both_ AS MATERIALIZED (
  SELECT h.row, h.entity, r.n_c, t.term FROM held h JOIN recurring r USING (entity) JOIN terms t USING (row)
), joint AS (
  SELECT entity, term, any_value(n_c) AS n_c, count(*) AS n_ct FROM both_ GROUP BY 1, 2 HAVING count(*) >= {pii.SUPPORT}
), reveals AS MATERIALIZED (
  SELECT entity, term, n_ct >= {pii.REMOVE} * n_t AS removed FROM joint JOIN counts USING (term), n
  WHERE ln(n_ct * n / (n_c * CAST(n_t AS DOUBLE))) >= ln(n / CAST(n_c AS DOUBLE)) / {pii.ALPHA} - 1e-9
), revealing AS MATERIALIZED (
  SELECT row, term, max(removed) AS removed FROM both_ JOIN reveals USING (entity, term) GROUP BY 1, 2
), w AS MATERIALIZED (
  SELECT row, lower(m) AS term, s AS start, s + length(m) AS stop FROM (
    SELECT row, unnest(list_transform(range(1, len(found) + 1), lambda i:
             CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) AS BIGINT)
             + coalesce(CAST(list_sum(list_transform(found[1:i - 1], lambda x: length(x))) AS BIGINT), 0))) AS s,
           unnest(found) AS m
    FROM (SELECT row, regexp_extract_all(text, '\\p{{L}}{{3,}}') AS found, string_split_regex(text, '\\p{{L}}{{3,}}') AS gaps
          FROM d WHERE row IN (SELECT row FROM revealing)))
), t AS (
  SELECT w.row, 'term' AS kind, w.start, w.stop, removed FROM w JOIN revealing USING (row, term)
  WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.row = w.row AND w.start < m.stop AND m.start < w.stop)
), every_ AS (SELECT row, kind, start, stop, false AS removed FROM m UNION ALL SELECT * FROM t
), edit AS (
  SELECT *, CASE WHEN removed THEN '' ELSE '[' || upper(kind) || ']' END AS by_, coalesce(max(stop) OVER (PARTITION BY row ORDER BY start, stop,
           CASE WHEN removed THEN '' ELSE '[' || upper(kind) || ']' END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM every_
), cleaned AS (
  SELECT row, sha256(string_agg(CASE WHEN start < reached THEN '' ELSE substr(text, reached + 1, start - reached) || by_ END, '' ORDER BY start, stop, by_)
           || substr(any_value(text), max(stop) + 1)) AS sanitised_sha256 FROM edit JOIN d USING (row) GROUP BY row
), s AS (
  SELECT row, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone, count(*) FILTER (kind = 'term') AS n_term,
         count(*) FILTER (removed) AS n_removed,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['email', 'ip', 'card', 'phone', 'term'], kind))
           FILTER (kind <> 'term') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['email', 'ip', 'card', 'phone', 'term'], kind)) AS spans
  FROM every_ GROUP BY row
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_term, 0) AS n_term,
       coalesce(n_removed, 0) AS n_removed, sanitised_sha256
FROM d LEFT JOIN s USING (row) LEFT JOIN cleaned USING (row)
"""


def _any_case(word: str) -> str:
    """A pattern of ASCII letters in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(["password", "passwd", "secret", "token"])
_ASSIGN = f"""(?:{_any_case(_KEYWORDS)}|{_any_case("api")}_?{_any_case("key")})["'']?[ ]*[:=][ ]*["'']?([A-Za-z0-9+/_.=-]+)"""
_ALLOWED = " OR ".join(
    f"regexp_full_match(x, '{p}')"
    for p in ("[0-9]+", "[A-Za-z]+", "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", "(?i).*(?:example|sample|dummy|placeholder|changeme|xxxx).*", "(?i).*(?:abcdefghij|0123456789).*", "[A-Za-z]+(?:[-_/][A-Za-z]+)+[0-9]{0,4}")
)


def _sql_runs(source: str, column: str, pattern: str, condition: str) -> str:
    """DuckDB: (row, place, x) of the matches of ``pattern`` in a column of ``source`` (row, place, column), placed in the text."""
    return f"""SELECT row, place + s AS place, x FROM (
    SELECT row, place, unnest(list_transform(range(1, len(found) + 1), lambda i:
             CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g))) AS BIGINT)
             + coalesce(CAST(list_sum(list_transform(found[1:i - 1], lambda y: length(y))) AS BIGINT), 0))) AS s, unnest(found) AS x
    FROM (SELECT row, place, regexp_extract_all({column}, '{pattern}') AS found, string_split_regex({column}, '{pattern}') AS gaps FROM {source})
  ) WHERE {condition}"""


def _sql_windows(kind: int) -> str:
    """DuckDB: the windows over the threshold in the runs of a character class."""
    c = secrets.CLASSES[kind]
    return f"""SELECT row, {kind} AS class, place AS run, place + i AS start, place + i + w AS stop FROM (
    SELECT *, unnest(range(0, length(x) - w + 1)) AS i FROM (SELECT *, least({c.window}, length(x)) AS w FROM run{kind})
  ) WHERE log2(w) - list_sum(list_transform(list_distinct(string_split(substr(x, i + 1, w), '')), lambda ch:
        (w - length(replace(substr(x, i + 1, w), ch, ''))) * log2(w - length(replace(substr(x, i + 1, w), ch, ''))))) / w
    >= {c.threshold} * log2(w) / log2({c.window}) - 1e-9"""


ORACLE_SQL["op6_secret_scan"] = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS row, doc_id, coalesce(text, '') AS text, 0 AS place FROM documents
), m AS MATERIALIZED (
  {_sql_matches("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 1)) >= 6")}
  UNION ALL {_sql_matches("access", "AKIA[A-Z0-9]+", "length(m) >= 20")}
  UNION ALL {_sql_matches("hex", "[0-9a-f]+", "length(m) >= 24")}
), candidate AS MATERIALIZED (
  {_sql_runs("d", "text", "[A-Za-z0-9+/_=-]+", f"length(x) >= {secrets.MIN_CANDIDATE} AND NOT ({_ALLOWED})")}
), run0 AS MATERIALIZED ({_sql_runs("candidate", "x", "[0-9a-fA-F]+", f"length(x) >= {secrets.MIN_CANDIDATE} AND NOT ({_ALLOWED})")}
), run1 AS MATERIALIZED ({_sql_runs("candidate", "x", "[A-Za-z0-9+/_=-]+", f"length(x) >= {secrets.MIN_CANDIDATE} AND NOT ({_ALLOWED})")}
), hot AS (
  {_sql_windows(0)}
  UNION ALL {_sql_windows(1)}
), cut AS (SELECT *, CASE WHEN start <= lag(stop) OVER (PARTITION BY row, class, run ORDER BY start) THEN 0 ELSE 1 END AS new FROM hot
), island AS (SELECT *, sum(new) OVER (PARTITION BY row, class, run ORDER BY start) AS g FROM cut
), entropy AS (
  SELECT DISTINCT row, start, stop FROM (SELECT row, min(start) AS start, max(stop) AS stop FROM island GROUP BY row, class, run, g) e
  WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.row = e.row AND m.start <= e.start AND e.stop <= m.stop)
), every_ AS (SELECT row, kind, start, stop FROM m UNION ALL SELECT row, 'entropy', start, stop FROM entropy
), s AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         count(*) FILTER (kind = 'entropy') AS n_entropy,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['assign', 'access', 'hex', 'entropy'], kind), stop) FILTER (kind <> 'entropy') AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['assign', 'access', 'hex', 'entropy'], kind), stop) AS spans
  FROM every_ GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (row)
"""


#: DuckDB: the 256 remainders of a byte, for CRC-32 (polynomial 0xEDB88320).
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, b:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _sql_crc32(text: str, table: str) -> str:
    """DuckDB: unsigned CRC-32 of a text's UTF-8 bytes; ``table`` holds _CRC_TABLE."""
    return f"""xor(4294967295, list_reduce([4294967295] || list_transform(regexp_extract_all(hex({text}), '..'), lambda x: CAST('0x' || x AS BIGINT)),
    lambda c, b: xor(c >> 8, {table}[xor(c, b) % 256 + 1])))"""


ORACLE_SQL["op11_sharding"] = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {_sql_crc32("coalesce(text, '')", "t")} AS text_crc32
  FROM documents, (SELECT {_CRC_TABLE} AS t)
), p AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, text_crc32, size) AS place,
         sum(size) OVER (ORDER BY doc_id NULLS LAST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM d
), s AS (SELECT *, least(7, CAST(((2 * upto - size) * 8) // (2 * total) AS INTEGER)) AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - min(place) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

ORACLE_SQL["op12_conversation_trie"] = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv, turn, strlen(coalesce(text, '')) AS n, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS label
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv, list({{'l': label, 'n': n}} ORDER BY turn NULLS FIRST, label) AS own, {_sql_crc32("CAST(conv AS VARCHAR)", "any_value(c.t)")} % 9 AS h
  FROM t, (SELECT {_CRC_TABLE} AS t) c GROUP BY conv
), made AS (
  SELECT o.conv, coalesce(b.own[1:o.h], []) || o.own[o.h + 1:] AS turns FROM own o LEFT JOIN own b ON b.conv = o.conv - o.conv % 5
), prefix AS (
  SELECT conv, d, len(turns) AS size, list_transform(turns[1:d], lambda x: x.l) AS path, CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n
  FROM made, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS d)
), node AS (
  SELECT path, min(conv) AS conv_id, any_value(d) AS depth, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
         sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (size = d), '')) AS ends_sha256
  FROM prefix GROUP BY path
), child AS (SELECT path[1:len(path) - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1
), under AS (
  SELECT n.path[1:a.d] AS path, n.saved, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM node n LEFT JOIN child c USING (path), LATERAL (SELECT unnest(range(0, n.depth + 1)) AS d) a
), rolled AS (SELECT path, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM under GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN rolled USING (path) LEFT JOIN child c USING (path) LEFT JOIN node p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""


def _sql_round(i: int) -> str:
    """DuckDB: the assignment ``a`` of round ``i`` to centroids ``c``, and the centroids after it."""
    return f"""
), a{i} AS MATERIALIZED (
  SELECT row, v, arg_min(k, (dist, k)) AS k, min(dist) AS dist FROM (
    SELECT p.row, p.v, c.k, CAST(list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS dist FROM p, c{i} c
  ) GROUP BY row, v
), m{i} AS (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM (
    SELECT k, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS n FROM a{i}, LATERAL (SELECT unnest(range(1, 65)) AS j) GROUP BY k, j) GROUP BY k
), c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (k)"""


ORACLE_SQL["op13_centroids"] = f"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS row, CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(64 * CAST(x AS DOUBLE)) >= {dual_tree.LIMIT})) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS k, v FROM p WHERE vec_id IS NOT NULL
  QUALIFY k < 16{"".join(map(_sql_round, range(4)))}
), t AS (SELECT k, CAST(sum(dist) AS BIGINT) AS cluster_inertia, CAST(sum(sum(dist)) OVER () AS BIGINT) AS inertia FROM a3 GROUP BY k)
SELECT p.vec_id, a.k AS cluster, a.dist AS distance, t.cluster_inertia, t.inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN p USING (row) JOIN t USING (k) JOIN c3 c USING (k)
"""
