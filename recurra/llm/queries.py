"""The operators applied to the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.llm import (
    benchmark_leaks,
    filter_audit,
    html_density,
    markov_secrets,
    pfair_mix,
    prefix_trie,
    quality_mcd,
    rank_profiles,
    ring_shards,
    simhash_dedup,
    suffix_dedup,
    warc_fixity,
    weak_toxicity,
)
from recurra.llm.common import stored, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query
def op9_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_shards.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home",
    )


@query
def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mix.mix(table(spark, sf_dir, "documents")).drop("key")


@query
def op5_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mcd.judge(table(spark, sf_dir, "documents"))


@query
def op3_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = markov_secrets.find(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_density.extract(table(spark, sf_dir, "pages"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op10_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    lengths = F.transform("removed", lambda r: r["end"] - r["start"])
    return rest.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _damaged(pages: DataFrame) -> DataFrame:
    """A replica with one byte changed, the end cut off, a record lost or one too many, here and there."""
    fate = F.pmod(F.col("page_id") * 7919, F.lit(100))
    html = F.when(fate == 1, F.concat(F.lit("~"), F.substring("html", 2, 1 << 30))).when(fate == 2, F.expr("left(html, length(html) - 10)"))
    kept = pages.where(fate != 3).withColumn("html", F.coalesce(html, F.col("html")))
    return kept.union(pages.where(fate == 4).withColumn("page_id", F.col("page_id") + 1_000_000_000))


@query
def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    replicas = (stored(warc_fixity.leaves(warc_fixity.records(p)), "leaves") for p in (pages, _damaged(pages)))
    return warc_fixity.audit(*replicas).withColumnRenamed("id", "page_id")


ORACLE_SQL["op7_warc_fixity"] = r"""
WITH fates AS (SELECT *, (page_id * 7919) % 100 AS fate FROM pages),
replica AS (
    SELECT page_id, url, CASE fate WHEN 1 THEN '~' || substring(html, 2) WHEN 2 THEN left(html, length(html) - 10) ELSE html END AS html
    FROM fates WHERE fate <> 3
    UNION ALL SELECT page_id + 1000000000, url, html FROM fates WHERE fate = 4),
both_sides AS (SELECT 'p' AS side, page_id, url, html FROM pages UNION ALL SELECT 'r', page_id, url, html FROM replica),
records AS (
    SELECT side, page_id, page_id // 1024 AS file, page_id % 1024 AS position,
        'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
        || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM both_sides),
leaves AS (
    SELECT side, page_id, file, position, strlen(record) AS length, sha256(record) AS digest,
        coalesce(sum(strlen(record)) OVER (PARTITION BY side, file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
    FROM records)
SELECT coalesce(l.file, r.file) AS file, coalesce(l.position, r.position) AS position, coalesce(l.page_id, r.page_id) AS page_id,
    l."offset" AS primary_offset, l.length AS primary_length, l.digest AS primary_digest,
    r."offset" AS replica_offset, r.length AS replica_length, r.digest AS replica_digest,
    CASE WHEN r.digest IS NULL THEN 'missing' WHEN l.digest IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM (SELECT * FROM leaves WHERE side = 'p') l FULL JOIN (SELECT * FROM leaves WHERE side = 'r') r USING (page_id)
WHERE l.digest IS DISTINCT FROM r.digest
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE_SQL["op12_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents),
judged AS (
    SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
        len(words) < 50 AS fails_a, 100 * len(list_distinct(words)) < 65 * len(words) AS fails_b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS fails_c,
        regexp_matches(text, '[#$%&*|]') AS fails_d, doc_id > min(doc_id) OVER (PARTITION BY text) AS fails_e
    FROM docs LEFT JOIN labels USING (doc_id)),
kinds AS (
    SELECT part, good, toxic, fails_a, fails_b, fails_c, fails_d, fails_e, count(*) AS n,
        [fails_a, fails_b, fails_c, fails_d, fails_e] AS fails
    FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT array_to_string(o, '') AS filter_order, s::INT AS step, o[s] AS f, o[:s - 1] AS before FROM orders, range(1, 6) r(s)),
failed AS (SELECT *, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: fails[i]) AS bad FROM kinds),
rows_ AS (
    SELECT part, filter_order, step, f,
        sum(CASE WHEN NOT list_has_any(bad, before) AND NOT list_contains(bad, f) THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT list_has_any(bad, before) AND list_contains(bad, f) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN list_has_any(bad, before) AND list_contains(bad, f) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN bad = [f] THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT list_has_any(bad, before) AND list_contains(bad, f) AND good THEN n ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT list_has_any(bad, before) AND list_contains(bad, f) AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM failed, steps GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM rows_
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


ORACLE_SQL["op13_prefix_trie"] = r"""
WITH own AS (
    SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token, length(coalesce(text, '')) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
    SELECT DISTINCT c, xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
            lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END))) % 6 AS h
    FROM own),
turns AS (
    SELECT h.c, o.token, o.size, o.pos AS place FROM heads h JOIN own o ON o.c = h.c - h.c % 100 AND o.pos <= h.h
    UNION ALL SELECT h.c, o.token, o.size, 1000 + o.pos FROM heads h JOIN own o ON o.c = h.c AND o.pos > h.h),
paths AS (
    SELECT c, size, row_number() OVER w AS depth, string_agg(token, '') OVER w AS path
    FROM turns WINDOW w AS (PARTITION BY c ORDER BY place)
    UNION ALL SELECT c, 0, 0, '' FROM heads),
ends AS (
    SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256
    FROM (SELECT c, max_by(path, depth) AS path FROM paths GROUP BY c) GROUP BY path),
nodes AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size, left(path, 64 * (depth - 1)) AS parent
    FROM paths GROUP BY path, depth),
children AS (SELECT parent, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
below AS (
    SELECT left(n.path, 64 * k) AS path, count(*) FILTER (ch.n_children IS NULL) AS n_leaves,
        sum((n.n_convs - 1) * n.size) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM nodes) n LEFT JOIN children ch ON ch.parent = n.path GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, b.n_leaves,
    b.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN ends e USING (path) LEFT JOIN children ch ON ch.parent = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.parent
"""


@query
def op11_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_profiles.identify(table(spark, sf_dir, "documents"))
