"""The registered queries of this subpackage: (session, folder) to DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    embedding_dedup,
    hard_negatives,
    language,
    minhash,
    mixing,
    quality,
    substring_dedup,
    suffix_dedup,
    token_files,
    url_filter,
    vector_codes,
    warc_audit,
)
from .common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None):
    def keep(build):
        QUERIES[build.__name__] = build
        if sql:
            SQL[build.__name__] = sql
        return build

    return keep


_LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
_ASCII = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = r"[^\x20\x09-\x0D]+"


@register("""
WITH r AS (
  SELECT page_id AS id, url, html, strlen('WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Target-URI: ' || url || e
      || 'Content-Length: ' || strlen(html) || e || e || html || e || e) AS length,
    sha256('WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Target-URI: ' || url || e
      || 'Content-Length: ' || strlen(html) || e || e || html || e || e) AS hash
  FROM (SELECT page_id, url, html, chr(13) || chr(10) AS e FROM pages))
SELECT id, id // 64 AS range,
  coalesce(sum(length) OVER (PARTITION BY id // 64 ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
  length, hash,
  CASE WHEN url LIKE '%#top' THEN 'missing' WHEN url LIKE '%://m.%' AND html <> '' THEN 'corrupt' ELSE 'intact' END AS status
FROM r""")
def op1_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Audits a replica in which pages of mobile hosts lost their last character and pages with
    the fragment `#top` are missing."""
    pages = table(spark, folder, "pages")
    mobile = F.col("url").like("%://m.%")
    shorter = F.expr("substring(html, 1, greatest(char_length(html) - 1, 0))")
    replica = pages.where(~F.coalesce(F.col("url").like("%#top"), F.lit(False))).withColumn(
        "html", F.when(mobile, shorter).otherwise(F.col("html")))
    return warc_audit.audit(warc_audit.records(pages), warc_audit.records(replica))


def vocabulary(name: str = "byte_bpe_50k.json") -> tuple[str, str]:
    """(file, pattern of its pre-tokenizer) of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


@register()
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.through_files(table(spark, folder, "documents"), *vocabulary())


@register()
def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = minhash.duplicate_groups(table(spark, folder, "documents"), percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@register(f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '{_ASCII}'), []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWERED}, '{_ASCII}') AS w FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item, w[i:i + least(len(w), 13) - 1] AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT len(gram) AS m FROM g),
p AS (SELECT doc_id, m, i, w[i:i + m - 1] AS gram FROM
  (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT doc_id, m, i, item FROM p JOIN g USING (gram)),
n AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS place FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)""")
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@register()
def op5_super_kmers(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.without_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register(f"""
WITH p AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '') END AS canonical
  FROM p),
l AS (SELECT canonical FROM r WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  l.canonical IS NOT NULL AS listed
FROM r LEFT JOIN l ON r.canonical = l.canonical""")
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The list: addresses that the crawl reached under more than one spelling."""
    pages = table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.crawled_twice(pages))


@register()
def op7_co_training(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "score", "kept")


@register()
def op8_projections(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@register()
def op9_radix_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register(f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_SPACE}')), 0)::BIGINT AS size,
    md5('0:' || doc_id) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((place - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT level FROM v WHERE level <= cap / weight ORDER BY cap / weight, place LIMIT 1),
t AS (SELECT v.*, least(cap, weight * coalesce((SELECT level FROM b), level)) AS target FROM v),
q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
x AS (SELECT doc_id, size, source_size, target, quota,
    coalesce(sum(size) OVER (PARTITION BY place ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
  (greatest(least(start + size, quota) - start, 0) + greatest(least(source_size + start + size, quota) - source_size - start, 0))::BIGINT AS taken
FROM x""")
def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@register()
def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


_INTEGERS = """
f AS (SELECT vec_id, label, embedding AS x FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS (SELECT vec_id, label, list_transform(x, lambda c: floor(256 * c::DOUBLE)) AS x FROM f)"""


@register(f"""
WITH {_INTEGERS},
e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, x FROM v
  WHERE label IS NOT NULL AND vec_id IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM e a JOIN e b ON len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY rank <= 5""")
def op12_threshold_algorithm(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


def _codes_sql(rounds: int = 2) -> str:
    """Rounds of assignment and update over (part, entry) rows, each a pair of subqueries."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS (SELECT vec_id, label, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT q.*, entry, list_sum(list_transform(range(1, len(q.x) + 1), lambda j: (q.x[j] - c.x[j]) ** 2)) AS d
    FROM q JOIN c{i} c USING (part)) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
u{i} AS (SELECT part, entry, list(m ORDER BY j) AS x FROM (
    SELECT part, entry, j, floor(sum(x[j]) / count(*)) AS m FROM (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM a{i}) GROUP BY ALL)
  GROUP BY ALL),
c{i + 1} AS (SELECT part, entry, coalesce(u.x, c.x) AS x FROM c{i} c LEFT JOIN u{i} u USING (part, entry))""")
    return f"""
WITH {_INTEGERS},
r AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM v),
q AS (SELECT vec_id, label, place, part, x[part * len(x) // 16 + 1:(part + 1) * len(x) // 16] AS x
  FROM (SELECT *, unnest(range(16)) AS part FROM r)),
c0 AS (SELECT part, place AS entry, x FROM q WHERE place < 64),{",".join(steps)},
e AS (SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM e"""


@register(_codes_sql())
def op13_ball_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))
