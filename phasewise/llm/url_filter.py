"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii

# (verdict, host, path): the host and all its subdomains, paths that start with the path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BITS_PER_URL, BITS_SET = 16, 5
MOST_BLOCKS = 1 << 20  # 64-bit words: what is broadcast stays under 16 MB however long the list is

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling per address: no scheme, `www.`, `m.`, query, fragment or closing slashes."""
    bare = F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/+$", ""))
    return F.when(host != "", bare)


def rule_of(host: Column, path: Column, rules: Sequence[tuple]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; of two as long the one with the longer host,
    then a blocking one.  Null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for name, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(name)).otherwise(verdict)
    return rule, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _mask(url: Column) -> Column:
    """A word with BITS_SET bits taken from a second hash of the URL."""
    second = F.xxhash64(url, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        place = F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_filter(listed: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(block, word) of every non-empty block, and the number of blocks."""
    blocks = 64
    while blocks < MOST_BLOCKS and blocks * 64 < listed.count() * BITS_PER_URL:
        blocks *= 2
    url = F.col(column)
    words = listed.groupBy(_block(url, blocks).alias("block")).agg(F.bit_or(_mask(url)).alias("word"))
    return words, blocks


def listed_urls(urls: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The rows of `urls` whose `column` is in `listed` (distinct, same column name), each once.

    The filter is broadcast: its size has a bound, MOST_BLOCKS words.  A longer list only lets
    more rows through to the exact join, which removes every false positive.
    """
    words, blocks = bloom_filter(listed, column)
    url = F.col(column)
    possible = (
        urls.withColumns({"block": _block(url, blocks), "mask": _mask(url)})
        .join(F.broadcast(words), "block")
        .where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
        .drop("block", "mask", "word")
    )
    return possible.join(listed, column, "left_semi")


def judge(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple] = RULES, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """(key, host, path, rule, verdict, listed) per row of `pages`.

    `listed` has one column `canonical`.  A rule decides alone; where none fits, listed
    addresses are blocked and all others allowed.  Null urls and urls without `://` have an
    empty host and path, fit no rule, are never listed, and are allowed.  Rows with the same key
    or url are judged one by one; further columns are not looked at.  No pages: no rows.
    """
    split = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).select(
        "key", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select(
        "key", "host", "path", canonical(F.col("host"), F.col("path")).alias("canonical"),
        rule.alias("rule"), verdict.alias("verdict"))
    listed = listed.select("canonical").where("canonical IS NOT NULL").distinct()
    hits = listed_urls(ruled.select("canonical").where("canonical IS NOT NULL").distinct(), listed, "canonical")
    marked = ruled.where("canonical IS NOT NULL").join(hits.withColumn("listed", F.lit(True)), "canonical", "left")
    blank = ruled.where("canonical IS NULL").withColumn("listed", F.lit(False))
    out = marked.unionByName(blank).withColumn("listed", F.coalesce("listed", F.lit(False)))
    return out.select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed")


def crawled_twice(pages: DataFrame, url: str = "url") -> DataFrame:
    """The canonical addresses that more than one row of `pages` leads to."""
    address = canonical(host_of(F.col(url)), path_of(F.col(url)))
    return (pages.groupBy(address.alias("canonical")).agg(F.count("*").alias("n"))
            .where("n > 1 AND canonical IS NOT NULL").select("canonical"))
