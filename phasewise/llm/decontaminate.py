"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over document windows.

DataFrame functions only.  A document's words become 64-bit hashes, every window of them one
hash; one row per window meets the broadcast windows of the benchmark, and what meets is
compared word by word before it counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_WORD, lower_ascii

WINDOW = 13
# Broadcast only while the test windows are fewer than this; beyond it the same join is shuffled.
MOST_BROADCAST = 2_000_000


def words_of(text: Column) -> Column:
    """Normalised words; null and empty texts have none."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(f"({ASCII_WORD})")),
                      F.array().cast("array<string>"))


def _windows(hashes: Column, length: int) -> Column:
    """(length, at, hash) of each run of `length` words, at counted from 1."""
    last = F.size(hashes) - length + 1
    every = F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda i: F.struct(F.lit(length).alias("length"), i.alias("at"),
                           F.xxhash64(F.slice(hashes, i, length)).alias("hash")),
    )
    return F.when(last >= 1, every)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id", text: str = "text") -> DataFrame:
    """(length, hash, gram, items): the distinct windows of all items with the items that hold
    them.  An item of fewer words is one window; one without words has none."""
    words = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    n = F.size("words")
    grams = F.when(n < window, F.array("words")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))),
                    lambda i: F.slice("words", i, window)))
    one = words.where(n > 0).select("item", F.explode(grams).alias("gram"))
    return (one.groupBy("gram").agg(F.collect_set("item").alias("items"))
            .select(F.size("gram").alias("length"),
                    F.xxhash64(F.transform("gram", lambda w: F.xxhash64(w))).alias("hash"),
                    "gram", "items"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20,
    key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, n_words, hit_words, items, n_hit, contaminated) per row of `docs`.

    hit_words: sorted places, from 1, of the words inside any occurrence of a window; items: the
    sorted items those windows belong to, as strings.  contaminated: `share` times the hit words
    are at least all words.  Null texts have no words and are clean; an empty benchmark leaves
    all clean; repeated rows are reported as often as they occur; rows with the same key and
    different texts are judged apart; other columns are not looked at.

    Each document also emits one row of length 0 that meets an empty window, so that clean
    documents come out of the same scan and no join back is needed.
    """
    tests = benchmark_windows(benchmark, window, item, item_text)
    sizes = tests.groupBy("length").agg(F.count("*").alias("n")).collect()  # `window` rows at most
    none = F.array().cast("array<string>")
    whole = docs.sparkSession.range(1).select(
        F.lit(0).alias("length"), F.lit(0).cast("long").alias("hash"), none.alias("gram"), none.alias("items"))
    tests = tests.unionByName(whole)
    if sum(r.n for r in sizes) < MOST_BROADCAST:
        tests = F.broadcast(tests)

    words = docs.select(
        F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("content"), F.col(text).isNull().alias("blank"),
        words_of(F.col(text)).alias("words"))
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    mark = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("at"), F.lit(0).cast("long").alias("hash")))
    lists = [F.coalesce(_windows(F.col("hashes"), r.length), F.filter(mark, lambda m: F.lit(False)))
             for r in sorted(sizes)]
    each = hashed.select("key", "content", "blank", "words", F.explode(F.concat(mark, *lists)).alias("w")).select(
        "key", "content", "blank", "words", "w.*")
    met = each.join(tests, ["length", "hash"]).where(
        (F.col("length") == 0) | (F.slice("words", F.greatest("at", F.lit(1)), F.col("length")) == F.col("gram")))
    found = met.select(
        "key", "content", "blank", F.size("words").alias("n_words"), "length", "at", "items",
    ).groupBy("key", "content", "blank", "n_words").agg(
        F.count_if(F.col("length") == 0).alias("rows"),
        F.collect_set(F.when(F.col("length") > 0, F.struct("at", "length"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    places = F.array_sort(F.array_distinct(F.flatten(
        F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))))
    n_hit = F.size("hit_words")
    return (
        found.withColumn("hit_words", places)
        .withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
        .select(F.col("key").alias(key), "content", "n_words", "hit_words", "items", n_hit.alias("n_hit"),
                ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs`, all columns, without the rows that `contamination` calls contaminated."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    bad = contamination(docs, benchmark, **options).where("contaminated").select(
        F.col(key).alias("__key"), F.col("content").alias("__content")).distinct()
    return docs.join(
        bad, docs[key].eqNullSafe(bad["__key"]) & (F.xxhash64(docs[text]) == bad["__content"]), "left_anti")


def without_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(key, text) per row of `docs` with the hit words cut out of the normalised text."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    found = contamination(docs, benchmark, **options).select(
        F.col(key).alias("__key"), F.col("content").alias("__content"), "hit_words").distinct()
    kept = F.filter(words_of(F.col(text)), lambda w, i: ~F.array_contains("hit_words", i + 1))
    joined = docs.join(
        found, docs[key].eqNullSafe(found["__key"]) & (F.xxhash64(docs[text]) == found["__content"]))
    return joined.select(F.col(key), F.array_join(kept, " ").alias(text))
