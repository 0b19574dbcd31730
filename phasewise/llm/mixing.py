"""Mixing sources to target weights by a low-discrepancy schedule.

DataFrame functions only.  Golden-ratio points t * phi mod 1 fall into the cumulative weights of
the sources; the slots of a source are ranked and joined with equal-sized blocks of its
documents, which lie in the order of a seeded digest.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # tokens of the mix per token of the input
REPEATS = 2  # times a source may be taken
BLOCK = 1024  # tokens
CELLS = 4096
PHI = (math.sqrt(5) - 1) / 2
_STEP = 1 << 26


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def _points(n: int, spark) -> DataFrame:
    """t and its golden-ratio point; t is split so that no digit is lost for large t."""
    t = F.col("id")
    point = F.pmod((t % _STEP) * PHI + F.floor(t / _STEP) * math.fmod(_STEP * PHI, 1.0), F.lit(1.0))
    return spark.range(n).select(t.alias("t"), point.alias("point"))


def targets(sources: DataFrame, weights: Sequence[float], share: float, repeats: float) -> DataFrame:
    """Adds `target` to (place, source_size): least(repeats * size, weight * level), where the
    level is such that all targets sum to `share` of all sizes.  One row per source."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(repeats))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    goal = F.sum("source_size").over(whole) * float(share)
    level = (goal - F.coalesce(F.sum("cap").over(order), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    rows = rows.withColumn("level", level)
    best = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(whole)
    return rows.withColumn("target", F.least("cap", F.col("weight") * F.coalesce(best["level"], F.col("level")))).drop("level", "cap")


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(place, rank, t): the slots of the mix in order t, with their rank inside their source.

    `sources` has place and quota (whole tokens).  A source gets ceil(quota / block) slots.  Its
    surplus points are skipped; the few that the sequence still owes it at the end are appended.
    """
    need = sources.select("place", F.ceil(F.col("quota") / block).alias("need")).where("need > 0")
    whole = Window.partitionBy()
    order = Window.orderBy("place")
    lines = need.select(
        "place", "need", F.sum("need").over(whole).alias("all"),
        F.sum("need").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    ).select("place", "need", ((F.col("upto") - F.col("need")) / F.col("all")).alias("low"), (F.col("upto") / F.col("all")).alias("high"))
    cells = lines.select(
        "*", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.ceil(F.col("high") * CELLS))).alias("cell"))
    n = need.agg(F.sum("need")).first()[0] or 0
    dealt = (
        _points(n, sources.sparkSession)
        .withColumn("cell", F.floor(F.col("point") * CELLS))
        .join(cells, "cell")
        .where("point >= low AND point < high")
        .select("place", "need", "t", F.floor(F.col("t") / 16_384).alias("range"))
    )
    ranges = dealt.groupBy("place", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("place", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("place", "range").orderBy("t")) - 1
    ranked = dealt.withColumn("inside", inside).join(starts, ["place", "range"])
    slots = ranked.select("place", (F.col("start") + F.col("inside")).alias("rank"), "t", "need").where("rank < need")
    got = ranges.groupBy("place").agg(F.sum("n").alias("got"))
    owed = (
        need.join(got, "place", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
        .select("place", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank"))
        .select("place", "rank", (F.lit(n) + F.col("rank")).alias("t"))
    )
    return slots.drop("need").unionByName(owed)


def lay_out(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: int = 0,
    per_bucket: int = 2000, key: str = "doc_id", text: str = "text", source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(documents, sources).  documents: (key, content, place, size, start) with the first token's place in
    its source, in the order of the digest of seed and key (equal keys: smaller first).
    sources: (place, name, source_size, target, quota); place counts them by code point, null last.

    A source is cut into buckets by the digest, each summed and shifted, so that no source is
    ever sorted in one task.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))  # any string sorts before null
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    sized = cut(docs.select(F.col(key).alias("key"), name.alias("name"), order.alias("digest"),
                            F.xxhash64(F.col(text)).alias("content"), size_of(F.col(text)).alias("size")), "sizes")
    totals = sized.groupBy("name").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    placed = totals.withColumn("place", F.row_number().over(Window.orderBy("name")))
    sources = cut(
        targets(placed, weights, share, repeats).withColumn("quota", F.floor(F.col("target") + 0.5)), "sources")
    unit = F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / float(1 << 32)
    bucketed = sized.join(sources.select("name", "place", "n"), "name").select(
        "key", "place", "digest", "content", "size",
        F.floor(unit * F.ceil(F.col("n") / per_bucket)).alias("bucket"))
    sums = bucketed.groupBy("place", "bucket").agg(F.sum("size").alias("tokens"))
    before = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("place", "bucket", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("shift"))
    within = (Window.partitionBy("place", "bucket").orderBy("digest", "size", "content")
              .rowsBetween(Window.unboundedPreceding, -1))
    laid = (
        bucketed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(shift, ["place", "bucket"])
        .select("key", "content", "place", "size", (F.col("shift") + F.col("inside")).alias("start"))
    )
    return cut(laid, "laid"), sources


def mixed_pieces(laid: DataFrame, sources: DataFrame, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """(t, place, key, start, size, turn, skip, tokens): the mix.  Slot t takes `tokens` words of the
    document, after its first `skip`; a slot takes `block` words, a source's last one the rest."""
    turns = laid.where("size > 0").join(sources.select("place", "source_size", "quota"), "place").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")).withColumn(
        "first", F.col("turn") * F.col("source_size") + F.col("start")).withColumn(
        "end", F.least(F.col("first") + F.col("size"), F.col("quota"))).where("first < end")
    ranked = turns.select(
        "*", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("end") - 1) / block))).alias("rank"))
    begin = F.greatest("first", F.col("rank") * block)
    return ranked.join(schedule(sources, block), ["place", "rank"]).select(
        "t", "place", "key", "start", "size", "turn", (begin - F.col("first")).alias("skip"),
        (F.least("end", (F.col("rank") + 1) * block) - begin).alias("tokens"))


def mix(docs: DataFrame, key: str = "doc_id", block: int = BLOCK, **options) -> DataFrame:
    """(key, size, source_size, target, taken) per row of `docs`; options as in `lay_out`.

    Null texts have size 0 and nothing is taken of them; a null source is a source of its own;
    rows with a repeated or null key are rows of their own; sources without words have target 0;
    no documents: no rows.  Further columns are not looked at.
    """
    laid, sources = lay_out(docs, key=key, **options)
    taken = (mixed_pieces(laid, sources, block, options.get("repeats", REPEATS))
             .groupBy("place", "start", "size").agg(F.sum("tokens").alias("taken")))
    return laid.join(taken, ["place", "start", "size"], "left").join(
        sources.select("place", "source_size", "target"), "place").select(
        F.col("key").alias(key), "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str = "n_chars", block: int = BLOCK, **options) -> DataFrame:
    """The mix as documents with the columns of `docs`: a row per document and turn it is taken in.

    Where a source's target ends inside a document, the taken words, joined by one space, are
    the text, and `length` their characters.  Documents of which nothing is taken go.
    """
    laid, sources = lay_out(docs, key=key, text=text, **options)
    taken = (mixed_pieces(laid, sources, block, options.get("repeats", REPEATS))
             .groupBy("place", "start", "size", "turn").agg(F.sum("tokens").alias("__taken")))
    turns = laid.join(taken, ["place", "start", "size"]).select(
        F.col("key").alias("__key"), F.col("content").alias("__content"), F.col("size").alias("__size"), "__taken")
    whole = docs.withColumn("__text", F.xxhash64(F.col(text))).dropDuplicates([key, "__text"])
    both = whole.join(turns, whole[key].eqNullSafe(turns["__key"]) & (whole["__text"] == turns["__content"]))
    part = F.array_join(F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({SPACE_WORD})")), F.lit(1), F.col("__taken").cast("int")), " ")
    cut_short = F.col("__taken") < F.col("__size")
    out = both.withColumn("__text", F.when(cut_short, part).otherwise(F.col(text)))
    number = F.when(cut_short, F.char_length("__text")).otherwise(F.col(length)).cast(dict(docs.dtypes)[length])
    return out.withColumn("__length", number).select(
        *[{text: F.col("__text"), length: F.col("__length")}.get(c, F.col(c)).alias(c) for c in docs.columns])
