"""MinHash near-duplicates by an inverted join on signature coordinates.

Documents with the same shingle set form a class.  A class is posted under its coordinate values,
rarest first; two classes that agree on THRESHOLD of COORDINATES must meet in the first
postings (the prefix), so only those are joined.  What meets has its agreeing coordinates
counted, and what passes is compared on full shingle sets.

Before that, the shingles that each posted class has in common with any other are counted: two
classes cannot share more than the smaller of their counts.  This rules out most pairs of a large
group of loose copies, whose own edits occur nowhere else.  For what the first links leave apart,
shingles of two or three classes count as well: classes that share such a one meet by it, and all
others cannot share any.  What is left of two classes' intersection lies inside the set of the hub they were
both compared with, where the smaller of their shares bounds it, or outside, where the smaller
rest does.  A class is joined only to the sizes and rests that this bound leaves possible, so
pairs that are ruled out do not become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, python_tasks
from .textcore import LOWER_ASCII, byte_sums, chunks, mixed, prefix_sums, span_hashes, words

SHINGLE = 5
COORDINATES = 64
# Of 64 coordinates two sets of similarity 0.80 agree on fewer than 36 once in 100,000 pairs.
THRESHOLD = 36
OUT = 1 << 16  # rows of a batch
_MULTIPLIERS = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, first): each row's distinct shingle hashes in order, row after row."""
    for row, data, ends in chunks(column):
        data = LOWER_ASCII[data]
        begin, end, first = words(data, ends)
        sums = prefix_sums(span_hashes(byte_sums(data), begin, end))
        count = np.diff(first)
        at = np.arange(len(begin))
        of = np.repeat(np.arange(len(count)), count)
        stop = np.minimum(at + SHINGLE, first[1:][of])
        whole = (at + SHINGLE <= first[1:][of]) | (at == first[:-1][of])
        at, stop, of = at[whole], stop[whole], of[whole]
        hashes = span_hashes(sums, at, stop) ^ mixed((stop - at).astype(np.uint64))
        order = np.lexsort((hashes, of))
        hashes, of = hashes[order], of[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
        yield row, hashes[new], np.searchsorted(of[new], np.arange(len(count) + 1))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, content = batch.column(0), batch.column(1)
        for row, hashes, first in shingles(batch.column(2)):
            n, size = len(first) - 1, np.diff(first)
            some = size > 0
            at = first[:-1][some]
            print_ = np.zeros(n, np.uint64)
            signature = np.zeros((n, COORDINATES), np.uint32)
            if len(at):
                one, two = np.add.reduceat(mixed(hashes), at), np.add.reduceat(mixed(hashes ^ np.uint64(0x5DEECE66D)), at)
                print_[some] = mixed(one ^ mixed(two + size[some].astype(np.uint64)))
                for k, m in enumerate(_MULTIPLIERS):
                    signature[some, k] = np.minimum.reduceat(((hashes * m) >> np.uint64(32)).astype(np.uint32), at)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * COORDINATES), pa.array(signature.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, n), content.slice(row, n), pa.array(size.astype(np.int64)),
                 pa.array(print_.view(np.int64)), lists],
                ["id", "content", "n_shingles", "node", "signature"])


def _list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, hashes, first in shingles(batch.column(1)):
            n = len(first) - 1
            sets = [hashes[first[i] : first[i + 1]].tobytes() for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), pa.array(np.diff(first).astype(np.int64)), pa.array(sets, pa.binary())],
                ["node", "size", "hashes"])


def _set(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), np.int64)


def _list_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        every = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].view(np.int64)
        node = np.repeat(batch.column(0).to_numpy(), np.diff(ends) // 8)
        for i in range(0, len(every), OUT):
            yield pa.RecordBatch.from_arrays([pa.array(node[i : i + OUT]), pa.array(every[i : i + OUT])], ["node", "shingle"])


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [len(np.intersect1d(_set(a), _set(b), assume_unique=True))
                for a, b in zip(batch.column(4), batch.column(5), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both, pa.int64())], ["u", "v", "nu", "nv", "both"])


def _agreeing(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def _measured(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v, both, linked) of the distinct (u, v) that agree on enough coordinates: the size of the
    intersection of their full sets, and whether that makes a link."""
    left = classes.select(F.col("node").alias("u"), F.col("signature").alias("su"))
    right = classes.select(F.col("node").alias("v"), F.col("signature").alias("sv"))
    passed = pairs.join(left, "u").join(right, "v").where(_agreeing("su", "sv") >= THRESHOLD).select("u", "v")
    ends = [sets.select(F.col("node").alias(x), F.col("size").alias(f"n{x}"), F.col("hashes").alias(f"s{x}")) for x in "uv"]
    both = passed.join(ends[0], "u").join(ends[1], "v").select("u", "v", "nu", "nv", "su", "sv")
    linked = F.col("both") * 100 >= (F.col("nu") + F.col("nv") - F.col("both")) * percent
    return both.mapInArrow(_intersect, "u long, v long, nu long, nv long, both long").select("u", "v", "both", linked.alias("linked"))


def _rare_shingles(sets: DataFrame) -> DataFrame:
    """(n, nodes) of every shingle that only n = 1, 2 or 3 classes have."""
    found = sets.select("node", "hashes").mapInArrow(_list_shingles, "node long, shingle long").groupBy("shingle").agg(
        F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor("node").alias("all"))
    between = F.col("all").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi"))
    nodes = (F.when(F.col("n") == 1, F.array("lo")).when(F.col("n") == 2, F.array("lo", "hi"))
             .otherwise(F.array("lo", between, "hi")))
    return cut(found.where("n <= 3").select("n", nodes.alias("nodes")), "rare")


def _bounded(posted: DataFrame, sizes: DataFrame, rare: DataFrame, percent: int) -> DataFrame:
    """`posted` with the size of each class's set, how many of it any other class has (common) and
    how many at least three others have (often), without the classes that have too few in common
    for any partner."""
    counts = rare.select("n", F.explode("nodes").alias("node")).groupBy("node").agg(
        F.count_if(F.col("n") == 1).alias("alone"), F.count("*").alias("seldom"))
    bounds = sizes.join(counts, "node", "left").select(
        "node", "size", *[(F.col("size") - F.coalesce(less, F.lit(0))).alias(name)
                          for name, less in (("common", "alone"), ("often", "seldom"))])
    return posted.join(bounds.where(F.col("common") * 100 >= F.col("size") * percent), "node")


def _sharing_rare(rare: DataFrame, grouped: DataFrame) -> DataFrame:
    """Distinct (u, v), u < v, of different components that share a rare shingle."""
    ends = F.when(F.col("n") == 2, F.array(F.struct(F.col("nodes")[0].alias("u"), F.col("nodes")[1].alias("v")))).otherwise(
        F.array(*[F.struct(F.col("nodes")[i].alias("u"), F.col("nodes")[j].alias("v")) for i, j in ((0, 1), (0, 2), (1, 2))]))
    pairs = rare.where("n > 1").select(F.explode(ends).alias("p")).select("p.u", "p.v").distinct()
    of = [grouped.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "uv"]
    return pairs.join(of[0], "u", "left").join(of[1], "v", "left").where(
        F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v")


def _may_link(a: str, b: str, percent: int, most: Column):
    return most * 100 >= (F.col(f"{a}.size") + F.col(f"{b}.size") - most) * percent


BAND = 1.01  # sizes of a band differ by less than this factor
REST = 8  # rests from here on are joined as one
UNKNOWN = -1  # the rest of a class not compared with the hub


def _band(size: Column) -> Column:
    return F.floor(F.log(size.cast("double")) / math.log(BAND) + 1e-9).cast("int")


def _reachable(outside: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """`outside` with `to`: the (band, rest) of its list, one row each, in which a partner may lie."""
    kinds = held.groupBy("k", "value").agg(F.collect_set("kind").alias("kinds"))  # some bands of sizes by REST rests
    inside = F.coalesce("inside", "often")

    def possible(kind: Column) -> Column:
        rest = F.when(kind["rest"] == REST, F.col("rest")).otherwise(F.least(F.col("rest"), kind["rest"]))
        most = F.when(F.col("inside").isNull() | (kind["rest"] == UNKNOWN), F.col("often")).otherwise(
            F.least(F.col("often"), inside + rest))
        # The partner is as large as its band's smallest size at least.
        smallest = F.pow(F.lit(BAND), kind["band"]) * (1 - 1e-6)
        return most * 100 >= (F.col("size") + smallest - most) * percent

    return outside.join(kinds, ["k", "value"]).withColumn("to", F.explode(F.filter("kinds", possible))).drop("kinds")


def _postings(classes: DataFrame) -> DataFrame:
    """(k, value, node, at, n): the prefix of each class's shared coordinate values, rarest first.

    n counts the shared values; a class with fewer than THRESHOLD of them has no partner.
    """
    every = classes.select("node", F.posexplode("signature").alias("k", "value"))
    shared = every.groupBy("k", "value").agg(F.count("*").alias("n")).where("n > 1")
    lists = every.join(shared, ["k", "value"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "k", "value"))).alias("posted"))
    n = F.size("posted")
    prefix = lists.where(n >= THRESHOLD).select(
        "node", n.alias("n"), F.posexplode(F.slice("posted", 1, n - THRESHOLD + 1)).alias("at", "p"))
    return prefix.select("p.k", "p.value", "node", "at", "n")


def duplicate_groups(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, content, n_shingles, component_id, kept) per row of `docs`.

    Texts are linked when 100 * intersection >= percent * union of their sets of 5-word shingles
    (fewer words: the whole text is one).  component_id is the smallest key reachable by links.
    Null and wordless texts have an empty set and no links.  Repeated rows belong to the same
    group, and rows that share the smallest key are all kept; a null key never names a group
    that has another.  content is the xxhash64 of the text.  Other columns are not looked at; no
    documents: no rows.

    Large groups of near copies are not compared pair by pair: every posting list is first
    linked to one member, the hub.  Then only members of different components meet, and those of a list's
    largest component never meet each other.
    """
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("content"), F.col(text).alias("text"))
    signed = cut(
        rows.mapInArrow(_sign, f"id {dict(docs.dtypes)[key]}, content long, n_shingles long, node long, signature array<int>"),
        "signatures")
    classes = cut(
        signed.where("n_shingles > 0").groupBy("node").agg(
            F.first("signature").alias("signature"), F.min("content").alias("content"),
            F.first("n_shingles").alias("size")), "classes")
    postings = cut(_postings(classes), "postings")
    wanted = classes.join(postings.select("node").distinct(), "node", "left_semi").select("node", "content", "size")
    texts = rows.join(wanted, "content").groupBy("node").agg(F.first("text").alias("text"))
    sets = cut(texts.mapInArrow(_list_sets, "node long, size long, hashes binary"), "sets")
    rare = _rare_shingles(sets)
    posted = cut(_bounded(postings, sets.select("node", "size"), rare, percent), "bounded")

    # A list's hub is the member that has most of its set in common with others.
    traits = ["common", "size", "often"]
    rank = F.struct(F.col("common") / F.col("size"), F.col("node"), *traits)
    first = cut(posted.groupBy("k", "value").agg(F.max(rank).alias("hub")).select("k", "value", "hub.node", *[f"hub.{t}" for t in traits]), "hubs")
    hub, member = first.alias("a"), posted.alias("b")
    stars = hub.join(
        member, (F.col("a.k") == F.col("b.k")) & (F.col("a.value") == F.col("b.value"))
        & (F.col("a.node") != F.col("b.node")) & _may_link("a", "b", percent, F.least("a.common", "b.common"))
    ).select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    measured = cut(_measured(stars, classes, sets, percent), "measured")
    grouped = components(measured.where("linked"))

    placed = posted.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = placed.groupBy("k", "value", "component").agg(F.count("*").alias("members"))
    open_lists = parts.groupBy("k", "value").agg(F.count("*").alias("parts"), F.max(F.struct("members", "component")).alias("most"))
    open_lists = open_lists.where("parts > 1").select("k", "value", F.col("most.component").alias("most"))
    hubs = first.select("k", "value", F.col("node").alias("hub"), (F.col("common") - F.col("often")).alias("hub_seldom"))
    # A pair counts in the first list that both its classes are in: none before it is common.
    posting = F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("value").bitwiseAND(F.lit(0xFFFFFFFF)))
    prefixes = posted.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", posting.alias("p"))))["p"].alias("prefix"))
    inside = F.when(F.col("node") == F.col("hub"), F.col("size")).otherwise(F.col("both"))
    # At most so many of the shingles in the hub's set are rare ones, which `often` leaves out.
    seldom = F.least(F.col("common") - F.col("often"), F.col("hub_seldom"))
    rest = F.when(F.col("inside").isNull(), F.lit(UNKNOWN)).otherwise(F.greatest(F.col("often") - F.col("inside") + seldom, F.lit(0)))
    held = cut(
        placed.join(open_lists.join(hubs, ["k", "value"]), ["k", "value"])
        .join(measured.select(F.col("u").alias("hub"), F.col("v").alias("node"), "both"), ["hub", "node"], "left")
        .withColumn("inside", inside).withColumn("rest", rest)
        .withColumn("kind", F.struct(_band(F.col("size")).alias("band"), F.least("rest", F.lit(REST)).alias("rest")))
        .select("k", "value", "node", "component", "most", "size", "often", "inside", "rest", "kind", "at")
        .join(prefixes, "node"), "open")
    a, b = _reachable(held.where("component <> most"), held, percent).alias("a"), held.alias("b")
    within = F.when(F.col("a.inside").isNotNull() & F.col("b.inside").isNotNull(),
                    F.least("a.inside", "b.inside") + F.least("a.rest", "b.rest"))
    more = a.join(
        b, (F.col("a.k") == F.col("b.k")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.to") == F.col("b.kind"))
        & (F.col("a.component") != F.col("b.component"))
        & _may_link("a", "b", percent, F.least("a.often", "b.often", within))  # least skips a null
        & ((F.col("b.component") == F.col("b.most")) | (F.col("a.node") < F.col("b.node")))
        & ~F.arrays_overlap(F.slice("a.prefix", F.lit(1), F.col("a.at")), F.col("b.prefix"))
    ).select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))
    more = _measured(more.union(_sharing_rare(rare, grouped)).distinct(), classes, sets, percent).where("linked").select("u", "v")
    stars_of = grouped.select(F.col("node").alias("u"), F.col("component").alias("v"))
    final = components(stars_of.unionByName(more))

    out = signed.join(final, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = out.where("n_shingles > 0").groupBy("component").agg(F.min("id").alias("least"))
    out = out.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")))
    return out.join(names, "component", "left").select(
        F.col("id").alias(key), "content", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs`, all columns, with one document of each group."""
    gone = duplicate_groups(docs, percent, key, text).where("NOT kept").select(
        F.col(key).alias("__key"), F.col("content").alias("__content")).distinct()
    return docs.join(
        gone, docs[key].eqNullSafe(gone["__key"]) & (F.xxhash64(docs[text]) == gone["__content"]), "left_anti")
