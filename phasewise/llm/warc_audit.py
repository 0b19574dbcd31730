"""Fixity audit of WARC replicas by Merkle trees.

Every record is hashed; FAN neighbouring ranges of ids hash to their parent, up to one root per
replica.  Nodes are named by id ranges, not by ranks, so a lost or added record changes only its
own branch.  The audit compares roots and goes down only where a parent differs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

FAN = 64
_NONE = -1  # branch of records without an id


def record(url: Column, payload: Column) -> Column:
    """The bytes of a WARC resource record: header lines, an empty line, the payload."""
    body = F.encode(F.coalesce(payload, F.lit("")), "utf-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "utf-8"), body, F.encode(F.lit("\r\n\r\n"), "utf-8"))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, length, hash) per record.  Null urls and payloads are empty, a null id is -1."""
    made = pages.select(F.coalesce(F.col(key).cast("long"), F.lit(_NONE)).alias("id"),
                        record(F.col(url), F.col(payload)).alias("bytes"))
    return made.select("id", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("hash"))


def _parents(nodes: DataFrame) -> DataFrame:
    """Hash of the children's numbers and hashes in order; FAN children at most."""
    inside = F.array_sort(F.collect_list(F.struct("node", "hash")))
    text = F.array_join(F.transform(inside, lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])), ",")
    return nodes.groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(F.sha2(text, 256).alias("hash"), F.sum("bytes").alias("bytes"))


def levels_for(*replicas: DataFrame) -> int:
    """Levels above the records until one node is left for all ids (two: negative ids and others)."""
    most = max([0] + [r.agg(F.max(F.abs("id"))).first()[0] or 0 for r in replicas])
    n = 1
    while most >= FAN**n:
        n += 1
    return n


def tree(recs: DataFrame, levels: int) -> DataFrame:
    """(level, node, hash, bytes): level 0 is one leaf per id (several records of one id: their
    sorted hashes), the last level the root."""
    many = F.array_join(F.array_sort(F.collect_list("hash")), ",")
    level = recs.groupBy(F.col("id").alias("node")).agg(
        F.when(F.count("*") == 1, F.max("hash")).otherwise(F.sha2(many, 256)).alias("hash"), F.sum("length").alias("bytes"))
    out = [level.withColumn("level", F.lit(0))]
    for n in range(1, levels + 1):
        level = _parents(level)
        out.append(level.withColumn("level", F.lit(n)))
    return cut(reduce(DataFrame.unionByName, out).select("level", "node", "hash", "bytes"), "merkle")


def differing(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """(id, left_hash, right_hash) of the leaves that differ; a side that lacks the leaf is null.

    Starts at the roots.  Below a node only the children of differing parents are read."""
    open_nodes = None
    for n in range(levels, -1, -1):
        a, b = (t.where(F.col("level") == n).select("node", "hash") for t in (left, right))
        if open_nodes is not None:
            a, b = (t.withColumn("parent", F.floor(F.col("node") / FAN))
                    .join(open_nodes.withColumnRenamed("node", "parent"), "parent", "left_semi").drop("parent")
                    for t in (a, b))
        both = a.withColumnRenamed("hash", "left_hash").join(b.withColumnRenamed("hash", "right_hash"), "node", "full")
        both = both.where(~F.col("left_hash").eqNullSafe(F.col("right_hash")))
        open_nodes = both.select("node")
    return both.withColumnRenamed("node", "id")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, range, start, length, hash, status) per record of the left replica, and per id that
    only the right one has (start, length and hash null).

    Both sides are frames of `records`.  status: intact, corrupt (hashes differ), missing (not in
    the right replica) or added.  range is the leaf's parent, start the byte offset inside that
    range in the order of ids; repeated ids share a status and lie in the order of their hashes.
    Empty replicas are equal.
    """
    levels = levels_for(left, right)
    wrong = differing(tree(left, levels), tree(right, levels), levels)
    status = (
        F.when(F.col("left_hash").isNull() & F.col("right_hash").isNull(), "intact")
        .when(F.col("left_hash").isNull(), "added").when(F.col("right_hash").isNull(), "missing").otherwise("corrupt")
    )
    before = (Window.partitionBy("range").orderBy("id", "hash", "length")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = left.withColumn("range", F.floor(F.col("id") / FAN)).withColumn(
        "start", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.join(wrong, "id", "full").select(
        "id", F.coalesce("range", F.floor(F.col("id") / FAN)).alias("range"), "start", "length", "hash",
        status.alias("status"))
