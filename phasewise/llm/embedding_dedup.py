"""Embedding near-duplicates by collision counting on one-dimensional projections.

Unit vectors are projected on random directions.  The projections of two vectors at cosine t
differ by a normal number of deviation sqrt(2 - 2t), so they fall into a window of WIDTH
deviations around each other with a known chance; LEAST of PROJECTIONS windows are hit by all but
about one in a million of the pairs at the threshold.  The first projection also deals out the
work, in slabs as wide as its own, wider window; slabs are split into blocks, and a unit of work is
two blocks.  A unit sorts every projection, counts window hits per pair, and verifies what passes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, python_tasks

THRESHOLD = 0.98
PROJECTIONS = 32
WIDTH = 2.5  # a pair at the threshold is inside with probability 0.9876
LEAST = 26  # of 32: fewer hits have probability 1e-6
SLAB_WIDTH = 4.5  # outside with probability 7e-6
BLOCK = 1024


def _directions(dimensions: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(11)).standard_normal((dimensions, PROJECTIONS + 1))


def _vectors(lists: pa.ListArray) -> np.ndarray:
    """Rows of equally many components, each scaled by a power of two so that squares stay finite."""
    rows = lists.flatten().to_numpy().astype(np.float64).reshape(len(lists), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None]) if len(rows) else rows


def _place(deviation: float):
    """The slab of each vector on the first projection."""

    def place(batches):
        for batch in batches:
            lists = batch.column(1)
            slabs = np.zeros(len(batch), np.int64)
            lengths = np.diff(lists.offsets.to_numpy())
            for d in np.unique(lengths):
                rows = np.flatnonzero(lengths == d)
                vectors = _vectors(lists.take(pa.array(rows)))
                x = vectors @ _directions(int(d))[:, 0] / np.linalg.norm(vectors, axis=1)
                slabs[rows] = np.floor(x / (SLAB_WIDTH * deviation))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slabs)], ["node", "slab"])

    return place


def _hits(left: np.ndarray, right: np.ndarray, half: float) -> np.ndarray:
    """Window hits per pair: each projection of `right` is sorted, and the window around each
    query is a range of that order."""
    counts = np.zeros((len(left), len(right)), np.int8)
    rows = np.arange(len(left))
    for p in range(left.shape[1]):
        order = np.argsort(right[:, p], kind="stable")
        line = right[order, p]
        step = np.zeros((len(left), len(right) + 1), np.int8)
        step[rows, np.searchsorted(line, left[:, p] - half, "left")] += 1
        step[rows, np.searchsorted(line, left[:, p] + half, "right")] -= 1
        counts[:, order] += np.cumsum(step[:, :-1], axis=1, dtype=np.int8)
    return counts


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable from each row over the links (a, b)."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        after = least.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        np.minimum.at(after, least[a], low)
        np.minimum.at(after, least[b], low)
        after = after[after]
        if (after == least).all():
            return least
        least = after


_FOUND = pa.schema([("node", pa.int64()), ("parent", pa.int64()), ("links", pa.int64())])


def _compare(threshold: float, deviation: float):
    half = WIDTH * deviation

    def compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows, [("side", "ascending"), ("node", "ascending")])
        rows = rows.take(order)
        vectors = _vectors(rows["vector"].combine_chunks())
        norms = np.linalg.norm(vectors, axis=1)
        side, node, copies = (rows[c].to_numpy() for c in ("side", "node", "copies"))
        n = len(node)
        split = int(np.searchsorted(side, 1))
        own = split == n  # a block with itself
        right = slice(0, n) if own else slice(split, n)
        if split == 0:
            return _FOUND.empty_table()
        lines = (vectors / norms[:, None]) @ _directions(vectors.shape[1])[:, 1:]
        ends = [[], []]
        for i in range(0, split, 256):
            part = slice(i, min(i + 256, split))
            a, b = np.nonzero(_hits(lines[part], lines[right], half) >= LEAST)
            a, b = a + i, b + right.start
            if own:
                a, b = a[a < b], b[a < b]
            cosine = np.einsum("ij,ij->i", vectors[a], vectors[b]) / (norms[a] * norms[b])
            ends[0].append(a[cosine >= threshold])
            ends[1].append(b[cosine >= threshold])
        a, b = np.concatenate(ends[0]), np.concatenate(ends[1])
        links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        parent = _forest(n, a, b)
        some = np.flatnonzero(links > 0)
        return pa.Table.from_arrays(
            [pa.array(node[some]), pa.array(node[parent[some]]), pa.array(links[some].astype(np.int64))], schema=_FOUND)

    return compare


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(key, n_links, component_id, kept) per row of `vectors`.

    Rows of the same non-null label and as many dimensions are linked when their cosine, in
    double precision, is at least `threshold`.  Null, empty and zero vectors and those with null
    or non-finite components have no links, and so have rows without a label.  Equal vectors
    count as linked rows each, but are compared once.  component_id: smallest key reachable; kept: it is the row's own.
    Rows that share the smallest key are all kept; other columns are not looked at; no vectors: no rows.
    """
    python_tasks(vectors.sparkSession)
    deviation = math.sqrt(2 - 2 * threshold)
    value = F.col("vector")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(value, lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(value) > 0) & finite, F.lit(False))
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")).select(
        "id", "label", "vector", F.when(usable, F.xxhash64("label", "vector")).alias("node"))
    classes = cut(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies")), "classes")
    slabs = cut(classes.select("node", "vector").mapInArrow(_place(deviation), "node long, slab long").join(
        classes.select("node", "label", F.size("vector").alias("d")), "node"), "slabs")
    sizes = slabs.groupBy("label", "d", "slab").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    above = sizes.select("label", "d", (F.col("slab") - 1).alias("slab"), F.col("blocks").alias("above"))
    below = sizes.select("label", "d", (F.col("slab") + 1).alias("slab"), F.col("blocks").alias("below"))
    around = sizes.join(above, ["label", "d", "slab"], "left").join(below, ["label", "d", "slab"], "left")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))

    def units(count: str, make):
        last = F.coalesce(F.col(count), F.lit(0)) - 1
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0))), make))

    def unit(slab, a, step: int, b, side):
        return F.struct(slab.alias("at"), a.alias("a"), F.lit(step).alias("step"), b.alias("b"), side.cast("int").alias("side"))

    slab, a = F.col("slab"), F.col("block")
    none = F.filter(F.array(unit(slab, a, 0, a, F.lit(0))), lambda u: F.lit(False))
    lists = [
        units("blocks", lambda b: unit(slab, F.least(a, b), 0, F.greatest(a, b), a > b)),
        units("above", lambda b: unit(slab, a, 1, b, F.lit(0))),
        units("below", lambda b: unit(slab - 1, b, 1, a, F.lit(1))),
    ]
    dealt = (
        slabs.join(around, ["label", "d", "slab"])
        .withColumn("block", block)
        .select("node", "label", "d", F.explode(F.concat(*[F.coalesce(x, none) for x in lists])).alias("u"))
        .select("node", "label", "d", "u.*")
        .join(classes.select("node", "vector", "copies"), "node")
    )
    found = cut(
        dealt.groupBy("label", "d", "at", "a", "step", "b").applyInArrow(
            _compare(threshold, deviation), "node long, parent long, links long"), "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("node").alias("u"), F.col("parent").alias("v")))
    out = (
        rows.select("id", "node")
        .join(classes.select("node", "copies"), "node", "left")
        .join(links, "node", "left")
        .join(grouped, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    names = out.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    return out.join(names, "component", "left").select(
        F.col("id").alias(key),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("node").isNotNull(), F.col("least")).otherwise(F.col("id")).cast("long").alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
