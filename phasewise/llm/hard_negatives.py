"""Hard negatives by the threshold algorithm on sorted candidate lists.

All rows are dealt into blocks, the anchors into blocks of their own, and a unit of work is one of
each.  In a unit every dimension has its candidates sorted.  An anchor reads the lists from the
end its own component's sign calls for, a few entries of all lists at a time; what it meets is
scored whole, in integers.  No row unread can score above the threshold, the sum of the anchor's
components times the last values read, so reading stops once the threshold is strictly below the
kth score of every window asked for.  A first pass finds the positives of each anchor in its own
label, a second one the negatives in the score window of each positive; the best of each unit
are merged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, python_tasks
from .integers import exact, finite, integers

POSITIVES = NEGATIVES = 5
LEAST_SHARE, MOST_SHARE = 80, 100  # percent of the positive's score
CELLS = 1 << 18  # components of a block of candidates: 4,096 rows of 64
ANCHORS = 1024  # of a block
EVERY = (-(1 << 62), 1 << 62)


class Lists:
    """Candidates with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.ids, self.values = ids, values
        self.order = np.argsort(values, axis=0, kind="stable")

    def reads(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """(entries read, threshold) of ever longer sorted reads; after the last one all rows are read."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        if not len(up) and not len(down):  # an anchor of zeros scores all rows alike
            yield np.arange(n), EVERY[0]
            return
        depth, step = 0, max(16, n // 16)
        while depth < n:
            last = min(depth + step, n)
            read = np.concatenate([self.order[depth:last, up].ravel(), self.order[n - last : n - depth, down].ravel()])
            ends = [(last - 1, up), (n - last, down)]
            threshold = sum((anchor[d] * self.values[self.order[at, d], d]).sum() for at, d in ends)
            yield read, threshold if last < n else EVERY[0]
            depth, step = last, 2 * step

    def first(self, anchor: np.ndarray, windows: Sequence[tuple[int, int]], k: int, free: np.ndarray) -> list[np.ndarray]:
        """For each window of scores, both ends included, the first `k` of the rows in it that are
        `free`, as (id, score) rows: highest score first, then smallest id."""
        seen = np.zeros(len(self.ids), bool)
        ids, scores, best = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        least = min(low for low, _ in windows)
        for read, threshold in self.reads(anchor):
            fresh = np.zeros(len(seen), bool)
            fresh[read] = True
            rows = np.flatnonzero(fresh & ~seen)
            seen[rows] = True
            made = (self.values[rows] @ anchor).astype(np.int64)
            rows, made = rows[good := free[rows] & (made >= least)], made[good]
            ids, scores = np.append(ids, self.ids[rows]), np.append(scores, made)
            order = np.lexsort((ids, -scores))
            ids, scores = ids[order], scores[order]
            best = []
            for low, high in windows:
                begin, end = np.searchsorted(-scores, -high, "left"), np.searchsorted(-scores, -low, "right")
                best.append(np.stack([ids[begin:end][:k], scores[begin:end][:k]], 1))
            if all(threshold < (found[-1, 1] if len(found) == k else low) for found, (low, _) in zip(best, windows, strict=True)):
                break
        return best


def _columns(key: tuple[pa.Scalar, ...], rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, components) of a block, by ascending id."""
    rows = rows.sort_by("id")
    values = rows["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), key[0].as_py())
    return rows["id"].to_numpy(), rows["label"].to_numpy(), values


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _table(parts: list[np.ndarray], schema: pa.Schema) -> pa.Table:
    rows = np.concatenate(parts) if parts else np.zeros((0, len(schema)), np.int64)
    return pa.Table.from_arrays([pa.array(rows[:, i]) for i in range(len(schema))], schema=schema)


def _beside(left: Sequence[int], right: np.ndarray) -> np.ndarray:
    return np.concatenate([np.broadcast_to(np.array(left, np.int64), (len(right), len(left))), right], 1)


def _positives(k: int):
    def search(key: tuple[pa.Scalar, ...], candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        (ids, labels, values), (own, kinds, vectors) = _columns(key, candidates), _columns(key, anchors)
        values, vectors = exact(values, vectors, terms=values.shape[1])
        out = []
        for label in np.unique(kinds.astype(str)):
            rows = np.flatnonzero(labels == label)
            lists = Lists(ids[rows], values[rows])
            for i in np.flatnonzero(kinds == label):
                [found] = lists.first(vectors[i], [EVERY], k, lists.ids != own[i]) or [np.zeros((0, 2), np.int64)]
                out.append(_beside([own[i]], found))
        return _table(out, _POSITIVE)

    return search


def _negatives(k: int, least: int, most: int):
    def search(key: tuple[pa.Scalar, ...], candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        (ids, labels, values), (own, kinds, vectors) = _columns(key, candidates), _columns(key, anchors)
        values, vectors = exact(values, vectors, terms=values.shape[1])
        positives = anchors.sort_by("id")["positives"].to_pylist()
        lists, out = Lists(ids, values), []
        for i, asked in enumerate(positives):
            # least * positive <= 100 * negative <= most * positive
            windows = {p["score"]: (-(-least * p["score"] // 100), most * p["score"] // 100) for p in asked}
            windows = {score: (low, high) for score, (low, high) in windows.items() if low <= high}
            if not windows or not len(ids):
                continue
            found = dict(zip(windows, lists.first(vectors[i], list(windows.values()), k, labels != kinds[i]), strict=True))
            out += [_beside([own[i], p["id"], p["score"]], found[p["score"]]) for p in asked if p["score"] in found]
        return _table(out, _NEGATIVE)

    return search


def _best(found: DataFrame, by: list[str], score: str, then: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), then)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    least: int = LEAST_SHARE, most: int = MOST_SHARE, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    cells: int = CELLS, block: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become integers (see `integers`); the score of two rows is the inner product of
    theirs.  Higher scores come first, ties by the smaller key.  Anchors are the rows for which
    `anchor`, a condition on the columns of `vectors`, holds; they and all other rows are candidates.  An
    anchor's positives are its first `positives` other rows of the same label; the negatives of
    each positive are the first `negatives` rows of another label of which
    least * positive_score <= 100 * negative_score <= most * positive_score.

    Rows without a key or label, and those whose vector is null or holds a null or non-finite
    component, take no part.  Only vectors of equal length meet; empty ones score 0.  Rows under
    the same key count once, with the least (label, vector).  An anchor alone in its label, and a
    positive without negatives, give no rows; no vectors: no rows.  Other columns are not looked at.
    """
    python_tasks(vectors.sparkSession)
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v"))).groupBy("id").agg(
        F.min(F.struct("label", "v", "asks")).alias("row"))
    rows = cut(rows.select("id", "row.label", "row.asks", F.size("row.v").alias("d"), integers(F.col("row.v")).alias("v")), "integers")
    sizes = rows.groupBy("d").agg(
        F.ceil(F.count("*") * F.greatest("d", F.lit(1)) / cells).alias("blocks"),
        F.ceil(F.count_if("asks") / block).alias("asking"))
    rows = rows.join(cut(sizes.where("asking > 0"), "blocks"), "d")

    def dealt(own: str, other: str, frame: DataFrame) -> DataFrame:
        """Every row with the number of its own block, once for each block of the other side."""
        many = {"block": F.col("blocks"), "ask": F.col("asking")}
        out = frame.withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), many[own])).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), many[other] - 1))).drop("blocks", "asking", "asks")
        return out.select(*[F.col(c).alias(c) for c in out.columns])

    unit = ["d", "block", "ask"]
    candidates = dealt("block", "ask", rows).groupBy(*unit)
    anchors = rows.where("asks")

    def ddl(schema: pa.Schema) -> str:
        return ", ".join(f"{name} long" for name in schema.names)

    near = candidates.cogroup(dealt("ask", "block", anchors).groupBy(*unit)).applyInArrow(_positives(positives), ddl(_POSITIVE))
    near = _best(near, ["anchor_id"], "positive_score", "positive_id", positives)
    asked = cut(near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(  # `positives` entries at most
        F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")), "positives")
    far = candidates.cogroup(dealt("ask", "block", anchors.join(asked, "id")).groupBy(*unit)).applyInArrow(
        _negatives(negatives, least, most), ddl(_NEGATIVE))
    far = _best(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
