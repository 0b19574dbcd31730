"""Vector codes by ball k-means: a codebook per part of the vector, and the codes it gives.

An entry's ball holds the parts assigned to it; its radius is the distance of the farthest.  Another
entry is a neighbour if half its distance is within the radius; no other can be nearer to any part
of the ball.  Within the ball, parts nearer to the centre than half the distance of the nearest neighbour are
its stable core and stay without work; the ring that a part lies in, between the half distances of
two successive neighbours, says how many of them it is compared with.  All of it is decided on
integers, so rings, ties and assignments are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, python_tasks
from .integers import exact, finite, integers

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SLICE = 1 << 20  # comparisons worked on at a time


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every entry, exact."""
    rows, entries = exact(rows, entries, terms=rows.shape[1])
    apart = (rows * rows).sum(1)[:, None] - 2 * (rows @ entries.T) + (entries * entries).sum(1)
    return apart.astype(np.int64)


def own_distance(rows: np.ndarray, entries: np.ndarray, code: np.ndarray) -> np.ndarray:
    return ((rows - entries[code]) ** 2).sum(1)


class Balls:
    """The balls of one part's codebook: neighbours by distance, within reach of the radius."""

    def __init__(self, entries: np.ndarray, radius: np.ndarray):
        """radius: the largest squared distance in each ball, -1 for empty ones."""
        self.entries = entries
        apart = squared(entries, entries)
        np.fill_diagonal(apart, np.iinfo(np.int64).max)
        self.order = np.argsort(apart, axis=1, kind="stable")
        near = np.take_along_axis(apart, self.order, 1)
        # A neighbour's half distance is within the radius: a quarter of the squared one.
        self.near = [line[: np.searchsorted(line, 4 * r, "right")] for line, r in zip(near, radius, strict=True)]

    def assign(self, rows: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(codes, squared distances, comparisons made) of rows that had the given codes."""
        best = own_distance(rows, self.entries, code)
        ring = np.zeros(len(rows), np.int64)  # how many neighbours may be as near as the own entry
        for i in np.unique(code):
            of = np.flatnonzero(code == i)
            ring[of] = np.searchsorted(self.near[i], 4 * best[of], "right")
        out, least, made = code.copy(), best.copy(), 0
        outside = np.flatnonzero(ring)
        ends = np.append(0, np.cumsum(ring[outside]))
        begin = 0
        while begin < len(outside):
            stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + SLICE, "right")) - 1)
            some, n = outside[begin:stop], ring[outside[begin:stop]]
            first = np.append(0, np.cumsum(n))[:-1]
            row = np.repeat(some, n)
            other = self.order[code[row], np.arange(len(row)) - np.repeat(first, n)]
            apart = own_distance(rows[row], self.entries, other)
            near = np.minimum(np.minimum.reduceat(apart, first), best[some])
            tied = np.where(apart == np.repeat(near, n), other, len(self.entries))
            tied = np.minimum.reduceat(tied, first)
            out[some] = np.where(best[some] == near, np.minimum(tied, code[some]), tied)
            least[some], made, begin = near, made + len(row), stop
        return out, least, made


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances), ties to the lower code."""
    apart = squared(rows, entries)
    code = apart.argmin(1)
    return code, apart[np.arange(len(rows)), code]


def _parts(vectors: pa.Array, parts: int) -> np.ndarray:
    """(part, row, place) of the integer components."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(vectors), parts, -1).transpose(1, 0, 2)


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts).T.astype(np.int64)


_STATE = "id long, label string, v array<int>, code binary, error long"


def _assign(entries: np.ndarray, radius: np.ndarray | None):
    """Codes and errors by full search, or, with radii, from the codes the rows have."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(e, r) for e, r in zip(entries, radius, strict=True)] if radius is not None else None
        for batch in batches:
            if not len(batch):
                continue
            rows = _parts(batch.column(2), len(entries))
            if balls is None:
                found = [nearest(r, e) for r, e in zip(rows, entries, strict=True)]
            else:
                found = [b.assign(r, c) for b, r, c in zip(balls, rows, _codes(batch.column(3), len(entries)), strict=True)]
            codes = np.ascontiguousarray(np.stack([f[0] for f in found], 1).astype(np.uint8))
            error = np.sum([f[1] for f in found], 0)
            packed = [line.tobytes() for line in codes]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(error)], ["id", "label", "v", "code", "error"])

    return assign


def _sums(parts: int, entries: int):
    """(part, entry, n, sums) of a task's rows: one row per entry used."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sums = None
        for batch in batches:
            if not len(batch):
                continue
            rows, codes = _parts(batch.column(0), parts), _codes(batch.column(1), parts)
            if count is None:
                count, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, rows.shape[2]), np.int64)
            for p in range(parts):
                count[p] += np.bincount(codes[p], minlength=entries)
                np.add.at(sums[p], codes[p], rows[p])
        if count is not None:
            part, entry = np.nonzero(count)
            lists = pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * sums.shape[2], sums[part, entry].ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), lists],
                ["part", "entry", "n", "sums"])

    return add


def _radii(entries: np.ndarray):
    """(part, entry, radius): the largest squared distance of a task's rows to their entries."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.full(entries.shape[:2], -1, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            rows, codes = _parts(batch.column(0), len(entries)), _codes(batch.column(1), len(entries))
            for p in range(len(entries)):
                np.maximum.at(most[p], codes[p], own_distance(rows[p], entries[p], codes[p]))
        part, entry = np.nonzero(most >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(most[part, entry])], ["part", "entry", "radius"])

    return reach


def _moved(state: DataFrame, entries: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floor of its parts' mean; unused ones stay."""
    parts, k, width = entries.shape
    added = state.select("v", "code").mapInArrow(_sums(parts, k), "part int, entry int, n long, sums array<long>")
    total = added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    moved = entries.copy()
    for r in total.collect():  # parts * entries rows at most
        moved[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return moved


def _reach(state: DataFrame, entries: np.ndarray) -> np.ndarray:
    radius = np.full(entries.shape[:2], -1, np.int64)
    found = state.select("v", "code").mapInArrow(_radii(entries), "part int, entry int, radius long")
    for r in found.groupBy("part", "entry").agg(F.max("radius").alias("radius")).collect():  # parts * entries rows at most
        radius[r.part, r.entry] = r.radius
    return radius


def codebooks_digest(entries: np.ndarray) -> str:
    """sha256 of the decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) per row of `vectors` that has a code.

    Components become integers (see `integers`) and vectors `parts` equal parts; each part has a
    codebook of at most 256 entries that starts as that part of the `entries` smallest keys and
    moves for `rounds` rounds to the floored means of its parts.  code: two hex digits per part;
    error: the squared distances summed over parts; label_error: error over the rows of the same
    label, null labels together.

    Rows whose vector is null or holds a null or non-finite component are dropped, and so are
    vectors that differ in length from that of the smallest key, empty ones, and lengths that `parts` does not
    divide.  Null keys come first and equal keys are ordered by their vectors; repeated rows are coded each.  Fewer rows than
    `entries`: as many entries as rows; no vectors: no rows.  Other columns are not looked at.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits per part")
    spark = vectors.sparkSession
    python_tasks(spark)
    kind = dict(vectors.dtypes)[key]
    v = F.col("v")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    rows = rows.where(finite(v)).select("id", "label", integers(v).alias("v")).where((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = rows.orderBy(F.asc_nulls_first("id"), "v").limit(1).collect()
    out = f"{key} {kind}, code string, error long, label_error long, codebooks_sha256 string"
    if not first:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("v") == len(first[0].v))
    start = rows.orderBy(F.asc_nulls_first("id"), "v").limit(entries).collect()  # `entries` rows
    books = np.array([r.v for r in start], np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2)
    blank = rows.select("id", "label", "v", F.lit(None).cast("binary").alias("code"))
    state = cut(blank.mapInArrow(_assign(books, None), _STATE), "codes")
    for _ in range(rounds):
        books = _moved(state, books)
        state = cut(state.mapInArrow(_assign(books, _reach(state, books)), _STATE), "codes")
    errors = cut(state.groupBy("label").agg(F.sum("error").alias("label_error")), "errors").withColumnRenamed("label", "of")
    return state.join(errors, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").cast(kind).alias(key), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
