"""Quality classifier by co-training.

Two views of a document: its words, and its metadata (source, language, length, and layout figures
such as shares of capitals, symbols or distinct words).  A classifier of each view labels the
unlabelled documents it is surest of for the other one, round after round; both are then
calibrated on held-out labels and combined.  Training takes bounded samples; scoring takes all
documents.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_tasks
from .textcore import LOWER_ASCII, byte_sums, chunks, span_hashes, words

MOST_LABELLED = 12_000  # labelled rows that the views are fitted and calibrated on
MOST_POOL = 4000  # unlabelled rows that may get pseudo-labels
ROUNDS = 2
EXCHANGED = 0.05  # share of the pool that a view labels for the other one, per round and class
SURE = 0.95
WORD_BITS = 18
_QUANTILES = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98)

IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = IS_LETTER[65:91] = IS_LETTER[128:] = True
_FIGURES = ["n_chars", "bytes", "words", "word_bytes", "distinct", "capitals", "digits", "symbols", "symbol_runs", "lines", "spaces"]


def features(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word buckets, first bucket of each row, figures, categories) of the columns
    id, text, source, lang, n_chars.  Nulls are a category of their own, a null length is -1."""
    length = batch.column(4).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.float64)
    names = [np.array([hash_of(k, v) for v in batch.column(c).to_pylist()], np.int64) for k, c in ((0, 2), (1, 3))]
    for row, data, ends in chunks(batch.column(1)):
        n = len(ends) - 1
        low = LOWER_ASCII[data]
        letter = IS_LETTER[low]
        begin, end, first = words(low, ends, letter)
        of = np.repeat(np.arange(n), np.diff(first))
        bucket = (span_hashes(byte_sums(low), begin, end) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        both = np.unique(of << WORD_BITS | bucket)
        owner, bucket = both >> WORD_BITS, both & ((1 << WORD_BITS) - 1)

        def count(flags: np.ndarray, ends: np.ndarray = ends) -> np.ndarray:
            sums = np.append(0, np.cumsum(flags))
            return sums[ends[1:]] - sums[ends[:-1]]

        size, number = np.diff(ends), np.diff(first)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        digit = (data >= 48) & (data <= 57)
        symbol = ~(letter | digit | space)
        twice = symbol[1:] & symbol[:-1]
        a_letter = np.maximum(count(letter), 1)
        figures = np.stack([
            length[row : row + n], size, number, count(letter) / np.maximum(number, 1),
            np.diff(np.searchsorted(owner, np.arange(n + 1))) / np.maximum(number, 1),
            count((data >= 65) & (data <= 90)) / a_letter, count(digit) / np.maximum(size, 1),
            count(symbol) / np.maximum(number, 1), count(np.append(twice, False)) / np.maximum(number, 1),
            count(data == 10) / np.maximum(number, 1), count(space) / np.maximum(number, 1),
        ], axis=1)
        yield row, bucket, np.searchsorted(owner, np.arange(n + 1)), figures, np.stack([x[row : row + n] for x in names], 1)


_CATEGORIES = 64


def hash_of(kind: int, value: str | None) -> int:
    """A category's column; null has its own."""
    from zlib import crc32

    return kind * _CATEGORIES + (0 if value is None else 1 + crc32(str(value).encode()) % (_CATEGORIES - 1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class View:
    """A logistic regression over rows of active columns."""

    weights: np.ndarray
    bias: float = 0.0

    def margins(self, columns: np.ndarray, first: np.ndarray) -> np.ndarray:
        sums = np.append(0.0, np.cumsum(self.weights[columns]))
        return sums[first[1:]] - sums[first[:-1]] + self.bias


def _rows(columns: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = first[rows + 1] - first[rows]
    ends = np.append(0, np.cumsum(n))
    return columns[np.repeat(first[rows], n) + np.arange(ends[-1]) - np.repeat(ends[:-1], n)], ends


def fit(columns: np.ndarray, first: np.ndarray, bad: np.ndarray, width: int, least: int = 3, decay: float = 1e-3, steps: int = 100) -> View:
    """Logistic regression with balanced classes on columns scaled by the logarithm of how much
    likelier bad rows have them, so that telling columns are punished less than common ones.
    Accelerated gradient steps with a diagonal scale; columns of fewer than `least` rows stay 0."""
    n = len(bad)
    owner = np.repeat(np.arange(n), np.diff(first))
    used = np.flatnonzero(np.bincount(columns, minlength=width) >= least)
    place = np.full(width, -1)
    place[used] = np.arange(len(used))
    some = place[columns] >= 0
    at, owner = place[columns[some]], owner[some]
    importance = np.where(bad, 0.5 / max(bad.sum(), 1), 0.5 / max((~bad).sum(), 1))
    with_bad, with_good = (np.bincount(at[mask[owner]], minlength=len(used)) for mask in (bad, ~bad))
    ratio = np.log((with_bad + 0.5) / (bad.sum() + 1)) - np.log((with_good + 0.5) / ((~bad).sum() + 1))
    share = ratio**2 * np.bincount(at, importance[owner], len(used))
    spread = np.bincount(owner, np.abs(ratio)[at], n)  # bounds the curvature along each column
    reach = np.bincount(at, (importance * spread)[owner], len(used)) * np.abs(ratio)
    scale = 1 / (0.25 * np.maximum(reach, share) + decay)
    w, before, bias, bias_before = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(steps):
        push = step / (step + 3)
        look, look_bias = w + push * (w - before), bias + push * (bias - bias_before)
        error = (_sigmoid(np.bincount(owner, (look * ratio)[at], n) + look_bias) - bad) * importance
        before, bias_before = w, bias
        w = look - scale * (ratio * np.bincount(at, error[owner], len(used)) + decay * look)
        bias = look_bias - 0.5 * error.sum()
    weights = np.zeros(width)
    weights[used] = w * ratio
    return View(weights, float(bias))


def _platt(margins: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """(intercept, slopes): logistic calibration of one or more margins, by Newton steps."""
    x = np.column_stack([np.ones(len(bad)), margins])
    target = np.where(bad, (bad.sum() + 1) / (bad.sum() + 2), 1 / ((~bad).sum() + 2))
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (target - p) - 1e-2 * w)
    return w


@dataclass
class Head:
    """Both views of one fault (low quality, toxic) and their calibrated combination."""

    text: View
    page: View
    singles: list[np.ndarray]  # calibration of each view alone
    both: np.ndarray  # of the two calibrated log-odds together

    def chance(self, margins: list[np.ndarray]) -> np.ndarray:
        calibrated = [c[0] + c[1] * m for c, m in zip(self.singles, margins, strict=True)]
        return _sigmoid(self.both[0] + self.both[1] * calibrated[0] + self.both[2] * calibrated[1])


@dataclass
class Model:
    cuts: np.ndarray
    heads: list[Head]
    threshold: float = 0.5


def page_columns(figures: np.ndarray, categories: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Active columns of the metadata view: one bin per figure, one column per category."""
    bins = np.stack([np.searchsorted(cuts[k], figures[:, k], "right") + k * (len(_QUANTILES) + 1) for k in range(len(_FIGURES))], 1)
    columns = np.concatenate([bins, categories + len(_FIGURES) * (len(_QUANTILES) + 1)], 1)
    return columns.ravel(), np.arange(len(figures) + 1) * columns.shape[1]


_PAGE_WIDTH = len(_FIGURES) * (len(_QUANTILES) + 1) + 2 * _CATEGORIES


def co_train(views: list[tuple], widths: list[int], bad: np.ndarray, held: np.ndarray, rounds: int = ROUNDS) -> Head | None:
    """`bad`: 1, 0, or -1 for unlabelled rows.  `held` rows calibrate and are never trained on.
    None if a class is missing on either side."""
    train, check = np.flatnonzero((bad >= 0) & ~held), np.flatnonzero((bad >= 0) & held)
    if min(len(np.unique(bad[train])), len(np.unique(bad[check]))) < 2:
        return None
    own = [(train, bad[train] == 1)] * 2
    pool = np.flatnonzero(bad < 0)
    truth = bad[check] == 1
    for turn in range(rounds + 1):
        fitted = [fit(*_rows(*v, rows), marks, w) for v, w, (rows, marks) in zip(views, widths, own, strict=True)]
        margins = [f.margins(*_rows(*v, check)) for f, v in zip(fitted, views, strict=True)]
        singles = [_platt(m, truth) for m in margins]
        if turn == rounds or not len(pool):
            break
        given = []
        for f, v, c in zip(fitted, views, singles, strict=True):
            p = _sigmoid(c[0] + c[1] * f.margins(*_rows(*v, pool)))
            order, k = np.argsort(p, kind="stable"), max(1, int(EXCHANGED * len(pool)))
            clean = order[:k][p[order[:k]] < 1 - SURE]
            dirty = order[-k:][p[order[-k:]] > SURE]
            given.append((np.concatenate([pool[clean], pool[dirty]]), np.repeat([False, True], [len(clean), len(dirty)])))
        own = [(np.concatenate([rows, g[0]]), np.concatenate([marks, g[1]])) for (rows, marks), g in zip(own, given[::-1], strict=True)]
        pool = np.setdiff1d(pool, np.concatenate([given[0][0], given[1][0]]))
    both = _platt(np.column_stack([c[0] + c[1] * m for c, m in zip(singles, margins, strict=True)]), truth)
    return Head(*fitted, singles, both)


_ARROW = "id long, low int, toxic int, held boolean, buckets array<int>, figures array<double>, categories array<int>"


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, bucket, first, figures, categories in features(batch):
            n = len(figures)

            def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
                return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), *[batch.column(c).slice(row, n) for c in (5, 6, 7)],
                 lists(bucket, first, pa.int32()), lists(figures.ravel(), np.arange(n + 1) * figures.shape[1], pa.float64()),
                 lists(categories.ravel(), np.arange(n + 1) * 2, pa.int32())],
                ["id", "low", "toxic", "held", "buckets", "figures", "categories"])


def _fit_rows(got: pa.Table, rounds: int) -> Model | None:
    """The model of rows that `_extract` made."""
    got = got.sort_by([("id", "ascending")]).combine_chunks()
    buckets = got["buckets"].combine_chunks()
    first = np.append(0, np.cumsum(np.diff(buckets.offsets.to_numpy())))
    figures = got["figures"].combine_chunks().flatten().to_numpy().reshape(len(got), -1)
    categories = got["categories"].combine_chunks().flatten().to_numpy().astype(np.int64).reshape(len(got), -1)
    cuts = np.quantile(figures, _QUANTILES, axis=0).T
    views = [(buckets.flatten().to_numpy().astype(np.int64), first), page_columns(figures, categories, cuts)]
    held = got["held"].to_numpy()
    heads = [co_train(views, [1 << WORD_BITS, _PAGE_WIDTH], got[fault].to_numpy(), held, rounds) for fault in ("low", "toxic")]
    heads = [h for h in heads if h]
    return Model(cuts, heads) if heads else None


def _fitted(rounds: int):
    """One task fits, so that neither the sample nor what fitting takes stays in the driver."""

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        model = _fit_rows(pa.Table.from_batches(got), rounds) if sum(map(len, got)) else None
        if model:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    return fitted


def train(docs: DataFrame, labels: DataFrame, labelled: int = MOST_LABELLED, pool: int = MOST_POOL, rounds: int = ROUNDS) -> Model | None:
    """Fits on at most `labelled` labelled and `pool` unlabelled documents, those with the
    smallest hashes of their ids; a third of the labelled ones is held out.  Several labels of a
    document: the worst counts; a null label is none.  None if no fault can be learned."""
    python_tasks(docs.sparkSession)
    marks = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 0).cast("int")), F.lit(-1)).alias("low"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(-1)).alias("toxic"))
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    order = F.xxhash64("doc_id", F.lit("sample"))
    chosen = ids.join(marks, "doc_id").withColumn("order", order).orderBy("order").limit(labelled).select(
        "doc_id", "low", "toxic", (F.pmod("order", F.lit(3)) == 0).alias("held"))
    free = ids.join(marks, "doc_id", "left_anti").orderBy(order).limit(pool).select(
        "doc_id", F.lit(-1).alias("low"), F.lit(-1).alias("toxic"), F.lit(False).alias("held"))
    sample = F.broadcast(chosen.unionByName(free))  # at most labelled + pool rows
    columns = ["doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "low", "toxic", "held"]
    rows = docs.join(sample, "doc_id").select(*columns).mapInArrow(_extract, _ARROW)
    fitted = rows.repartition(1).mapInArrow(_fitted(rounds), "model binary").first()  # a bounded sample
    return pickle.loads(fitted["model"]) if fitted else None


def _chances(model: Model, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(score, kept) of the rows of a batch with the columns that `features` takes."""
    clean, kept = np.ones(len(batch)), np.ones(len(batch), bool)
    for row, bucket, first, figures, categories in features(batch):
        some, page = slice(row, row + len(figures)), page_columns(figures, categories, model.cuts)
        for head in model.heads:
            p = head.chance([head.text.margins(bucket, first), head.page.margins(*page)])
            clean[some] *= 1 - p
            kept[some] &= p < model.threshold
    return clean, kept


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, kept = _chances(model, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(5), pa.array(clean), pa.array(kept)], ["doc_id", "content", "score", "kept"])

    return score


def _keep(model: Model, places: list[int]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in places]
            columns[4] = columns[4].cast(pa.int64())
            _, kept = _chances(model, pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "source", "lang", "n_chars"]))
            yield batch.filter(pa.array(kept))

    return keep


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, content, score, kept) per row of `docs`; options as in `train`.

    score is the product of the calibrated chances that the document is not of low quality and not
    toxic; kept: both are above one half.  Null and empty texts, sources, languages and lengths are values of
    their own; repeated rows get equal scores.  Without enough labels of both kinds every
    document is kept with score 1.  content is the xxhash64 of the text; no documents: no rows.
    """
    model = train(docs, labels, **options)
    columns = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), F.xxhash64("text").alias("content"))
    if model is None:
        return columns.select("doc_id", "content", F.lit(1.0).alias("score"), F.lit(True).alias("kept"))
    kind = dict(docs.dtypes)["doc_id"]
    return columns.mapInArrow(_score(model), f"doc_id {kind}, content long, score double, kept boolean")


def without_rejected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """`docs`, all columns, without the documents that `classify` rejects.  Nothing is shuffled."""
    model = train(docs, labels, **options)
    if model is None:
        return docs
    places = [docs.columns.index(c) for c in ("doc_id", "text", "source", "lang", "n_chars")]
    return docs.mapInArrow(_keep(model, places), docs.schema)
