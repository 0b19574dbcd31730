"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its letter n-grams, one to four letters within a word, word
ends included, hashed into a fixed table; a linear layer turns the mean into a score per
language.  Both are trained together by stochastic gradient descent, one example at a time, on
pieces of a bounded sample of labelled texts.  A fold of its own sets the temperature of the softmax and
the score below which a prediction is rejected.  Prediction reads whole texts, a stretch at a time.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_tasks

UNKNOWN = "und"
PER_LANGUAGE = 600  # texts of each language that the model is fitted and calibrated on, about
MOST_LANGUAGES = 256  # the most frequent ones; a language beyond them is not learned
PIECE_LETTERS = (8, 24, 64, 192, 512)  # lengths of the pieces of a text that are learned from
BITS, WIDTH, GRAM = 16, 16, 4
EPOCHS, RATE = 4, 0.5
ERRORS = 0.01  # share of wrong predictions among those not rejected, in the fold that calibrates
STRETCH = 1 << 20  # characters worked on at a time


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point the letter it is lowered to, 0 where it is not part of a word; and whether
    it is a letter.  Marks are parts of words.  Only the first plane is lowered."""
    import unicodedata

    low, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        if (kind := unicodedata.category(chr(i))[0]) in "LM":
            one = chr(i).lower() if i < 0x10000 else ""
            low[i], letter[i] = ord(one) if len(one) == 1 else i, kind == "L"
    return low, letter


def stretches(text: str) -> Iterator[tuple[np.ndarray, bool]]:
    """(buckets of the n-grams, whether there is a letter) of a text, a stretch at a time."""
    low, letter = _letters()
    for at in range(0, len(text), STRETCH):
        raw = np.frombuffer(text[at : at + STRETCH + GRAM - 1].encode("utf-32-le", "replace"), np.uint32)
        ends = [np.zeros(int(at == 0), np.uint32), low[raw], np.zeros(GRAM - 1 if at + STRETCH >= len(text) else 0, np.uint32)]
        yield _buckets(np.concatenate(ends)), bool(letter[raw].any())


def _buckets(codes: np.ndarray) -> np.ndarray:
    """Buckets of the n-grams that begin before the last GRAM - 1 places: letters of one word, with
    the places just before and after it as signs of its ends."""
    n = len(codes) - GRAM + 1
    word = codes != 0
    hashes, inner, out = codes[:n].copy(), np.ones(n, bool), [codes[:n][word[:n]]]
    for k in range(1, GRAM):
        hashes = hashes * np.uint32(0x01000193) + codes[k : n + k] * np.uint32(0x85EBCA6B) + np.uint32(k)
        if k > 1:
            inner &= word[k - 1 : n + k - 1]
        out.append(hashes[inner if k > 1 else word[:n] | word[1 : n + 1]])
    mixed = np.concatenate(out) * np.uint32(0x9E3779B1)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(32 - BITS)).astype(np.int32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # a row per bucket
    layer: np.ndarray | None  # what the mean row is multiplied by; None: the rows are scores already
    temperature: float = 1.0
    least: float = 0.0  # predictions of lower score are rejected

    def scores(self, mean: np.ndarray) -> np.ndarray:
        return softmax((mean if self.layer is None else mean @ self.layer) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, accepted)"""
        total, n, letters = 0.0, 0, False
        for buckets, some in stretches(text or "") if self.languages else ():
            total, n, letters = total + self.table[buckets].sum(0), n + len(buckets), letters or some
        if not letters:
            return UNKNOWN, 0.0, False
        p = self.scores(total / n)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.least)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def descend(examples: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, languages: int,
            epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(embeddings, layer) after `epochs` passes over the examples, each (buckets, shares), with a
    rate that falls to nothing.  The order of every pass is drawn from a fixed seed."""
    rnd = np.random.Generator(np.random.PCG64(3))
    embeddings = rnd.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH))
    layer = np.zeros((WIDTH, languages))
    steps, step = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rnd.permutation(len(examples)):
            buckets, shares = examples[i]
            rows = embeddings[buckets]
            mean = shares @ rows
            error = softmax(mean @ layer)
            error[marks[i]] -= 1
            now = rate * (1 - step / steps)
            embeddings[buckets] = rows - now * shares[:, None] * (layer @ error)
            layer -= now * np.outer(mean, error)
            step += 1
    return embeddings, layer


def calibrate(logits: np.ndarray, marks: np.ndarray, errors: float = ERRORS) -> tuple[float, float]:
    """(temperature, least score): the temperature of the highest likelihood, and the lowest score
    down to which at most a share `errors` of the predictions are wrong; above 1 if there is none."""
    if not len(marks):
        return 1.0, 0.0
    rows = np.arange(len(marks))

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(softmax(logits / temperature)[rows, marks], 1e-300)).mean()

    temperature = min((float(t) for t in np.geomspace(0.02, 20, 121)), key=loss)
    p = softmax(logits / temperature)
    score, wrong = p.max(1), p.argmax(1) != marks
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    last = np.append(np.diff(score[order]) != 0, True)  # equal scores are accepted together
    good = np.flatnonzero(last & (share <= errors))
    return temperature, float(score[order][good[-1]]) if len(good) else 2.0


def pieces(text: str, seed: int) -> Iterator[str]:
    """Pieces of growing length from drawn places of a text, of whole words where it has spaces."""
    rnd = random.Random(seed)
    for length in PIECE_LETTERS:
        at = rnd.randint(0, max(len(text) - length, 0))
        piece = text[at : at + length]
        words = piece.split(" ")
        inside = words[int(at > 0) : len(words) - int(at + length < len(text))]
        yield " ".join(inside) or piece


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lang, fold, seed, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for piece in pieces(text, seed):
                found = [b for b, some in stretches(piece) if some]
                if found:
                    out.append((lang, fold, seed, np.concatenate(found)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()),
             pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.list_(pa.int32()))],
            ["lang", "fold", "seed", "buckets"])


def remainder(key: Column) -> Column:
    """crc32 of the key as text, modulo 4: 2 is held out, 3 calibrates, 0 and 1 train."""
    return (F.crc32(key.cast("string").cast("binary")) % 4).cast("int")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fits on about `per_language` different texts of each of the MOST_LANGUAGES most frequent
    languages, those with the smallest hashes; none of them held out, without a key or label."""
    python_tasks(docs.sparkSession)
    seed = F.xxhash64(F.col(key), F.col(text))
    known = docs.select(F.col(lang).cast("string").alias("lang"), remainder(F.col(key)).alias("fold"), seed.alias("seed"), F.col(text).alias("text"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL AND fold <> 2")
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("seed").alias("n"))
    rates = {r.lang: per_language / r.n for r in sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    if not rates:
        return Model([], np.zeros((1, 0)), None)
    rate = F.element_at(F.create_map(*[F.lit(x) for pair in rates.items() for x in pair]), F.col("lang"))
    drawn = known.where(F.pmod("seed", F.lit(1 << 30)) < rate * float(1 << 30))
    drawn = drawn.groupBy("lang", "fold", "seed").agg(F.first("text").alias("text"))  # repeated rows: once
    got = drawn.mapInArrow(_examples, "lang string, fold int, seed long, buckets array<int>").toArrow()
    got = got.sort_by([("seed", "ascending"), ("lang", "ascending")]).combine_chunks()
    fold, given = got["fold"].to_numpy(), got["lang"].to_pylist()
    bags = []
    for buckets in got["buckets"]:
        distinct, n = np.unique(buckets.values.to_numpy(), return_counts=True)
        bags.append((distinct, n / n.sum()))
    languages = sorted({x for x, f in zip(given, fold, strict=True) if f != 3})
    if not languages:
        return Model([], np.zeros((1, 0)), None)
    place = {x: i for i, x in enumerate(languages)}
    marks = np.array([place.get(x, -1) for x in given])
    learn, check = np.flatnonzero(fold != 3), np.flatnonzero((fold == 3) & (marks >= 0))
    embeddings, layer = descend([bags[i] for i in learn], marks[learn], len(languages))
    logits = np.array([bags[i][1] @ embeddings[bags[i][0]] @ layer for i in check]).reshape(len(check), len(languages))
    temperature, least = calibrate(logits, marks[check])
    if len(languages) <= WIDTH:  # the narrower of the two is what each n-gram looks up
        return Model(languages, embeddings @ layer, None, temperature, least)
    return Model(languages, embeddings, layer, temperature, least)


def _predict(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
                ["key", "held_out", "lang_pred", "score", "accepted"])

    return predict


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """(key, held_out, lang_pred, score, accepted) per row of `docs`; options as in `train`.

    The model learns from the text and label of documents that are not held out; a prediction
    takes nothing but the text.  score is the calibrated chance of lang_pred, and accepted says
    that it isn't rejected.  Null texts and texts without a letter are `und`, score 0, rejected, and so
    are all where no language can be learned.  Rows without a key are held out; repeated rows are predicted
    each and learned from once; null labels are no language; other columns are not looked at; no
    documents: no rows.
    """
    model = train(docs, key=key, text=text, lang=lang, **options)
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(remainder(F.col(key)) == 2, F.lit(True)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(
        _predict(model), f"key {kind}, held_out boolean, lang_pred string, score double, accepted boolean"
    ).withColumnRenamed("key", key)
