"""Hard negatives and vector codes against plain Python, language identification on unseen texts."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from phasewise.llm import hard_negatives, integers, language, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label string, id long, v string, block int, code string"


def vectors(n=260, d=16):
    """Ties, repeated vectors, zeros, odd rows, and a label that holds most rows."""
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(12, d)).round(1) / 4
    rows = [(i, (base[i % 12] + rnd.integers(-2, 3, d) / 128).tolist(), "a" if i % 3 else "bc"[i % 2]) for i in range(n)]
    rows += [(n + i, rows[i][1], "d") for i in range(20)]
    rows += [(1001, None, "a"), (1002, [0.0] * d, "a"), (1003, [None] * d, "a"), (1004, [math.inf] * d, "b"), (1005, [math.nan] * d, "b"),
             (1006, [], "a"), (1007, [1.0] * (d + 16), "a"), (1100, [0.0] * d, "b"), (1200, rows[0][1], None), (1300, [0.5] * d, "alone")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", 1, "clash") for r in rows], SCHEMA).repartition(3)


def usable(rows):
    return [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def mined(rows, positives=5, negatives=5):
    given = [r for r in usable(rows) if r[2] is not None and r[0] is not None]
    out = set()
    for i, a, label in given:
        if i % 20:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), j, other) for j, b, other in given if j != i and len(a) == len(b))
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(j, -m) for m, j, other in scored if other != label and 80 * -minus <= 100 * -m <= 100 * -minus]
            out |= {(i, p, rank, j, -minus, s) for rank, (j, s) in enumerate(fits[:negatives], 1)}
    return out


@pytest.mark.parametrize(("cells", "block"), [(1 << 18, 1024), (16 * 30, 4)])
def test_hard_negatives(spark, cells, block):
    rows = vectors()
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 20 == 0, cells=cells, block=block).collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == mined(rows)
    assert found


def test_hard_negatives_of_odd_tables(spark):
    rows = vectors(40)
    every = F.col("vec_id") % 20 == 0
    assert hard_negatives.hard_negatives(frame(spark, rows).where("false"), every).collect() == []
    assert hard_negatives.hard_negatives(frame(spark, rows), F.lit(None).cast("boolean")).collect() == []
    repeated = [*rows, *rows, (None, rows[0][1], "a")]
    found = hard_negatives.hard_negatives(frame(spark, repeated), every).collect()
    assert Counter(map(tuple, found)) == Counter(mined(rows))


def test_reading_stops_once_no_row_can_be_better():
    rnd = np.random.default_rng(1)
    values = rnd.integers(-20, 20, (4000, 3)).astype(np.float64)
    values[:50] *= 40
    lists = hard_negatives.Lists(np.arange(4000), values)
    anchor = np.array([3.0, -2.0, 1.0])
    reads = list(lists.reads(anchor))
    assert [t for _, t in reads] == sorted((t for _, t in reads), reverse=True)
    [best] = lists.first(anchor, [hard_negatives.EVERY], 5, np.ones(4000, bool))
    score = values @ anchor
    expected = sorted(range(4000), key=lambda i: (-score[i], i))[:5]
    assert best[:, 0].tolist() == expected
    taken = iter(reads)
    lists.reads = lambda anchor: taken
    lists.first(anchor, [hard_negatives.EVERY], 5, np.ones(4000, bool))
    assert sum(1 for _ in taken) > 0  # the rest was never read


def coded(rows, parts, entries, rounds):
    given = sorted([r for r in usable(rows)], key=lambda r: (r[0], r[1]))
    given = [r for r in given if len(r[1]) and len(r[1]) % parts == 0]
    given = [r for r in given if len(r[1]) == len(given[0][1])]
    width = len(given[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in given]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for turn in range(rounds + 1):
        found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                members = defaultdict(list)
                for c, f in zip(cut, found, strict=True):
                    members[f[p][1]].append(c[p])
                for k, xs in members.items():
                    books[p][k] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    errors = [sum(d for d, _ in f) for f in found]
    total = Counter()
    for (_, _, label), e in zip(given, errors, strict=True):
        total[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in f), e, total[label], digest)
                   for (i, _, label), f, e in zip(given, found, errors, strict=True))


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(16, 64, 2), (4, 20, 3), (2, 255, 1), (8, 3, 0)])
def test_vector_codes(spark, parts, entries, rounds):
    rows = vectors()
    found = vector_codes.compress(frame(spark, rows), parts, entries, rounds).collect()
    assert Counter(map(tuple, found)) == coded(rows, parts, entries, rounds)


def test_vector_codes_of_odd_tables(spark):
    rows = vectors(30)
    assert vector_codes.compress(frame(spark, rows).where("false")).collect() == []
    assert vector_codes.compress(frame(spark, rows).where("embedding IS NULL OR size(embedding) = 0")).collect() == []
    repeated = [*rows, *rows[:25]]
    assert Counter(map(tuple, vector_codes.compress(frame(spark, repeated)).collect())) == coded(repeated, 16, 64, 2)
    with pytest.raises(ValueError, match="two hex digits"):
        vector_codes.compress(frame(spark, rows), entries=257)


def test_stable_cores_are_not_compared():
    rnd = np.random.default_rng(2)
    entries = rnd.integers(-4000, 4000, (64, 4))
    entries[7] = entries[3]  # a tie between entries
    code = rnd.integers(0, 64, 5000)
    rows = entries[code] + rnd.integers(-60, 60, (5000, 4))
    rows[:50] = rnd.integers(-4000, 4000, (50, 4))
    radius = np.full(64, -1)
    np.maximum.at(radius, code, vector_codes.own_distance(rows, entries, code))
    got, apart, made = vector_codes.Balls(entries, radius).assign(rows, code)
    expected = vector_codes.nearest(rows, entries)
    assert (got == expected[0]).all() and (apart == expected[1]).all()
    assert made < 0.2 * rows.shape[0] * 64


def test_very_large_components_stay_exact():
    rows = np.array([[integers.MOST] * 64, [-integers.MOST] * 64])
    assert vector_codes.squared(rows, rows).tolist() == [[0, (2 * integers.MOST) ** 2 * 64], [(2 * integers.MOST) ** 2 * 64, 0]]


SYLLABLES = {"xa": "ka lo mi ré tu san", "xb": "der ung sch ein ich ver", "xc": "что это как бы не он", "xd": "の は 日 本 を た"}


def written(rnd, lang, words):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def spoken(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(900):
        lang = rnd.choice(sorted(SYLLABLES))
        rows.append((i, written(rnd, lang, rnd.randint(1, 80)), lang, "s", 1))
    rows += [(2000 + i, written(rnd, "xa", 30), None, None, None) for i in range(5)]
    rows += [(3000, None, "xa", None, None), (3001, "", "xb", None, None), (3002, "123 ... \n 4", "xc", None, None),
             (3003, written(rnd, "xc", 400_000), "xc", None, None), (None, written(rnd, "xb", 20), "xa", None, None)]
    rows += [rows[1]] * 300
    out = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    for name in ("key", "fold", "seed", "held_out", "score"):
        out = out.withColumn(name, F.lit("clash"))
    return out


def test_languages_of_unseen_texts(spark, spoken):
    found = {r.doc_id: r for r in language.identify(spoken).collect()}
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    assert found.keys() == truth.keys()
    assert language.identify(spoken).count() == spoken.count()
    from zlib import crc32

    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) for i, r in found.items() if i is not None)
    unseen = [i for i, r in found.items() if i is not None and r.held_out and i < 1000]
    assert np.mean([found[i].lang_pred == truth[i] for i in unseen]) > 0.98
    taken = [i for i in unseen if found[i].accepted]
    assert len(taken) > 0.9 * len(unseen)
    assert np.mean([found[i].lang_pred == truth[i] for i in taken]) > 0.98
    assert [found[i].lang_pred for i in (3000, 3001, 3002)] == ["und"] * 3
    assert found[3003].lang_pred == "xc" and found[2000].lang_pred == "xa"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_predictions_look_at_nothing_but_the_text(spark, spoken):
    model = language.train(spoken)
    again = language.train(spoken.withColumn("lang", F.when(language.remainder(F.col("doc_id")) == 2, "xd").otherwise(F.col("lang"))))
    assert (model.table == again.table).all() and model.least == again.least  # held-out labels do not matter
    r = spoken.where("doc_id = 5").first()
    other = language.identify(spoken.withColumn("source", F.lit("z"))).where("doc_id = 5").first()
    assert model.predict(r.text) == (other.lang_pred, other.score, other.accepted)


def test_long_texts_are_read_whole(monkeypatch):
    text = written(random.Random(1), "xb", 300)
    [(whole, _)] = list(language.stretches(text))
    monkeypatch.setattr(language, "STRETCH", 50)
    cut = np.concatenate([b for b, _ in language.stretches(text)])
    assert Counter(whole.tolist()) == Counter(cut.tolist())


def test_the_gradient_is_the_softmax_one():
    """One step from the first state, held against the written-out derivative."""
    examples = [(np.array([3, 9]), np.array([0.25, 0.75]))]
    embeddings, layer = language.descend(examples, np.array([1]), 3, epochs=1, rate=0.3)
    rnd = np.random.Generator(np.random.PCG64(3))
    start = rnd.uniform(-1 / language.WIDTH, 1 / language.WIDTH, (1 << language.BITS, language.WIDTH))
    mean = 0.25 * start[3] + 0.75 * start[9]
    assert np.allclose(layer, -0.3 * np.outer(mean, [1 / 3, -2 / 3, 1 / 3]))
    assert np.allclose(embeddings, start)  # the layer began at zero


def test_no_labels_no_language(spark, docs, odd, nothing):
    rows = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score, r.accepted) for r in rows} == {("und", 0.0, False)}
    assert len(language.identify(odd).collect()) == odd.count()
    assert language.identify(nothing).collect() == []


def test_calibration():
    logits = np.array([[4.0, 0], [3, 0], [2, 0], [0, 1]])
    temperature, least = language.calibrate(logits, np.array([0, 0, 1, 1]), errors=0.0)
    assert 3 / temperature == pytest.approx(math.log(least / (1 - least)))  # the third one is wrong
    assert language.calibrate(logits[:1], np.array([1]), errors=0.0)[1] > 1
