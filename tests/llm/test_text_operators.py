"""Operators on texts against plain Python."""

import dataclasses
import random
import re
from collections import Counter

import numpy as np
import pytest

from phasewise.llm import decontaminate, minhash, mixing, repeats, substring_dedup, suffix_dedup, textcore

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def pairs(frame, *columns):
    return [(r["doc_id"], tuple(r[c] for c in columns)) for r in frame.collect()]


def held(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def shingle_sets(given):
    out = {}
    for i, text in given.items():
        w = WORD.findall(text.translate(LOWER))
        out[i] = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    return out


def groups(sets, percent):
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = find(a), find(b)
                least[max(p, q)] = min(p, q)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, percent):
    sets = shingle_sets(held(docs))
    group = groups(sets, percent)
    got = dict(pairs(minhash.duplicate_groups(docs, percent), "n_shingles", "component_id", "kept"))
    assert got == {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_a_large_group_of_loose_copies(spark, percent):
    """Copies around one text, of which some link only through another, and edits that many share."""
    rnd = random.Random(percent)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(500):
        words = list(base)
        for _ in range(rnd.randint(0, 9)):
            at = rnd.randrange(len(words))
            words[at] = rnd.choice(["often", f"own{i}", "seldom" if i % 9 else "two"])
        if i % 50 == 0:
            words += [f"tail{i // 100}{j}" for j in range(30)]  # two each share a longer tail
        if i % 31 == 0:
            del words[:20]
        rows.append((i, " ".join(words)))
    sets = shingle_sets(dict(rows))
    group = groups(sets, percent)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(pairs(minhash.duplicate_groups(frame, percent), "n_shingles", "component_id", "kept"))
    assert got == {i: (len(sets[i]), group[i], group[i] == i) for i in sets}
    assert 2 < len(set(group.values())) < 480


def test_one_document_of_each_group_stays(docs):
    group = groups(shingle_sets(held(docs)), 80)
    left = minhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(group.values()))


def test_near_duplicates_of_odd_rows(odd, nothing):
    got = Counter(pairs(minhash.duplicate_groups(odd), "component_id", "kept"))
    assert got[4, (4, True)] == 2 and got[None, (4, False)] == 1
    assert got[None, (None, True)] == 1 and got[5, (5, True)] == 2 and got[6, (6, True)] == 1
    assert minhash.duplicate_groups(nothing).collect() == []


def without_windows(words, repeated, length):
    gone = [False] * len(words)
    for j in range(len(words) - length + 1):
        if repeated(tuple(words[j : j + length])):
            gone[j : j + length] = [True] * length
    return gone


@pytest.mark.parametrize(("hot", "places"), [(3, 26), (2000, 26), (2000, 9)])
def test_repeated_word_windows(docs, hot, places):
    """With few places a text takes many goes, as one of more than 2^26 words does."""
    words = {i: WORD.findall(t) for i, t in held(docs).items()}
    count = Counter(tuple(w[j : j + 35]) for w in words.values() for j in range(len(w) - 34))
    expected = {}
    for i, w in words.items():
        gone = without_windows(w, lambda x: count[x] > 1, 35)
        expected[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    assert dict(pairs(substring_dedup.without_repeats(docs, hot=hot, places=places), "n_words", "n_removed", "kept")) == expected


@pytest.mark.parametrize(("hot", "places"), [(3, 26), (2000, 26), (2000, 10)])
def test_repeated_byte_windows(docs, hot, places):
    seen, expected = set(), {}
    for i, text in sorted(held(docs).items()):
        body = text.encode()
        gone = without_windows(body, lambda x: x in seen, 50)
        seen |= {tuple(body[j : j + 50]) for j in range(len(body) - 49)}
        spans = sum(g and (not j or not gone[j - 1]) for j, g in enumerate(gone))
        expected[i] = (len(body), sum(gone), spans, bytes(x for x, g in zip(body, gone, strict=True) if not g))
    got = dict(pairs(suffix_dedup.without_repeats(docs, hot=hot, places=places), "n_bytes", "n_removed", "n_spans", "kept"))
    assert {i: (*v[:3], bytes(v[3])) for i, v in got.items()} == expected


def test_anchors_do_not_depend_on_the_stretch():
    units = suffix_dedup.Units(50, 24, None, None)
    rnd = np.random.default_rng(3)
    hashes = textcore._BYTE[rnd.integers(97, 101, 5000)]
    first = np.array([0, 0, 1200, 1230, 5000])

    def windows(places):
        return [w for s, n, a in zip(*repeats.anchored_runs(dataclasses.replace(units, places=places), hashes, first), strict=True)
                for w in range(s, s + n)]

    assert windows(26) == windows(9) == windows(7) == [*range(1151), *range(1230, 4951)]


def test_repeats_in_odd_rows(odd, nothing):
    words = Counter(pairs(substring_dedup.without_repeats(odd), "n_words", "n_removed"))
    assert words == {(4, (90, 90)): 2, (None, (90, 90)): 1, (None, (0, 0)): 1, (5, (0, 0)): 2, (6, (2, 0)): 1}
    removed = Counter((i, v[1] > 0) for i, v in pairs(suffix_dedup.without_repeats(odd), "n_bytes", "n_removed"))
    assert removed == {(4, False): 2, (None, True): 1, (None, False): 1, (5, False): 2, (6, False): 1}
    assert substring_dedup.without_repeats(nothing).collect() == suffix_dedup.without_repeats(nothing).collect() == []


def test_contamination(spark, docs):
    given = held(docs)
    long = next(t for t in given.values() if len(t) > 50_000).split()
    items = [("a", " ".join(long[50:80])), ("b", "One-two"), ("c", None), ("d", ""), ("e", "zzz " * 20), ("a", "AGAIN " * 13),
             ("f", given[7 * 3 + 1]), ("f", given[7 * 3 + 1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    grams = {}
    for item, text in items:
        w = ASCII_WORD.findall((text or "").translate(LOWER))
        for j in range(max(len(w) - 12, 1) if w else 0):
            grams.setdefault(tuple(w[j : j + 13]), set()).add(item)
    expected = {}
    for i, text in given.items():
        w = ASCII_WORD.findall(text.translate(LOWER))
        hit, found = set(), set()
        for m in {len(g) for g in grams}:
            for j in range(len(w) - m + 1):
                if tuple(w[j : j + m]) in grams:
                    found |= grams[tuple(w[j : j + m])]
                    hit |= set(range(j, j + m))
        expected[i] = (len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w))
    got = dict(pairs(decontaminate.contamination(docs, bench), "n_words", "n_hit", "items", "contaminated"))
    assert got == expected
    assert sum(v[3] for v in expected.values()) > 1
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, v in expected.items() if not v[3])


def test_contamination_of_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([], "item_id string, text string")
    assert Counter(pairs(decontaminate.contamination(odd, none), "n_hit", "contaminated")) == {
        (None, (0, False)): 2, (4, (0, False)): 2, (5, (0, False)): 2, (6, (0, False)): 1}
    assert decontaminate.contamination(nothing, none).collect() == []


def test_the_mix_meets_its_targets(docs):
    size = {i: len(WORD.findall(t)) for i, t in held(docs).items()}
    rows = mixing.mix(docs).collect()
    assert {r.doc_id: r["size"] for r in rows} == size
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    target, taken = {}, Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        target[source[r.doc_id]] = r.target
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1
    assert Counter(mixing.mix(docs).collect()) == Counter(rows)


def test_mixed_documents_hold_the_words_taken(docs):
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == {i: n for i, n in taken.items() if n}


def test_the_mix_of_odd_rows(odd, nothing):
    rows = mixing.mix(odd).collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 0, 2, 90, 90, 90]
    assert mixing.mix(nothing).collect() == mixing.mixed_documents(nothing).collect() == []
    assert mixing.mixed_documents(odd).columns == odd.columns
