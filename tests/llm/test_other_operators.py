"""Token files, embeddings, the classifier, and queries that SQL can state."""

import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from phasewise.llm import embedding_dedup, quality, registry, simple8b, token_files, url_filter, warc_audit

DATA = Path("/root/testdata/sf0.01")


@pytest.mark.parametrize("values", [
    [], [0], [0] * 1000, [2**60 - 1, 2**60, 2**64 - 1, 0, 1], list(range(5000)), [1] * 239, [2**i for i in range(64)] * 9,
])
def test_simple8b_round_trip(values):
    given = np.array(values, np.uint64)
    assert simple8b.decode(simple8b.encode(given)).tolist() == values


def test_simple8b_random_round_trip():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        given = rnd.integers(0, 1 << 63, rnd.integers(1, 3000), dtype=np.uint64) >> rnd.integers(0, 64, dtype=np.uint64)
        assert (simple8b.decode(simple8b.encode(given)) == given).all()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    pytest.importorskip("public_tokenizers")
    return Tokenizer.from_file(registry.vocabulary()[0])


def test_token_files(spark, docs, odd, nothing, tokenizer):
    vocabulary = registry.vocabulary()
    texts = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    start, expected = 0, []
    for i, text in texts:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, token_files.END]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    path = token_files.new_path(spark, "tokens")
    token_files.write_tokens(docs, path, *vocabulary)
    assert sorted(map(tuple, token_files.read_tokens(spark, path, with_ids=True).collect())) == expected
    rows = token_files.through_files(odd, *vocabulary).collect()
    assert Counter(r.doc_id for r in rows) == {None: 2, 4: 2, 5: 2, 6: 1}
    assert [r.n_tokens for r in rows if r.doc_id == 5] == [1, 1]
    assert token_files.through_files(nothing, *vocabulary).collect() == []


def test_texts_are_encoded_as_the_plain_call_does(tokenizer):
    """Added tokens, odd white space, narrow and wide texts, and a memo that overflows."""
    encoder = token_files.Encoder(*registry.vocabulary())
    rnd = random.Random(4)
    texts = ["a <|endoftext|> </s>", "<|endoftext|><|endoftext|>x", "\x00\x01\u00ad \U0001f600\u200b １２", " \n\n  tab\t\xa0é", "",
             "don't 's 'll\n's  've!!'s", "\x1c\x1d \x85\xa0 ²³½ª \xad µ", "\r\n\r\n \u2028 x", "\n"]
    texts += ["".join(chr(rnd.randrange(256)) for _ in range(40)) for _ in range(300)]
    alphabet = "ab 'sé\n\t１!\u3000\u0301z\U00010348²"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(400)]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0][1] != expected[0][2] and 50256 in expected[0]
    assert [encoder.ids(t).tolist() for t in texts] == expected
    small = token_files.Encoder(*registry.vocabulary())
    small.pieces = token_files.Pieces(registry.vocabulary()[0])
    keep = token_files._MEMO_SIZE, token_files._LATER
    try:
        token_files._MEMO_SIZE, token_files._LATER = 10, 5
        assert [small.ids(t).tolist() for t in texts] == expected
    finally:
        token_files._MEMO_SIZE, token_files._LATER = keep


def test_near_duplicate_vectors(spark):
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + rnd.normal(size=16) * 0.04 * (i % 9)).tolist(), "ab"[i % 2]) for i in range(300)]
    rows += [(300, base[0].tolist(), None), (301, None, "a"), (302, [0.0] * 16, "a"), (303, [], "a"), (304, [float("nan")] * 16, "a"),
             (305, [None] * 16, "a"), (306, rows[0][1], "a"), (307, rows[0][1], "a"), (308, [1e200] * 16, "b"), (309, [2e200] * 16, "b")]
    least, links = {r[0]: r[0] for r in rows}, Counter()

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    good = [(i, np.array(v) / np.abs(v).max(), x) for i, v, x in rows
            if x and v and None not in v and np.isfinite(v).all() and np.any(v)]
    for n, (i, a, x) in enumerate(good):
        for j, b, y in good[n + 1 :]:
            if x == y and a @ b >= 0.98 * np.linalg.norm(a) * np.linalg.norm(b):
                links.update((i, j))
                p, q = find(i), find(j)
                least[max(p, q)] = min(p, q)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()}
    assert got == {i: (links[i], find(i), find(i) == i) for i, *_ in rows}
    assert embedding_dedup.near_duplicates(frame.where("false")).collect() == []


def labelled(spark, n=1500):
    """Clean texts, toxic ones with insults, and low-quality ones that repeat one word."""
    rnd = random.Random(2)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(n):
        kind = rnd.choice(["clean"] * 6 + ["toxic", "low"])
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 60))]
        if kind == "toxic":
            text[5:9] = [rnd.choice(["idiot", "moron", "scum", "trash"]) for _ in range(4)]
        if kind == "low":
            text = [text[0].title()] * 40 + ["!!!"] * 9
        rows.append((i, " ".join(text), "en", f"s{i % 3}", len(" ".join(text))))
        labels.append((i, int(kind != "low"), int(kind == "toxic")))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_co_training_on_unseen_documents(spark):
    docs, labels = labelled(spark)
    rows = quality.classify(docs, labels.where("doc_id % 2 = 0")).collect()
    truth = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.collect()}
    unseen = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id % 2]
    assert len(rows) == len(truth)
    assert np.mean([k for k, t in unseen if t]) > 0.99
    assert np.mean([not k for k, t in unseen if not t]) > 0.97
    left = quality.without_rejected(docs, labels.where("doc_id % 2 = 0"))
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in rows if r.kept}


def test_the_classifier_takes_odd_rows(spark, odd, docs, nothing):
    train, labels = labelled(spark, 400)
    both = train.unionByName(odd)
    rows = quality.classify(both, labels).collect()
    assert len(rows) == 407
    assert all(0 <= r.score <= 1 for r in rows)
    model = quality.classify(docs, labels.where("false")).collect()
    assert {(r.score, r.kept) for r in model} == {(1.0, True)}
    assert quality.classify(nothing, labels).collect() == []


def test_the_classifier_is_fitted_in_a_task(spark, monkeypatch):
    def in_the_driver(*_, **__):
        raise AssertionError("fitted in the driver")

    monkeypatch.setattr(quality, "co_train", in_the_driver)  # workers import their own
    train, labels = labelled(spark, 400)
    assert len(quality.train(train, labels).heads) == 2


def test_audit_of_odd_records(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (1, "http://a/", "x"), (None, None, None), (70, "http://b/", ""), (9, "u", None)],
                                  "page_id long, url string, html string")
    other = pages.where("page_id IS NULL OR page_id <> 9").union(spark.createDataFrame([(2, "n", "n")], pages.schema))
    got = Counter((r.id, r.status) for r in warc_audit.audit(warc_audit.records(pages), warc_audit.records(other)).collect())
    assert got == {(1, "intact"): 2, (-1, "intact"): 1, (70, "intact"): 1, (9, "missing"): 1, (2, "added"): 1}
    none = warc_audit.records(pages.where("false"))
    assert warc_audit.audit(none, none).collect() == []


def test_the_url_filter_has_no_false_positives(spark):
    rows = [(i, f"http://h{i % 400}.net/p{i % 7}") for i in range(3000)] + [(-1, None), (-2, "no scheme"), (-3, "x://"), (-4, "http://A.com/fr/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = url_filter.crawled_twice(pages.where("page_id % 5 = 0"))
    names = {r.canonical for r in listed.collect()}
    for r in url_filter.judge(pages, listed).collect():
        assert (r.verdict == "block") == (r.page_id >= 0 and r.host + r.path in names)
        assert r.page_id >= 0 or (r.host, r.rule) == (("a.com", "com/fr/") if r.page_id == -4 else ("", None))
    assert url_filter.judge(pages.where("false"), listed).collect() == []
    assert {r.verdict for r in url_filter.judge(pages, listed.where("false")).collect()} == {"allow"}


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    frame = registry.QUERIES[name](spark, str(DATA))
    columns = sorted(frame.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.SQL[name]})").fetchall()
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(expected)
    assert expected
