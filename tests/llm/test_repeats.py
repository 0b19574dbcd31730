"""What a task of the substring operators holds at a time."""

import string
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from phasewise.llm import repeats, substring_dedup, suffix_dedup


@pytest.fixture
def sent_bytes(tmp_path, monkeypatch):
    """Runs an operator; gives its rows and the bytes that came to the buckets of windows."""
    find_equal, calls = repeats._find_equal, iter(range(9))

    def run(build):
        folder = tmp_path / str(next(calls))
        folder.mkdir()
        place = str(folder)

        def noting(*args):
            find = find_equal(*args)

            def noted(key, sent):
                with open(f"{place}/{key[0]}", "w") as file:
                    file.write(str(sent.nbytes))
                return find(key, sent)

            return noted

        monkeypatch.setattr(repeats, "_find_equal", noting)
        rows = build().collect()
        return rows, sum(int(f.read_text()) for f in folder.iterdir())

    return run


def periodic(spark, line, times):
    rows = [(i, line, c) for i, c in enumerate(string.ascii_uppercase + "0123456789!#$%")]
    frame = spark.createDataFrame(rows, "doc_id long, line string, tail string")
    return frame.select("doc_id", F.concat(F.repeat("line", times), "tail").alias("text"))


def test_places_of_a_common_byte_window_stay_in_their_part(spark, sent_bytes):
    line = "".join(np.random.default_rng(1).choice(list(string.ascii_lowercase), 60))
    few, few_bytes = sent_bytes(lambda: suffix_dedup.without_repeats(periodic(spark, line, 50), hot=20))
    many, many_bytes = sent_bytes(lambda: suffix_dedup.without_repeats(periodic(spark, line, 400), hot=20))
    assert {r.doc_id: r.n_removed for r in few} == {i: 3000 * (i > 0) for i in range(40)}
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in many} == {i: (24_000 * (i > 0), int(i > 0)) for i in range(40)}
    assert many_bytes < 1.2 * few_bytes


def test_places_of_a_common_word_window_stay_in_their_part(spark, sent_bytes):
    rnd = np.random.default_rng(2)
    line = "".join("".join(rnd.choice(list(string.ascii_lowercase), 5)) + " " for _ in range(40))
    few, few_bytes = sent_bytes(lambda: substring_dedup.without_repeats(periodic(spark, line, 20), hot=5))
    many, many_bytes = sent_bytes(lambda: substring_dedup.without_repeats(periodic(spark, line, 160), hot=5))
    assert {r.n_removed for r in few} == {800} and {r.n_removed for r in many} == {6400}
    assert many_bytes < 1.2 * few_bytes


def test_common_windows_with_null_and_repeated_keys(spark):
    """Rows of one key remove nothing from each other; a null key counts as the largest."""
    line = "".join(np.random.default_rng(3).choice(list(string.ascii_lowercase), 60))
    keys = [None, 7, 7, 5, 5, None, -(1 << 63)]
    docs = spark.createDataFrame([(k, line * 9 + c) for k, c in zip(keys, "ABCDEFG", strict=True)], "doc_id long, text string")
    gone = suffix_dedup.without_repeats(docs, hot=3).select("doc_id", "n_removed", F.expr("right(kept, 1)").cast("string").alias("tail"))
    assert {(r.doc_id, r.tail): r.n_removed for r in gone.collect()} == {
        (k, c): 0 if k == -(1 << 63) else 540 for k, c in zip(keys, "ABCDEFG", strict=True)}
    without = suffix_dedup.without_repeats(docs.where("doc_id > 0 or doc_id is null"), hot=3)
    assert {(r.doc_id, r.n_removed) for r in without.collect()} == {(5, 0), (7, 540), (None, 540)}
    words = substring_dedup.without_repeats(docs.withColumn("text", F.regexp_replace("text", "(?<=[a-j])", " ")), hot=3)
    assert all(r.n_removed > 0 for r in words.collect())


def peak(work):
    work()  # tables that are kept
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_grouping_of_windows_takes_little_memory():
    rnd = np.random.default_rng(4)
    text = rnd.integers(97, 101, 60 * 40_000, dtype=np.uint8).tobytes()
    body, n = text * 2, np.full(80_000, 11)
    offsets = np.arange(80_001) * 60
    group = suffix_dedup._radix_groups(50)(body, offsets, n)
    assert np.array_equal(group[:440_000], group[440_000:]) and len(np.unique(group)) == 440_000
    assert peak(lambda: suffix_dedup._radix_groups(50)(body, offsets, n)) < 80 * len(group)


@pytest.mark.parametrize("slice_", [1, 100, 1 << 18])
@pytest.mark.parametrize("depth", [3, 8, 9, 20])
def test_grouping_in_slices(slice_, depth):
    text = np.random.default_rng(5).integers(97, 99, 900, dtype=np.uint8).tobytes()
    offsets, n = np.array([0, 300, 600, 900]), np.full(3, 301 - depth)
    windows = [text[low + i : low + i + depth] for low in (0, 300, 600) for i in range(301 - depth)]
    group = suffix_dedup._radix_groups(depth, slice_)(text, offsets, n).tolist()
    assert len(set(zip(windows, group, strict=True))) == len(set(windows)) == len(set(group))


def test_a_part_is_worked_on_in_small_pieces():
    rnd = np.random.default_rng(6)
    texts = [bytes(x).decode() for x in rnd.integers(97, 123, (1000, 3000), dtype=np.uint8)]
    units = suffix_dedup.Units(50, 24, suffix_dedup._read, suffix_dedup._radix_groups(50), suffix_dedup.PART_BYTES)
    number = np.arange(1000)
    table = pa.table({"part": pa.array(number * 0, pa.int32()), "id": number, "uid": number, "text": texts})
    notes = pa.table({"part": pa.array(number * 0, pa.int32()), "kind": pa.array(number * 0, pa.int32()), "uid": number, "id": number,
                      "n": number * 0 + 1, "body": pa.array([None] * 1000, pa.binary())})
    send = repeats._send_anchors(units, 64)
    apply = repeats._apply(units, suffix_dedup._RESULT, suffix_dedup._finish, True)
    assert apply((pa.scalar(0),), table, notes)["n_removed"].to_pylist() == [0] * 1000
    assert peak(lambda: send((pa.scalar(0),), table, notes)) < 20 * 3_000_000
    assert peak(lambda: apply((pa.scalar(0),), table, notes)) < 10 * 3_000_000
