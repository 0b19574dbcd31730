"""Windows that occur more than once in a corpus: what the substring operators share.

A window is LENGTH neighbouring units (bytes, words) of one text.  Its anchor is the smallest
hash among the grams of GRAM units inside it; equal windows have equal anchors at equal places,
and neighbouring windows mostly share theirs.  The passes:

1. every part (a hash class of rows) sends its distinct anchors, coded as sorted differences, to
   ranges of anchor values; each range tells a part which of them other parts hold as well;
2. only runs of windows with such an anchor travel, as one packed string, to the bucket of the
   anchor, where equal windows are found exactly;
3. the marks return to the parts, and the texts are cut.

All three passes read the same exchange of the texts.  Equal texts count once, by a group-by of
their 128-bit hashes.  Windows of an anchor with more than HOT occurrences travel singly to
the bucket of their own hash, and only once from each part: with the smallest id and the number
of their places, which stay in the part.  The verdict on each comes back once as well, and the part
finds the places again by the window's 64-bit hash.  So a bucket grows with the parts and not with
the occurrences of an anchor or a window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, python_tasks
from .textcore import chunks, mixed, powers, prefix_sums, runs

PART_BYTES = 8 << 20  # of text in a part, where a unit has several bytes
LEAST_PARTS = 64
PARTS_A_RANGE = 4  # of anchors, which take about 9 bytes each
CHUNK = 1 << 18  # bytes worked on at a time: a dozen arrays of eight bytes for each
STRETCH = 1 << 18  # units of a longer text worked on at a time
HOT = 2000
_NO_ID = np.iinfo(np.int64).max  # a null id counts as the largest


@dataclass(frozen=True)
class Units:
    """How texts are cut: `read` gives (hash of each unit, first unit of each row, packed bytes,
    begin and end of each unit in them) of neighbouring rows."""

    length: int
    gram: int
    read: Callable
    equal: Callable  # (packed bytes, entry offsets, windows per entry) -> group of each window
    part_bytes: int = PART_BYTES
    places: int = 26  # bits of a place among the grams worked on at a time; longer texts take several goes


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i : i + width], by doubling."""
    n, have, out = len(values) - width + 1, 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have :][:n])


def _window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Of every `width` neighbouring units, equal for equal ones wherever they stand."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(hashes)
    spans = sums[width:] - sums[: len(sums) - width]
    spans *= powers(len(sums))[1][: len(spans)]
    return mixed(spans)


def anchored_runs(units: Units, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, 48-bit anchor) of the runs that share an anchor."""
    stretch = min((1 << units.places) - units.length, STRETCH)
    found = [_runs_from(units, hashes, first, low, low + stretch) for low in range(0, max(len(hashes), 1), stretch)]
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _runs_from(units: Units, hashes: np.ndarray, first: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of the windows that start in [low, high).  An anchor depends on its window alone, so
    where a stretch ends only cuts a run in two."""
    length, gram, mask = units.length, units.gram, np.uint64((1 << units.places) - 1)
    hashes = hashes[low : high + length - 1]
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64)
    grams = _window_hashes(hashes, gram)
    place = _sliding_min((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    place &= mask
    stop = np.repeat(first[1:], np.diff(np.clip(first, low, low + n)))  # of each unit's row
    whole = np.flatnonzero(np.arange(low + length, low + n + 1) <= stop[: n - length + 1])
    if not len(whole):
        return none, none, none.astype(np.uint64)
    place = place[whole].astype(np.int64)
    new = np.ones(len(whole), bool)
    new[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1] + 1)
    begin = np.flatnonzero(new)
    return whole[begin] + low, np.diff(np.append(begin, len(whole))), mixed(grams[place[begin]]) >> np.uint64(16)


def _planes(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, which the shuffle compresses."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[:7].tobytes()


def _numbers(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(7, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :7] = planes.T
    return np.cumsum(full.reshape(-1).view("<u8"), dtype=np.uint64)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _classes(notes: pa.Table) -> dict[int, tuple[int, int]]:
    """Class of equal texts -> (smallest id, rows), of the classes whose first row is in this part."""
    rows = notes.filter(pc.equal(notes["kind"], 0))
    return dict(zip(rows["uid"].to_pylist(), zip(rows["id"].to_pylist(), rows["n"].to_pylist(), strict=True), strict=True))


def _bodies(notes: pa.Table, kind: int) -> np.ndarray:
    found = [_numbers(b) for b in notes.filter(pc.equal(notes["kind"], kind))["body"].to_pylist()]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _first_rows(texts: pa.Table, notes: pa.Table) -> pa.Table:
    """One row of each class that starts in this part."""
    least, rows, seen = _classes(notes), [], set()
    for i, (uid, key) in enumerate(zip(texts["uid"].to_pylist(), texts["id"].to_pylist(), strict=True)):
        if uid not in seen and uid in least and least[uid][0] == key:
            seen.add(uid)
            rows.append(i)
    return texts.take(pa.array(rows, pa.int64()))


def _send_anchors(units: Units, ranges: int):
    schema = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("body", pa.binary()), ("counts", pa.binary())])

    def send(key: tuple[pa.Scalar, ...], texts: pa.Table, notes: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for _, data, ends in chunks(_first_rows(texts, notes)["text"], CHUNK):
            hashes, first, *_ = units.read(data, ends)
            found.append(anchored_runs(units, hashes, first)[2])
        values, counts = np.unique(np.concatenate(found), return_counts=True)
        part = key[0].as_py()
        edge = np.searchsorted(values, [(i << 48) // ranges for i in range(ranges + 1)])
        rows = [(i, part, _planes(values[a:b]), np.minimum(counts[a:b], 65535).astype("<u2").tobytes())
                for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if a < b]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, schema.types, strict=True)], schema=schema)

    return send


_NOTE = "part int, kind int, uid long, id long, n long, body binary"
_NOTES = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("uid", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("body", pa.binary())])


def _note_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    parts, kinds, bodies = zip(*rows, strict=True) if rows else ((), (), ())
    zero = pa.array(np.zeros(len(rows), np.int64))
    return pa.Table.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(kinds, pa.int32()), zero, zero, zero, pa.array(bodies, pa.binary())], schema=_NOTES)


def _compare_anchors(most: int):
    """To each part: its anchors that other parts hold as well (kind 1), and hot ones (kind 2)."""

    def compare(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        values = [_numbers(b) for b in sent["body"].to_pylist()]
        counts = [np.frombuffer(b, "<u2") for b in sent["counts"].to_pylist()]
        every, where, parts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        total = np.bincount(where, np.concatenate(counts))
        shared, hot = every[parts > 1], every[total > most]
        rows = []
        for part, mine in zip(sent["part"].to_pylist(), values, strict=True):
            for kind, table in ((1, shared), (2, hot)):
                some = mine[_among(mine, table)]
                if len(some):
                    rows.append((part, kind, _planes(some)))
        return _note_table(rows)

    return compare


_SENT = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("runs", pa.binary()), ("body", pa.binary()),
                   ("single", pa.binary()), ("single_body", pa.binary())])
_SENT_DDL = "bucket int, part int, runs binary, body binary, single binary, single_body binary"
_RUN = np.dtype([("id", "<i8"), ("text", "<i4"), ("start", "<i4"), ("n", "<i4"), ("size", "<i4")])  # size: of the packed bytes
_SINGLE = np.dtype([("own", "<u8"), ("id", "<i8"), ("n", "<i4"), ("size", "<i4")])  # own: hash; id: the smallest; n: places
_MARK = np.dtype([("text", "<i4"), ("start", "<i4"), ("n", "<i4")])
_VERDICT = np.dtype([("own", "<u8"), ("id", "<i8")])


def _rank(classes: np.ndarray, uids: np.ndarray) -> np.ndarray:
    """The number of each text in its part, which does not depend on the order of the rows."""
    return np.searchsorted(np.unique(classes), uids)


def _records(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.zeros(len(next(iter(columns.values()))), kind)
    for name, values in columns.items():
        out[name] = values
    return out


def _counted(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n[0]-1, 0, 1, .. n[1]-1, and so on."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _bounds(sorted_values: np.ndarray) -> tuple[list[int], list[int]]:
    if not len(sorted_values):
        return [], []
    edge = np.flatnonzero(np.diff(sorted_values)) + 1
    return [0, *edge.tolist()], [*edge.tolist(), len(sorted_values)]


def _distinct(single: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One record of each window, with the smallest id and all places; where its bytes begin."""
    order = np.lexsort((single["id"], single["own"]))
    single, low = single[order], low[order]
    new = np.ones(len(single), bool)
    new[1:] = single["own"][1:] != single["own"][:-1]
    begin = np.flatnonzero(new)
    out = single[begin]
    if len(out):
        out["n"] = np.minimum(np.add.reduceat(single["n"].astype(np.int64), begin), 1 << 30)
    return out, low[begin]


def _by_bucket(packed: memoryview, records: np.ndarray, low: np.ndarray, bucket: np.ndarray) -> dict[int, tuple[bytes, bytes]]:
    """Bucket -> (its records, their bytes joined)."""
    order = np.argsort(bucket, kind="stable")
    records, low, bucket = records[order], low[order], bucket[order]
    high, out = low + records["size"], {}
    for a, b in zip(*_bounds(bucket), strict=True):
        body = b"".join([packed[i:j] for i, j in zip(low[a:b].tolist(), high[a:b].tolist(), strict=True)])
        out[int(bucket[a])] = records[a:b].tobytes(), body
    return out


def _send_windows(units: Units, buckets: int):
    def send(key: tuple[pa.Scalar, ...], texts: pa.Table, notes: pa.Table) -> pa.Table:
        active = _first_rows(texts, notes)
        shared, hot = _bodies(notes, 1), _bodies(notes, 2)
        uids = active["uid"].to_numpy()
        rank, ids = _rank(uids, uids), active["id"].fill_null(_NO_ID).to_numpy()
        read, seen, base = [], [np.zeros(0, np.uint64)], 0
        single, single_low = [np.zeros(0, _SINGLE)], [np.zeros(0, np.int64)]
        for row, data, ends in chunks(active["text"], CHUNK):
            hashes, first, packed, begin, end = units.read(data, ends)
            start, n, anchor = anchored_runs(units, hashes, first)
            common = _among(anchor, hot)
            if common.any():
                each = np.repeat(start[common], n[common]) + _counted(n[common])
                records = _records(
                    _SINGLE, own=_window_hashes(hashes, units.length)[each], n=np.ones(len(each)),
                    id=ids[row + np.searchsorted(first, each, "right") - 1], size=end[each + units.length - 1] - begin[each])
                records, low = _distinct(records, begin[each])
                single.append(records)
                single_low.append(low + base)
            start, n, anchor = start[~common], n[~common], anchor[~common]
            read.append((row, first, packed, begin, end, start, n, anchor))
            seen.append(anchor)
            base += len(packed)
        values, counts = np.unique(np.concatenate(seen), return_counts=True)
        live = np.union1d(values[counts > 1], shared)
        run, run_low, bucket, base = [np.zeros(0, _RUN)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
        for row, first, packed, begin, end, start, n, anchor in read:
            some = _among(anchor, live)
            start, n = start[some], n[some]
            doc, low = np.searchsorted(first, start, "right") - 1, begin[start]
            run.append(_records(_RUN, id=ids[row + doc], text=rank[row + doc], start=start - first[doc], n=n,
                                size=end[start + n + units.length - 2] - low))
            run_low.append(low + base)
            bucket.append(mixed(anchor[some]) % np.uint64(buckets))
            base += len(packed)
        body = memoryview(np.concatenate([r[2] for r in read])) if read else memoryview(b"")
        several = _by_bucket(body, np.concatenate(run), np.concatenate(run_low), np.concatenate(bucket))
        records, low = _distinct(np.concatenate(single), np.concatenate(single_low))
        alone = _by_bucket(body, records, low, records["own"] % np.uint64(buckets))
        part, none = key[0].as_py(), (b"", b"")
        rows = [(i, part, *several.get(i, none), *alone.get(i, none)) for i in sorted({*several, *alone})]
        if not rows:
            return _SENT.empty_table()
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SENT.types, strict=True)], schema=_SENT)

    return send


def _find_equal(units: Units, later_only: bool):
    """Marks the windows that occur again, or with `later_only` those that a smaller id has too
    (kind 3).  Of windows that came singly the smallest id goes back to their parts (kind 4)."""

    def column(sent: pa.Table, name: str, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
        """The records of all rows, and the row of each."""
        bodies = sent[name].to_pylist()
        return np.frombuffer(b"".join(bodies), kind), np.repeat(np.arange(len(bodies)), [len(b) // kind.itemsize for b in bodies])

    def groups(sent: pa.Table, name: str, size: np.ndarray, n: np.ndarray) -> np.ndarray:
        if not len(n):
            return np.zeros(0, np.int64)
        return units.equal(b"".join(sent[name].to_pylist()), np.append(0, np.cumsum(size, dtype=np.int64)), n)

    def least(group: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.full(int(group.max(initial=-1)) + 1, _NO_ID)
        np.minimum.at(out, group, ids)
        return out

    def marks(sent: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        run, source = column(sent, "runs", _RUN)
        n = run["n"].astype(np.int64)
        group = groups(sent, "body", run["size"], n)
        if later_only:
            ids = np.repeat(run["id"], n)
            marked = ids > least(group, ids)[group]
        else:
            marked = np.bincount(group)[group] > 1
        # A stretch must not go on from one run to the next: a false place is put between them.
        before = np.cumsum(n) - n + np.arange(len(n))
        gapped = np.zeros(len(marked) + len(n), bool)
        gapped[np.repeat(before, n) + _counted(n)] = marked
        begin, stop = runs(gapped)
        of = np.searchsorted(before, begin, "right") - 1
        return _records(_MARK, text=run["text"][of], start=run["start"][of] + begin - before[of], n=stop - begin), source[of]

    def verdicts(sent: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        single, source = column(sent, "single", _SINGLE)
        group = groups(sent, "single_body", single["size"], np.ones(len(single), np.int64))
        again = (np.bincount(group, single["n"]) > 1)[group] if len(group) else np.zeros(0, bool)
        ids = least(group, single["id"])[group]
        return _records(_VERDICT, own=single["own"][again], id=ids[again]), source[again]

    def find(key: tuple[pa.Scalar, ...], sent: pa.Table) -> pa.Table:
        rows = []
        for kind, (records, source) in ((3, marks(sent)), (4, verdicts(sent))):
            for a, b in zip(*_bounds(source), strict=True):
                rows.append((sent["part"][int(source[a])].as_py(), kind, records[a:b].tobytes()))
        return _note_table(rows)

    return find


def _noted(notes: pa.Table, kind: int, record: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(notes.filter(pc.equal(notes["kind"], kind))["body"].to_pylist()), record)


def _places(hashes: np.ndarray, length: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows with a hash in `own`, which is sorted, begin; which of `own` it is."""
    bits = np.uint64(44)
    near = np.zeros(1 << 20, bool)
    near[own >> bits] = True
    found = _window_hashes(hashes, length)
    at = np.flatnonzero(near[found >> bits])
    which = np.minimum(np.searchsorted(own, found[at]), len(own) - 1)
    same = own[which] == found[at]
    return at[same], which[same]


def _apply(units: Units, result: pa.Schema, finish: Callable, later_only: bool):
    """Cuts the texts.  `finish` makes the result columns of (data, ends, flags of covered units)."""

    def apply(key: tuple[pa.Scalar, ...], texts: pa.Table, notes: pa.Table) -> pa.Table:
        if not len(texts):
            return result.empty_table()
        classes, marks, verdicts = _classes(notes), _noted(notes, 3, _MARK), _noted(notes, 4, _VERDICT)
        marks, verdicts = marks[np.argsort(marks["text"], kind="stable")], verdicts[np.argsort(verdicts["own"])]
        text, own, least = marks["text"].copy(), verdicts["own"].copy(), verdicts["id"].copy()
        uids, ids = texts["uid"].to_pylist(), texts["id"].to_pylist()
        numbers = texts["id"].fill_null(_NO_ID).to_numpy()
        rank = _rank(np.array(list(classes), np.int64), texts["uid"].to_numpy())
        columns = [[] for _ in result]
        for row, data, ends in chunks(texts["text"], CHUNK):
            hashes, first, packed, begin, end = units.read(data, ends)
            step = np.zeros(int(first[-1]) + 1, np.int32)
            if len(own):
                at, which = _places(hashes, units.length, own)
                doc = np.searchsorted(first, at, "right") - 1
                some = at + units.length <= first[doc + 1]
                if later_only:
                    some &= numbers[row + doc] > least[which]
                step[at[some]] += 1
                step[at[some] + units.length] -= 1
            low, high = (np.searchsorted(text, rank[row : row + len(first) - 1], side) for side in ("left", "right"))
            for i, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
                if first[i + 1] - first[i] < units.length:
                    continue
                known, copies = classes.get(uids[row + i], (None, 2))
                if uids[row + i] not in classes or known != ids[row + i] or (copies > 1 and not later_only):
                    step[first[i]] += 1
                    step[first[i + 1]] -= 1
                elif a < b:
                    np.add.at(step, first[i] + marks["start"][a:b], 1)
                    np.add.at(step, first[i] + marks["start"][a:b] + marks["n"][a:b] + units.length - 1, -1)
            gone = np.cumsum(step[:-1]) > 0
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                for column, value in zip(columns, (ids[row + i], *finish(packed, begin[a:b], end[a:b], gone[a:b])), strict=True):
                    column.append(value)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, result.types, strict=True)], schema=result)

    return apply


def cut_repeats(
    docs: DataFrame, units: Units, result: pa.Schema, ddl: str, finish: Callable, later_only: bool, key: str, text: str,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of `docs`: the id and what `finish` makes of the text without the units
    that a repeated window covers.  `key` is an integer column."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    hashes = F.xxhash64("text").alias("one"), F.xxhash64(F.lit("second"), "text").alias("two")
    equal = cut(rows.select("id", *hashes, F.octet_length("text").cast("long").alias("bytes")).groupBy("one", "two").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "equal")
    parts = max(LEAST_PARTS, (equal.agg(F.sum("bytes")).first()[0] or 0) // units.part_bytes + 1)
    uid = F.col("one").bitwiseXOR(F.shiftleft("two", 1)).alias("uid")

    def part(one, id_):
        return F.pmod(F.xxhash64(one, id_), F.lit(parts)).cast("int").alias("part")

    texts = rows.withColumns({"one": hashes[0], "two": hashes[1]}).select(part("one", "id"), "id", uid, "text")
    classes = equal.select(part("one", "id"), F.lit(0).alias("kind"), uid, "id", "n", F.lit(None).cast("binary").alias("body"))

    def together(notes: DataFrame, what, schema: str) -> DataFrame:
        return texts.groupBy("part").cogroup(notes.groupBy("part")).applyInArrow(what, schema)

    anchors = together(classes, _send_anchors(units, max(LEAST_PARTS, parts // PARTS_A_RANGE)), "range int, part int, body binary, counts binary")
    shared = anchors.groupBy("range").applyInArrow(_compare_anchors(hot), _NOTE)
    sent = together(classes.unionByName(shared), _send_windows(units, parts), _SENT_DDL)
    marks = sent.groupBy("bucket").applyInArrow(_find_equal(units, later_only), _NOTE)
    return together(classes.unionByName(marks), _apply(units, result, finish, later_only), ddl)
