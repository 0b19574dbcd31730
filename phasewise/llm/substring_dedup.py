"""Substring dedup by super-k-mer partitioning.

Neighbouring windows of words that share a minimiser travel as one packed string, the words joined
by one space, to the minimiser's bucket, where sorting the windows counts them exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import HOT, Units, cut_repeats
from .textcore import IS_SPACE, byte_sums, span_hashes, words

WINDOW = 35  # words
MINIMISER = 8  # words

_RESULT = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _read(data: np.ndarray, ends: np.ndarray):
    begin, end, first = words(data, ends)
    keep = ~IS_SPACE[data]
    closing = end[end < len(data)]
    closing = closing[IS_SPACE[data[closing]]]
    keep[closing] = True  # one separator after each word
    packed = data[keep]
    packed[IS_SPACE[packed]] = 32
    place = np.append(0, np.cumsum(keep))
    return span_hashes(byte_sums(data), begin, end), first, packed, place[begin], place[end]


def _sorted_groups(length: int):
    def equal(body: bytes, offsets: np.ndarray, n: np.ndarray) -> np.ndarray:
        windows = []
        for low, high, count in zip(offsets[:-1].tolist(), offsets[1:].tolist(), n.tolist(), strict=True):
            text = body[low:high]
            spaces = (np.flatnonzero(np.frombuffer(text, np.uint8) == 32)).tolist()
            begins, stops = [0, *[s + 1 for s in spaces]], [*spaces, len(text)]
            windows += [text[begins[i] : stops[i + length - 1]] for i in range(count)]
        group = np.zeros(len(windows), np.int64)
        number, before = -1, None
        for i in sorted(range(len(windows)), key=windows.__getitem__):
            if windows[i] != before:
                number, before = number + 1, windows[i]
            group[i] = number
        return group

    return equal


def _finish(packed: np.ndarray, begin: np.ndarray, end: np.ndarray, gone: np.ndarray):
    kept = b" ".join(packed[i:j].tobytes() for i, j in zip(begin[~gone].tolist(), end[~gone].tolist(), strict=True))
    return len(gone), int(gone.sum()), kept.decode("utf-8", "replace")


def without_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, key: str = "doc_id", text: str = "text", hot: int = HOT, places: int = 26) -> DataFrame:
    """(key, n_words, n_removed, kept) per row of `docs`.

    A word goes if a window of `window` words that covers it starts anywhere else as well, in
    the same text too; all windows are judged on the input.  kept: the other words, unchanged,
    joined by one space.  Null and empty texts have no words; texts shorter than a window lose
    nothing; equal texts of window length and more go whole, repeated rows included; null keys
    are rows like others; further columns are not looked at; no documents: no rows.
    """
    units = Units(window, min(minimiser, window), _read, _sorted_groups(window), places=places)
    out = cut_repeats(docs, units, _RESULT, "key long, n_words long, n_removed long, kept string", _finish, False, key, text, hot)
    return out.withColumnRenamed("key", key)
