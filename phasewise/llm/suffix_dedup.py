"""Substring dedup on suffixes ordered by a depth-limited radix sort.

Suffixes are told apart by most-significant digits first and never beyond the threshold: the first
digit is an anchor of GRAM bytes, dealt out over the cluster, where suffixes without a partner
drop out; the passes after it take eight bytes each inside a bucket, and again only groups of more
than one go on.  The groups left at the threshold are exactly the repeated windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import HOT, Units, cut_repeats
from .textcore import _BYTE, runs

THRESHOLD = 50  # bytes
GRAM = 24  # bytes
PART_BYTES = 3 << 20  # every byte is a unit, and most travel in several windows
SLICE = 1 << 18  # windows sorted at a time after the first pass

_RESULT = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
_AT = np.arange((1 << 18) + 1)  # shared by the chunks of a part


def _read(data: np.ndarray, ends: np.ndarray):
    at = _AT[: len(data) + 1] if len(data) < len(_AT) else np.arange(len(data) + 1)
    return _BYTE[data], ends, data, at[:-1], at[1:]


def _split(block: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Neighbouring slices of about `size` that cut no block, which are sorted."""
    edge = np.append(np.flatnonzero(np.diff(block)) + 1, len(block))
    out, low = [], 0
    while low < len(block):
        high = int(edge[min(np.searchsorted(edge, low + size), len(edge) - 1)])
        out.append((low, high))
        low = high
    return out


def _radix_groups(depth: int, slice_: int = SLICE):
    passes = [*range(0, depth - 7, 8)] or [0]
    if depth > 8 and passes[-1] + 8 < depth:
        passes.append(depth - 8)  # the last digit overlaps the one before

    def equal(body: bytes, offsets: np.ndarray, n: np.ndarray) -> np.ndarray:
        # The eight bytes from every place on as one number, the first byte highest.
        digits = np.ndarray(len(body) + 1, ">u8", body + bytes(8), strides=(1,))
        place = np.repeat((offsets[:-1] - np.cumsum(n) + n).astype(np.int32 if len(body) < 1 << 31 else np.int64), n)
        place += np.arange(len(place), dtype=place.dtype)

        def digit(left: np.ndarray, p: int) -> np.ndarray:
            found = digits[place[left] + p].astype(np.uint64)
            return found >> np.uint64(8 * (8 - depth)) if depth < 8 else found

        def partners(left: np.ndarray, block: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            new = np.ones(len(left), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (block[1:] != block[:-1])
            alone = new & np.append(new[1:], True)
            return left[~alone], (np.cumsum(new, dtype=np.int32) - 1)[~alone]

        group, found = np.full(len(place), -1, np.int64), 0
        first = digit(np.arange(len(place), dtype=np.int32), passes[0])
        order = np.argsort(first).astype(np.int32)
        every, blocks = partners(order, np.zeros(len(place), np.int8), first[order])
        del first, order
        for low, high in _split(blocks, slice_):
            left, block = every[low:high], blocks[low:high]
            for p in passes[1:]:
                own = digit(left, p)
                order = np.lexsort((own, block))
                left, block = partners(left[order], block[order], own[order])
            names, group[left] = np.unique(block, return_inverse=True)
            group[left] += found
            found += len(names)
        rest = np.flatnonzero(group < 0)
        group[rest] = found + np.arange(len(rest))
        return group

    return equal


def _finish(packed: np.ndarray, begin: np.ndarray, end: np.ndarray, gone: np.ndarray):
    text = packed[begin[0] : end[-1]] if len(begin) else packed[:0]
    return len(gone), int(gone.sum()), len(runs(gone)[0]), text[~gone].tobytes()


def without_repeats(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM, key: str = "doc_id", text: str = "text", hot: int = HOT, places: int = 26) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) per row of `docs`, of its UTF-8 bytes.

    A byte goes if a string of `threshold` bytes that covers it starts in a document with a smaller key as
    well; all strings are judged on the input.  kept: the other bytes (a cut may split a
    character); n_spans: maximal removed runs.  Null and empty texts have no bytes; rows with
    the same key are one document to each other and remove nothing there; a null key counts as
    the largest; further columns are not looked at; no documents: no rows.
    """
    units = Units(threshold, min(gram, threshold), _read, _radix_groups(threshold), PART_BYTES, places)
    out = cut_repeats(
        docs, units, _RESULT, "key long, n_bytes long, n_removed long, n_spans long, kept binary", _finish, True, key, text, hot)
    return out.withColumnRenamed("key", key)
