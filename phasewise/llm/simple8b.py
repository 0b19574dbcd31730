"""Simple-8b: unsigned integers packed into 64-bit words, the top four bits naming the packing.

A block is a header, the word offset of every group of GROUP values, the words and the escapes.
A value of more than 60 bits is an escape: its word holds its place in the list at the end, so
no word has to be read before another one and a block is decoded selector by selector.
"""

from __future__ import annotations

import numpy as np

GROUP = 4096
_MAGIC = 0x31423853  # "S8B1"
# Fixed packings: values per word and bits per value, by selector; selector 15 is the escape.
COUNTS = np.array([120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = 15


def _widths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < np.uint64(1 << 53):  # exact as doubles
        return np.frexp(values.astype(np.float64))[1].astype(np.uint8)
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For every place the packing that takes most values from there on; what lies beyond the end
    fits any packing.  Widest values of windows come from those of half as many."""
    n = len(values)
    widths = np.append(_widths(values), np.zeros(2 * COUNTS[0], np.uint8))
    best = np.where(widths[:n] > BITS[14], ESCAPE, 14).astype(np.uint8)
    have, widest = 1, widths  # of the windows of `have` values from each place on
    for s in range(13, -1, -1):
        count = int(COUNTS[s])
        while 2 * have <= count:
            widest = np.maximum(widest[: len(widest) - have], widest[have:])
            have *= 2
        fits = np.maximum(widest[:n], widest[count - have : count - have + n]) <= BITS[s]
        if not fits.any():
            break  # nor do longer windows of narrower values
        best[fits] = s
    return best.astype(np.int64)


def encode(values: np.ndarray) -> bytes:
    values = np.ascontiguousarray(values, np.uint64)
    n, best = len(values), _selectors(values)
    steps = COUNTS[best].tolist()
    starts, offsets = [], []
    for begin in range(0, n, GROUP):
        at, stop = begin, min(begin + GROUP, n)
        offsets.append(len(starts))
        while at < stop:
            starts.append(at)
            at += steps[at]
    starts = np.array(starts, np.int64)
    chosen = best[starts] if n else np.zeros(0, np.int64)
    packed = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.append(values, np.zeros(COUNTS[0], np.uint64))
    last = np.minimum((starts // GROUP + 1) * GROUP, n)
    for s in np.unique(chosen):
        at = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            packed[at] |= np.arange(len(at), dtype=np.uint64)
        elif BITS[s]:
            begin, room = starts[at], last[at] - starts[at]
            short = np.flatnonzero(room < COUNTS[s])  # words that end with their group
            word = padded[begin]
            for j in range(1, COUNTS[s]):
                value = padded[begin + j]
                value[short[room[short] <= j]] = 0
                word |= value << np.uint64(j * BITS[s])
            packed[at] |= word
    escapes = values[starts[chosen == ESCAPE]]
    head = np.array([_MAGIC, n, len(packed), len(escapes)], "<u4")
    return b"".join(x.tobytes() for x in (head, np.array(offsets, "<u4"), packed.astype("<u8"), escapes.astype("<u8")))


def decode(block: bytes, first: int = 0, end: int | None = None) -> np.ndarray:
    """The values, or those of the groups `first` to before `end`, which are found by the offsets."""
    magic, n, n_words, n_escapes = np.frombuffer(block, "<u4", 4).tolist()
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b block")
    groups = -(-n // GROUP)
    offsets = np.append(np.frombuffer(block, "<u4", groups, 16), n_words).astype(np.int64)
    at = 16 + 4 * groups
    escapes = np.frombuffer(block, "<u8", n_escapes, at + 8 * n_words)
    end = groups if end is None else min(end, groups)
    if first >= end:
        return np.zeros(0, np.uint64)
    packed = np.frombuffer(block, "<u8", n_words, at)[offsets[first] : offsets[end]]
    chosen = (packed >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    sizes = np.minimum(GROUP, n - np.arange(first, end) * GROUP)
    ends = offsets[first + 1 : end + 1] - offsets[first]
    sums = np.append(0, np.cumsum(counts))
    counts[ends - 1] -= sums[ends] - sums[ends - np.diff(offsets[first : end + 1])] - sizes  # padding of each group
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()) + COUNTS[0], np.uint64)
    for s in np.unique(chosen):
        words = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            out[begin[words]] = escapes[(packed[words] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif BITS[s]:
            mask = np.uint64((1 << int(BITS[s])) - 1)
            for j in range(COUNTS[s]):
                some = words[counts[words] > j]
                out[begin[some] + j] = (packed[some] >> np.uint64(j * BITS[s])) & mask
    return out[: int(counts.sum())]
