"""Vectorised helpers on the UTF-8 bytes of Arrow text columns: words, hashes of words and of
windows.  Hashes are 64-bit polynomials over random byte values, taken from prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 2_000_000  # bytes worked on at a time; a longer text is worked on alone
_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            made = np.full(n, base, np.uint64)
            made[0] = 1
            _powers[k] = np.multiply.accumulate(made)
    return _powers[0][:n], _powers[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy over all 64 bits; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends) of neighbouring rows of about `size` bytes; ends has one entry more
    than rows and starts at 0.  Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(_BYTE[data])


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """s with s[j] - s[i] = sum of values[t] * base^t for i <= t < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values in [begin, end), equal for equal values wherever they stand."""
    return mixed((sums[end] - sums[begin]) * powers(len(sums))[1][begin])


def words(
    data: np.ndarray, ends: np.ndarray, letter: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first): byte spans of the words [^\\x20\\x09-\\x0D]+, or of the runs of `letter`,
    and for each row the number of its first word, with one entry more at the end.  No word
    crosses rows."""
    n = len(data)
    inside = np.ones(n + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~IS_SPACE[data] if letter is None else letter
    edge = np.zeros(n + 1, bool)
    edge[ends] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | edge)[: n + 1])
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge)[: n + 1])
    return begin, end, np.searchsorted(begin, ends)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[begin, end) of the runs of true values."""
    padded = np.zeros(len(flags) + 2, np.int8)
    padded[1:-1] = flags
    step = np.diff(padded)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)
