"""Words of Arrow text batches as numpy arrays of 64-bit hashes.

Works on the UTF-8 bytes of whole texts: a word is a run of bytes outside a
separator set, its hash a polynomial over per-byte random 64-bit values.  Bytes
are taken in pieces cut at separators, so memory does not follow text length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes taken at once; a single longer word is taken whole.
PIECE = 1 << 18
BASE = U(0x9E3779B97F4A7C15)
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finish: spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: A random value for each byte; upper-case ASCII letters take their lower case's.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
UP = _powers(int(BASE), PIECE + 1)
DOWN = _powers(pow(int(BASE), -1, 1 << 64), PIECE + 1)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[list(SPACES)] = True


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def bounds(data: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``."""
    out = separator[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], out, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def pieces(data: np.ndarray, separator: np.ndarray) -> Iterator[np.ndarray]:
    """``data`` in pieces of about ``PIECE`` bytes, cut after separators."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            stops = np.flatnonzero(separator[data[at:end]])
            while not len(stops) and end < len(data):
                end = min(end + PIECE, len(data))
                stops = np.flatnonzero(separator[data[at:end]])
            if len(stops):
                end = at + int(stops[-1]) + 1
        yield data[at:end]
        at = end


def hash_words(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray, byte: np.ndarray) -> np.ndarray:
    up, down = (UP, DOWN) if len(piece) < len(UP) else (
        _powers(int(BASE), len(piece) + 1), _powers(pow(int(BASE), -1, 1 << 64), len(piece) + 1))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte[piece] * up[:len(piece)], dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashes(data: np.ndarray, byte: np.ndarray = BYTE_LOWER, separator: np.ndarray = SEPARATOR) -> np.ndarray:
    """The hash of every word in ``data``, in order."""
    found = []
    for piece in pieces(data, separator):
        starts, ends = bounds(piece, separator)
        if len(starts):
            found.append(hash_words(piece, starts, ends, byte))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def slices(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def words_of(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR,
             byte: np.ndarray = BYTE_LOWER) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): words of consecutive texts; no word reaches across two texts."""
    n = len(offsets) - 1
    if n == 1:
        h = hashes(data, byte, separator)
        return h, np.array([len(h)])
    # a separator between the texts keeps their words apart
    gap = np.insert(data, offsets[1:-1], 0x20)
    starts, _ = bounds(gap, separator)
    ends = offsets[1:] + np.arange(n)
    upto = np.searchsorted(starts, ends, "left")
    return hashes(gap, byte, separator), np.diff(np.concatenate(([0], upto)))


def shingles(hashed: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) of all runs of ``k`` words; a text of fewer words (one at least) is one shingle."""
    row = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    short = (counts > 0) & (counts < k)
    total = len(hashed)
    full = np.zeros(0, np.int64)
    if total >= k:
        i = np.arange(total - k + 1)
        full = i[row[i] == row[i + k - 1]]
    value = np.zeros(len(full), np.uint64)
    for j in range(k):
        value = value * U(0xD1342543DE82EF95) + hashed[full + j]
    rows, values = [row[full]], [mix(value)]
    for r in np.flatnonzero(short):
        x = U(0)
        with np.errstate(over="ignore"):
            for h in hashed[ends[r] - counts[r]:ends[r]]:
                x = x * U(0xD1342543DE82EF95) + h
        rows.append(np.array([r]))
        values.append(mix(np.array([x + U(int(counts[r]))], np.uint64)))
    return np.concatenate(rows), np.concatenate(values)
