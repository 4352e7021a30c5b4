"""Anchors of equal byte strings: winnowing over rolling hashes.

Of the ``k``-byte strings inside every ``span``-byte string the one with the
smallest hash is its anchor, so equal strings have equal anchors at equal
distance.  Neighbouring strings share anchors; an anchor owns the stretch of
string starts it serves.
"""

from __future__ import annotations

import numpy as np

from playerledger.llm.words_np import BYTE, U, _powers, mix

GRAM = 64
#: Bits for the place inside a slice; the rest of the key is hash.
PLACE_BITS = 24
BASE = 0x9E3779B97F4A7C15


def prefix_sums(data: np.ndarray, table: np.ndarray = BYTE) -> np.ndarray:
    """sums[i]: polynomial hash of the first i bytes, terms weighted from the left."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(BASE, len(data) + 1)[:-1], dtype=np.uint64, out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, alike wherever the bytes stand."""
    down = _powers(pow(BASE, -1, 1 << 64), len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (w - size)], x[w - size:]) if w > size else x


def anchors(data: np.ndarray, offsets: np.ndarray, span: int, gram: int = GRAM):
    """(row, place, first, last, hash, sums) of consecutive texts: the text, where in
    ``data`` the anchor stands, the first and last string start it owns, its hash."""
    sums = prefix_sums(data)
    empty = np.zeros(0, np.int64)
    if len(data) < span:
        return empty, empty, empty, empty, np.zeros(0, np.uint64), sums
    at = np.arange(len(data) - gram + 1)
    grams = mix((sums[gram:] - sums[:-gram]) * _powers(pow(BASE, -1, 1 << 64), len(at)))
    low = U((1 << PLACE_BITS) - 1)
    best = (sliding_min((grams & ~low) | at.astype(np.uint64), span - gram + 1) & low).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(best)), "right") - 1
    inside = np.arange(len(best)) + span <= offsets[row + 1]
    head = inside.copy()
    head[1:] &= ~inside[:-1] | (best[1:] != best[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(head)
    last = np.flatnonzero(inside & np.concatenate((head[1:] | ~inside[1:], [True])))
    return row[first], best[first], first, last, grams[best[first]], sums


def collapsed(row: np.ndarray, first: np.ndarray, n: np.ndarray, h: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where, times): adjoining equal segments, as a text that repeats itself has them, taken as one."""
    same = (row[1:] == row[:-1]) & (h[1:] == h[:-1]) & (seg[1:] == seg[:-1]) & (first[1:] == first[:-1] + n[:-1])
    where = np.flatnonzero(np.concatenate(([True], ~same)))
    return where, np.diff(np.concatenate((where, [len(row)])))
