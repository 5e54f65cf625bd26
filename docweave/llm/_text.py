"""Vectorised word scanning over Arrow string buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D; UTF-8 never uses those bytes inside a character, so scanning bytes
gives the same words as scanning characters. Lower-casing touches A-Z only. Words are identified by 64-bit hashes (two
independent ones where groups must be exact): multilinear ones, in which each place has a multiplier of its own. Two texts
that differ anywhere by an odd number collide with probability 2^-64 over the multipliers, any two with 2^-57 at most, however
they repeat themselves; powers of one radix modulo 2^64 would make some regular texts equal for every radix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.arange(1, 257, dtype=np.uint64)
_LOWER = np.arange(256)
_LOWER[0x41:0x5B] += 0x20
_SALT = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)
_LENGTH = np.array([0x9E3779B97F4A7C15, 0xA0761D6478BD642F], dtype=np.uint64)
_MULTIPLIERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
_KEPT = 1 << 16
_CHUNK = 1 << 20


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    h = h + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def multipliers(which: int, n: int) -> np.ndarray:
    """The multipliers of the first ``n`` places (at least): pseudo-random, from an endless row fixed by ``which``."""
    known = _MULTIPLIERS[which]
    if n <= len(known):
        return known
    size = max(n, min(2 * n, _KEPT))
    made = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SALT[which]), 3 + which)
    if size <= _KEPT:
        _MULTIPLIERS[which] = made
    return made


def string_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a column of texts: ``start``/``end`` byte places, ``first[i]:first[i + 1]`` the words of text i, ``hash``."""

    def __init__(self, column, lower: bool, hashes: int = 1):
        self.data, self.offsets = string_buffer(column)
        self.start, self.end = _bounds(self.data, self.offsets)
        self.first = np.searchsorted(self.start, self.offsets)
        self.hash = [_hash(self.data, self.start, self.end, lower, k) for k in range(hashes)]

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(word[:-1], out=before[1:])
    before |= cut[:-1]
    start = np.flatnonzero(word & before)
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(word[1:], out=after[:-1])
    after |= cut[1:]
    return start, np.flatnonzero(word & after) + 1


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool, which: int) -> np.ndarray:
    table = _BYTE[_LOWER] if lower else _BYTE.copy()
    table[SPACE] = 0
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + _CHUNK)))
        lo, hi = start[i], end[j - 1]
        at = np.zeros(hi - lo, np.int32)
        at[start[i:j] - lo] = (start[i:j] - lo).astype(np.int32)
        np.maximum.accumulate(at, out=at)
        place = np.arange(hi - lo, dtype=np.int32) - at
        value = table[data[lo:hi]]
        value *= multipliers(which, int(place.max()) + 1)[place]
        sums = np.add.reduceat(value, start[i:j] - lo)
        out[i:j] = mix(sums ^ (end[i:j] - start[i:j]).astype(np.uint64) * _LENGTH[which], which + 1)
        i = j
    return out


def windows(hashes: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of every n consecutive words, whatever text they belong to; see ``starts_of_windows``."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out, by, part = np.zeros(m, np.uint64), multipliers(which, n), np.empty(m, np.uint64)
    for j in range(n):
        np.multiply(hashes[j : j + m], by[j], out=part)
        out += part
    return mix(out, n + 64 * (which + 1))


def starts_of_windows(first: np.ndarray, n: int) -> np.ndarray:
    """Word places at which a window of n words stays inside its text."""
    total = int(first[-1])
    m = max(0, total - n + 1)
    ok = np.ones(m, dtype=bool)
    for j in range(1, n):  # the last n - 1 words of each text start none
        at = first[1:] - j
        at = at[(at >= first[:-1]) & (at < m)]
        ok[at] = False
    return np.flatnonzero(ok)


def shingles(words: Words, n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every n-word shingle in order; a text of fewer words has its whole sequence as its only one."""
    starts = starts_of_windows(words.first, n)
    doc = np.searchsorted(words.first, starts, side="right") - 1
    value = windows(words.hash[which], n, which)[starts] if len(starts) else np.empty(0, np.uint64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for k, i in enumerate(short):
            w = words.hash[which][words.first[i] : words.first[i + 1]]
            extra[k] = windows(w, len(w), which)[0]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, extra])
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
    return doc, value


def distinct_pairs(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, ordered by text, then hash. ``doc`` must be sorted."""
    if not len(doc):
        return doc, value
    out_d, out_v = [], []
    bounds = np.searchsorted(doc, np.arange(int(doc[-1]) + 2))
    i = 0
    while i < len(bounds) - 1:  # texts in groups, so that one sort serves many short texts
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + (1 << 18))) - 1)
        j = min(j, len(bounds) - 1)
        d, v = doc[bounds[i] : bounds[j]], value[bounds[i] : bounds[j]]
        order = np.lexsort((v, d))
        d, v = d[order], v[order]
        if len(d):
            keep = np.ones(len(d), dtype=bool)
            keep[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
            out_d.append(d[keep])
            out_v.append(v[keep])
        i = j
    return np.concatenate(out_d), np.concatenate(out_v)
