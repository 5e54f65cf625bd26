"""Elias-Fano sequences and the n-gram trie built of them, all vectorised over queries.

A monotone sequence of n values below u is kept as the low ``floor(log2(u / n))`` bits of each value and, in unary, its high
parts: about two bits and the low part a value. A successor search finds the bucket of equal high parts by one select and
compares low parts inside it only.
"""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np

_POP = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_NTH = np.zeros((256, 8), np.uint8)  # place of the n-th set bit of a byte
for _b in range(256):
    for _n, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _NTH[_b, _n] = _p


class EliasFano:
    """Arrays ``low``, ``high`` (bit strings), ``ones``/``zeros`` (counts before each 64-bit word of ``high``)."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones, self.zeros = n, bits, low, high, ones, zeros
        self.mask = np.uint64((1 << bits) - 1)
        self.low_words = np.ndarray((max(0, len(low) - 7),), "<u8", np.ascontiguousarray(low), strides=(1,)) if not isinstance(low, np.memmap) else np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = min(bits, 48)
        low = np.zeros(0, np.uint8)
        if bits and n:
            width = -(-bits // 8)
            parts = []
            for i in range(0, n, 1 << 19):  # a multiple of eight values, so that parts join at whole bytes
                raw = (values[i : i + (1 << 19)] & np.uint64((1 << bits) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
                parts.append(np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little"))
            low = np.concatenate(parts)
        low = np.concatenate([low, np.zeros(8, np.uint8)])
        size = n + (int(values[-1]) >> bits if n else 0) + 1
        flags = np.zeros(-(-size // 64) * 64, np.uint8)
        flags[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little")
        each = _POP[high].reshape(-1, 8).sum(1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(each)[:-1]]).astype(np.uint32)
        zeros = (np.arange(len(each), dtype=np.int64) * 64 - ones).astype(np.uint32)
        return cls(n, bits, low, high, ones, zeros)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"size": np.array([self.n, self.bits], np.int64), "low": self.low, "high": self.high, "ones": self.ones, "zeros": self.zeros}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> EliasFano:
        return cls(int(a["size"][0]), int(a["size"][1]), a["low"], a["high"], a["ones"], a["zeros"])

    def _select(self, k: np.ndarray, one: bool) -> np.ndarray:
        before = self.ones if one else self.zeros
        word = np.searchsorted(before, k.astype(before.dtype), side="right") - 1
        left = (k - before[word]).astype(np.int64)
        place = word * 8
        for _ in range(7):
            have = _POP[self.high[place]] if one else 8 - _POP[self.high[place]]
            on = left >= have
            if not on.any():
                break
            left -= have * on
            place = place + on
        byte = self.high[place]
        return place * 8 + _NTH[byte if one else 255 - byte, np.minimum(left, 7)]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        p = i * self.bits
        return self.low_words[p >> 3] >> (p & 7).astype(np.uint64) & self.mask

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.empty(0, np.uint64)
        return (self._select(i, True) - i).astype(np.uint64) << np.uint64(self.bits) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value >= x, by successor search; n if there is none."""
        x = x.astype(np.uint64)
        if not self.n or not len(x):
            return np.full(len(x), self.n, np.int64)
        bucket = (x >> np.uint64(self.bits)).astype(np.int64)
        last = len(self.high) * 8 - self.n - 1  # zeros there are, counted from 0
        inside = bucket <= last
        b = np.minimum(bucket, last)
        end = np.minimum(self._select(b, False) - b, self.n)
        start = np.where(b > 0, self._select(np.maximum(b - 1, 0), False) - (b - 1), 0)
        start = np.minimum(start, self.n)
        low = x & self.mask
        while True:  # binary search among the few low parts of the bucket
            open_ = np.flatnonzero(start < end)
            if not len(open_):
                break
            mid = (start[open_] + end[open_]) >> 1
            less = self._low(mid) < low[open_]
            start[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]
        return np.where(inside, start, self.n)


def _groups(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, index of each element), without sorting where ``a`` ascends."""
    step = a[1:] != a[:-1]
    if (a[1:] < a[:-1]).any():
        return np.unique(a, return_inverse=True)
    index = np.zeros(len(a), np.int64)
    np.cumsum(step, out=index[1:])
    return a[np.concatenate([[True], step])] if len(a) else a, index


class Level:
    """Sorted ids grouped by parent: one Elias-Fano sequence over all groups (each raised by the last value of the one
    before, so that it stays monotone) and one over the groups' first places."""

    def __init__(self, ids: EliasFano, pointers: EliasFano):
        self.ids, self.pointers = ids, pointers

    @classmethod
    def of(cls, parent: np.ndarray, ids: np.ndarray, parents: int) -> Level:
        first = np.searchsorted(parent, np.arange(parents + 1))
        tops = np.zeros(parents, np.uint64)
        full = first[1:] > first[:-1]
        tops[full] = ids[first[1:][full] - 1].astype(np.uint64) + np.uint64(1)
        base = np.concatenate([[0], np.cumsum(tops, dtype=np.uint64)[:-1]]).astype(np.uint64) if parents else tops
        return cls(EliasFano.of(ids.astype(np.uint64) + np.uint64(1) + (base[parent] if parents else np.uint64(0))), EliasFano.of(first))

    def find(self, parent: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the level, place within the group) of each id below its parent; -1 where it isn't, or parent is -1."""
        out, rel = np.full(len(ids), -1, np.int64), np.full(len(ids), -1, np.int64)
        at = np.flatnonzero((parent >= 0) & (ids >= 0))
        if len(at):
            p = parent[at]
            group, index = _groups(p)
            first = self.pointers.get(group).astype(np.int64)
            last = self.pointers.get(group + 1).astype(np.int64)
            base = np.zeros(len(group), np.uint64)
            later = first > 0
            base[later] = self.ids.get(first[later] - 1)
            x = ids[at].astype(np.uint64) + np.uint64(1) + base[index]
            place = self.ids.find(x)
            hit = place < last[index]
            hit[hit] = self.ids.get(place[hit]) == x[hit]
            out[at[hit]], rel[at[hit]] = place[hit], place[hit] - first[index[hit]]
        return out, rel


_STEP = 4.5e-4  # of a code, in powers of ten of x / (1 - x)
_MIDDLE, _ONE = 1 << 15, 65535


def encode(x: np.ndarray) -> np.ndarray:
    """16-bit codes of numbers from 0 to 1: steps even in the logarithm of x / (1 - x), so that both x and 1 - x are off by
    0.06 % at most (beyond 10^-14 they are held at that). 0 and 1 have codes of their own. The same for every shard."""
    x = np.asarray(x, float)
    with np.errstate(divide="ignore"):
        odds = np.log10(x) - np.log1p(-x) / np.log(10)
    code = np.clip(np.round(np.clip(odds, -99, 99) / _STEP) + _MIDDLE, 1, _ONE - 1)
    return np.where(x <= 0, 0, np.where(x >= 1, _ONE, code)).astype(np.uint16)


def _code_book() -> np.ndarray:
    odds = 10.0 ** ((np.arange(_ONE + 1) - _MIDDLE) * _STEP)
    out = odds / (1 + odds)
    out[0], out[_ONE] = 0, 1
    return out


_BOOK: list[np.ndarray] = []


def decode(code: np.ndarray) -> np.ndarray:
    if not _BOOK:
        _BOOK.append(_code_book())
    return _BOOK[0][code]


def discount(once: int, twice: int) -> float:
    """The absolute discount, by how many counts are 1 and 2."""
    return min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.98)


class NgramTrie:
    """Trigram model of the words after each word v, as four levels.

    v (all words with a successor) -> w: bigrams; v -> u: the contexts (u, v); (u, v) -> w: trigrams, with w written as its
    rank among the successors of v, which makes the ids small. Absolute discounting: a bigram or trigram has its discounted
    share, a node the weight that it leaves to the shorter context; both as 16-bit codes (``encode``).
    """

    KEYS = ("roots", "bigrams", "contexts", "trigrams")

    def __init__(self, levels: dict[str, Level], tables: dict[str, np.ndarray]):
        self.levels, self.tables = levels, tables

    @classmethod
    def build(cls, v: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray, whole: tuple[int, int, int] | None = None, pairs: tuple | None = None, discounts: tuple[float, float] | None = None) -> NgramTrie:
        """From distinct (v, u, w) in ascending order with counts above 0, which may be a part of all.

        ``whole``: (v, total, kinds) of a v that has one u only and of whose w just a part is here. ``pairs``: (v, w, count)
        of the bigrams, ascending, with counts above 0, and the total and kinds of each v from 0, if not those of the trigrams;
        ``discounts``: of bigrams and of trigrams, if not those of these counts.
        """
        if pairs:
            roots = np.flatnonzero(pairs[3])
            size = int(max([1, *(x.max() for x in (w, u, pairs[1]) if len(x))])) + 1
            bi, c2 = np.searchsorted(roots, pairs[0]) * size + pairs[1], pairs[2]
            vi = np.searchsorted(roots, v)
            at2 = np.searchsorted(bi, vi * size + w)
            sums2 = pairs[3][roots], pairs[4][roots]
        else:
            roots, vi = _groups(v)
            size = int(max(w.max(), u.max())) + 1 if len(w) else 1
            bi, at2 = np.unique(vi * size + w, return_inverse=True)
            c2 = np.bincount(at2, count)
            sums2 = None
        bv = bi // size
        cx, atc = _groups(vi * size + u)
        cv = cx // size
        rank = at2 - np.searchsorted(bv, np.arange(len(roots)))[vi]  # in ascending order below each context, as w is
        levels = {
            "roots": Level.of(np.zeros(len(roots), np.int64), roots, 1),
            "bigrams": Level.of(bv, bi % size, len(roots)),
            "contexts": Level.of(cv, cx % size, len(roots)),
            "trigrams": Level.of(atc, rank, len(cx)),
        }
        tables = {}
        for k, (name, parent, c, n) in enumerate((("2", bv, c2, len(roots)), ("3", atc, count, len(cx)))):
            d = discounts[k] if discounts else discount((c == 1).sum(), (c == 2).sum())
            total, kinds = sums2 if sums2 and not k else (np.bincount(parent, c, n), np.bincount(parent, minlength=n))
            if whole:
                at = roots == whole[0] if name == "2" else roots[cv] == whole[0]
                total[at], kinds[at] = whole[1:]
            tables["share" + name], tables["rest" + name] = encode((c - d) / total[parent]), encode(d * kinds / total)
        return cls(levels, tables)

    def query(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a, b) for each, quickest if they ascend: the probability of w after u v is a + b * (its probability without context). -1: unknown id."""
        t = self.tables
        one, index = _groups(v)
        root = self.levels["roots"].find(np.where(one >= 0, 0, -1), one)[0][index]
        bigram, rank = self.levels["bigrams"].find(root, w)
        first = np.concatenate([[True], (v[1:] != v[:-1]) | (u[1:] != u[:-1])]) if len(v) else np.empty(0, bool)
        context = self.levels["contexts"].find(root[first], u[first])[0][np.cumsum(first) - 1]
        trigram, _ = self.levels["trigrams"].find(np.where(rank >= 0, context, -1), rank)
        a, b = np.zeros(len(v)), np.ones(len(v))
        at = root >= 0
        b[at] = decode(t["rest2"][root[at]])
        at = bigram >= 0
        a[at] = decode(t["share2"][bigram[at]])
        at = context >= 0
        rest = decode(t["rest3"][context[at]])
        a[at] *= rest
        b[at] *= rest
        at = trigram >= 0
        a[at] += decode(t["share3"][trigram[at]])
        return a, b

    def arrays(self) -> dict[str, np.ndarray]:
        out = {f"t/{k}": a for k, a in self.tables.items()}
        for k, level in self.levels.items():
            out |= {f"l/{k}/i/{n}": a for n, a in level.ids.arrays().items()} | {f"l/{k}/p/{n}": a for n, a in level.pointers.arrays().items()}
        return out

    def save(self, path: str) -> None:
        """One file: a line of JSON (names, types, places), then the arrays, each at a multiple of 64 bytes."""
        heads, at = [], 0
        for name, a in self.arrays().items():
            heads.append([name, a.dtype.str, len(a), at])
            at += -(-a.nbytes // 64) * 64
        head = json.dumps(heads).encode() + b"\n"
        with open(path, "wb") as out:
            out.write(head + b" " * (-len(head) % 64))
            for a in self.arrays().values():
                out.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 64))

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        """The levels as memory-mapped arrays."""
        with open(path, "rb") as file:
            head = file.readline()
        base = len(head) + -len(head) % 64
        a = {n: np.memmap(path, np.dtype(t), "r", base + at, (size,)) if size else np.empty(0, np.dtype(t)) for n, t, size, at in json.loads(head)}
        part = lambda prefix: EliasFano.from_arrays({k[len(prefix) :]: v for k, v in a.items() if k.startswith(prefix)})
        return cls({k: Level(part(f"l/{k}/i/"), part(f"l/{k}/p/")) for k in cls.KEYS}, {k[2:]: v for k, v in a.items() if k.startswith("t/")})


def mapped(trie: NgramTrie) -> tuple[NgramTrie, str]:
    """The trie from a memory-mapped file in this task's temporary folder, which the caller removes."""
    handle, path = tempfile.mkstemp(suffix=".trie")
    os.close(handle)
    trie.save(path)
    return NgramTrie.open(path), path
