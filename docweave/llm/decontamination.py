"""Benchmark decontamination by pigeonhole edit matching.

A passage within ``k`` edits of a test item contains at least one of any ``k + 1`` pieces of it unchanged. Documents are
scanned for the pieces with one 8-byte probe for each place (a bit table, then exact comparison); around each hit Myers'
bit-parallel distance decides. Items and texts are compared after mapping A-Z to a-z and every run of ASCII characters that
are neither letters nor digits to one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import pieces as parts_of
from ._spark import lean_batches, release, stored, text_bytes
from ._text import string_buffer

_NORMAL = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _NORMAL[_lo:_hi] = np.arange(_lo, _hi)
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)
_MULTIPLY, _BITS = np.uint64(0x9E3779B97F4A7C15), 18


def normalised(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the normalised texts of a string column."""
    data, offsets = string_buffer(column)
    plain = _NORMAL[data]
    space = plain == 0x20
    keep = np.ones(len(plain), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    at = offsets[:-1][offsets[:-1] < len(plain)]
    keep[at] = ~space[at]  # none at the start of a text
    count = np.concatenate([[0], np.cumsum(keep)])
    return plain[keep], count[offsets]


def normalise(text: str | None) -> bytes:
    return normalised(pa.array([text], pa.string()))[0].tobytes().rstrip(b" ")


def myers(pattern: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any part of ``text``, end of the first such part)."""
    m = len(pattern)
    if not m:
        return 0, 0
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = ((((eq & pv) + pv) ^ pv) | eq) & full
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # a match may begin anywhere
        pv = (mh << 1 | (full & ~(xv | ph))) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def budget(size: int, share: float, shortest: int) -> int:
    """Edits allowed in an item of ``size`` bytes: ``share`` of it, but no piece shorter than ``shortest``."""
    return max(0, min(int(size * share), size // shortest - 1))


class Matcher:
    """Pieces of the items, with the table that finds them."""

    def __init__(self, items: list[tuple[int, bytes]], share: float, shortest: int):
        self.items = [(i, t, budget(len(t), share, shortest)) for i, t in items]
        rows = []
        for n, (_, t, k) in enumerate(self.items):
            cut = [len(t) * p // (k + 1) for p in range(k + 2)]
            rows += [(int.from_bytes(t[a : a + 8], "little"), n, a, b) for a, b in zip(cut, cut[1:])]
        rows.sort()
        self.key = np.array([r[0] for r in rows], np.uint64)
        self.piece = [r[1:] for r in rows]
        self.table = np.zeros(1 << _BITS, dtype=bool)
        self.table[(self.key * _MULTIPLY) >> np.uint64(64 - _BITS)] = True

    def hits(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, place of the item's start if nothing before the piece was edited, place of the piece) of every exact piece."""
        n = len(data) - 7
        out: list[tuple[int, int, int]] = []
        data = np.ascontiguousarray(data)
        for lo in range(0, max(0, n), 1 << 21):
            m = min(1 << 21, n - lo)
            probe = np.ndarray((m,), "<u8", data, offset=lo, strides=(1,))
            at = np.flatnonzero(self.table[(probe * _MULTIPLY) >> np.uint64(64 - _BITS)])
            value = probe[at]
            first = np.searchsorted(self.key, value)
            real = first < len(self.key)
            real[real] = self.key[first[real]] == value[real]
            for place, v, r in zip((at[real] + lo).tolist(), value[real].tolist(), first[real].tolist()):
                while r < len(self.key) and int(self.key[r]) == v:
                    item, a, b = self.piece[r]
                    if data[place : place + b - a].tobytes() == self.items[item][1][a:b]:
                        out.append((item, place - a, place))
                    r += 1
        return out

    def matches(self, column) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, passages) for every text and item with a passage within the item's budget."""
        data, offsets = normalised(column)
        places: dict[tuple[int, int], list[int]] = {}
        found = self.hits(data)
        if not found:
            return []
        docs = np.searchsorted(offsets, [at for *_, at in found], side="right") - 1
        for (item, place, _), doc in zip(found, docs.tolist()):
            places.setdefault((doc, item), []).append(place)
        out = []
        for (doc, item), at in places.items():
            _, pattern, k = self.items[item]
            lo, hi = int(offsets[doc]), int(offsets[doc + 1])
            spans: list[list[int]] = []
            for p in sorted(set(at)):
                a, b = max(lo, p - k), min(hi, p + len(pattern) + k)
                if a < b and spans and a <= spans[-1][1]:
                    spans[-1][1] = max(b, spans[-1][1])
                elif a < b:
                    spans.append([a, b])
            near = [d for a, b in spans if b - a >= len(pattern) - k and (d := myers(pattern, data[a:b].tobytes())[0]) <= k]
            if near:
                out.append((doc, item, min(near), len(near)))
        return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.08, shortest: int = 8, item_bytes: int = 8 << 20) -> DataFrame:
    """Documents with a passage within ``share`` of an item's length in edits: doc_id, item_id, distance, budget, passages.

    The items go to every task, where one set of them of at most about ``item_bytes`` is enough; the documents are scanned
    once and never shuffled. More items make rounds, each of which scans the documents and is stored before the next one's
    items are fetched, so that driver and tasks hold the items of one round, however large the benchmark is. Items shorter
    than 8 bytes after normalising, null ones and null or empty texts match nothing; items under 2 * ``shortest`` bytes
    match without edits only; equal items and repeated rows all count; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    lean_batches(docs.sparkSession)
    rounds = parts_of(text_bytes(items), item_bytes)
    out = None
    for r in range(rounds):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == r).collect()  # at most about item_bytes
        known = sorted(((x.item_id, n) for x in rows if len(n := normalise(x.text)) >= 8), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        found = texts.mapInArrow(_scan(known, share, shortest), "doc_id long, item_id long, distance int, budget int, passages int")
        if rounds > 1:
            found = stored(found, "leaks")
        out = found if out is None else out.unionByName(found)
    return out


def _scan(known: list[tuple[int, bytes]], share: float, shortest: int):
    names = ("doc_id", "item_id", "distance", "budget", "passages")
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())

    def scan(batches):
        matcher = Matcher(known, share, shortest)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                rows = matcher.matches(part.column(1)) if known else []
                ids = part.column(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f(*r) for r in rows], t) for f, t in zip((lambda d, *_: ids[d].as_py(), lambda _, n, *x: matcher.items[n][0], lambda _, n, d, p: d, lambda _, n, *x: matcher.items[n][2], lambda _, n, d, p: p), kinds)],
                    names=names,
                )
        release()

    return scan


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that ``find_leaks`` names (all columns kept; rows with a null id are kept only if no
    leaking row has a null id)."""
    leaks = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["_leak"]), "left_anti")
