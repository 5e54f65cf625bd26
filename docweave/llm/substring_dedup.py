"""Exact substring deduplication behind a count-min prefilter.

Pass 1: every batch of documents sends the sketch of its windows, in sparse form, to shards of the hash space; a shard
merges them into one count-min sketch and answers which windows it estimates to occur twice or more. It may overestimate but
never misses one. Pass 2: of those windows each batch's earliest travels with its full hashes (two independent ones of 64
bits) and place; they are grouped exactly, and all but the earliest of each group are reported back. Pass 3: covered words
go. A window that very many documents share so moves once for each batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._route import answer, ask, batches, ddl, deltas, finish, narrow, pack, runs, sized, undelta, unpack
from ._spark import pieces, text_bytes
from ._text import Words, starts_of_windows, windows

_ODD = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)
_NO_ID = 2**63 - 1


class Sketch:
    """Count-min over 32-bit fingerprints, counters saturating at 255."""

    def __init__(self, size: int, depth: int = 4):
        self.bits = min(26, max(8, int(2 * size).bit_length()))
        self.rows = np.zeros((depth, 1 << self.bits), np.uint8)

    def _cell(self, prints: np.ndarray, row: int) -> np.ndarray:
        return (prints * _ODD[row] ^ (prints >> np.uint32(15)) * _ODD[row - 1]) >> np.uint32(32 - self.bits)

    def merge(self, prints: np.ndarray, times: np.ndarray) -> None:
        """Add partitions' sketches, given as the fingerprints counted in them and how often."""
        for k, row in enumerate(self.rows):
            counts = np.bincount(self._cell(prints, k), times, minlength=len(row))
            np.minimum(counts + row, 255, out=row, casting="unsafe")

    def estimate(self, prints: np.ndarray) -> np.ndarray:
        least = self.rows[0][self._cell(prints, 0)]
        for k in range(1, len(self.rows)):
            np.minimum(least, self.rows[k][self._cell(prints, k)], out=least)
        return least


def _windows(rows: pa.Table, size: int, shards: int):
    """Words, window starts, first hash, and the order by (shard, fingerprint) with its runs."""
    words = Words(rows.column("text"), lower=False, hashes=2)
    starts = starts_of_windows(words.first, size)
    h = windows(words.hash[0], size, 0)[starts] if len(starts) else np.empty(0, np.uint64)
    shard = (h & np.uint64(0xFFFFFFFF)) % np.uint64(shards)
    prints = (h >> np.uint64(32)).astype(np.uint32)
    order = np.argsort(shard << np.uint64(32) | prints, kind="stable")
    return words, starts, h, prints, order, runs(shard[order].astype(np.int64))


def _sketch(size: int, shards: int):
    def fn(batch, rows, _):
        _, _, _, prints, order, parts = _windows(rows, size, shards)
        for shard, a, b in parts:  # a window that the batch repeats counts twice there, which is all that matters
            one, count = np.unique(prints[order[a:b]], return_counts=True)
            yield shard, pack(deltas(one), np.minimum(count, 2).astype(np.uint8))

    return fn


def _estimate(shard, asked):
    got = [(b, *unpack(p)) for b, p in asked]
    got = [(b, undelta(x).astype(np.uint32), n) for b, x, n in got]
    sketch = Sketch(sum(len(x) for _, x, _ in got))
    sketch.merge(np.concatenate([x for _, x, _ in got]), np.concatenate([n for _, _, n in got]))
    for b, prints, _ in got:
        yield b, pack(np.packbits(sketch.estimate(prints) >= 2))


def _candidates(size: int, shards: int):
    def fn(batch, rows, got):
        words, starts, h, prints, order, parts = _windows(rows, size, shards)
        masks = dict(got)
        ids = np.array([_NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()], np.int64)
        second = windows(words.hash[1], size, 1)[starts] if len(starts) else h
        doc = np.searchsorted(words.first, starts, side="right") - 1
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        repeated = []
        for shard, a, b in parts:
            own = order[a:b]
            new = np.ones(b - a, bool)
            new[1:] = prints[own[1:]] != prints[own[:-1]]
            mask = np.unpackbits(unpack(masks[shard])[0])[: int(new.sum())].astype(bool)[np.cumsum(new) - 1]
            at = own[mask]
            if not len(at):
                continue
            at = at[np.lexsort((starts[at], rank[doc[at]], second[at], h[at]))]
            first = np.ones(len(at), bool)
            first[1:] = (h[at[1:]] != h[at[:-1]]) | (second[at[1:]] != second[at[:-1]])
            repeated.append(at[~first])  # only the batch's earliest goes on; the others have one before them here
            at = np.sort(at[first])
            docs, index = np.unique(doc[at], return_inverse=True)
            yield shard, pack(h[at], second[at], deltas(at), narrow(index), narrow(starts[at] - words.first[doc[at]]), ids[docs], narrow(docs))
        if repeated and len(own := np.sort(np.concatenate(repeated))):
            yield -1 - batch, pack(deltas(own))  # comes back to this batch as it is

    return fn


def _earliest(shard, asked):
    if shard < 0:
        yield from asked
        return
    got = [(b, unpack(p)) for b, p in asked]
    docs = np.concatenate([np.stack([g[5], np.full(len(g[5]), k), g[6]], 1).astype(np.int64) for k, (_, g) in enumerate(got)])
    rank = np.empty(len(docs), np.uint64)
    rank[np.lexsort((docs[:, 2], docs[:, 1], docs[:, 0]))] = np.arange(len(docs), dtype=np.uint64)
    sizes = [len(g[0]) for _, g in got]
    base = np.cumsum([0] + [len(g[5]) for _, g in got])
    place = np.concatenate([rank[g[3].astype(np.int64) + base[k]] << np.uint64(32) | g[4].astype(np.uint64) for k, (_, g) in enumerate(got)])
    h, check = np.concatenate([g[0] for _, g in got]), np.concatenate([g[1] for _, g in got])
    order = np.lexsort((place, check, h))
    later = np.zeros(len(h), bool)
    same = (h[order[1:]] == h[order[:-1]]) & (check[order[1:]] == check[order[:-1]])
    later[order[1:][same]] = True
    at = 0
    for (b, g), n in zip(got, sizes):
        if (mine := later[at : at + n]).any():
            yield b, pack(deltas(undelta(g[2])[mine]))
        at += n


def kept_text(words: Words, removed: np.ndarray) -> pa.Array:
    """Each text's words that are not ``removed``, joined by one space."""
    keep = ~removed
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[words.start[keep]] += 1
    edge[words.end[keep]] -= 1
    body = words.data[np.cumsum(edge[:-1]).astype(bool)]
    doc, length = words.doc()[keep], (words.end - words.start)[keep]
    follows = np.zeros(len(doc), bool)
    follows[1:] = doc[1:] == doc[:-1]
    at = np.cumsum(length) - length
    body = np.insert(body, at[follows], 0x20)
    sizes = np.bincount(doc, length + follows, minlength=len(words.offsets) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(body.tobytes())).cast(pa.string())


def _removal(size: int):
    def fn(batch, rows, got):
        words = Words(rows.column("text"), lower=False)
        starts = starts_of_windows(words.first, size)
        edge = np.zeros(len(words) + 1, np.int32)
        for _, payload in got:
            at = starts[undelta(unpack(payload)[0]).astype(np.int64)]
            edge[at] += 1
            edge[at + size] -= 1
        removed = np.cumsum(edge[:-1]) > 0
        count = np.diff(np.concatenate([[0], np.cumsum(removed)])[words.first])
        place = rows.schema.get_field_index("text")
        rows = rows.set_column(place, pa.field("text", pa.string()), kept_text(words, removed))
        return rows.append_column("n_words", pa.array(words.counts, pa.int64())).append_column("n_removed", pa.array(count, pa.int64()))

    return fn


def remove_repeats(docs: DataFrame, window: int = 20, batch_bytes: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any more) with each word removed that a repeated window covers, if the window's sequence of
    words also starts earlier: in a smaller doc_id, or in the same document before. Adds n_words (before) and n_removed.

    ``text`` becomes the kept words joined by one space. Windows are judged on the input. Null texts have no words and become
    empty; shorter texts than the window stay whole. Rows with a null id come last; of rows with equal ids the one read
    first is earlier. Columns named n_words or n_removed are replaced.
    """
    docs = docs.drop("n_words", "n_removed").withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    total = text_bytes(docs)
    each = batch_bytes or sized(total)
    shards = pieces(total, each)
    held = batches(docs, each)
    estimated = answer(ask(held, _sketch(window, shards)), _estimate)
    later = answer(ask(held, _candidates(window, shards), estimated), _earliest)
    return finish(held, later, _removal(window), ddl(docs, "n_words long", "n_removed long"))
