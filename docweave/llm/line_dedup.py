"""Fuzzy line deduplication by MinHash.

1. Equal lines: each batch sends its distinct lines' hashes to shards, which answer whose occurrence is the first of all.
2. Only first occurrences are signed: minima of their character shingles under ``bands * rows`` hashes; the bands' keys go to
   shards, which answer those that several lines share.
3. Lines with a shared band are verified by exact Jaccard similarity of their shingle sets (in blocks of bounded size), and
   the links joined by distributed union-find; of each component the earliest line stays.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import MOST, links
from ._components import components
from ._route import answer, ask, batches, ddl, deltas, finish, narrow, pack, runs, sized, to_shards, undelta, unpack
from ._spark import pieces, stored, text_bytes
from ._text import SPACE, distinct_pairs, mix, multipliers, string_buffer

_NO_ID = 2**63 - 1
_NEWLINE = 0x0A
_FIRST_BYTES = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


class Lines:
    """Lines of a column of texts (cut at each new-line; a null text has none): bytes, bounds, text and place in it."""

    def __init__(self, column):
        self.data, self.offsets = string_buffer(column)
        valid = np.concatenate([np.asarray(c.is_valid()) for c in column.chunks]) if isinstance(column, pa.ChunkedArray) and column.num_chunks else np.asarray(column.is_valid())
        cuts = np.flatnonzero(self.data == _NEWLINE)
        texts = np.flatnonzero(valid)
        self.start = np.concatenate([self.offsets[:-1][texts], cuts + 1])
        self.doc = np.concatenate([texts, np.searchsorted(self.offsets, cuts, side="right") - 1])
        order = np.lexsort((self.start, self.doc))
        self.start, self.doc = self.start[order], self.doc[order]
        last = np.ones(len(self.doc), bool)
        last[:-1] = self.doc[1:] != self.doc[:-1]
        self.end = np.where(last, self.offsets[1:][self.doc], np.append(self.start[1:], 0) - 1)
        first = np.searchsorted(self.doc, np.arange(len(self.offsets)))
        self.first, self.number = first, np.arange(len(self.doc)) - first[self.doc]
        self.blank = self.end == self.start
        for i in np.flatnonzero(~self.blank & SPACE[self.data[np.minimum(self.start, len(self.data) - 1)]]).tolist() if len(self.data) else []:
            self.blank[i] = SPACE[self.data[self.start[i] : self.end[i]]].all()

    def hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of the lines' 128-bit XXH3 hashes: what tells lines apart."""
        from xxhash import xxh3_128_digest

        raw = self.data.tobytes()
        digests = b"".join([xxh3_128_digest(raw[a:b]) for a, b in zip(self.start[at].tolist(), self.end[at].tolist())])
        both = np.frombuffer(digests, "<u8").reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()

    def shingles(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(64-bit hashes, first place of each line) of the shingles of ``size`` characters of the lines ``at``, ascending and
        none empty; a shorter line is one itself."""
        lo, hi = int(self.start[at[0]]), int(self.end[at[-1]])
        head = np.append(np.flatnonzero(self.data[lo:hi] & 0xC0 != 0x80), hi - lo)  # where characters begin
        window = np.ndarray((hi - lo,), "<u4", np.append(self.data[lo:hi], np.zeros(3, np.uint8)), strides=(1,))
        code = (window[head[:-1]] & _FIRST_BYTES[np.minimum(np.diff(head), 4)]).astype(np.uint64)  # a character's bytes as a number
        code += np.uint64(1)
        start, end = np.searchsorted(head, self.start[at] - lo), np.searchsorted(head, self.end[at] - lo)
        by, whole = multipliers(0, size), np.zeros(max(0, len(code) - size + 1), np.uint64)
        for j in range(size):
            whole += code[j : j + len(whole)] * by[j]
        count = np.maximum(end - start - size + 1, 1)
        first = np.cumsum(count) - count
        place = np.arange(int(count.sum())) - np.repeat(first - start, count)
        value = np.append(whole, np.zeros(size, np.uint64))[place]
        for i in np.flatnonzero(end - start < size).tolist():
            own = code[start[i] : end[i]]
            value[first[i]] = (own * by[: len(own)]).sum(dtype=np.uint64)
        return mix(value, 5), first


def signature_bands(value: np.ndarray, first: np.ndarray, bands: int, rows: int, seed: int = 11) -> np.ndarray:
    """(line, band) keys: 64-bit hashes of each band's minima."""
    rng = np.random.Generator(np.random.PCG64(seed))
    factors = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    small = (value >> np.uint64(32)).astype(np.uint32)
    keys = np.zeros((len(first), bands), np.uint64)
    for b in range(bands):
        for r in range(rows):
            least = np.minimum.reduceat(small * factors[b * rows + r], first)
            keys[:, b] = mix(keys[:, b] ^ least, 2 + b)
    return keys


def _distinct(rows: pa.Table):
    """Lines, and of the distinct ones that aren't blank: place of the first and both hashes; by hash. Also all places."""
    lines = Lines(rows.column("text"))
    ids = np.array([_NO_ID if i is None else i for i in rows.column("doc_id").to_pylist()], np.int64)
    solid = np.flatnonzero(~lines.blank)
    one, two = lines.hashes(solid)
    order = np.lexsort((lines.number[solid], lines.doc[solid], ids[lines.doc[solid]], two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    firsts = order[new]
    return lines, ids, solid[firsts], one[firsts], two[firsts], solid


def _ask_equal(shards: int):
    def fn(batch, rows, _):
        lines, ids, at, one, two, _ = _distinct(rows)
        order, parts = to_shards((one % np.uint64(shards)).astype(np.int64))
        for shard, a, b in parts:
            mine = at[order[a:b]]
            yield shard, pack(one[order[a:b]], two[order[a:b]], ids[lines.doc[mine]], narrow(lines.doc[mine]), narrow(lines.number[mine]))

    return fn


def _first_of_all(shard, asked):
    got = [(b, unpack(p)) for b, p in asked]
    one, two, ids = (np.concatenate([g[k] for _, g in got]) for k in (0, 1, 2))
    doc, number = (np.concatenate([g[k].astype(np.int64) for _, g in got]) for k in (3, 4))
    batch = np.repeat(np.arange(len(got)), [len(g[0]) for _, g in got])
    order = np.lexsort((number, doc, batch, ids, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    owner = np.zeros(len(order), bool)
    owner[order[new]] = True
    at = 0
    for b, g in got:
        yield b, pack(np.packbits(owner[at : at + len(g[0])]))
        at += len(g[0])


def _owned(one: np.ndarray, shards: int, got) -> np.ndarray:
    """Which of the batch's distinct lines are the first of all."""
    order, parts = to_shards((one % np.uint64(shards)).astype(np.int64))
    told, out = dict(got), np.zeros(len(one), bool)
    for shard, a, b in parts:
        out[order[a:b]] = np.unpackbits(unpack(told[shard])[0])[: b - a].astype(bool)
    return out


def _ask_bands(size: int, bands: int, rows_: int, shards: int):
    def fn(batch, rows, got):
        lines, _, at, one, _, solid = _distinct(rows)
        at = np.sort(at[_owned(one, shards, got)])
        repeat = np.zeros(len(lines.doc), bool)
        repeat[solid] = True
        repeat[at] = False
        yield -2 - batch, pack(np.packbits(repeat))  # comes back to this batch as it is
        if not len(at):
            return
        keys = np.concatenate([signature_bands(*lines.shingles(part, size), bands, rows_) for part in _parts(lines, at)]).ravel()
        line = np.repeat(at, bands)
        order, parts = to_shards((keys % np.uint64(shards)).astype(np.int64))
        for shard, a, b in parts:
            yield shard, pack(deltas(line[order[a:b]]), keys[order[a:b]])

    return fn


def _parts(lines: Lines, at: np.ndarray, most: int = 2 << 20):
    """``at`` (ascending) in runs of lines that begin within ``most`` bytes of the batch."""
    for _, a, b in runs(lines.start[at] // most):
        yield at[a:b]


def _shared_bands(shard, asked):
    if shard < 0:
        yield from asked
        return
    got = [(b, unpack(p)) for b, p in asked]
    keys = np.concatenate([g[1] for _, g in got])
    _, index, count = np.unique(keys, return_inverse=True, return_counts=True)
    shared = count[index] > 1
    at = 0
    for b, g in got:
        mine = shared[at : at + len(g[1])]
        at += len(g[1])
        if mine.any():
            yield b, pack(deltas(undelta(g[0])[mine]), g[1][mine])


def _item(batch: int, line: int) -> int:
    """A number of its own for each line of each batch (read by up to 2^20 tasks, of up to 2^14 batches each)."""
    return batch >> 32 << 43 | (batch & 0xFFFFFFFF) << 29 | line


def _candidates():
    kinds = [("item", pa.int64()), ("batch", pa.int64()), ("id", pa.int64()), ("line", pa.int64()), ("keys", pa.binary()), ("content", pa.binary())]

    def fn(batch, rows, got):
        out: list[tuple] = []
        x = [unpack(p) for s, p in got if s >= 0]
        if x:
            line, keys = np.concatenate([undelta(g[0]).astype(np.int64) for g in x]), np.concatenate([g[1] for g in x])
            order = np.argsort(line, kind="stable")
            line, keys = line[order], keys[order]
            lines = Lines(rows.column("text"))
            ids = rows.column("doc_id").to_pylist()
            places = runs(line)
            for p, a, b in places:
                i = ids[int(lines.doc[p])]
                out.append((_item(batch, p), batch, _NO_ID if i is None else i, p, keys[a:b].tobytes(), lines.data[lines.start[p] : lines.end[p]].tobytes()))
        out += [(None, batch, None, None, None, p) for s, p in got if s < 0]  # the repeats, for the last pass
        cols = list(zip(*out)) if out else [[]] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, kinds)], schema=pa.schema(kinds))

    return fn


def _line_sets(size: int):
    def fn(rows: pa.Table):
        lines = Lines(rows.column("content").cast(pa.string()))
        value, first = lines.shingles(np.arange(len(lines.doc)), size)
        count = np.diff(np.append(first, len(value)))
        doc, value = distinct_pairs(np.repeat(np.arange(len(count)), count), value)
        bounds = np.searchsorted(doc, np.arange(len(count) + 1))
        return value, bounds, np.diff(bounds)

    return fn


def _kept(batch, rows, got):
    """Each text without its removed lines and a new-line for each."""
    lines = Lines(rows.column("text"))
    removed = np.zeros(len(lines.doc), bool)
    for shard, p in got:
        if shard < -1:
            removed = np.unpackbits(unpack(p)[0])[: len(removed)].astype(bool)
    removed[[struct.unpack("<q", p)[0] for shard, p in got if shard == -1]] = True
    n = len(lines.offsets) - 1
    count = np.bincount(lines.doc[removed], minlength=n)
    keep = np.ones(len(lines.data), bool)
    last = np.append(lines.doc[1:] != lines.doc[:-1], True) if len(lines.doc) else removed
    for a, b in zip(lines.start[removed].tolist(), (lines.end + ~last)[removed].tolist()):
        keep[a:b] = False
    tail = np.full(n, -1)  # the last line that a text keeps; if others came after it, its new-line goes
    np.maximum.at(tail, lines.doc[~removed], np.flatnonzero(~removed))
    tail = tail[tail >= 0]
    tail = tail[~last[tail]]
    tail = tail[removed[np.minimum(tail + 1, len(removed) - 1)]]
    keep[lines.end[tail]] = False
    size = np.concatenate([[0], np.cumsum(keep)])[lines.offsets]
    text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(size), pa.py_buffer(lines.data[keep].tobytes())).cast(pa.string())
    column = rows.column("text")
    whole = pa.concat_arrays(column.is_valid().chunks) if column.num_chunks else pa.array([], pa.bool_())
    rows = rows.set_column(rows.schema.get_field_index("text"), pa.field("text", pa.string()), pc.if_else(whole, text, pa.nulls(n, pa.string())))
    return rows.append_column("n_lines", pa.array(np.diff(lines.first), pa.int64())).append_column("n_removed", pa.array(count, pa.int64()))


def dedup_lines(docs: DataFrame, size: int = 8, bands: int = 10, rows: int = 4, num: int = 80, den: int = 100, most: int = MOST, batch_bytes: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any more) without repeated lines; adds n_lines (before) and n_removed.

    Lines are similar if the Jaccard similarity of their sets of shingles of ``size`` characters is at least num / den; equal and similar lines form components, of which the line of the smallest (doc_id, row, line) stays. At that
    similarity a pair shares a band with probability 1 - (1 - (num / den) ** rows) ** bands (0.995), above it with more.
    Blank lines stay and join nothing; a line shorter than a shingle is similar to equal ones only. Null texts stay null;
    rows with a null id come last. Columns named n_lines or n_removed are replaced, others kept.
    """
    docs = docs.drop("n_lines", "n_removed").withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    total = text_bytes(docs)
    each = batch_bytes or sized(total, 8 << 20)
    shards = pieces(total, each)
    held = batches(docs, each)
    equal = answer(ask(held, _ask_equal(shards)), _first_of_all)
    near = answer(ask(held, _ask_bands(size, bands, rows, shards), equal), _shared_bands)
    found = stored(finish(held, near, _candidates(), "item long, batch long, id long, line long, keys binary, content binary"), "lines")
    near_lines = found.where("item is not null")
    groups = components(links(near_lines.select("item", "keys", "content", F.length("content").alias("weight")), _line_sets(size), num, den, most))
    place = F.struct("id", "batch", "line")
    placed = near_lines.select("item", "batch", "line", place.alias("place")).join(groups, F.col("item") == F.col("node")).select("batch", "line", "place", "component")
    least = placed.groupBy("component").agg(F.min("place").alias("least"))
    lost = placed.join(least, "component").where(F.col("place") != F.col("least"))
    told = lost.select(F.lit(-1).cast("long").alias("shard"), "batch", _little_endian(F.col("line")).alias("payload"))
    back = found.where("item is null").select(F.lit(-2).cast("long").alias("shard"), "batch", F.col("content").alias("payload")).unionByName(told)
    return finish(held, back, _kept, ddl(docs, "n_lines long", "n_removed long"))


def _little_endian(value):
    """A long as eight bytes, least significant first."""
    digits = F.lpad(F.hex(value), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * k, 2) for k in range(8)]))
