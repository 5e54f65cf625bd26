"""Best-fit packing of tokenised documents into fixed-length sequences, improved by swap-based local search.

Pieces are packed where they are read: each task fills bins best-fit-decreasing over groups of ``group_pieces`` pieces and
then exchanges pieces between underfull bins (moves, one-for-one, two-for-one) as long as that raises the sum of squared
fills, which drains some bins until they are empty. What is left in underfull bins goes through one small shuffle and is
packed again, so that splitting the work over many tasks costs next to nothing.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import pieces as parts_of
from ._spark import lean_batches, release, stored
from .tokenise import encoder


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit-decreasing: bins of indices into ``sizes``. Bins are looked up by free space in one bit mask."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        if m := mask >> size:
            room = (m & -m).bit_length() - 1 + size
            b = free[room].pop()
            if not free[room]:
                mask ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if left := room - size:
            free[left].append(b)
            mask |= 1 << left
    return bins


def _exchange(a: list[int], b: list[int], sizes: list[int], fa: int, fb: int, capacity: int) -> tuple[list[int], list[int]] | None:
    """The exchange between bin a (at least as full) and b that raises fa**2 + fb**2 most: pieces to take from (a, b)."""
    room, best, found = capacity - fa, 0, None
    for j in b:  # a move: b's piece into a
        if best < sizes[j] <= room:
            best, found = sizes[j], ([], [j])
    if best == room:
        return found
    for j in b:
        for i in a:  # one for one
            gain = sizes[j] - sizes[i]
            if best < gain <= room:
                best, found = gain, ([i], [j])
    if best == room:
        return found
    for few, many, flip in ((a, b, False), (b, a, True)):  # two for one, either way round
        for x in range(len(many)):
            for y in range(x):
                pair = sizes[many[x]] + sizes[many[y]]
                for k in few:
                    gain = sizes[k] - pair if flip else pair - sizes[k]
                    if best < gain <= room:
                        best, found = gain, (([many[x], many[y]], [k]) if flip else ([k], [many[x], many[y]]))
    return found


def local_search(bins: list[list[int]], sizes: list[int], capacity: int, most: int = 48) -> list[list[int]]:
    """Exchange pieces between underfull bins while the sum of squared fills rises; empty bins go.

    Fills are integers below a bound and each exchange raises the sum, so the search ends; ``most`` neighbouring bins (by
    fill) are searched together, with neighbourhoods half of that further on in every other round, until a round of either
    kind has changed nothing.
    """
    full = [b for b in bins if sum(sizes[i] for i in b) == capacity]
    work = [b for b in bins if sum(sizes[i] for i in b) != capacity]
    turn = idle = 0
    while idle < 2:
        changed = False
        work.sort(key=lambda b: (-sum(sizes[i] for i in b), b))
        cuts = [0, *range(most // 2 if turn % 2 else most, len(work), most), len(work)]
        for lo, hi in zip(cuts, cuts[1:]):
            block = work[lo:hi]
            fills = [sum(sizes[i] for i in b) for b in block]
            for t in range(len(block) - 1, 0, -1):  # drain the emptiest first
                for k in range(t):
                    x, y = (k, t) if fills[k] >= fills[t] else (t, k)
                    while block[y] and fills[x] < capacity and (take := _exchange(block[x], block[y], sizes, fills[x], fills[y], capacity)):
                        out_x, out_y = take
                        for i in out_x:
                            block[x].remove(i)
                        for i in out_y:
                            block[y].remove(i)
                        block[x] += out_y
                        block[y] += out_x
                        moved = sum(sizes[i] for i in out_y) - sum(sizes[i] for i in out_x)
                        fills[x] += moved
                        fills[y] -= moved
                        changed = True
                        if fills[x] < fills[y]:
                            x, y = y, x
        work = [b for b in work if b]
        turn, idle = turn + 1, 0 if changed else idle + 1
    return full + work


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    return local_search(best_fit(sizes, capacity), sizes, capacity)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, spaces_matter: bool = False, payload: str = "ids", group_pieces: int = 40_000, loose: float = 1 / 64) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, sequence_id, offset and the payload.

    A document is its ids and then ``end_id``; null texts are empty (``end_id`` alone). Only longer documents than
    ``capacity`` are cut, into full pieces and a last one that may be shorter. ``payload``: "ids" (little-endian uint32
    bytes), or "ids_crc32" (their checksum, a long) where the ids themselves aren't wanted. Rows with equal or null ids are
    documents of their own; other columns are ignored; an empty table gives no rows. Pieces that stay in bins with more than
    ``loose`` of their room free are packed again together.
    """
    if payload not in ("ids", "ids_crc32"):
        raise ValueError("payload is ids or ids_crc32")
    kind = pa.binary() if payload == "ids" else pa.int64()
    names = ["doc_id", "piece", "start", "length", payload, "sequence_id", "offset"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), kind, pa.int64(), pa.int64()])))
    ddl = f"doc_id long, piece int, start long, length long, {payload} {'binary' if payload == 'ids' else 'long'}, sequence_id long, offset long"
    floor = int(capacity * (1 - loose))

    def rows(held: list[tuple], base: int, hold_back: bool) -> list[tuple[list[tuple], int]]:
        sizes = [h[3] for h in held]
        out, n = [], base
        for b in pack(sizes, capacity):
            keep = not hold_back or sum(sizes[i] for i in b) >= floor
            at = 0
            for i in b:
                out.append((*held[i], n if keep else None, at if keep else None))
                at += sizes[i]
            n += keep
        return out, n

    def batches_of(out: list[tuple]):
        for i in range(0, len(out), 20_000 if payload != "ids" else 2_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + (20_000 if payload != "ids" else 2_000)]), schema.types)], schema=schema)

    def read(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        code, end = encoder(tokenizer_path, spaces_matter), struct.pack("<I", end_id)
        value = (lambda x: x) if payload == "ids" else zlib.crc32
        held: list[tuple] = []
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1)
            for i in range(0, batch.num_rows, 512):
                texts = [t or "" for t in column.slice(i, 512).to_pylist()]
                for key, got in zip(ids[i : i + 512], code.encode_many(texts), strict=True):
                    got += end
                    n, whole = len(got) // 4, []
                    for p, at in enumerate(range(0, n, capacity)):
                        part = got[4 * at : 4 * (at + capacity)]
                        piece = (key, p, at, len(part) // 4, value(part))
                        if piece[3] == capacity:
                            whole.append((*piece, base, 0))
                            base += 1
                        else:
                            held.append(piece)
                    yield from batches_of(whole)
                if len(held) >= group_pieces:
                    out, base = rows(held, base, True)
                    yield from batches_of(out)
                    held = []
        out, base = rows(held, base, True)
        yield from batches_of(out)
        del out, held
        release()

    def again(table: pa.Table) -> pa.Table:
        group = table.column("g")[0].as_py()
        held = sorted(zip(*(table.column(n).to_pylist() for n in names[:5])), key=lambda h: (h[0] is None, h[0] or 0, h[1], h[4]))
        out, _ = rows(held, (1 << 62) + (group << 36), False)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    lean_batches(docs.sparkSession)
    first = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(read, ddl), "packed")
    left = first.filter("sequence_id is null")
    groups = parts_of(left.count(), group_pieces)
    second = left.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups))).groupBy("g").applyInArrow(again, ddl)
    return first.filter("sequence_id is not null").unionByName(second)
