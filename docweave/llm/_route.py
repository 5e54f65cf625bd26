"""Key routing: documents ask questions about keys that occur anywhere in the corpus.

Documents are bundled into batches (compressed Arrow tables of about ``batch_bytes`` of text), which are shuffled once. A
batch sends the keys of its texts, as packed arrays, to shards by key; a shard sees all occurrences of its keys and answers
each batch in the order in which it asked; the batch joins its answers. What moves is a few bytes for each key, no task
holds more than a batch or a shard, and no key's occurrences are paired with each other. With batches and shards of b bytes
of text, a payload stands for about b * b / (all bytes) of it, so batches grow with the root of the input (``sized``).

Batches are numbered by the tasks that read the documents, and answers refer to those numbers, so a batch that is made again
must hold the same rows in the same order: what isn't plainly read from a table is stored first (``steady``).
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._spark import lean_batches, release, steady

MOST_BYTES = 256 << 20
Answers = list[tuple[int, bytes]]


def sized(total: int, least: int = 12 << 20) -> int:
    """Bytes of text in a batch for ``total`` bytes of input: enough for payloads of some 2,000 words, from ``least`` to
    what a Python worker can hold."""
    return max(least, min(MOST_BYTES, math.isqrt(12_800 * total)))


def narrow(a: np.ndarray) -> np.ndarray:
    """The array in the smallest unsigned type that holds it."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def deltas(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending array of unsigned integers, narrow; ``undelta`` is its inverse."""
    out = a.astype(np.uint64)
    out[1:] -= out[:-1].copy()
    return narrow(out)


def undelta(a: np.ndarray) -> np.ndarray:
    return np.cumsum(a, dtype=np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstandard frame, byte planes apart."""
    import zstandard

    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        head.append(struct.pack("<cBq", a.dtype.kind.encode(), a.dtype.itemsize, len(a)))
        body.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(payload: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    heads = [struct.unpack_from("<cBq", raw, 1 + 10 * k) for k in range(raw[0])]
    at, out = 1 + 10 * raw[0], []
    for kind, size, n in heads:
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"{kind.decode()}{size}"))
        at += n * size
    return out


def batches(docs: DataFrame, batch_bytes: int, column: str = "text") -> DataFrame:
    """(batch, rows): documents in compressed batches, dealt by batch."""
    place = docs.columns.index(column)
    lean_batches(docs.sparkSession)
    docs = steady(docs)

    def bundle(parts):
        from pyspark import TaskContext

        base, n, held, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for part in parts:
            lengths = _bytes_of(part.column(place))
            i = 0
            while i < part.num_rows:
                room = np.searchsorted(np.cumsum(lengths[i:]), batch_bytes - size, side="right")
                j = min(part.num_rows, i + max(1 if not held else 0, int(room)))
                if j > i:
                    held.append(part.slice(i, j - i))
                    size += int(lengths[i:j].sum())
                    i = j
                if i < part.num_rows:
                    yield _bundle(base + n, held)
                    held, size, n = [], 0, n + 1
        if held:
            yield _bundle(base + n, held)
        held = []
        release()

    return docs.mapInArrow(bundle, "batch long, rows binary").repartition("batch")


def _bytes_of(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64


def _bundle(batch: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    import zstandard

    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, parts[0].schema) as out:
        for p in parts:
            out.write_batch(p)
    rows = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([rows], pa.binary())], names=["batch", "rows"])


def opened(rows: bytes) -> pa.Table:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(rows)
    return pa.ipc.open_stream(pa.py_buffer(raw)).read_all()


_SENT = pa.schema([("shard", pa.int64()), ("batch", pa.int64()), ("payload", pa.binary())])
_SENT_DDL = "shard long, batch long, payload binary"


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], t.type) for k, t in enumerate(_SENT)], schema=_SENT)


def ask(held: DataFrame, fn: Callable[[int, pa.Table, Answers], Iterable[tuple[int, bytes]]], answers: DataFrame | None = None) -> DataFrame:
    """(shard, batch, payload): what ``fn(batch, rows, answers so far)`` sends to shards."""
    if answers is not None:
        return finish(held, answers, lambda b, rows, got: _sent([(s, b, p) for s, p in fn(b, rows, got)]), _SENT_DDL)

    def each(parts):
        for part in parts:
            for b, rows in zip(part.column(0).to_pylist(), part.column(1)):
                yield from _sent([(s, b, p) for s, p in fn(b, opened(rows.as_py()), [])]).to_batches()
                release()

    return held.mapInArrow(each, _SENT_DDL)


def answer(asked: DataFrame, fn: Callable[[int, Answers], Iterable[tuple[int, bytes]]], schema: str | None = None) -> DataFrame:
    """Each shard's ``fn(shard, [(batch, payload)])`` gives (batch, payload) answers, or with ``schema`` an Arrow table."""

    def each(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        got = sorted(zip(table.column("batch").to_pylist(), table.column("payload").to_pylist()))
        out = fn(shard, got)
        out = out if schema else _sent([(shard, b, p) for b, p in out])
        del got
        release()
        return out

    return asked.groupBy("shard").applyInArrow(each, schema or _SENT_DDL)


def answer_told(asked: DataFrame, told: DataFrame, fn: Callable[[int, Answers, pa.Table], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """As ``answer``, by ``fn(shard, [(batch, payload)], the shard's rows of told)``; every shard needs such a row."""

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        shard = left.column("shard")[0].as_py()
        got = sorted(zip(left.column("batch").to_pylist(), left.column("payload").to_pylist()))
        out = _sent([(shard, b, p) for b, p in fn(shard, got, right)])
        del got
        release()
        return out

    return asked.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(each, _SENT_DDL)


def finish(held: DataFrame, answers: DataFrame, fn: Callable[[int, pa.Table, Answers], pa.Table], schema: str) -> DataFrame:
    """``fn(batch, rows, [(shard, payload)])`` for every batch with all its answers, in order of shards."""

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        batch, rows = left.column("batch")[0].as_py(), left.column("rows")[0].as_py()
        got = sorted(zip(right.column("shard").to_pylist(), right.column("payload").to_pylist()))
        out = fn(batch, opened(rows), got)
        del got, rows
        release()
        return out

    return held.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(each, schema)


def to_shards(shard: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Stable order by shard, and (shard, from, to) in that order."""
    order = np.argsort(shard, kind="stable")
    return order, runs(shard[order])


def runs(a: np.ndarray) -> list[tuple[int, int, int]]:
    """(value, from, to) of the runs of equal values."""
    if not len(a):
        return []
    cut = np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]])
    return list(zip(a[cut[:-1]].tolist(), cut[:-1].tolist(), cut[1:].tolist()))


def ddl(df: DataFrame, *more: str) -> str:
    """The schema of ``df`` as text, with further columns."""
    return ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))
