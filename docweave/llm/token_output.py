"""Token-ID output: independent zstandard frames, a trailing seek table, a checksum for each frame.

File format (one file for each range of documents, all integers little-endian):

* frames: each an independent zstandard frame whose content is the uint32 ids of consecutive whole documents
  (a document longer than ``frame_bytes`` makes a frame of its own);
* index: one more zstandard frame, a list of int64 quadruples (document key, frame, first id within the frame, ids), sorted
  as the documents are stored; it comes last among the frames;
* seek table: a skippable frame (magic 0x184D2A5E, size) with, for each frame, compressed size, content size and the low 32
  bits of the content's XXH64, then frames (uint32), a descriptor byte (0x80: checksums) and the magic 0x8F92EAB1: the
  public seekable format, so that ordinary zstandard tools read the files too.

A reader takes the seek table from the end of the file, then the index, then only the frames that hold the wanted documents.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import fresh_path, lean_batches, pieces, stored, text_bytes
from .tokenise import encoder

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
NULL_KEY = -(2**63)


def _xxh32(content: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class FrameWriter:
    """Writes one file; ``out`` is any binary file object."""

    def __init__(self, out, frame_bytes: int = 1 << 20, level: int = 3):
        import zstandard

        self.out, self.frame_bytes = out, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int]] = []
        self.held: list[bytes] = []
        self.size = self.n_tokens = 0

    def add(self, key: int, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.index.append((key, len(self.table), self.size // 4, len(ids) // 4))
        self.held.append(ids)
        self.size += len(ids)
        self.n_tokens += len(ids) // 4

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.table.append((len(packed), len(content), _xxh32(content)))
        self.out.write(packed)

    def _flush(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def close(self) -> None:
        self._flush()
        self._frame(np.asarray(self.index, dtype="<i8").tobytes())
        body = b"".join(struct.pack("<III", *t) for t in self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)


class FrameReader:
    """Random access to one file through ``source``, a seekable binary file object."""

    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        source.seek(0, 2)
        end = source.tell()
        n, _, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end of the file")
        raw = self._at(end - 9 - 12 * n, 12 * n)
        self.table = list(struct.iter_unpack("<III", raw))
        self.place = np.concatenate([[0], np.cumsum([t[0] for t in self.table])]).astype(np.int64)
        self.index = np.frombuffer(self.frame(n - 1), "<i8").reshape(-1, 4)

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(int(place))
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        packed, size, check = self.table[k]
        content = self.zstd.decompress(self._at(self.place[k], packed), max_output_size=size) if size else b""
        if len(content) != size or _xxh32(content) != check:
            raise ValueError(f"frame {k}: checksum differs")
        return content

    def documents(self, keys: set[int] | None = None):
        """(key, ids as bytes) in stored order; of the given keys only, opening only the frames that hold them."""
        last, content = -1, b""
        for key, k, at, n in self.index.tolist():
            if keys is None or key in keys:
                if k != last:
                    last, content = k, self.frame(k)
                yield key, content[4 * at : 4 * (at + n)]


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri)


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, directory: str, spaces_matter: bool = True, part_bytes: int = 48 << 20, frame_bytes: int = 1 << 20) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write their ids in ascending doc_id order; return the manifest.

    Null texts are empty, null ids come first (stored with the smallest key), rows of one id stand side by side (in the
    order of their texts' hashes); other columns are ignored. Documents are dealt by range of (doc_id, hash of the text), so
    that no id makes a part too large; each part is one file. A retried task writes a new file, and only files in the
    manifest count: columns part, path, first_key, last_key (of its documents, null keys as the smallest), n_docs, n_tokens,
    first_token (ids of all parts before it).
    """
    lean_batches(docs.sparkSession)
    n = pieces(text_bytes(docs), part_bytes)
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = dealt.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        files, base = _filesystem(directory)
        files.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        code, end = encoder(tokenizer_path, spaces_matter, 450_000), struct.pack("<I", end_id)
        n_docs = 0
        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            writer = FrameWriter(out, frame_bytes)
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1)
                for i in range(0, batch.num_rows, 512):
                    key = ids.slice(i, 512).to_pylist()
                    for k, got in zip(key, code.encode_many(t or "" for t in texts.slice(i, 512).to_pylist()), strict=True):
                        writer.add(NULL_KEY if k is None else k, got + end)
                    n_docs += len(key)
            writer.close()
        keys = [x[0] for x in writer.index] or [None]
        row = {"part": part, "path": f"{directory}/{name}", "first_key": keys[0], "last_key": keys[-1], "n_docs": n_docs, "n_tokens": writer.n_tokens}
        kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema(list(zip(row, kinds))))

    written = stored(dealt.mapInArrow(write, "part int, path string, first_key long, last_key long, n_docs long, n_tokens long"), "manifest")
    # one row for each file; summed in two steps, so that one task sees a row for each 4096 files only
    groups = written.withColumn("g", F.expr("part div 4096"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    base = groups.groupBy("g").agg(F.sum("n_tokens").alias("t")).select("g", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return groups.join(base, "g").select("part", "path", "first_key", "last_key", "n_docs", "n_tokens", (F.col("base") + F.coalesce(inside, F.lit(0))).alias("first_token"))


def read_token_files(manifest: DataFrame, wanted: set[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents of the files in ``manifest``, each file by one task: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32 and, ``with_ids``, ids. ``wanted``: a small set of ids; only files whose keys may hold one are opened,
    and only their frames decompressed."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, path = _filesystem(row["path"])
                with files.open_input_file(path) as source:
                    reader = FrameReader(source)
                    before = np.concatenate([[0], np.cumsum(reader.index[:, 3])]) + row["first_token"]
                    starts = iter(before.tolist()) if wanted is None else iter([b for b, k in zip(before.tolist(), reader.index[:, 0].tolist()) if k in wanted])
                    rows: list[tuple] = []
                    size = 0
                    for (key, ids), start in zip(reader.documents(wanted), starts):
                        rows.append((None if key == NULL_KEY else key, start, len(ids) // 4, zlib.crc32(ids), ids if with_ids else None))
                        size += len(ids) if with_ids else 40
                        if size > 4 << 20:
                            yield _rows(rows, with_ids)
                            rows, size = [], 0
                    if rows:
                        yield _rows(rows, with_ids)

    if wanted is not None:
        ids = F.array(*[F.lit(int(i)) for i in sorted(wanted)]).cast("array<bigint>")
        manifest = manifest.where(F.exists(ids, lambda i: i.between(F.col("first_key"), F.col("last_key"))))
    spread = manifest.repartition("path")
    return spread.select("path", "first_token").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows))[: len(names)], kinds)], names=names)


def output_directory(spark: SparkSession) -> str:
    """A new folder for token files in the shared folder."""
    return fresh_path(spark, "tokens")
