"""N-gram Jaccard self-join by T-occurrence search.

1. Every document's distinct word shingles are routed to shards, which answer in how many documents each occurs. A shingle
   of one document links nothing, so a document with too few shared ones is done (most are, at once).
2. Documents of equal sets become one; the shared shingles among the rarest ones of each set (its prefix, of which linked
   sets must share one) form blocks.
3. Within a block, of two sets or of many, DivideSkip: the short inverted lists of a set's shingles are merged by a heap, which
   jumps over what can't get there; what reaches the required overlap less the number of long lists is a candidate, and the
   long lists are probed for it by binary search. What is connected to the document already is passed over.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._blocks import MOST, links, needed
from ._components import components
from ._route import answer, ask, batches, deltas, finish, narrow, pack, runs, sized, undelta, unpack
from ._spark import pieces, stored, text_bytes
from ._text import Words, distinct_pairs, shingles


def _sets(rows: pa.Table, n: int, shards: int):
    """(words, doc, shingle) of the distinct shingles, and their order by (shard, fingerprint) with its runs."""
    words = Words(rows.column("text"), lower=True)
    doc, value = distinct_pairs(*shingles(words, n))
    shard = (value & np.uint64(0xFFFFFFFF)) % np.uint64(shards)
    order = np.argsort(shard << np.uint64(32) | value >> np.uint64(32), kind="stable")
    return words, doc, value, order, runs(shard[order].astype(np.int64))


def _ask(n: int, shards: int):
    def fn(batch, rows, _):
        _, _, value, order, parts = _sets(rows, n, shards)
        for shard, a, b in parts:  # each shingle once with its count, however many of the batch's documents have it
            prints, first = _once(value[order[a:b]] >> np.uint64(32))
            yield shard, pack(deltas(prints), narrow(np.diff(np.append(np.flatnonzero(first), b - a))))

    return fn


def _once(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, which elements are the first of theirs)."""
    first = np.ones(len(ascending), bool)
    first[1:] = ascending[1:] != ascending[:-1]
    return ascending[first], first


def _frequencies(shard, asked):
    got = [(b, *unpack(p)) for b, p in asked]
    prints = np.concatenate([undelta(x).astype(np.uint32) for _, x, _ in got])
    one, index = np.unique(prints, return_inverse=True)
    count = np.bincount(index, np.concatenate([n for _, _, n in got]), len(one))
    code = np.minimum(count, 65535).astype(np.uint16)[index]
    at = 0
    for b, x, _ in got:
        yield b, pack(code[at : at + len(x)])
        at += len(x)


def _judged(n: int, num: int, den: int, shards: int):
    """Per row: doc_id, n_shingles, and for a document with enough shared shingles its fingerprint, shingles and prefix."""

    def fn(batch, rows, got):
        from xxhash import xxh3_128_digest

        words, doc, value, order, parts = _sets(rows, n, shards)
        df = np.ones(len(value), np.uint16)
        told = dict(got)
        for shard, a, b in parts:
            _, new = _once(value[order[a:b]] >> np.uint64(32))
            df[order[a:b]] = unpack(told[shard])[0][np.cumsum(new) - 1]
        texts = rows.num_rows
        first = np.searchsorted(doc, np.arange(texts + 1))
        size = np.diff(first)
        shared = np.diff(np.concatenate([[0], np.cumsum(df > 1)])[first])
        live = np.flatnonzero((size > 0) & (den * shared >= num * size))
        sets, keys, one, two = [None] * texts, [None] * texts, [None] * texts, [None] * texts
        for i in live:
            v, f = value[first[i] : first[i + 1]], df[first[i] : first[i + 1]]
            one[i], two[i] = struct.unpack("<qq", xxh3_128_digest(v.tobytes()))  # ascending, so equal for equal sets
            rare = np.lexsort((v, f))[: len(v) - needed(len(v), num, den) + 1]
            keys[i] = v[rare[f[rare] > 1]].tobytes()
            sets[i] = v[f > 1].tobytes()
        return pa.table([rows.column("doc_id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(sets, pa.binary()), pa.array(keys, pa.binary())], names=["doc_id", "n_shingles", "one", "two", "shared", "keys"])

    return fn


def _shared(rows: pa.Table):
    own = [np.frombuffer(s, "<u8") for s in rows.column("shared").to_pylist()]
    return np.concatenate(own), np.cumsum([0] + [len(s) for s in own]), rows.column("n_shingles").to_numpy()


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, most: int = MOST, batch_bytes: int | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A document's set: its distinct ``n``-word shingles after lower-casing A-Z; of fewer words, the whole sequence as one;
    of none, empty, and linked with nothing. Documents link when den * intersection >= num * union; component_id is the
    smallest doc_id that links lead to. Rows of equal ids and different texts are documents of their own; rows with a null id
    stay alone (component null). Other columns are ignored. Sets are compared by 64-bit hashes of their shingles, equal sets
    found by 128 bits.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = text_bytes(docs)
    each = batch_bytes or sized(total, 8 << 20)
    shards = pieces(total, each)
    held = batches(docs, each)
    told = answer(ask(held, _ask(n, shards)), _frequencies)
    schema = "doc_id long, n_shingles long, one long, two long, shared binary, keys binary"
    every = stored(finish(held, told, _judged(n, num, den, shards), schema), "sets")
    live = every.where("shared is not null and doc_id is not null")
    classes = live.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("rep"))
    chosen = live.join(classes.select(F.col("rep").alias("doc_id"), "one", "two", "n_shingles"), ["doc_id", "one", "two", "n_shingles"], "left_semi")
    items = stored(chosen.select(F.xxhash64("one", "two", "n_shingles").alias("item"), "n_shingles", "shared", "keys", F.col("n_shingles").alias("weight")), "items")
    found = links(items, _shared, num, den, most, occurrence=True)
    groups = components(found)
    named = stored(classes.withColumn("node", F.xxhash64("one", "two", "n_shingles")).join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component"), "classes")
    smallest = named.groupBy("group").agg(F.min("rep").alias("component_id"))
    mine = named.join(smallest, "group").select("one", "two", "n_shingles", "component_id")
    out = every.select("doc_id", "n_shingles", "one", "two").join(mine, ["one", "two", "n_shingles"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
