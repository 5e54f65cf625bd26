"""Language-model scores of documents by a trigram model that is spread over the cluster.

Words are routed to shards twice. By word: shards add up the training counts, answer how often each word occurs and give it
a number, small for frequent words. By the word before (v): a shard then holds every training trigram u v w of its v, as
numbers, builds an Elias-Fano trie of them, maps it into memory, and answers, for the distinct trigrams of each batch, the
two figures from which the batch gets the probability of w after u v. All training documents are counted, however many.

A frequent v goes to several shards by a hash of u. Each then holds its contexts u v whole but only a part of the pairs
v w, so before the tries are built v's own shard adds these up and tells them, with v's total and kinds, to those that hold
a part. The first word of a text follows two begin marks; every text has that context, so it is split over shards by w.
Its total and kinds, and how many trigrams and pairs occur once and twice (the discounts), are summed over all shards.
Probabilities are quantised by one fixed code book. Scores therefore don't depend on shards and batches.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._route import answer, answer_told, ask, batches, ddl, finish, narrow, pack, runs, sized, unpack
from ._spark import pieces, text_bytes
from ._text import Words, mix
from .elias_fano import NgramTrie, decode, discount, encode, mapped

BEGIN, END = np.uint64(0x1F3D5B79A2C4E687), np.uint64(0x2B4D6F81A3C5E709)
_AT_ONCE = 1 << 18  # trigrams looked up together
_FIRST = 0  # the begin mark as a context; words have their number + 1
_SUMS = ("first_total", "first_kinds", "pairs_once", "pairs_twice", "trigrams_once", "trigrams_twice")


def _distinct(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of up to three arrays of numbers, ascending, and the place of each element's tuple."""
    bits = [max(1, int(k.max()).bit_length()) if len(k) else 1 for k in keys]
    if sum(bits) <= 63:
        packed = keys[0]
        for k, n in zip(keys[1:], bits[1:]):
            packed = packed << n | k
        one, index = np.unique(packed, return_inverse=True)
        out = []
        for n in reversed(bits[1:]):
            out.append(one & ((1 << n) - 1))
            one = one >> n
        return [one, *reversed(out)], index
    dense = [np.unique(k, return_inverse=True) for k in keys]  # fewer than 2^31 different ones each, whatever the numbers
    pairs, at = np.unique(dense[0][1] << 31 | dense[1][1], return_inverse=True)
    one, index = np.unique(at << 31 | dense[2][1], return_inverse=True)
    places = pairs[one >> 31] >> 31, pairs[one >> 31] & 0x7FFFFFFF, one & 0x7FFFFFFF
    return [d[p] for (d, _), p in zip(dense, places)], index


class _Tokens:
    """Distinct words of a batch (hash, ordered by shard), and the id of each token of each text with its context."""

    def __init__(self, rows: pa.Table, folds: int, held_out: int, shards: int):
        words = Words(rows.column("text"), lower=True)
        n = len(words.first) - 1
        first = words.first + 3 * np.arange(n + 1)  # two begin marks and an end mark around each text
        seq = np.empty(len(words) + 3 * n, np.uint64)
        at = np.arange(len(words)) + 3 * words.doc() + 2
        seq[at] = words.hash[0]
        seq[first[:-1]] = seq[first[:-1] + 1] = BEGIN
        seq[first[1:] - 1] = END
        known, index = np.unique(seq, return_inverse=True)
        shard = (known >> np.uint64(20)) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        self.known, self.shard, ids = known[order], shard[order].astype(np.int64), rank[index]
        self.begin = int(np.flatnonzero(self.known == BEGIN)[0]) if n else -1
        real = np.ones(len(seq), bool)
        real[first[:-1]] = real[first[:-1] + 1] = False
        w = np.flatnonzero(real)
        self.u, self.v, self.w = ids[w - 2], ids[w - 1], ids[w]
        self.first = words.first + np.arange(n + 1)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        self.held_out = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == held_out for i in rows.column("doc_id").to_pylist()], bool)
        self.training = ~self.held_out[self.doc]

    def trigrams(self):
        """[v, u, w] of the distinct trigrams in ascending order, and the place of each token's."""
        return _distinct(self.v, self.u, self.w)


def _ask_words(folds: int, held_out: int, shards: int):
    def fn(batch, rows, _):
        t = _Tokens(rows, folds, held_out, shards)
        count = np.bincount(t.w, t.training, len(t.known)).astype(np.int64)
        at = {s: (a, b) for s, a, b in runs(t.shard)}
        for shard in range(shards):  # all shards, so that each batch hears all their totals
            a, b = at.get(shard, (0, 0))
            yield shard, pack(t.known[a:b], narrow(count[a:b]))

    return fn


def _word_counts(shards: int):
    def fn(shard, asked):
        got = [(b, unpack(p)) for b, p in asked]
        known, index = np.unique(np.concatenate([g[0] for _, g in got]), return_inverse=True)
        total = np.bincount(index, np.concatenate([g[1] for _, g in got]), len(known)).astype(np.int64)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
        sums = np.array([total.sum(), (total > 0).sum()], np.int64)
        at = 0
        for b, g in got:
            mine = index[at : at + len(g[0])]
            yield b, pack(sums, narrow(total[mine]), narrow(rank[mine] * shards + shard))
            at += len(g[0])

    return fn


def _told(t: _Tokens, got) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, number) of the batch's words, and the sums over all shards."""
    own = {s: (a, b) for s, a, b in runs(t.shard)}
    count, number, sums = np.zeros(len(t.known), np.int64), np.zeros(len(t.known), np.int64), np.zeros(2, np.int64)
    for shard, payload in got:
        x = unpack(payload)
        sums += x[0]
        if shard in own:
            a, b = own[shard]
            count[a:b], number[a:b] = x[1], x[2]
    return count, number, sums


def _placed(t: _Tokens, v: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray, number: np.ndarray, shards: int, per_shard: int):
    """Order of the distinct trigrams by shard, its runs, and over how many shards each v is split."""
    ways = count[v] // per_shard + 1
    kind = mix(number[u].astype(np.uint64), 77) % ways.astype(np.uint64)
    shard = (t.shard[v] + kind.astype(np.int64)) % shards
    first = np.flatnonzero(v == t.begin)
    shard[first] = (mix(number[w[first]].astype(np.uint64), 78) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard.astype(np.uint16) if shards < 65535 else shard, kind="stable")
    return order, runs(shard[order]), ways


def _ask_trigrams(folds: int, held_out: int, shards: int, per_shard: int):
    def fn(batch, rows, got):
        t = _Tokens(rows, folds, held_out, shards)
        count, number, _ = _told(t, got)
        (v, u, w), index = t.trigrams()
        n = np.bincount(index, t.training, len(v)).astype(np.int64)
        order, parts, ways = _placed(t, v, u, w, count, number, shards, per_shard)
        root = number + 1
        if t.begin >= 0:
            root[t.begin] = _FIRST
        for shard, a, b in parts:
            own = order[a:b]
            at = v[own]
            new = np.concatenate([[True], at[1:] != at[:-1]])
            times = np.diff(np.append(np.flatnonzero(new), b - a))
            yield shard, pack(narrow(root[at[new]]), narrow(times), narrow(number[u[own]]), narrow(number[w[own]]), narrow(n[own]), (ways[own][new] > 1).astype(np.uint8))

    return fn


class _Asked:
    """A shard's distinct trigrams in ascending order with their counts (``known[v]`` are the words), who asked for them, and
    the pairs v w in ascending order with what is counted of them here."""

    def __init__(self, asked):
        got = [(b, unpack(p)) for b, p in asked]
        self.names, self.sizes = [b for b, _ in got], [len(g[4]) for _, g in got]
        known, at = np.unique(np.concatenate([g[0] for _, g in got]), return_index=True)
        self.known, self.split = known.astype(np.int64), np.concatenate([g[5] for _, g in got])[at] > 0
        v, u, w, count = (np.concatenate(x) for x in ([np.repeat(np.searchsorted(known, g[0]), g[1]) for _, g in got], *([g[k].astype(np.int64) for _, g in got] for k in (2, 3, 4))))
        del got
        (self.v, self.u, self.w), self.index = _distinct(v, u, w)
        self.count = np.bincount(self.index, count, len(self.v)).astype(np.int64)
        del v, u, w, count
        size = int(self.w.max()) + 1
        pairs, at = np.unique(self.v * size + self.w, return_inverse=True)
        self.pairs, self.pair_v, self.pair_w = np.bincount(at, self.count, len(pairs)).astype(np.int64), pairs // size, pairs % size
        self.first = self.known[0] == _FIRST  # then v 0 is the begin mark
        if self.first:
            self.split[0] = False  # each of its pairs is whole here

    def sent(self, shards: int):
        """(shard of the word, places of its pairs) for the words that are split."""
        at = np.flatnonzero(self.split[self.pair_v])
        home = (self.known[self.pair_v[at]] - 1) % shards
        order = np.argsort(home, kind="stable")
        return {s: at[order[a:b]] for s, a, b in runs(home[order])}


def _times(count: np.ndarray) -> tuple[int, int]:
    return int((count == 1).sum()), int((count == 2).sum())


def _part_pairs(shards: int):
    """Each shard sends its part of the pairs of split words to the words' own shards, and its sums to itself."""

    def fn(shard, asked):
        t = _Asked(asked)
        first = t.count[t.v == 0] if t.first else t.count[:0]
        sums = np.array([first.sum(), (first > 0).sum(), *_times(t.pairs[~t.split[t.pair_v]]), *_times(t.count)], np.int64)
        sent = t.sent(shards)
        for home in sorted({shard, *sent}):
            at = sent.get(home, np.empty(0, np.int64))
            yield home, pack(sums if home == shard else sums * 0, narrow(t.known[t.pair_v[at]]), narrow(t.pair_w[at]), narrow(t.pairs[at]))

    return fn


def _whole_pairs(shard, parts):
    """The pairs of this shard's split words added up: counts, totals and kinds for those who sent parts; sums in one row."""
    got = [(b, unpack(p)) for b, p in parts]
    v, w, count = (np.concatenate([g[k].astype(np.int64) for _, g in got]) for k in (1, 2, 3))
    words, v = np.unique(v, return_inverse=True)
    size = int(w.max()) + 1 if len(w) else 1
    pairs, index = np.unique(v * size + w, return_inverse=True)
    count = np.bincount(index, count, len(pairs)).astype(np.int64)
    total = np.bincount(pairs // size, count, len(words)).astype(np.int64)
    kinds = np.bincount(pairs // size, count > 0, len(words)).astype(np.int64)
    sums = sum(g[0] for _, g in got)
    sums[2:4] += _times(count)
    at, payloads = 0, []
    for _, g in got:
        n = len(g[1])
        payloads.append(pack(narrow(count[index[at : at + n]]), narrow(total[v[at : at + n]]), narrow(kinds[v[at : at + n]])))
        at += n
    columns = [pa.array([b for b, _ in got], pa.int64()), pa.array([shard] * len(got), pa.int64()), pa.array(payloads, pa.binary())]
    return pa.table([*columns, *(pa.array([x] + [0] * (len(got) - 1), pa.int64()) for x in sums.tolist())], names=("shard", "home", "payload", *_SUMS))


def _continuations(shards: int):
    def fn(shard, asked, told):
        t = _Asked(asked)
        sums = {n: told.column(n)[0].as_py() for n in _SUMS}
        total, kinds = np.bincount(t.pair_v, t.pairs, len(t.known)).astype(np.int64), np.bincount(t.pair_v, t.pairs > 0, len(t.known)).astype(np.int64)
        sent = t.sent(shards)
        for home, payload in zip(told.column("home").to_pylist(), told.column("payload").to_pylist()):
            if home in sent:
                at = sent[home]
                t.pairs[at], total[t.pair_v[at]], kinds[t.pair_v[at]] = unpack(payload)
        if t.first:
            total[0], kinds[0] = sums["first_total"], sums["first_kinds"]
        seen = t.count > 0
        v, u, w = t.v, t.u, t.w
        if total.any():
            pair = t.pairs > 0
            discounts = discount(sums["pairs_once"], sums["pairs_twice"]), discount(sums["trigrams_once"], sums["trigrams_twice"])
            whole = (0, total[0], kinds[0]) if t.first else None
            trie, path = mapped(NgramTrie.build(v[seen], u[seen], w[seen], t.count[seen], whole, (t.pair_v[pair], t.pair_w[pair], t.pairs[pair], total, kinds), discounts))
            try:
                a, b = (np.concatenate(x) for x in zip(*(trie.query(v[i : i + _AT_ONCE], u[i : i + _AT_ONCE], w[i : i + _AT_ONCE]) for i in range(0, len(v), _AT_ONCE))))
            finally:
                del trie
                os.unlink(path)
        else:
            a, b = np.zeros(len(v)), np.ones(len(v))
        a, b = encode(a), encode(b)
        at = 0
        for batch, n in zip(t.names, t.sizes):
            mine = t.index[at : at + n]
            yield batch, pack(a[mine], b[mine])
            at += n

    return fn


def _scores(folds: int, held_out: int, shards: int, per_shard: int):
    def fn(batch, rows, got):
        t = _Tokens(rows, folds, held_out, shards)
        count, number, sums = _told(t, [g for g in got if g[0] < shards])
        (v, u, w), index = t.trigrams()
        share, rest = np.zeros(len(v)), np.ones(len(v))
        order, parts, _ = _placed(t, v, u, w, count, number, shards, per_shard)
        spans = {s: order[a:b] for s, a, b in parts}
        for shard, payload in got:
            if shard >= shards:
                x = unpack(payload)
                own = spans[shard - shards]
                share[own], rest[own] = decode(x[0]), decode(x[1])
        plain = (count + 0.1) / (sums[0] + 0.1 * (sums[1] + 1))
        log = np.log10(np.minimum(share + rest * plain[w], 1.0))[index]
        base = np.log10(plain)[t.w]
        n = len(t.held_out)
        out = [t.held_out, np.diff(t.first), np.bincount(t.doc, count[t.w] > 0, n).astype(np.int64), np.full(n, sums[0]), np.bincount(t.doc, base, n), np.bincount(t.doc, log, n)]
        for name, x, kind in zip(("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), out, (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())):
            rows = rows.append_column(pa.field(name, kind), pa.array(x, kind))
        return rows

    return fn


def score_documents(docs: DataFrame, folds: int = 10, held_out: int = 0, batch_bytes: int | None = None, per_shard: int = 400_000) -> DataFrame:
    """``docs`` (doc_id, text, any more) with held_out, n_tokens, n_known, train_tokens, base_score and score added.

    Learns from the documents whose crc32(doc_id as text) modulo ``folds`` isn't ``held_out``; a null id counts as the empty
    text, a null text as empty (one token, the end). ``base_score``: log10 probability by single words, add-0.1; ``score``: by
    the trigram model, which interpolates down to just that; its shares and weights are quantised to 0.06 % each. Without training documents both are that of unknown words.
    Columns named like the added ones are replaced.
    """
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    docs = docs.drop(*added).withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    total = text_bytes(docs)
    size = batch_bytes or sized(total)
    shards = pieces(total, size // 2)
    held = batches(docs, size)
    words = answer(ask(held, _ask_words(folds, held_out, shards)), _word_counts(shards))
    asked = ask(held, _ask_trigrams(folds, held_out, shards, per_shard), words)
    parts = answer(asked, _part_pairs(shards)).select(F.col("batch").alias("shard"), F.col("shard").alias("batch"), "payload")
    pairs = answer(parts, _whole_pairs, "shard long, home long, payload binary, " + ", ".join(f"{n} long" for n in _SUMS))
    sums = pairs.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _SUMS))
    ahead = answer_told(asked, pairs.drop(*_SUMS).crossJoin(F.broadcast(sums)), _continuations(shards))
    told = words.unionByName(ahead.withColumn("shard", F.col("shard") + shards))
    return finish(held, told, _scores(folds, held_out, shards, per_shard), ddl(docs, *(f"{n} {k}" for n, k in zip(added, ("boolean", "long", "long", "long", "double", "double")))))
