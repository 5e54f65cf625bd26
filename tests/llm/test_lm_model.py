"""The trie and the scores against plain dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from docweave.llm.elias_fano import EliasFano, NgramTrie, decode, encode, mapped
from docweave.llm.lm_scoring import _distinct, score_documents


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((1, 1), (5, 3), (100, 1000), (3000, 10**9), (5000, 100), (2000, 2**40)):
        x = np.sort(rng.integers(0, top, n))
        e = EliasFano.of(x)
        assert (e.get(np.arange(n)) == x).all()
        q = rng.integers(0, top + 10, 500)
        assert (e.find(q) == np.searchsorted(x, q)).all()
    assert EliasFano.of(np.empty(0, np.uint64)).find(np.array([3])).tolist() == [0]


def test_trie_is_a_distribution():
    rng = np.random.default_rng(1)
    tri = np.unique(rng.integers(0, 30, (4000, 3)), axis=0)
    trie, path = mapped(NgramTrie.build(tri[:, 0], tri[:, 1], tri[:, 2], rng.integers(1, 4, len(tri))))
    w = np.arange(30)
    for v in (0, 5, 29, -1):
        for u in (0, 7, -1):
            a, b = trie.query(np.full(30, v), np.full(30, u), w)
            assert abs((a + b / 30).sum() - 1) < 0.001, path


def test_codes_are_close():
    """The code book's error, near 0 and near 1 alike; 0 and 1 are exact."""
    x = np.concatenate([10.0 ** -np.linspace(0, 13, 4001)[1:], 1 - 10.0 ** -np.linspace(0, 13, 4001)[1:]])
    got = decode(encode(x))
    assert (np.abs(got - x) <= 6e-4 * x).all() and (np.abs(got - x) <= 6e-4 * (1 - x) + 1e-15).all()
    assert decode(encode(np.array([0.0, 1.0]))).tolist() == [0, 1]


def test_distinct_tuples_of_large_numbers():
    r = np.random.default_rng(2)
    keys = [r.choice(r.integers(0, 2**45, 5), 400) for _ in range(3)]
    out, index = _distinct(*keys)
    assert list(zip(*(o.tolist() for o in out))) == sorted(set(zip(*(k.tolist() for k in keys))))
    assert all((o[index] == k).all() for o, k in zip(out, keys))


def test_scores_equal_plain_model(spark):
    """Absolute discounting over trigrams and bigrams, down to add-0.1 single words; only quantising differs."""
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) for i, t in texts.items()}
    want = _plain_scores(words)
    got = score_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), batch_bytes=200_000).collect()
    assert len(got) == len(want)
    for x in got:
        assert math.isclose(x.score, want[x.doc_id], rel_tol=0.002), (x.doc_id, x.score, want[x.doc_id])


def test_split_words(spark):
    """With every word split over shards, each next word, known or not, has the plain model's probability."""
    vocabulary = [f"w{k}" for k in range(12)]
    r = random.Random(7)
    rows = [(10 * i + 1, " ".join(r.choice(vocabulary) for _ in range(20))) for i in range(150)]
    held = [i for i in range(2_000_000, 2_000_400) if zlib.crc32(str(i).encode()) % 10 == 0]  # so that they don't train
    first, *tests = zip(held, ["w1 w2", *(f"w1 w2 {w}" for w in [*vocabulary, "never"])])
    df = spark.createDataFrame([*rows, first, *tests], "doc_id long, text string").repartition(2)
    want = _plain_scores({i: t.split() for i, t in [*rows, first, *tests]})
    for per_shard in (20, 10**9):
        out = {x.doc_id: x.score for x in score_documents(df, batch_bytes=1 << 12, per_shard=per_shard).collect()}
        assert out.keys() == want.keys() and all(math.isclose(out[i], want[i], rel_tol=0.002) for i in out)


def _plain_scores(texts):
    """Scores by dictionaries that count every trigram, those after begin marks too."""
    c1, c2, c3 = Counter(), Counter(), Counter()
    for i, t in texts.items():
        seq = ["<", "<", *t, ">"]
        if zlib.crc32(str(i).encode()) % 10:
            for u, v, w in zip(seq, seq[1:], seq[2:]):
                c1[w] += 1
                c2[v, w] += 1
                c3[u, v, w] += 1
    levels = []
    for counts in (c2, c3):
        once, twice = (sum(x == k for x in counts.values()) for k in (1, 2))
        total, kinds = defaultdict(int), defaultdict(int)
        for k, x in counts.items():
            total[k[:-1]] += x
            kinds[k[:-1]] += 1
        levels.append((counts, min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.98), total, kinds))
    n, size = sum(c1.values()), len(c1)
    out = {}
    for i, t in texts.items():
        seq, score = ["<", "<", *t, ">"], 0.0
        for x in zip(seq, seq[1:], seq[2:]):
            p = (c1[x[2]] + 0.1) / (n + 0.1 * (size + 1))
            for key, (c, d, total, kinds) in zip((x[1:], x), levels):
                if total[key[:-1]]:
                    p = max(c[key] - d, 0) / total[key[:-1]] + d * kinds[key[:-1]] / total[key[:-1]] * p
            score += math.log10(p)
        out[i] = score
    return out


def test_first_words_have_a_context(spark):
    """Texts that open alike, and empty ones: the first word, or the end, is scored after the begin marks."""
    r = random.Random(6)
    texts = {i: [r.choice(("so", "so", "so", "then", f"o{i % 7}"))] * (i % 4 > 0) + [f"w{r.randrange(30)}" for _ in range(i % 4)] for i in range(400)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    want = _plain_scores(texts)
    for got in score_documents(df, batch_bytes=1 << 20).collect():
        assert math.isclose(got.score, want[got.doc_id], rel_tol=0.002, abs_tol=1e-3), texts[got.doc_id]


def test_scores_do_not_depend_on_shards(spark):
    """Any split of words and batches gives the same scores, and the plain model's up to quantising."""
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)]
    texts = {}
    for i in range(300):
        texts[i] = [r.choice(vocabulary[: r.choice((3, 10, 60))]) for _ in range(r.randint(0, 40))]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string").repartition(3)
    want = _plain_scores(texts)
    first: dict[int, float] = {}
    for batch_bytes, per_shard in ((1 << 20, 400_000), (1 << 13, 400_000), (1 << 13, 50), (1 << 12, 7), (1 << 14, 1)):
        for got in score_documents(df, batch_bytes=batch_bytes, per_shard=per_shard).collect():
            assert math.isclose(got.score, first.setdefault(got.doc_id, got.score), rel_tol=1e-9), (batch_bytes, per_shard, got.doc_id)
            assert math.isclose(got.score, want[got.doc_id], rel_tol=0.002, abs_tol=1e-3), (batch_bytes, per_shard, got.doc_id)
