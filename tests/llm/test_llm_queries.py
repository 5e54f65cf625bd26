"""The registered queries of the subpackage on the smallest tables: SQL where there is some, else brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from docweave.llm import queries as Q
from docweave.llm.decontamination import budget, find_leaks, myers, normalise
from docweave.llm.quality import fit
from docweave.llm.tokenise import public_path
from docweave.llm.url_filter import SEEDS, filter_urls, host_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = Q.QUERIES[name](spark, SF), con.sql(Q.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert sorted(tuple(r[c] for c in cols) for r in got.collect()) == sorted(want.select(*cols).fetchall())


def test_lm_scoring(spark, texts):
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    count = Counter(w for i, t in tokens.items() if not out[i] for w in t)
    n, v = sum(count.values()), len(count)
    held = [0.0, 0.0]
    for r in Q.QUERIES["op1_lm_scoring"](spark, SF).collect():
        t = tokens[r.doc_id]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[r.doc_id], len(t), sum(count[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0
        if r.held_out:
            held[0] += r.score
            held[1] += base
    assert held[0] > held[1]


def test_decontamination_finds_every_exact_item(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r.distance for r in Q.QUERIES["op2_benchmark_decontamination"](spark, SF).collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert exact and all(found.get(p) == 0 for p in exact)
    clean = {d for d, t in texts.items() if not any(x[k : k + 20] in t for x in items.values() for k in range(0, len(x) - 20, 5))}
    assert not clean & {d for d, _ in found}


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rows = Q.QUERIES["op6_best_fit_packing"](spark, SF).collect()
    pieces: dict[int, list] = {}
    bins: dict[int, list] = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == texts.keys()
    total = 0
    for i, own in pieces.items():
        ids = [*tok.encode(texts[i], add_special_tokens=False).ids, 0]
        total += len(ids)
        for p, r in enumerate(sorted(own, key=lambda r: r.piece)):
            part = ids[2048 * p : 2048 * (p + 1)]
            assert (r.piece, r.start, r.length) == (p, 2048 * p, len(part))
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        assert sum(r.length for r in own) == len(ids)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 2


def test_token_output(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    rows = sorted(Q.QUERIES["op7_token_output"](spark, SF).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        ids = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)


def test_url_filter(spark):
    rules = [(v, *r.split("/", 1), r) for v, r in Q.RULES]
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = Q.QUERIES["op8_url_filter"](spark, SF).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rest = (urls[r.page_id] or "").partition("://")[2]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fits = [(len(x), x, v) for v, h, p, x in rules if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        best = max(fits) if fits else None
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[2] if best else r.verdict in ("allow", "block")


def test_quality_classifier(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = Q.QUERIES["op10_quality_classifier"](spark, SF).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_line_dedup(spark, texts):
    """Against all pairs of distinct lines that share a shingle."""
    rows = {r.doc_id: r for r in Q.QUERIES["op9_line_dedup"](spark, SF).collect()}
    want = plain.dedup_lines(texts)
    assert rows.keys() == want.keys()
    for i, t in texts.items():
        removed = t.count("\n") + 1 - (want[i].count("\n") + 1 if want[i] or not t else 0)
        assert (rows[i].n_lines, rows[i].kept_sha256) == (t.count("\n") + 1, hashlib.sha256(want[i].encode()).hexdigest()), i
        assert rows[i].n_removed == removed or not want[i]


def test_decontamination_equals_brute_force(spark):
    """Every document against every item: passages with edits anywhere, within the budget and beyond, side by side."""
    r = random.Random(13)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(300)]
    items = {i: " ".join(r.choice(words) for _ in range(r.randint(5, 20))) for i in range(12)}
    docs = {}
    for d in range(60):
        parts = [" ".join(r.choice(words) for _ in range(r.randint(0, 30)))]
        for _ in range(r.randint(0, 2)):
            x = list(items[r.randrange(12)])
            for _ in range(r.randint(0, len(x) // 9)):
                k = r.randrange(len(x))
                x[k : k + r.randint(0, 1)] = r.choice(("", "z", "q"))
            parts += ["".join(x), " ".join(r.choice(words) for _ in range(r.randint(0, 20)))]
        docs[d] = " ".join(parts)
    found = find_leaks(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(2), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    got = {(x.doc_id, x.item_id): x.distance for x in found.collect()}
    want = {}
    for i, x in items.items():
        pattern = normalise(x)
        for d, t in docs.items():
            if (k := plain.edit_distance(pattern, normalise(t))) <= budget(len(pattern), 0.08, 8):
                want[d, i] = k
    assert got == want and len(want) > 20 and max(want.values()) > 2


def test_decontamination_query(spark, texts):
    """The query's leaks are those of Myers' distance over all documents and items."""
    items = {r.item_id: normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in Q.QUERIES["op2_benchmark_decontamination"](spark, SF).collect()}
    clean = {i: normalise(t) for i, t in texts.items()}
    near = sorted({d for d, _ in got} | set(sorted(clean)[:40]))  # every leak, and documents of which most have none
    want = {(d, i): k for i, x in items.items() for d in near if (k := myers(x, clean[d])[0]) <= budget(len(x), 0.08, 8)}
    assert {k: v for k, v in got.items() if k[0] in near} == want


def test_trees_equal_plain_traversal():
    """Flattened trees against a walk from node to node, and the first split against an exhaustive search."""
    r = np.random.default_rng(5)
    x = r.integers(0, 12, (400, 4)).astype(np.float32)
    y = ((x[:, 2] > 6) ^ (r.random(400) < 0.1)).astype(float)
    model = fit(x, y, trees=7, depth=3)

    def walk(row):
        total = model.base
        for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + bool(row[f[node]] > t[node])
            total += leaf[node - len(f)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(model.score(x), [walk(row) for row in x])
    p = y.mean()

    def gain(f, cut):
        def part(at):
            return (p - y[at]).sum() ** 2 / ((p * (1 - p)) * at.sum() + 1.0)

        left = x[:, f] <= cut
        return part(left) + part(~left)

    best = max(((f, c) for f in range(4) for c in range(11)), key=lambda s: gain(*s))
    assert (model.feature[0, 0], model.threshold[0, 0]) == best


def test_url_model_ranks_unseen_hosts(spark):
    """Hosts whose marking word no training URL holds are still ranked below the accepted ones, on the whole."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    host = host_of(F.col("url"))
    marked = F.arrays_overlap(F.split(host, "[.-]"), F.array(*[F.lit(x) for x in SEEDS]))
    rows = pages.select("url", host.alias("h"), marked.alias("rejected")).cache()
    ranks = {}
    for (name,) in rows.where("rejected").select("h").distinct().collect():
        own = [w for w in re.split("[.-]", name) if w in SEEDS]
        holds = F.arrays_overlap(F.split(host_of(F.col("url")), "[.-]"), F.array(*[F.lit(w) for w in own]))
        labels = rows.where(~holds).select("url", "rejected")
        scored = filter_urls(pages, labels=labels).select("score", holds.alias("unseen"), marked.alias("rejected")).where("score is not null").toPandas()
        unseen, fine = scored[scored.unseen].score, scored[~scored.rejected].score
        ranks[name] = float(np.mean([(fine > s).mean() for s in unseen]))
    print(ranks)
    assert np.mean(list(ranks.values())) > 0.8
