"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave.llm._spark import intermediates, shared_dir, steady
from docweave.llm._text import Words
from docweave.llm.decontamination import budget, decontaminate, find_leaks, myers, normalise, normalised
from docweave.llm.line_dedup import Lines, dedup_lines, signature_bands
from docweave.llm.lm_scoring import score_documents
from docweave.llm.ngram_join import jaccard_components
from docweave.llm.packing import best_fit, local_search, pack, pack_documents
from docweave.llm.quality import score_quality, train_quality
from docweave.llm.substring_dedup import Sketch, remove_repeats
from docweave.llm.token_output import FrameReader, FrameWriter, output_directory, read_token_files, write_token_files
from docweave.llm.tokenise import PieceEncoder, public_path
from docweave.llm.topk import MTree, fit_pivots, pivots_to_search, top_k, whole_vectors
from docweave.llm.url_filter import filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch long, shard string, payload binary, rows string, item long, score double, n_words long, n_removed string, component string, sequence_id int"
_r = random.Random(4)
_words = ["".join(_r.choice("abcdefgh") for _ in range(_r.randint(1, 9))) for _ in range(4000)]
LONG = " ".join(_r.choice(_words) for _ in range(60_000))
BASE = " ".join(_r.choice(_words) for _ in range(200))
NEAR = " ".join([*BASE.split()[:100], "changed", *BASE.split()[101:]])
TEXTS = [(1, BASE), (2, NEAR), (3, BASE), (4, None), (5, ""), (6, " \t\n\v "), (7, LONG), (8, "one"), (8, "one"), (None, BASE), (None, None), (9, "one two\n\none two\nÉté ẞ 漢字 one"), (10, "\n"), (11, "ONE")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, None, None, 1, None, b"", "r", 2, 0.5, 3, "x", None, 7) for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


def test_lm_scoring(docs, none):
    out = score_documents(docs).collect()
    assert len(out) == len(TEXTS) and all(r.score < 0 and r.base_score < 0 and r.n_tokens >= 1 for r in out)
    assert {r.n_tokens for r in out if not (r.text or "").strip()} == {1}
    assert all(r.source is None and r.payload is not None for r in out)
    assert score_documents(none).collect() == []


def test_lm_without_training(spark):
    one = spark.createDataFrame([(None, "a b")], "doc_id long, text string")  # a null id is held out
    r = score_documents(one).first()
    assert r.held_out and r.n_known == 0 and r.train_tokens == 0 and abs(r.score - r.base_score) < 1e-6


def test_decontamination(spark, docs, none):
    passage = " ".join(BASE.split()[50:90])
    edited = passage[:40] + "X" + passage[41:120] + passage[122:]
    items = spark.createDataFrame([(1, passage), (2, edited), (3, None), (4, ""), (5, "zz"), (6, "not in any of these texts at all, surely")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    assert {(1, 1), (3, 1), (1, 2), (None, 1)} <= found and not {i for _, i in found} & {3, 4, 5, 6}
    assert {r.doc_id for r in decontaminate(docs, items).collect()} == {4, 5, 6, 7, 8, 9, 10, 11}
    assert find_leaks(none, items).collect() == [] and find_leaks(docs, items.limit(0)).collect() == []
    rounds = {(r.doc_id, r.item_id) for r in find_leaks(docs, items, item_bytes=100).collect()}
    assert rounds == found


def test_decontamination_at_the_ends_of_texts(spark):
    """Texts that are items clipped and edited at both ends, between other texts, against plain edit distances."""

    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    r = random.Random(9)
    items = [(i, normalise(" ".join(r.choice(_words) for _ in range(r.randint(6, 25))))) for i in range(25)]
    texts = []
    for _, x in items:
        for _ in range(3):
            t = bytearray(x[r.randint(0, 4) : len(x) - r.randint(0, 4)])
            for _ in range(r.randint(0, 3)):
                t[r.choice((r.randrange(8), -1 - r.randrange(8)))] = r.choice(b"xyz")
            texts += [r.choice(_words), bytes(t).decode(), r.choice(_words) * r.randint(0, 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(i, x.decode()) for i, x in items], "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.distance for x in find_leaks(docs, bench).collect()}
    limit = {i: budget(len(x), 0.08, 8) for i, x in items}
    want = {(3 * d + 1, i): k for d in range(75) for i, x in items[d // 3 : d // 3 + 1] if (k := plain(x, normalised(pa.array(texts[3 * d + 1 : 3 * d + 2]))[0].tobytes())) <= limit[i]}
    assert len(want) > 30 and got == want


def test_myers_equals_table():
    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return min(row)

    r = random.Random(0)
    for _ in range(200):
        p, t = (bytes(r.choice(b"abc") for _ in range(r.randint(1, n))) for n in (12, 30))
        assert myers(p, t)[0] == plain(p, t)


def test_jaccard_join(docs, none):
    rows = jaccard_components(docs, 5, 80, 100).collect()
    assert len(rows) == len(TEXTS)
    out = {r.doc_id: r for r in rows}
    assert {out[i].component_id for i in (1, 2, 3)} == {1} and out[8].component_id == out[11].component_id == 8
    assert all(out[i].n_shingles == 0 and out[i].component_id == i for i in (4, 5, 6, 10))
    assert out[7].component_id == 7
    assert jaccard_components(none).collect() == []


def test_jaccard_join_in_chunks(spark):
    """Blocks far above the bound of a task give the same components as one task."""
    r = random.Random(2)
    rows = []
    for g in range(4):
        words = [f"w{g}x{k}" for k in range(60)]
        for k in range(90):
            own = list(words)
            own[r.randrange(60)] = f"new{g}y{k}"
            rows.append((g * 1000 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    chain = [" ".join(f"c{j}" for j in range(8 * k, 8 * k + 100)) for k in range(40)]  # each links with its neighbours only
    df = df.union(spark.createDataFrame([(9000 + k, t) for k, t in enumerate(chain)], "doc_id long, text string"))
    one = {x.doc_id: x.component_id for x in jaccard_components(df, 3, 80, 100).collect()}
    many = {x.doc_id: x.component_id for x in jaccard_components(df, 3, 80, 100, most=500).collect()}
    assert one == many and set(one.values()) == {0, 1000, 2000, 3000, 9000}


def test_substring_dedup(docs, none):
    rows = remove_repeats(docs).collect()
    assert len(rows) == len(TEXTS)
    out = {r.doc_id: r for r in rows}
    assert out[1].n_removed == 0 and out[3].text == "" and out[3].n_removed == 200 and out[2].text == "changed" and out[4].text == ""
    assert out[7].n_words == 60_000 and out[6].n_words == 0 and out[9].text == "one two one two Été ẞ 漢字 one"
    assert out[None].text == "" and out[1].sequence_id == 7
    assert remove_repeats(none).collect() == []


def test_line_dedup(spark, docs, none):
    rows = dedup_lines(docs).collect()
    out = {r.doc_id: r for r in rows}
    assert len(rows) == len(TEXTS) and out[1].text == BASE and out[3].text == "" and out[2].text == ""
    assert out[9].text == "one two\n\nÉté ẞ 漢字 one" and out[10].text == "\n" and out[6].text == " \t\n\v " and out[4].text is None
    assert sorted(r.text for r in rows if r.doc_id == 8) == ["", "one"]
    assert dedup_lines(none).collect() == []


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5]) for i in range(0, 90)] + [(100, None), (101, []), (102, [1.0, None]), (103, [nan, 1.0]), (104, [inf, 1.0]), (105, [1.0]), (120, [-1.0, -1.0]), (None, [1.0, 1.0]), (140, [2.0, 2.0, 2.0])]
    v = whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(None).cast("long")).repartition(3))
    out = top_k(v, v.where("vec_id % 20 = 0"), 20, shard_rows=16, block_rows=2, page=4).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in out}}
    assert set(got) == {0, 20, 40, 60, 80, 120}
    same = 64 * 64 + 32 * 32
    assert got[20] == [(i, same) for i in range(21) if i != 20]
    assert got[120] == [(i, -64 * 96) for i in range(20)]
    assert top_k(v.limit(0), v.limit(0)).collect() == []


def test_top_k_random(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(700)]
    v = whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plain = {x.vec_id: x.v for x in v.collect()}
    for q, got in ((q, [(x.vec_id, x.score) for x in sorted(rs, key=lambda x: x["rank"])]) for q, rs in _grouped(top_k(v, v.where("vec_id % 50 = 0"), 7, shard_rows=100, page=8).collect())):
        want = sorted(((sum(a * b for a, b in zip(plain[q], p)), i) for i, p in plain.items() if i != q), key=lambda x: (-x[0], x[1]))[:7]
        assert got == [(i, s) for s, i in want]


def _clustered(n, clusters, size=16, spread=4, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 400, (clusters, size))
    return np.floor(centres[r.integers(0, clusters, n)] + r.normal(0, spread, (n, size))).astype(np.int64)


def _plain_top(vectors, queries, k):
    score = vectors @ vectors.T
    return {q: [(int(i), int(score[q, i])) for i in np.lexsort((np.arange(len(vectors)), -score[q])) if i != q][:k] for q in queries}


def test_tree_avoids_computations():
    """On clustered vectors the bounds leave a small part of all products, for blocks and for single queries."""
    x = _clustered(4000, 40)
    queries = np.arange(0, 4000, 20)
    want = _plain_top(x, queries.tolist(), 10)
    for step in (1, len(queries)):
        tree = MTree(np.arange(4000), x, page=32)
        for at in range(0, len(queries), step):
            own = queries[at : at + step]
            place, ids, score = tree.search(own, x[own], 10)
            for p, q in enumerate(own.tolist()):
                got = sorted(zip(ids[place == p].tolist(), score[place == p].tolist()), key=lambda r: (-r[1], r[0]))
                assert got == want[q]
        assert tree.computed < 0.25 * len(queries) * 4000


def test_pivots_exclude_shards():
    x = _clustered(3000, 30)
    pivots = fit_pivots(np.full(3000, 16), list(x), 30)[16]
    near = ((x[:, None] - pivots) ** 2).sum(2).argmin(1)
    far = np.array([np.sqrt(((x[near == k] - pivots[k]) ** 2).sum(1)).max(initial=-1) for k in range(len(pivots))])
    norm = np.array([np.sqrt((x[near == k] ** 2).sum(1)).max(initial=-1) for k in range(len(pivots))])
    opened = 0
    for q in range(0, 3000, 100):
        floor = np.sort(x @ x[q])[-11]
        to = pivots_to_search(x[q : q + 1], np.array([floor]), pivots, far, norm)
        assert set(near[x @ x[q] >= floor].tolist()) <= set(to.tolist())
        opened += len(to)
    assert opened < 0.3 * 30 * len(pivots)


def test_top_k_clustered(spark):
    x = _clustered(900, 12, 8)
    df = spark.createDataFrame([(i, v.tolist(), 8) for i, v in enumerate(x)], "vec_id long, v array<long>, size int").repartition(3)
    out = top_k(df, df.where("vec_id % 25 = 0"), 7, shard_rows=60, block_rows=5, page=8).collect()
    want = _plain_top(x, range(0, 900, 25), 7)
    assert {q: [(r.vec_id, r.score) for r in sorted(rs, key=lambda r: r["rank"])] for q, rs in _grouped(out)} == want


def test_top_k_of_large_numbers(spark):
    """Beyond 53 bits products are still exact, ties and signs included; beyond 64 bits they are refused."""
    for top in (2**27, 2**30):
        rows = [(i, [top + i % 3, -top + i, i], 3) for i in range(40)]
        df = spark.createDataFrame(rows, "vec_id long, v array<long>, size int")
        got = {q: [(r.vec_id, r.score) for r in sorted(rs, key=lambda r: r["rank"])] for q, rs in _grouped(top_k(df, df.where("vec_id < 3"), 4, shard_rows=16).collect())}
        dot = lambda a, b: sum(x * y for x, y in zip(rows[a][1], rows[b][1]))
        assert got == {q: sorted(((i, dot(q, i)) for i in range(40) if i != q), key=lambda r: (-r[1], r[0]))[:4] for q in range(3)}
    huge = spark.createDataFrame([(i, [2**40, i], 2) for i in range(3)], "vec_id long, v array<long>, size int")
    with pytest.raises(Exception, match="beyond 64 bits"):
        top_k(huge, huge, 1).collect()


def _grouped(rows):
    out: dict = {}
    for r in rows:
        out.setdefault(r.query_id, []).append(r)
    return out.items()


def _regular(n: int) -> tuple[str, str]:
    """Two strings that collide under every polynomial hash modulo 2^64: Thue-Morse and its complement."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_words_and_lines_are_told_apart(spark):
    """What differs isn't equal, however regular: nothing is linked, removed or counted together."""
    one, two = _regular(4096)
    rest = [f"x{k}" for k in range(19)]
    rows = [(1, one), (2, two), (3, " ".join([one, *rest])), (4, " ".join([two, *rest]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in jaccard_components(df.where("doc_id < 3"), 5, 80, 100).collect()}
    assert out[2].component_id == 2
    assert {r.doc_id: r.n_removed for r in remove_repeats(df.where("doc_id in (3, 4)")).collect()} == {3: 0, 4: 0}
    lines = Lines(pa.array([one, two, one[:-1], two[1:]]))  # their shingle sets are equal, so nearness can't tell them apart
    assert all(len(set(h.tolist())) == 4 for h in lines.hashes(np.arange(4)))
    got = {r.doc_id: r for r in score_documents(df.where("doc_id <= 2")).collect()}
    assert {r.n_tokens for r in got.values()} == {2} and got[1].train_tokens == 2 * sum(not r.held_out for r in got.values())
    words = Words(pa.array([one, two, one + "a", one * 40, two * 40, "a", "b", "ab", "ba"]), lower=True, hashes=2)
    assert all(len(set(h.tolist())) == 9 for h in words.hash)


def test_lines_of_every_script(spark):
    """A shingle is so many characters, whatever their bytes: the same edit counts alike."""
    r = random.Random(12)
    rows, at = [], 0
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ", "一二三四五六七八九十百千万人口日月山川田土石金木水火"):
        for _ in range(30):
            line = "".join(r.choice(letters) for _ in range(120))
            k = r.randrange(10, 110)
            rows += [(at, line), (at + 1, line[:k] + "#" + line[k + 1 :]), (at + 2, line[:20] + "####" + line[24:50] + "####" + line[54:])]
            at += 3
    out = {x.doc_id: x.n_removed for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert all(out[i] == (i % 3 == 1) for i in out)  # 105 of 121 shingles in common, and 91 of 135


def test_recall_of_bands():
    """Pairs of similarity 0.8 share a band as often as independent permutations would have it."""
    r = np.random.default_rng(6)
    hits, n = 0, 2000
    for _ in range(n):
        own = r.integers(0, 2**63, 90).astype(np.uint64)
        a, b = own[:81], np.concatenate([own[9:81], own[81:90]])  # 72 of 90
        keys = signature_bands(np.concatenate([a, b]), np.array([0, 81]), 10, 4)
        hits += bool((keys[0] == keys[1]).any())
    assert hits / n > 0.985


def test_sketch_never_underestimates():
    r = np.random.default_rng(7)
    sketch, truth = Sketch(3000), {}
    for _ in range(6):
        prints, times = np.unique(r.integers(0, 5000, 2000).astype(np.uint32), return_counts=True)
        sketch.merge(prints, times)
        for p, t in zip(prints.tolist(), times.tolist()):
            truth[p] = truth.get(p, 0) + t
    known = np.array(list(truth), np.uint32)
    assert (sketch.estimate(known) >= np.minimum(np.array(list(truth.values())), 255)).all()


def test_frames_are_opened_one_by_one(tmp_path):
    """The reader opens only frames that hold what is wanted, and refuses one whose content changed."""
    path = tmp_path / "x.zst"
    with open(path, "wb") as f:
        writer = FrameWriter(f, frame_bytes=4000)
        for k in range(100):
            writer.add(k, np.full(300, k, "<u4").tobytes())
        writer.close()

    class Counting(FrameReader):
        def frame(self, k):
            opened.append(k)
            return super().frame(k)

    opened: list[int] = []
    with open(path, "rb") as f:
        reader = Counting(f)
        assert len(reader.table) == 35 and opened == [34]
        got = dict(reader.documents({3, 4, 71}))
        assert {k: np.frombuffer(v, "<u4").tolist() for k, v in got.items()} == {k: [k] * 300 for k in (3, 4, 71)}
        assert opened == [34, 1, 23]
    changed = bytearray(path.read_bytes())
    with open(path, "rb") as f:
        place = int(FrameReader(f).place[1])
    changed[place : place + len(writer.zstd.compress(b"x"))] = b"\0" * len(writer.zstd.compress(b"x"))
    path.write_bytes(changed)
    with open(path, "rb") as f:
        reader = FrameReader(f)
        assert dict(reader.documents({71}))
        with pytest.raises(Exception):  # noqa: B017  the decoder's error, or the checksum's
            dict(reader.documents({3}))
    other = tmp_path / "y.zst"
    with open(other, "wb") as f:
        writer = FrameWriter(f)
        writer.add(1, b"\1\0\0\0")
        writer.close()
    raw = bytearray(other.read_bytes())
    raw[-9 - 12 * 2 + 8] ^= 1  # the checksum of the first frame
    other.write_bytes(raw)
    with open(other, "rb") as f, pytest.raises(ValueError):
        dict(FrameReader(f).documents())


def test_only_files_that_may_hold_them_are_opened(spark, tmp_path):
    docs = spark.range(200).selectExpr("id doc_id", "concat('text ', id, ' ', repeat('word ', 200)) text")
    manifest = write_token_files(docs, public_path("byte_bpe_50k.json"), 2, output_directory(spark), part_bytes=1 << 15)
    rows = manifest.orderBy("first_key").collect()
    assert len(rows) > 3 and all(a.last_key < b.first_key for a, b in zip(rows, rows[1:]))
    for r in rows:  # files that can't hold it are gone, so opening them would fail
        if not r.first_key <= 7 <= r.last_key:
            os.unlink(r.path.removeprefix("file://"))
    assert [r.doc_id for r in read_token_files(manifest, {7}).collect()] == [7]


def test_unsteady_inputs_are_stored(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert steady(table.select("doc_id", F.col("text").cast("string")).where("doc_id > 3")).inputFiles() == table.inputFiles()
    mixed = table.repartition(3)
    assert steady(mixed).inputFiles() != table.inputFiles() and steady(mixed).count() == table.count()


def test_intermediates_are_deleted(spark, docs):
    before = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    with intermediates(spark):
        rows = jaccard_components(docs).collect()
    assert len(rows) == len(TEXTS) and set(os.listdir(shared_dir(spark).removeprefix("file://"))) <= before


def test_packing(docs, none):
    path = public_path("word_bpe_49k.json")
    rows = pack_documents(docs, path, 0).collect()
    assert sum(r.start + r.length for r in rows if r.doc_id == 7 and r.piece == max(x.piece for x in rows if x.doc_id == 7)) == sum(r.length for r in rows if r.doc_id == 7)
    assert all(len(r.ids) == 4 * r.length for r in rows) and {r.length for r in rows if r.doc_id in (4, 5, 6)} == {1}
    assert len([r for r in rows if r.doc_id is None]) == 2 and len([r for r in rows if r.doc_id == 8]) == 2
    assert pack_documents(none, path, 0).collect() == []
    with pytest.raises(ValueError):
        pack_documents(docs, path, 0, payload="text")


def test_special_token_strings():
    """Ids of texts with special-token strings are the library's own."""
    from tokenizers import Tokenizer

    r = random.Random(10)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "\n", "  ", "don't", "Émile", "a", "b1,", "漢字"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", *("".join(r.choice(parts) for _ in range(r.randint(1, 9))) for _ in range(400))]
    for name, spaces_matter in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        tok = Tokenizer.from_file(public_path(name))
        for text, ids in zip(texts, PieceEncoder(public_path(name), spaces_matter).encode_many(texts), strict=True):
            assert ids == b"".join(x.to_bytes(4, "little") for x in tok.encode(text, add_special_tokens=False).ids), (name, text)


def test_pack_fills_bins():
    r = random.Random(3)
    for _ in range(20):
        sizes = [r.randint(1, 100) for _ in range(r.randint(0, 400))]
        bins = pack(sizes, 100)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(0 < sum(sizes[i] for i in b) <= 100 for b in bins)
        assert len(bins) <= len(best_fit(sizes, 100))
    assert len(pack([60, 60, 40, 40, 50, 50, 30, 70], 100)) == 4


def test_local_search_ends_without_an_exchange_left():
    r = random.Random(11)
    sizes = [r.randint(600, 760) for _ in range(1500)]
    bins = pack(sizes, 2048)
    again = local_search([list(b) for b in bins], sizes, 2048)
    squares = [sum(sum(sizes[i] for i in b) ** 2 for b in x) for x in (bins, again)]
    assert sorted(i for b in bins for i in b) == list(range(1500)) and squares[0] == squares[1]


def test_token_output(spark, docs, none):
    path = public_path("byte_bpe_50k.json")
    manifest = write_token_files(docs, path, 2, output_directory(spark), part_bytes=1 << 16, frame_bytes=1 << 12)
    rows = read_token_files(manifest).collect()
    assert len(rows) == len(TEXTS) and sorted(r.start for r in rows)[0] == 0
    ordered = sorted(rows, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    ids = [r.doc_id for r in ordered]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    assert {r.doc_id for r in read_token_files(manifest, {8, 9}).collect()} == {8, 9}
    assert read_token_files(write_token_files(none, path, 2, output_directory(spark))).collect() == []


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Spam.Example.COM:80/a/B?x#y", "ftp://u@h/p", "a://b://c/d", "https://ok.example.org", "x://é/漢?", "http://spam.example.com/" + "q" * 100_000]
    pages = spark.createDataFrame([(i, u, "keep", 1.0) for i, u in enumerate(urls * 2)], "page_id long, url string, host string, score double")
    rows = sorted(filter_urls(pages, [("block", "example.org/"), ("allow", "spam.example.com/a")]).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path) for r in rows[:9]] == [("", ""), ("", ""), ("", ""), ("", ""), ("www.spam.example.com:80", "/a/B"), ("u@h", "/p"), ("b:", "//c/d"), ("ok.example.org", ""), ("é", "/漢")]
    assert all(r.verdict in ("allow", "block") for r in rows) and rows[0].verdict == "allow" and rows[0].score is None
    assert [r.verdict for r in rows[:10]] == [r.verdict for r in rows[10:]]
    assert filter_urls(pages.limit(0)).collect() == []


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/en/70"), (2, "http://a.com/en/1"), (3, "http://xcom/en/1"), (4, "http://example.org/es")], "page_id long, url string")
    rules = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "org/es/")]
    assert {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages, rules).collect()} == {1: ("example.com/en/7", "allow"), 2: ("com/en/", "block"), 3: (None, "allow"), 4: (None, "allow")}


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 1), (7, 0), (None, 1), (2, None), (99, 0)], "doc_id long, quality int")
    model = train_quality(docs, labels)
    rows = score_quality(docs, model).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert score_quality(none, model).collect() == []
    nothing = train_quality(docs, labels.limit(0))
    assert all(r.predicted == 1 for r in score_quality(docs, nothing).collect())
    assert score_quality(docs.withColumn("x y", F.lit(1)), model).count() == len(TEXTS)
