"""The pipeline stages, each judged on its own input and against a brute-force version; rows of every odd kind."""

from __future__ import annotations

import zlib

import corpus_pipeline as P
import numpy as np
import plain
import pyarrow as pa
import pytest

from docweave.llm._spark import stored
from docweave.llm.decontamination import budget, myers, normalise
from docweave.llm.quality import features, fit
from docweave.llm.tokenise import public_path

SF = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def kept(spark):
    """Texts before and after each stage but the last."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), "test")
        assert after.columns == columns and dict(after.dtypes) == dict(docs.dtypes), name
        out.append((by_id(docs), by_id(after)))
        docs = after
    return out


def test_stages_and_columns(kept):
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
    assert all(after and after.keys() <= before.keys() for before, after in kept)


def test_quality_stage(spark, kept):
    before, after = kept[0]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = sorted(i for i in labels if i in before and zlib.crc32(str(i).encode()) % 4 != 2)
    model = fit(features(pa.array([before[i] for i in known])), np.array([labels[i] for i in known], float))
    ids = sorted(before)
    score = model.score(features(pa.array([before[i] for i in ids])))
    assert after == {i: before[i] for i, s in zip(ids, score) if s >= 0.7}
    held = [i for i in labels if i in before and i not in known]
    assert sum((i in after) == labels[i] for i in held) / len(held) > 0.9


def test_line_stage(kept):
    before, after = kept[1]
    want = plain.dedup_lines(before)
    assert after == {i: t for i, t in want.items() if t == before[i] or t.strip(" \t\r\v\f\n")}


def test_join_stage(kept):
    before, after = kept[2]
    words = {i: t.lower().split() for i, t in before.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in words.items()}
    ids = sorted(before)
    groups = plain.Sets(len(ids))
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and 100 * len(x & y) >= 80 * len(x | y):
                groups.join(a, b)
    assert after == {i: before[i] for k, i in enumerate(ids) if groups.find(k) == k}


def test_decontamination_stage(spark, kept):
    before, after = kept[3]
    items = [normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = sorted(before.keys() - after.keys())
    some = [*gone, *sorted(after)[:40]]
    leaks = {i for i in some if any(myers(x, t)[0] <= budget(len(x), 0.08, 8) for t in (normalise(before[i]),) for x in items)}
    assert gone and leaks == set(gone) and all(after[i] == before[i] for i in after)


def test_packing_stage(spark, kept):
    from tokenizers import Tokenizer

    tok, texts = Tokenizer.from_file(public_path("word_bpe_49k.json")), kept[3][1]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    rows = P.STAGES[-1][1](spark, docs, SF).collect()
    pieces: dict[int, list] = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == texts.keys()
    for i, own in pieces.items():
        ids = np.array([*tok.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        assert [(r.start, r.length, r.ids_crc32) for r in sorted(own, key=lambda r: r.piece)] == [(at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for at in range(0, len(ids), 2048)]
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted string, n_lines int, n_removed string, component_id string, _goes long, _leak long, batch string, item string"


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_odd_rows(spark, name):
    """Nulls, empty and very long texts, repeats, clashing names, an empty table: none stops a stage, and what each does
    with them is its operator's stated result."""
    long = " ".join(f"w{k * k % 977}x{k}" for k in range(30_000))
    line = "a line of prose that is long enough to have some shingles of its own"
    texts = [(1, line), (1, line), (2, None), (3, ""), (4, "\n \t\n"), (None, None), (None, line), (5, long), (6, long), (7, f"\n{line}\n"), (8, "é 漢字 \u0000 end")]
    rows = [(i, t, None, None, None, 0.5, "p", 3, "x", None, 1, 2, None, "i") for i, t in texts]
    docs = spark.createDataFrame(rows, ODD).repartition(2)
    stage = dict(P.STAGES)[name]
    out = stage(spark, docs, SF).collect()
    assert stage(spark, docs.limit(0), SF).collect() == []
    got = sorted(((r.doc_id, r.text) for r in out), key=str) if name != "best-fit packing" else None
    if name == "quality classifier":  # none of these is labelled, so what the model says decides; no row is doubled or changed
        assert all(got.count(x) <= texts.count(x) for x in got)
    elif name == "line dedup":
        assert {(1, line), (2, None), (3, ""), (4, "\n \t\n"), (5, long), (8, "é 漢字 \u0000 end"), (None, None)} == set(got) and len(got) == 7
        assert {r.doc_id: r.n_chars for r in out}[1] == len(line)
    elif name == "n-gram Jaccard join":
        assert {i for i, _ in got} == {1, 2, 3, 4, 5, 8, None} and got.count((1, line)) == 2
    elif name == "benchmark decontamination":
        assert got == sorted(texts, key=str)
    else:
        assert len({(r.doc_id, r.piece) for r in out}) >= 9 and sum(r.length for r in out if r.doc_id == 1) == 2 * next(r.length for r in out if r.doc_id == 1)
        assert [r.length for r in out if r.doc_id in (2, 3, 4)] == [1, 1, 1]


def test_run_is_the_stages_one_after_the_other(spark, kept):
    rows = P.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == kept[3][1].keys()
    assert sum(r.length for r in rows) == sum(r.length for r in P.STAGES[-1][1](spark, stored(spark.createDataFrame(list(kept[3][1].items()), "doc_id long, text string"), "test"), SF).collect())
