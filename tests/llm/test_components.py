from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import _blocks
from docweave.llm._blocks import count_common, divide_skip, link_groups, links, merge_skip, sketches
from docweave.llm._components import components, local_components


def plain(edges):
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in root}


def graph(seed):
    r = random.Random(seed)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5000, 5000 + k) for k in range(1, 60)]
    loose = [(r.randrange(-50, 400), r.randrange(-50, 400)) for _ in range(200)]
    out = chain + star + loose + [(7, 7), (9000, 9000)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("one_task", [4_000_000, 0])
def test_components(spark, one_task):
    edges = graph(3)
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert {r.node: r.component for r in components(df, one_task).collect()} == plain(edges)
    assert components(df.limit(0), one_task).collect() == []


def test_local():
    edges = graph(5)
    a, b = np.array(edges).T
    nodes, root = local_components(a, b)
    assert dict(zip(nodes.tolist(), root.tolist())) == plain(edges)


def sets(seed, n):
    r = random.Random(seed)
    base = [frozenset(r.sample(range(60 * k, 60 * k + 60), 40)) for k in range(3)]
    return [frozenset(x for x in r.choice(base) if r.random() > 0.06) | frozenset(r.sample(range(10_000), r.randrange(4))) for _ in range(n)]


@pytest.mark.parametrize("n", [2, 7, 30, 90, 300])
@pytest.mark.parametrize("threshold", [(80, 100), (85, 100), (1, 2)])
def test_links_connect_what_pairs_connect(n, threshold):
    num, den = threshold
    for seed in range(6 if n < 300 else 1):
        own = sets(seed, n)
        want = plain([(i, j) for i in range(n) for j in range(i) if den * len(own[i] & own[j]) >= num * len(own[i] | own[j])] + [(i, i) for i in range(n)])
        arrays = [np.array(sorted(x << 40 for x in s), np.uint64) for s in own]
        sizes = np.array([len(s) for s in own])
        found = divide_skip(arrays, sizes, np.zeros(n, int), num, den)
        assert plain([*found, *[(i, i) for i in range(n)]]) == want
        assert all(den * len(own[a] & own[b]) >= num * len(own[a] | own[b]) for a, b in found)
        bounds = np.cumsum([0, *map(len, arrays)])
        for small in (1, 48):
            got = link_groups(np.concatenate(arrays), bounds, sizes, np.zeros(n, int), np.zeros(n, int), num, den, small=small)
            assert plain([*map(tuple, got.tolist()), *[(i, i) for i in range(n)]]) == want


def test_prints_that_agree_dont_link():
    """Values that share their first 48 bits only are different."""
    a = (np.arange(10, dtype=np.uint64) << np.uint64(16)) + np.uint64(1)
    got = link_groups(np.concatenate([a, a + np.uint64(1)]), np.array([0, 10, 20]), np.array([10, 10]), np.zeros(2, int), np.zeros(2, int), 4, 5)
    assert not len(got)


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_merge_skip(least):
    r = random.Random(least)
    for _ in range(200):
        lists = [sorted(r.sample(range(30), r.randint(1, 12))) for _ in range(r.randint(0, 7))]
        count = Counter(x for own in lists for x in own)
        assert list(merge_skip(lists, least)) == sorted((x, c) for x, c in count.items() if c >= least)


def test_blocks_by_lists(spark):
    """A block that chance keys hold together, cut into many tasks, has the links that all pairs have."""
    r = random.Random(4)
    own = {i: frozenset(r.sample(range(100 * (i % 5), 100 * (i % 5) + 60), 50)) for i in range(150)}
    own |= {i + 1000: own[i] - {min(own[i])} for i in range(0, 150, 3)}
    rows = [(i, np.array(sorted({x << 40 for x in s} | {7 << 20}), "<u8").tobytes(), np.array([x << 40 for x in s] + [7 << 20], "<i8").tobytes(), len(s) + 1) for i, s in own.items()]
    items = spark.createDataFrame(rows, "item long, content binary, keys binary, weight int").repartition(4)

    def parts(rows):
        values = [np.frombuffer(x, "<u8") for x in rows.column("content").to_pylist()]
        return np.concatenate(values), np.cumsum([0] + [len(v) for v in values]), np.array([len(v) for v in values])

    sets_ = {i: s | {-1} for i, s in own.items()}
    want = plain([(i, j) for i in own for j in own if i > j and 10 * len(sets_[i] & sets_[j]) >= 8 * len(sets_[i] | sets_[j])])
    for most, few in ((10**6, 16), (700, 16), (700, 1), (200, 1)):
        for occurrence in (True, False):
            found = links(items, parts, 8, 10, most, occurrence, few).collect()
            assert plain([(x.a, x.b) for x in found if x.a != x.b]) == want, (most, few, occurrence)


def test_known_labels_are_not_compared_again():
    own = [np.arange(0, 20, dtype=np.uint64) << np.uint64(40)] * 5
    side = np.array([0, 0, 0, 1, 1])
    found = divide_skip(own, np.full(5, 20), side, 4, 5, np.array([10, 10, 20, 10, 30]))
    assert len(found) == 2 and plain([*found, (0, 1), (0, 3)]) == dict.fromkeys(range(5), 0)


def test_sides_are_compared_across():
    own = [np.arange(0, 20, dtype=np.uint64) << np.uint64(40)] * 4
    found = divide_skip(own, np.full(4, 20), np.array([0, 0, 1, 1]), 4, 5)
    assert {frozenset(p) for p in found} == {frozenset((2, 0)), frozenset((2, 1)), frozenset((3, 0))}


@pytest.mark.parametrize("n", [1, 2, 7, 90, 300])
@pytest.mark.parametrize("threshold", [(80, 100), (85, 100), (1, 2)])
def test_counting_connects_what_pairs_connect(n, threshold):
    """Within a group, across its sides, with labels of what is connected, and with sets that have values of their own."""
    num, den = threshold
    for seed in range(4 if n < 300 else 1):
        own = sets(seed, n)
        sizes, own = np.array([len(s) for s in own]), [s & set(range(180)) for s in own]  # the other values count for the size only
        arrays = [np.array(sorted(x << 40 for x in s), np.uint64) for s in own]
        linked = [(i, j) for i in range(n) for j in range(i) if (den + num) * len(own[i] & own[j]) >= num * (sizes[i] + sizes[j])]
        alone = [(i, i) for i in range(n)]
        found = count_common(arrays, sizes, np.zeros(n, int), num, den)
        assert plain([*found, *alone]) == plain([*linked, *alone]) and {(max(p), min(p)) for p in found} <= set(linked)
        side = np.arange(n) % 2
        over = [p for p in linked if side[p[0]] != side[p[1]]]
        assert plain([*count_common(arrays, sizes, side, num, den), *alone]) == plain([*over, *alone])
        known = np.arange(n) // 4 * 4
        joined = [(i, int(known[i])) for i in range(n)]
        assert plain([*count_common(arrays, sizes, side, num, den, known), *joined]) == plain([*over, *joined])


def test_sketches_never_differ_in_more_than_the_sets():
    own = [np.array(sorted(s), np.uint64) for s in sets(1, 60)]
    values, index = np.unique(np.concatenate(own), return_inverse=True)
    for bits in (64, 256):
        sketch = sketches(np.repeat(np.arange(60), [len(s) for s in own]), index, 60, bits)
        for d in range(60):
            differ = np.bitwise_count(sketch ^ sketch[:, d : d + 1]).sum(0)
            assert all(differ[c] <= len(np.setxor1d(own[c], own[d])) for c in range(60)) and differ[d] == 0


def test_large_groups_of_near_copies_take_little_time():
    """Two families of edited copies, near the threshold, that one block holds: verified in a fraction of DivideSkip's time."""
    r = np.random.default_rng(6)
    base = [np.arange(400) + 1000 * k for k in range(2)]
    own = [np.unique(np.concatenate([b[r.random(400) > r.uniform(0.03, 0.12)], r.integers(5000, 9000, 25)])).astype(np.uint64) << np.uint64(40) for b in base for _ in range(250)]
    sizes, none = np.array([len(s) for s in own]), np.zeros(len(own), int)
    began = time.process_time()
    slow = divide_skip(own, sizes, none, 80, 100)
    middle = time.process_time()
    fast = count_common(own, sizes, none, 80, 100)
    took = time.process_time() - middle
    alone = [(i, i) for i in range(len(own))]
    assert plain([*fast, *alone]) == plain([*slow, *alone]) and 100 < len(slow) < len(own) - 20
    assert took < (middle - began) / 5


def test_large_blocks_of_op9_are_counted(monkeypatch):
    """The task over blocks uses DivideSkip only where T-occurrence is asked for."""

    class Rows:
        columns = ["item", "block", "i", "j", "side", "label", "content"]
        repartition = sortWithinPartitions = lambda self, *_: self

        def mapInArrow(self, fn, _):
            table = pa.table([range(60), [1] * 60, [0] * 60, [0] * 60, [0] * 60, pa.nulls(60, pa.int64()), [np.arange(k % 2 * 50, k % 2 * 50 + 40, dtype="<u8").tobytes() for k in range(60)]], names=self.columns)
            return [p for out in fn(table.to_batches()) for p in zip(*(c.to_pylist() for c in out.columns))]

    def parts(rows):
        values = [np.frombuffer(x, "<u8") for x in rows.column("content").to_pylist()]
        return np.concatenate(values), np.cumsum([0] + [len(v) for v in values]), np.array([len(v) for v in values])

    asked = []
    monkeypatch.setattr(_blocks, "divide_skip", lambda *x: asked.append(1) or divide_skip(*x))
    for occurrence in (False, True):
        assert not asked
        assert plain(_blocks._compared(Rows(), parts, 80, 100, occurrence)) == {i: i % 2 for i in range(60)}
    assert asked
