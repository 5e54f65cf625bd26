"""From items with keys to verified links: blocks of items that share keys, and tasks over blocks of bounded size.

Items are linked in a candidate graph through their keys (a star for each key, reduced to forests on the map side, so a key
that very many items share moves once for each task). Its components are blocks: no similar pair lies across two. A block
of up to ``most`` elements is one task. A larger one is cut into chunks. First each chunk is compared within itself and with
a few pivots of the block; in a group of near copies that connects all but a few. Then, in a block of up to ``few`` chunks, the
items outside its largest component are taken to every chunk. In a larger one, what may still link is looked up by key: of
the lists of items by key, those whose items aren't all connected go on (equal lists once), and in each the items outside the
list's largest component are taken to every chunk of the list. A pair that this leaves out is connected already, so nothing is
lost; no task grows with a block; a group of near copies takes as many tasks as it has chunks, and a vast block that chance
keys hold together as many as its lists that hold something apart.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._components import components, edge_batch, local_components
from ._spark import release, stored

MOST = 250_000
FEW = 16


def _key_stars(parts):
    """Within a map task: forests of its items, and one (key, root) for each key and forest."""
    items, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in parts:
        own = [np.frombuffer(k or b"", "<i8") for k in part.column(1).to_pylist()]
        keys += own
        items.append(np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(k) for k in own]))
    yield from _stars(np.concatenate(items), np.concatenate(keys), True)


def _stars(item: np.ndarray, key: np.ndarray, onward: bool):
    order = np.argsort(key, kind="stable")
    key, item = key[order], item[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    hub = item[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))] if len(key) else item
    nodes, root = local_components(item, hub)
    yield _keyed(np.zeros(len(nodes), np.int64), np.zeros(len(nodes), bool), nodes, root)
    if onward:
        yield _keyed(key[first], np.ones(int(first.sum()), bool), root[np.searchsorted(nodes, item[first])], np.zeros(int(first.sum()), np.int64))


def _keyed(key, has_key, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64(), mask=~has_key), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["k", "a", "b"])


def _across(parts):
    """After the shuffle by key: the same again over all tasks' roots."""
    item, key = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in parts:
        real = part.column(0).is_valid().to_numpy(zero_copy_only=False)
        a, b = part.column(1).to_numpy(zero_copy_only=False), part.column(2).to_numpy(zero_copy_only=False)
        yield edge_batch(a[~real], b[~real])
        item.append(a[real])
        key.append(part.column(0).drop_null().to_numpy(zero_copy_only=False))
    for batch in _stars(np.concatenate(item), np.concatenate(key), False):
        yield edge_batch(batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False))


def blocks(items: DataFrame) -> DataFrame:
    """(item, block) of ``items`` (item long, keys binary of int64) that share a key with another item."""
    stars = items.select("item", "keys").mapInArrow(_key_stars, "k long, a long, b long")
    edges = stars.repartition(F.coalesce("k", "a")).mapInArrow(_across, "a long, b long")
    return components(edges.where("a <> b")).toDF("item", "block")


def links(items: DataFrame, sets: Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]], num: int, den: int, most: int = MOST, occurrence: bool = False, few: int = FEW) -> DataFrame:
    """(a, b): links between items of Jaccard similarity num / den or more, enough to connect all that are linked.

    ``items``: item, keys, weight (elements, about) and whatever ``sets(rows)`` needs to give (values, bounds, sizes): item i has the distinct uint64
    values[bounds[i]:bounds[i + 1]], ascending, in common with others at most, and ``sizes[i]`` elements in all. Two items that link must
    share a key. ``occurrence``: every block is searched by T-occurrence; otherwise small ones by comparing pairs, larger ones
    by counting.
    """
    in_block = stored(blocks(items).join(items.select("item", "weight"), "item"), "blocks")
    sizes = in_block.groupBy("block").agg(F.sum("weight").alias("n")).select(F.col("block").alias("of"), _parts(F.col("n"), most).alias("chunks"))
    dealt = in_block.join(sizes, in_block["block"] == sizes["of"]).drop("of").withColumn("chunk", F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int"))
    dealt = stored(dealt, "blocks")
    rows, none = items.drop("keys", "weight"), F.lit(0)
    large = dealt.where("chunks > 1")
    pivot = F.min(F.struct(F.xxhash64("item", F.lit(1)), "item")).alias("p")
    pivots = large.groupBy("block", "chunks", F.pmod(F.xxhash64("item", F.lit(2)), F.lit(PIVOTS)).alias("k")).agg(pivot)
    everywhere = pivots.select(F.col("p.item").alias("item"), "block", F.explode(F.sequence(none, F.col("chunks") - 1)).alias("i"))
    tasks = dealt.select("item", "block", F.col("chunk").alias("i")).unionByName(everywhere)
    tasks = tasks.select("item", "block", "i", none.alias("j"), none.alias("side"), F.lit(None).cast("long").alias("label"))
    near = stored(_compared(rows.join(tasks, "item"), sets, num, den, occurrence), "links")
    if large.isEmpty():
        return near
    known = large.join(components(near), F.col("item") == F.col("node"), "left").select("item", "block", "weight", "chunks", F.coalesce("component", "item").alias("label"))
    known = stored(known, "labels")
    rest = _apart(known.where(F.col("chunks") <= few), most)
    if not (vast := known.where(F.col("chunks") > few)).isEmpty():
        entries = stored(vast.join(items.select("item", "keys"), "item").mapInArrow(_by_key, "key long, item long, weight long, label long"), "keys")
        lists = entries.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("h"), F.sum("weight").alias("total"), F.min("label").alias("low"), F.max("label").alias("high"))
        lists = lists.where("low < high").groupBy("n", "h", "total").agg(F.min("key").alias("block")).select("block", _parts(F.col("total"), most).alias("chunks"))
        listed = stored(entries.join(lists, F.col("key") == F.col("block")).drop("key"), "lists")
        rest = rest.unionByName(_apart(listed, most))
    rest = stored(rest, "tasks")  # few rows, as a rule: then the items needn't be shuffled for them
    return near.unionByName(_compared(rows.join(rest, "item"), sets, num, den, occurrence))


def _apart(listed: DataFrame, most: int) -> DataFrame:
    """Tasks that take what lies outside the largest component of each block of ``listed`` (item, block, weight, chunks, label)
    to every chunk of the block."""
    none = F.lit(0)
    main = listed.groupBy("block", "label").agg(F.sum("weight").alias("w")).groupBy("block").agg(F.max_by("label", F.struct("w", "label")).alias("main"))
    others = listed.join(main, "block").where("label <> main").drop("main")
    count = others.groupBy("block").agg(F.sum("weight").alias("n")).select(F.col("block").alias("of"), _parts(F.col("n"), most).alias("ways"))
    others = others.join(count, others["block"] == count["of"]).drop("of")
    chunk = F.pmod(F.xxhash64("item"), F.col("chunks")).cast("int")
    one = listed.join(count, listed["block"] == count["of"]).select("item", "block", chunk.alias("i"), F.explode(F.sequence(none, F.col("ways") - 1)).alias("j"), none.alias("side"), "label")
    two = others.withColumn("j", F.pmod(F.xxhash64("item", F.lit(3)), F.col("ways")).cast("int"))
    return one.unionByName(two.select("item", "block", F.explode(F.sequence(none, F.col("chunks") - 1)).alias("i"), "j", F.lit(1).alias("side"), "label"))


def _by_key(parts):
    """A row for each key of each item."""
    for part in parts:
        item, weight, label, keys = (part.column(part.schema.get_field_index(n)) for n in ("item", "weight", "label", "keys"))
        own = [np.frombuffer(k or b"", "<i8") for k in keys.to_pylist()]
        n = pa.array(np.repeat(np.arange(len(own)), [len(k) for k in own]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *own])), item.take(n), weight.cast(pa.int64()).take(n), label.take(n)], names=["key", "item", "weight", "label"])


PIVOTS = 4


def _parts(n, most: int):
    return F.ceil(F.greatest(n, F.lit(1)) / most).cast("int")


def _compared(rows: DataFrame, sets: Callable, num: int, den: int, occurrence: bool) -> DataFrame:
    """(a, b): links within the tasks (block, i, j) of ``rows``; a task with sides wants only links across them."""
    spread = rows.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "item", "side")
    names = spread.columns

    def work(parts):
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for part in (p.slice(i, 500) for p in parts for i in range(0, p.num_rows, 500)):
            keys = _task_keys(part, names)
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            at = 0
            if held and size > _AT_ONCE:  # whole tasks only
                end = 0 if (keys[0] != last).any() else int(cut[0]) if len(cut) else len(keys)
                held.append(part.slice(0, end))
                if end < len(keys):
                    yield found(held)
                    held, size = [], 0
                    release()
                at = end
            if at < len(keys):
                held.append(part.slice(at))
            size += part.nbytes
            last = keys[-1]
        if held:
            yield found(held)
        held = []
        release()

    def found(held):
        table = pa.Table.from_batches(held).combine_chunks()
        keys, item = _task_keys(table, names), table.column("item").to_numpy()
        new = np.ones(len(item), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(1)
        one, side = new.copy(), table.column("side").to_numpy()
        one[1:] |= (item[1:] != item[:-1]) | (side[1:] != side[:-1])  # repeated items stand for themselves once
        table, item, side, group = table.filter(pa.array(one)), item[one], side[one], (np.cumsum(new) - 1)[one]
        known = table.column("label").fill_null(0).to_numpy() if side.any() else None
        pairs = link_groups(*sets(table), group, side, num, den, known, *((1, divide_skip) if occurrence else (_SMALL, count_common)))
        return edge_batch(item[pairs[:, 0]], item[pairs[:, 1]])

    return spread.mapInArrow(work, "a long, b long")


_AT_ONCE, _SMALL, _PRINT = 1 << 20, 48, np.uint64(16)


def _task_keys(part, names: list[str]) -> np.ndarray:
    columns = [part.column(names.index(c)) for c in ("block", "i", "j")]
    return np.stack([c.to_numpy().astype(np.int64) if isinstance(c, pa.ChunkedArray) else c.to_numpy(zero_copy_only=False).astype(np.int64) for c in columns], 1)


def link_groups(values: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, group: np.ndarray, side: np.ndarray, num: int, den: int, known: np.ndarray | None = None, small: int = _SMALL, search: Callable | None = None) -> np.ndarray:
    """Links (pairs of places) within each group of items, enough to connect all that are linked; ``group`` ascends, and a
    group with sides wants only pairs across them. Groups of up to ``small`` items are compared together, in rounds; larger
    ones by ``search`` (DivideSkip). ``known``: labels of items that are connected already (groups with sides)."""
    first = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]])
    out = [np.empty((0, 2), np.int64)]
    n = np.diff(first)
    split = np.maximum.reduceat(side, first[:-1]) if len(group) else side
    large = (n > small) | (split > 0)
    for g in np.flatnonzero(large).tolist():
        a, b = int(first[g]), int(first[g + 1])
        own = [values[bounds[i] : bounds[i + 1]] for i in range(a, b)]
        found = (search or divide_skip)(own, sizes[a:b], side[a:b], num, den, known[a:b] if known is not None and split[g] else None)
        out.append(np.array(found, np.int64).reshape(-1, 2) + a)
    label, pivot_done = np.arange(len(group)), np.repeat(large | (n < 2), n)
    while True:
        # in each group, an item that hasn't been compared becomes the pivot for those not yet connected with it
        waiting = np.flatnonzero(~pivot_done)
        if not len(waiting):
            return np.concatenate(out)
        lead = np.ones(len(waiting), bool)
        lead[1:] = group[waiting[1:]] != group[waiting[:-1]]
        pivots = waiting[lead]
        pivot_done[pivots] = True
        of = np.full(int(group[-1]) + 1, -1)
        of[group[pivots]] = pivots
        x = waiting[~lead]
        p = of[group[x]]
        near = (label[x] != label[p]) & (np.minimum(sizes[x], sizes[p]) * den >= num * np.maximum(sizes[x], sizes[p]))
        x, p = x[near], p[near]
        held = np.diff(bounds)
        for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(np.cumsum(held[x] + held[p]) >> 20)) + 1):
            xs, ps = x[part], p[part]
            both = _overlaps(values, bounds, ps, xs)
            yes = (den + num) * both >= num * (sizes[xs] + sizes[ps])
            for k in np.flatnonzero(yes).tolist():  # the prints may count too many, never too few
                i, j = xs[k], ps[k]
                whole = len(np.intersect1d(values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]], assume_unique=True))
                yes[k] = (den + num) * whole >= num * int(sizes[i] + sizes[j])
            out.append(np.stack([xs[yes], ps[yes]], 1))
            for a, b in zip(xs[yes].tolist(), ps[yes].tolist()):
                if (old := label[a]) != label[b]:
                    g0, g1 = first[np.searchsorted(first, a, side="right") - 1], first[np.searchsorted(first, a, side="right")]
                    part = label[g0:g1]
                    part[part == old] = label[b]


def _overlaps(values: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common values of items a[i] and b[i], or a few more, by one sort of (pair, 48 bits of the value) for all pairs."""
    items = np.concatenate([a, b])
    pair = np.tile(np.arange(len(a), dtype=np.uint64), 2)
    size = (bounds[items + 1] - bounds[items]).astype(np.int64)
    start = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(start - bounds[items], size)
    key = np.repeat(pair << np.uint64(48), size) | values[place] >> _PRINT
    key.sort()
    same = key[1:][key[1:] == key[:-1]] >> np.uint64(48)
    return np.bincount(same.astype(np.int64), minlength=len(a))


class Union:
    """Disjoint sets as an array of labels, so that members can be compared all at once."""

    def __init__(self, n: int, known: np.ndarray | None = None):
        self.label = np.arange(n)
        self.members: dict[int, list[int]] = {}
        if known is not None:
            _, first, index = np.unique(known, return_index=True, return_inverse=True)
            self.label = first[index]
            order = np.argsort(index, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(index[order])) + 1):
                self.members[int(first[index[own[0]]])] = own.tolist()

    def join(self, a: int, b: int) -> None:
        x, y = int(self.label[a]), int(self.label[b])
        if x == y:
            return
        own, more = self.members.pop(x, [x]), self.members.pop(y, [y])
        if len(own) < len(more):
            x, own, more = y, more, own
        self.label[more] = x
        own += more
        self.members[x] = own


def needed(size: int, num: int, den: int) -> int:
    """The least overlap of a set of ``size`` with any set it links with."""
    return -(-num * size // den)


_BITS = 2  # bits of a sketch for each value of a set, on average
MU = 0.0085  # cost of a probe against that of merging, as in DivideSkip's published rule


def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(number, on how many lists) of the numbers on ``least`` of the ascending lists or more, in order, by a heap of the lists'
    heads; what can't reach that many is jumped over by binary search."""
    at, heap = [0] * len(lists), [(x[0], k) for k, x in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= least:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            yield top, len(popped)
            for k in popped:
                at[k] += 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                return
            for k in popped:
                at[k] = bisect_left(lists[k], heap[0][0], at[k])
        for k in popped:
            if at[k] < len(lists[k]):
                heapq.heappush(heap, (lists[k][at[k]], k))


def divide_skip(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, num: int, den: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all similar sets: ``sets`` are sorted arrays, ``sizes`` the sizes that count for the similarity.

    For each set the inverted lists of its values are divided: the longest ones, by the published rule on the needed overlap,
    are probed by binary search for what the heap merge of the others brings up often enough. Sets that are connected to it
    already, or can't be similar by size, are taken off the lists before.
    """
    n, across = len(sets), bool(side.any())
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    values, index = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(index, kind="stable")
    posting = np.repeat(np.arange(n), np.diff(bounds))[order]
    start = np.searchsorted(index[order], np.arange(len(values) + 1))
    entry, length = index[order] * n + posting, np.diff(start)  # (value, owner) as one ascending number, for the probes
    groups, out = Union(n, known), []
    for d in range(n):
        if across and side[d] == 0:
            continue
        size, terms = int(sizes[d]), index[bounds[d] : bounds[d + 1]]
        want = -(-num * (size + sizes) // (den + num))  # the overlap that links d with each
        allowed = (side == 0) if across else np.arange(n) < d
        allowed &= (np.minimum(size, sizes) * den >= num * np.maximum(size, sizes)) & (groups.label != groups.label[d])
        if not allowed.any() or len(terms) < (least := int(want[allowed].min())):
            continue
        terms = terms[np.argsort(length[terms], kind="stable")]
        n_long = min(least - 1, len(terms) - 1, int(least / (MU * math.log2(max(2, int(length[terms[-1]]))) + 1)))
        short, long = terms[: len(terms) - n_long], terms[len(terms) - n_long :]
        first = np.cumsum(length[short]) - length[short]
        ids = posting[np.arange(int(length[short].sum())) - np.repeat(first - start[short], length[short])]
        of = np.repeat(np.arange(len(short)), length[short])
        while True:
            on = allowed[ids]
            ids, of = ids[on], of[on]
            if not len(ids):
                break
            lists = [x.tolist() for x in np.split(ids, np.flatnonzero(of[1:] != of[:-1]) + 1)]
            for c, count in merge_skip(lists, max(1, least - n_long)):
                if count + n_long < want[c]:
                    continue
                key = long * n + c
                place = np.minimum(np.searchsorted(entry, key), len(entry) - 1)
                if count + int((entry[place] == key).sum()) >= want[c]:
                    out.append((d, c))
                    groups.join(d, c)
                    allowed &= groups.label != groups.label[d]
                    allowed[: c + 1] = False
                    break
            else:
                break
    return out


def sketches(owner: np.ndarray, index: np.ndarray, n: int, bits: int) -> np.ndarray:
    """(word, set) parities of how many values of each set fall on each bit: two sets differ in as many values as their
    sketches in bits, or in more. ``owner`` ascends."""
    out, step = np.empty((n, bits // 64), np.uint64), max(1, (1 << 20) // bits)
    cut = np.searchsorted(owner, np.arange(0, n + step, step))
    for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        own = out[k * step : (k + 1) * step]
        count = np.bincount((owner[a:b] - k * step) * bits + index[a:b] % bits, minlength=len(own) * bits)
        own[:] = np.packbits((count & 1).astype(bool)).view(np.uint64).reshape(own.shape)
    return np.ascontiguousarray(out.T)


def count_common(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, num: int, den: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all similar sets, as ``divide_skip`` finds them, by counting what a set has in common with others.

    Among near copies most lists of sets by value are as long as the group, so sets are compared all at once with one of them:
    first sketches, which rule out only pairs that differ too much; what they leave and isn't connected yet is counted exactly.
    Sets of the component that is the largest wait, as those outside it look for them.
    """
    n, across, held = len(sets), bool(side.any()), np.array([len(s) for s in sets])
    values, index, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, bounds = np.repeat(np.arange(n), held), np.concatenate([[0], np.cumsum(held)])
    alone = np.bincount(owner, weights=count[index] == 1, minlength=n).astype(np.int64)
    able = (held > 0) & (den * (held - alone) >= num * sizes)
    bits = min(1 << 13, max(64, 1 << int(_BITS * len(index) / n).bit_length()))
    sketch = sketches(owner, index, n, bits)
    # a pair needs (den + num) * common >= num * (sizes + sizes), and held + held - 2 * common is what it differs in
    spare, has = (den + num) * held - 2 * num * sizes, np.zeros(len(values), bool)
    reach = np.where(able & (side == 0), spare, np.iinfo(np.int64).min // 2)
    groups, out, main = Union(n, known), [], -1
    todo = np.flatnonzero(able & (side > 0) if across else able).tolist()
    while todo:
        waiting = []
        for d in todo:
            if not across and groups.label[d] == main:
                waiting.append(d)
                continue
            differ = np.bitwise_count(sketch ^ sketch[:, d : d + 1]).sum(0, dtype=np.uint16)
            near = np.flatnonzero(reach + spare[d] >= (den + num) * differ.astype(np.int64))
            near = near[groups.label[near] != groups.label[d]]
            if not len(near):
                continue
            has[terms := index[bounds[d] : bounds[d + 1]]] = True
            first = np.cumsum(held[near]) - held[near]
            place = np.arange(int(held[near].sum())) - np.repeat(first - bounds[near], held[near])
            common = np.add.reduceat(has[index[place]], first, dtype=np.int64)
            has[terms] = False
            near = near[(den + num) * common >= num * (sizes[d] + sizes[near])]
            for c in near[np.unique(groups.label[near], return_index=True)[1]].tolist():
                out.append((d, c))
                groups.join(d, c)
            label = int(groups.label[d])
            if len(groups.members.get(label, ())) > len(groups.members.get(main, ())):
                main = label
        todo = [d for d in waiting if groups.label[d] != main]
    return out
