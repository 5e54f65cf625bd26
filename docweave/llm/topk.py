"""Exact top-k search by inner product in M-trees.

Inner products become distances by one more coordinate: with ``M`` the largest norm of the candidates, ``x' = (x, sqrt(M^2 -
|x|^2))`` and ``q' = (q, 0)`` have ``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``, so the nearest are those of the largest product, and
distances obey the triangle inequality. A tree's pages hold routing entries: a centre, a covering radius and the distance to the
parent's centre. A query walks the tree best first; an entry is passed over by the stored parent distance before its own
distance is computed, a page by its radius, a leaf's vectors by theirs.

Candidates are dealt to shards by the nearest of a few pivots (fitted on a bounded sample; every candidate is indexed), each an
M-tree that is built once for the blocks of queries that come to it. A block searches one shard of its own pivot first; that
gives each query a score to beat. It then goes on only to the shards of pivots whose bound (q.p + |q| * radius, at most |q| *
largest norm) doesn't exclude all its queries, and starts there with the scores to beat.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._route import pack, unpack
from ._spark import pieces, stored

SLACK = 1e-6
NONE = -(2**62)  # below every score
PIVOTS, SAMPLE = 256, 4096
TOGETHER = 64  # blocks that meet a shard in one task


class MTree:
    """Pages of up to ``page`` entries over integer vectors with ids; built by recursive clustering around spread centres."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = 256):
        self.ids, self.whole, self.raw = ids.astype(np.int64), vectors, vectors.astype(np.float64)
        self.computed = 0  # distances and products of queries so far
        norm = (self.raw**2).sum(1)
        self.top = float(norm.max()) if len(norm) else 0.0
        self.slack = SLACK + 1e-7 * np.sqrt(self.top)  # for the rounding of stored distances
        self.points = np.concatenate([self.raw, np.sqrt(np.maximum(self.top - norm, 0))[:, None]], 1)
        self.page, self.nodes = page, []
        if len(ids):
            everything = np.arange(len(ids))
            self.centre = self._centre(everything)
            self.root = self._build(everything, self.centre)

    def _centre(self, rows: np.ndarray) -> int:
        """The row nearest to the mean."""
        p = self.points[rows]
        return int(rows[((p - p.mean(0)) ** 2).sum(1).argmin()])

    def _distance(self, a: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(((self.points[a] - self.points[row]) ** 2).sum(1))

    def _build(self, rows: np.ndarray, centre: int) -> int:
        """Append the node over ``rows``; inner nodes hold (child, centre row, radius, parent distance), leaves rows."""
        if len(rows) <= self.page:
            d = self._distance(rows, centre)
            order = np.lexsort((self.ids[rows], d))
            self.nodes.append(("leaf", rows[order], d[order], int(self.ids[rows].min())))
            return len(self.nodes) - 1
        ways = min(16, -(-len(rows) // self.page))
        seeds = [centre]
        least = self._distance(rows, centre)
        while len(seeds) < ways and least.max() > 0:  # each next seed is the row farthest from those before
            seeds.append(int(rows[least.argmax()]))
            least = np.minimum(least, self._distance(rows, seeds[-1]))
        if len(seeds) == 1:  # copies of one vector: cut by id
            parts = [p for p in np.array_split(rows[np.argsort(self.ids[rows], kind="stable")], ways)]
            centres = [centre] * ways
        else:
            near = np.argmin(np.stack([self._distance(rows, s) for s in seeds]), axis=0)
            parts = [rows[near == k] for k in range(len(seeds))]
            centres = [self._centre(p) if len(p) else centre for p in parts]
        own = [k for k in range(len(parts)) if len(parts[k])]
        if len(own) == 1:
            parts = list(np.array_split(parts[own[0]], ways))
            centres, own = [self._centre(p) for p in parts], list(range(ways))
        children = [self._build(parts[k], centres[k]) for k in own]
        c = np.array([centres[k] for k in own])
        radius = np.array([self._distance(parts[k], centres[k]).max() for k in own])
        smallest = np.array([self.ids[parts[k]].min() for k in own])
        self.nodes.append(("inner", np.array(children), c, radius, self._distance(c, centre), smallest))
        return len(self.nodes) - 1

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query place, id, score) of each query's k best other than the id ``own``, ties to the smaller id; none below
        ``floor``, a score that k others are known to reach.

        The queries of a block walk together, best first by their least bound; at each entry those go on that the bounds
        don't exclude: first the stored parent distance, then the covering radius, in a leaf each vector's stored distance.
        """
        if not len(self.ids) or not len(queries):
            return (np.empty(0, np.int64),) * 3
        q = queries.astype(np.float64)
        square = (q**2).sum(1)
        order = np.argsort(self.ids, kind="stable")
        tie = np.empty(len(order), np.int64)  # larger for smaller ids
        tie[order] = len(order) - 1 - np.arange(len(order))
        width = 1 << max(1, int(len(order) - 1).bit_length())
        floor = np.full(len(q), NONE) if floor is None else floor
        largest = float(np.sqrt(square.max() * self.top))  # no product is beyond, nor any part of its sum
        if largest >= 2.0**53 or largest * width >= 2.0**62:
            return self._each(own, queries, k, floor, largest)
        none = NONE
        best = np.full((len(q), k), none, np.int64)  # score * width + tie
        limit = np.full(len(q), np.inf)
        told = floor > NONE
        limit[told] = self._limit(square[told], floor[told])
        nodes = [(0.0, 0, self.root, np.arange(len(q)), np.zeros(len(q)), self._to(q, square, np.array([self.centre]))[:, 0])]
        tick = 0
        while nodes:
            _, _, node, active, low, to_centre = heapq.heappop(nodes)
            go = low <= limit[active]
            active, to_centre = active[go], to_centre[go]
            if not len(active):
                continue
            entry = self.nodes[node]
            if entry[0] == "leaf":
                _, rows, d, _ = entry
                a = np.searchsorted(d, to_centre - limit[active])
                b = np.searchsorted(d, to_centre + limit[active], side="right")
                # queries of like reach together, so that none meets vectors that its own bound excludes
                for a0, b0, mine in self._reaches(a, b):
                    self._leaf(rows[a0:b0], active[mine], own, q, square, width, tie, best, limit)
            else:
                _, children, centres, radius, parent, _ = entry
                near = np.abs(to_centre[:, None] - parent) - radius <= limit[active][:, None]  # no distance needed so far
                open_ = np.flatnonzero(near.any(0))
                d = self._to(q[active], square[active], centres[open_])
                for at, j in enumerate(open_.tolist()):
                    bound = np.maximum(0.0, d[:, at] - radius[j])
                    on = near[:, j] & (bound <= limit[active])
                    if on.any():
                        tick += 1
                        heapq.heappush(nodes, (float(bound[on].min()), tick, int(children[j]), active[on], bound[on], d[on, at]))
        place, at = np.nonzero(best > none)
        keys = best[place, at]
        score = keys // width
        on = score >= floor[place]
        return place[on], self.ids[order[len(order) - 1 - keys[on] % width]], score[on]

    def _limit(self, square: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance of a candidate with that score."""
        return np.sqrt(np.maximum(0.0, square + self.top - 2.0 * score)) + self.slack

    @staticmethod
    def _reaches(a: np.ndarray, b: np.ndarray):
        """(from, to, queries) so that each query meets its own rows [a, b) and few others."""
        some = np.flatnonzero(b > a)
        if not len(some):
            return
        lo, hi = int(a[some].min()), int(b[some].max())
        if (b[some] - a[some]).sum() * 4 >= 3 * (hi - lo) * len(some) or len(some) == 1:
            yield lo, hi, some
            return
        order = some[np.lexsort((b[some], a[some]))]
        for part in np.array_split(order, min(8, len(order))):
            yield int(a[part].min()), int(b[part].max()), part

    def _leaf(self, rows, active, own, q, square, width, tie, best, limit) -> None:
        """Multiply queries with a leaf's vectors and keep what is better."""
        k = best.shape[1]
        self.computed += len(active) * len(rows)
        key = (q[active] @ self.raw[rows].T).astype(np.int64) * width + tie[rows]
        key[self.ids[rows] == own[active][:, None]] = NONE
        gain = key.max(1) > best[active, 0]
        active = active[gain]
        if len(active):
            merged = np.concatenate([best[active], key[gain]], 1)
            merged = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            worst = merged.min(1)
            merged[np.arange(len(active)), merged.argmin(1)] = merged[:, 0]
            merged[:, 0] = worst  # the worst comes first
            best[active] = merged
            full = worst > NONE
            mine = active[full]
            limit[mine] = np.minimum(limit[mine], self._limit(square[mine], worst[full] // width))

    def _each(self, own: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``search`` where products don't fit into a float's 53 bits: every product, in whole numbers."""
        out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64),) * 3]
        kind = np.int64 if largest < 2.0**62 else object
        whole = self.whole.astype(kind)
        self.computed += len(queries) * len(whole)
        for p, query in enumerate(queries.astype(kind)):
            score = whole @ query
            at = np.flatnonzero(self.ids != own[p])
            if kind is object:
                if any(abs(x) >= 2**63 for x in score[at]):
                    raise OverflowError("an inner product is beyond 64 bits")
                score = score.astype(np.int64)
            at = at[score[at] >= floor[p]]
            at = at[np.lexsort((self.ids[at], ~score[at]))][:k]
            out.append((np.full(len(at), p), self.ids[at], score[at]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _to(self, q: np.ndarray, square: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Distances of the queries to the candidates ``rows``."""
        self.computed += len(q) * len(rows)
        return np.sqrt(np.maximum(0.0, square[:, None] + self.top - 2.0 * (q @ self.raw[rows].T)))


def whole_vectors(df: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v, size): each component x as floor(scale * x), x as double; vectors that are null or empty or hold null or
    components that aren't finite are left out, and so are rows with a null id."""
    vec = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    out = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(vec, lambda x: F.floor(x * scale).cast("long")).alias("v"), F.size("embedding").alias("size"))


def _narrow(a: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest signed type that holds them."""
    low, high = (int(a.min()), int(a.max())) if len(a) else (0, 0)
    return a.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _opened(rows: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, vectors, floors) of a bundle."""
    ids, values, floor = unpack(rows)
    return ids, values.reshape(len(ids), -1), floor


def fit_pivots(sizes: np.ndarray, vectors: list[np.ndarray], most: int, rounds: int = 5) -> dict[int, np.ndarray]:
    """For each size of the sampled vectors its share of ``most`` pivots: spread seeds, moved to their members' means."""
    out = {}
    for size in np.unique(sizes).tolist():
        x = np.unique(np.stack([v for v, s in zip(vectors, sizes) if s == size]).astype(float), axis=0)
        seeds, least = [0], ((x - x[0]) ** 2).sum(1)
        while len(seeds) < min(len(x), max(1, most * int((sizes == size).sum()) // len(sizes))) and least.max() > 0:
            seeds.append(int(least.argmax()))
            least = np.minimum(least, ((x - x[seeds[-1]]) ** 2).sum(1))
        p = x[seeds]
        for _ in range(rounds):
            near = ((p**2).sum(1) - 2 * x @ p.T).argmin(1)
            sums = np.stack([np.bincount(near, x[:, j], len(p)) for j in range(x.shape[1])], 1)
            n = np.bincount(near, minlength=len(p))
            p[n > 0] = sums[n > 0] / n[n > 0, None]
        out[size] = p
    return out


def _dealt(df: DataFrame, pivots: dict[int, np.ndarray], product: bool) -> DataFrame:
    """``df`` (vec_id, v, size) with its pivot (by product or distance; 0 where its size has none), its distance to that and
    its norm."""

    def each(batches):
        for batch in batches:
            size, v = batch.column("size").to_numpy(), batch.column("v")
            flat, first = v.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
            pivot, far, norm = np.zeros(len(size), np.int32), np.zeros(len(size)), np.zeros(len(size))
            for s in np.unique(size).tolist():
                at = np.flatnonzero(size == s)
                x = flat[first[at][:, None] + np.arange(s)].astype(float)
                norm[at] = np.sqrt((x**2).sum(1))
                if s in pivots:
                    p = pivots[s]
                    close = x @ p.T if product else 2 * x @ p.T - (p**2).sum(1)
                    pivot[at] = close.argmax(1)
                    far[at] = np.sqrt(((x - p[pivot[at]]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(far), pa.array(norm)], names=[*batch.schema.names, "pivot", "far", "norm"])

    return df.select("vec_id", "v", "size").mapInArrow(each, "vec_id long, v array<long>, size int, pivot int, far double, norm double")


def _bundles(dealt: DataFrame, each: int) -> DataFrame:
    """(size, pivot, part, rows): vectors of one size and pivot in bundles of about ``each``."""
    ways = dealt.groupBy("size", "pivot").agg(F.ceil(F.count("*") / each).alias("ways"))
    parts = dealt.join(ways, ["size", "pivot"]).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("ways")).cast("int"))

    def bundle(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        ids, v = table.column("vec_id").to_numpy(), table.column("v").combine_chunks()
        v = pa.concat_arrays(v.chunks) if isinstance(v, pa.ChunkedArray) else v
        rows = pack(ids, _narrow(v.flatten().to_numpy()), np.full(len(ids), NONE))
        key = {n: table.column(n)[0].as_py() for n in ("size", "pivot", "part")}
        return pa.Table.from_pylist([{**key, "rows": rows}], schema=pa.schema([*((n, pa.int32()) for n in key), ("rows", pa.binary())]))

    columns = parts.select("size", "pivot", "part", "vec_id", "v")
    return columns.groupBy("size", "pivot", "part").applyInArrow(bundle, "size int, pivot int, part int, rows binary")


_KEYS = ("size", "pivot", "part", "way")


def _searched(shards: DataFrame, sent: DataFrame, k: int, page: int) -> DataFrame:
    """What the blocks ``sent`` (size, pivot, part, way, home, block, rows) find in the shards that they are sent to, and the
    blocks themselves with the scores to beat: query_id, vec_id, score of finds; size, home, block, rows of blocks."""
    wanted = shards.join(sent.select(*_KEYS).distinct(), ["size", "pivot", "part"]).select(*(F.col(n).alias(n) for n in _KEYS), "rows")
    kinds = [(n, pa.int64()) for n in ("query_id", "vec_id", "score")] + [(n, pa.int32()) for n in ("size", "home", "block")] + [("rows", pa.binary())]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        tree = MTree(*_opened(left.column("rows")[0].as_py())[:2], page) if left.num_rows else None
        found, blocks = [(np.empty(0, np.int64),) * 3], []
        for block in right.select(["size", "home", "block", "rows"]).to_pylist():
            own, vectors, floor = _opened(block["rows"])
            if tree is not None:
                place, ids, score = tree.search(own, vectors, k, floor)
                found.append((own[place], ids, score))
                full = np.bincount(place, minlength=len(own)) == k
                least = np.full(len(own), 2**62)
                np.minimum.at(least, place, score)
                floor = np.where(full, np.maximum(floor, least), floor)
            blocks.append({**block, "rows": pack(own, _narrow(vectors.ravel()), floor)})
        finds = pa.table([np.concatenate(x) for x in zip(*found)], names=["query_id", "vec_id", "score"])
        none = [pa.nulls(finds.num_rows, t) for _, t in kinds[3:]]
        finds = pa.Table.from_arrays([*finds.columns, *none], schema=pa.schema(kinds))
        return pa.concat_tables([finds, pa.Table.from_pylist(blocks, schema=pa.schema(kinds))])

    schema = "query_id long, vec_id long, score long, size int, home int, block int, rows binary"
    return wanted.groupBy(*_KEYS).cogroup(sent.groupBy(*_KEYS)).applyInArrow(search, schema)


def pivots_to_search(vectors: np.ndarray, floor: np.ndarray, pivots: np.ndarray, far: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Which pivots may have a candidate that a query's score to beat doesn't exclude, by the members' largest distance to
    the pivot and largest norm (below 0: no members)."""
    q = vectors.astype(float)
    length = np.sqrt((q**2).sum(1))[:, None]
    most = np.minimum(q @ pivots.T + length * far, length * norm)
    most += 1e-9 * (np.abs(most) + length * (far + norm)) + SLACK
    return np.flatnonzero(((most >= floor[:, None]) & (norm >= 0)).any(0))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = 16_384, block_rows: int = 512, page: int = 256) -> DataFrame:
    """For each query its ``k`` candidates of the largest inner product: query_id, rank (from 1), vec_id, score.

    Both have (vec_id, v array<long>, size); a query meets candidates of its own length only, other than those of its own id;
    ties go to the smaller id; fewer candidates than k give all. Queries of one id count once (the smallest vector).
    Products are exact: where they may not fit into 53 bits, they are made of whole numbers; beyond 64 bits is an error. A
    task holds one shard and up to 64 blocks of queries; no list of a query's finds is ever gathered.
    """
    candidates = candidates.select("vec_id", "v", "size")
    sample = candidates.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).collect()  # the bound is SAMPLE
    most = min(PIVOTS, pieces(candidates.count(), shard_rows))
    pivots = fit_pivots(np.array([r["size"] for r in sample]), [np.array(r["v"]) for r in sample], most) if sample else {}
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("size", "v")).alias("x")).select("vec_id", "x.v", "x.size")
    dealt = stored(_dealt(candidates, pivots, False), "vectors")
    shards = stored(_bundles(dealt, shard_rows), "shards")
    blocks = stored(_bundles(_dealt(queries, pivots, True), block_rows).toDF("size", "home", "block", "rows"), "blocks")
    way = F.pmod(F.xxhash64("home", F.expr(f"block div {TOGETHER}")), F.lit(2**20)).cast("int").alias("way")
    first = stored(_searched(shards.where("part = 0"), blocks.select("size", F.col("home").alias("pivot"), F.lit(0).alias("part"), way, "home", "block", "rows"), k, page), "finds")
    beaten = first.where("rows is not null").select("size", "home", "block", "rows")
    # at most PIVOTS rows for each size that the sample has, and the sample is bounded
    known = dealt.where(F.col("size").isin(*pivots)).groupBy("size", "pivot").agg(F.max("far").alias("far"), F.max("norm").alias("norm")).collect() if pivots else []
    bounds = {s: (np.full(len(p), -1.0), np.full(len(p), -1.0)) for s, p in pivots.items()}
    for r in known:
        bounds[r["size"]][0][r["pivot"]], bounds[r["size"]][1][r["pivot"]] = r["far"], r["norm"]

    def targets(batches):
        for batch in batches:
            for block in batch.to_pylist():
                _, vectors, floor = _opened(block["rows"])
                s = block["size"]
                to = pivots_to_search(vectors, floor, pivots[s], *bounds[s]) if s in pivots else np.zeros(1, np.int64)
                columns = [pa.array(np.full(len(to), block[n]), pa.int32()) for n in ("size", "home", "block")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(to, pa.int32())], names=["size", "home", "block", "pivot"])

    to = beaten.mapInArrow(targets, "size int, home int, block int, pivot int").join(shards.select("size", "pivot", "part"), ["size", "pivot"]).where("not (pivot = home and part = 0)")
    second = _searched(shards, to.join(beaten, ["size", "home", "block"]).select("size", "pivot", "part", way, "home", "block", "rows"), k, page)
    found = first.where("rows is null").unionByName(second.where("rows is null")).select("query_id", "vec_id", "score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
