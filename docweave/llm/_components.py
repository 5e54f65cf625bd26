"""Connected components of undirected graphs with integer nodes; a component is named by its smallest node."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import release, stored

#: Edges that one task may join (32 bytes each at most); more go through star rounds over the cluster.
ONE_TASK = 4_000_000


def local_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each node's component) of the edges (a, b)."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        low, high = np.minimum(parent[x], parent[y]), np.maximum(parent[x], parent[y])
        if not (low != high).any():
            return nodes, nodes[parent]
        np.minimum.at(parent, high, low)
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up


def edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _forest(parts):
    """The edges of a partition as one star for each of its components."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in parts:
        a.append(part.column(0).to_numpy(zero_copy_only=False))
        b.append(part.column(1).to_numpy(zero_copy_only=False))
    nodes, root = local_components(np.concatenate(a), np.concatenate(b))
    yield edge_batch(nodes, root)
    release()


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b), both long and not null; loops only name a node.

    Every partition first reduces its edges to stars. If few are left, one task joins them (the bound is ``one_task`` edges);
    otherwise large-star and small-star rounds run until nothing changes, each round written to the shared folder. Hubs are
    pre-aggregated before they are shuffled, and their joins are ordinary ones, which adaptive execution splits.
    """
    stars = stored(edges.select("a", "b").mapInArrow(_forest, "a long, b long"), "edges")
    if stars.count() <= one_task:
        return stars.repartition(1).mapInArrow(_forest, "a long, b long").toDF("node", "component")
    nodes = stars.select("a").union(stars.select("b")).distinct().toDF("node")
    e = stars.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    mark = None
    while True:
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = stored(small.where("a <> b").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return nodes.join(e.groupBy("a").agg(F.min("b").alias("b")), nodes["node"] == F.col("a"), "left").select("node", F.coalesce("b", "node").alias("component"))
