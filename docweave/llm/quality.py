"""Document quality by histogram gradient-boosted trees over text statistics, flattened for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import lean_batches, release
from ._text import SPACE, Words, distinct_pairs, windows

FEATURES = (
    "log_bytes", "log_words", "word_length", "longest_word", "lower", "upper", "digit", "mark", "symbol", "high", "white", "line",
    "log_lines", "distinct_words", "distinct_pairs", "same_as_before", "marks_a_word", "upper_words", "digit_words", "short_words",
)
_CLASS = np.full(256, 4, np.uint8)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 5
_CLASS[[ord(c) for c in ".,;:'\"-"]] = 3
_CLASS[SPACE] = 6
_CLASS[0x0A] = 7


def features(column) -> np.ndarray:
    """A row of ``FEATURES`` for each text (null as empty), from the whole text."""
    words = Words(column, lower=True)
    n, data, offsets = len(words.offsets) - 1, words.data, words.offsets
    size, count = np.diff(offsets), words.counts
    out = np.zeros((n, len(FEATURES)), np.float32)
    if n == 0:
        return out
    kinds = _CLASS[data]
    shares = np.zeros((n, 8))
    for k in range(8):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
        shares[:, k] = np.diff(total[offsets])
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(count, 1)
    length = words.end - words.start
    of = words.doc()

    def summed(value) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(value, dtype=np.int64)])[words.first])

    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    d, _ = distinct_pairs(of, words.hash[0])
    unique = np.bincount(d, minlength=n)
    pair = windows(words.hash[0], 2)
    inside = of[1:] == of[:-1] if len(of) > 1 else np.empty(0, bool)
    d2, _ = distinct_pairs(of[:-1][inside], pair[inside])
    pairs = np.bincount(d2, minlength=n)
    same = np.zeros(len(of), bool)
    same[1:] = inside & (words.hash[0][1:] == words.hash[0][:-1])
    first_byte = data[words.start] if len(of) else np.empty(0, np.uint8)
    second = data[np.minimum(words.start + 1, words.end - 1)] if len(of) else first_byte
    columns = [
        np.log1p(size), np.log1p(count), summed(length) * per_word, np.log1p(longest),
        *(shares[:, k] * per_byte for k in range(8)),
        np.log1p(shares[:, 7]), unique * per_word, pairs / np.maximum(count - 1, 1), summed(same) * per_word,
        shares[:, 4] * per_word, summed((_CLASS[first_byte] == 1) & (_CLASS[second] == 1)) * per_word, summed(_CLASS[first_byte] == 2) * per_word, summed(length <= 3) * per_word,
    ]
    for k, c in enumerate(columns):
        out[:, k] = c
    return out


@dataclass
class Trees:
    """Complete binary trees of one depth: split arrays (tree, inner node) and leaf values (tree, leaf)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            total += leaf[node - (leaf.shape[0] - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 48, damping: float = 1.0) -> Trees:
    """Gradient boosting of the logistic loss; candidate thresholds are quantiles, gains come from histograms."""
    inner, leaves, n_f = 2**depth - 1, 2**depth, x.shape[1]
    if not len(y) or y.min() == y.max():  # nothing to tell apart: a constant
        base = 6.0 if not len(y) or y.min() == 1 else -6.0
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(n_f)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    width = max(len(e) for e in edges) + 1
    flat = binned + np.arange(n_f) * width
    mean = y.mean()
    base = float(np.log(mean / (1 - mean)))
    total = np.full(len(y), base)
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    allowed = np.zeros((n_f, width), bool)
    for f, e in enumerate(edges):
        allowed[f, : len(e)] = True
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (n_f * width) + flat).ravel()
            hg = np.bincount(at, np.repeat(g, n_f), n * n_f * width).reshape(n, n_f, width)
            hh = np.bincount(at, np.repeat(h, n_f), n * n_f * width).reshape(n, n_f, width)
            gl, hl = hg.cumsum(2), hh.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + damping) + (gt - gl) ** 2 / (ht - hl + damping) - gt**2 / (ht + damping)
            gain[~np.broadcast_to(allowed, gain.shape) | (hl < 1) | (ht - hl < 1)] = 0
            best = gain.reshape(n, -1).argmax(1)
            for k in range(n):
                f, b = divmod(int(best[k]), width)
                if gain[k, f, b] > 1e-6:
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + damping)
        total += leaf[t][at]
    return Trees(base, feature, threshold, leaf)


def train_quality(docs: DataFrame, labels: DataFrame, training_rows: int = 20_000, **options) -> Trees:
    """Fit on at most ``training_rows`` labelled documents (those of the smallest hashes of their id; the bound is what the
    driver receives). ``labels``: doc_id, quality 0/1; several labels of an id count by their mean, null ones not at all; of
    several texts of an id the one of the smallest features counts."""
    lean_batches(docs.sparkSession)
    wanted = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(training_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.join(F.broadcast(wanted), "doc_id").select("doc_id", "quality", "text")

    def measure(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                x = features(part.column(2)).astype("<f4")
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.int32()), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])
        release()

    measured = found.mapInArrow(measure, "doc_id long, quality int, x binary").groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("r"))
    rows = measured.select("doc_id", "r.quality", "r.x").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), "<f4").reshape(-1, len(FEATURES))
    return fit(x, rows.column("quality").to_numpy().astype(float), **options)


def score_quality(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= threshold) added, in one pass without a shuffle.

    Null and empty texts are scored like any other; all columns and repeated rows stay; columns named score or predicted
    are replaced. A model fitted without labels scores 1 nearly (nothing speaks against the document).
    """
    lean_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")
    place = kept.columns.index("text")
    schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema.fields) + ", score double, predicted int"

    def judge(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                score = model.score(features(part.column(place)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*part.schema.names, "score", "predicted"])
        release()

    return kept.mapInArrow(judge, schema)
