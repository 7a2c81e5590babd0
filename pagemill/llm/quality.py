"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts on the executors.  The trees are grown in the driver on
histograms of a bounded sample of labelled rows and flattened to arrays of complete binary trees,
so that a batch of documents walks all trees at once in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, read_table, without

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "exclamation", "pipes", "symbols", "brackets", "stops", "white", "beyond_ascii", "byte_entropy", "distinct_words", "commonest_word",
    "word_repeats", "distinct_pairs", "log_lines", "distinct_lines", "log_line_bytes", "longest_word", "tabs_and_controls",
)


def _group(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode("latin-1"))] = 1
    return out


_UPPER, _LETTER = _group("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _group("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_RATIOS = np.stack([_group("0123456789"), _group("!"), _group("|"), _group("#$%&*@^~+="), _group("()[]{}<>\\/_"), _group(".,;:?"), _group(" \n\r\t"), _group("".join(map(chr, range(128, 256)))), _group("\t" + "".join(map(chr, [*range(9), *range(11, 32), 127])))])


def statistics(text: str | None) -> list[float]:
    """The FEATURES of one text; null counts as empty."""
    raw = (text or "").encode()
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    digits, exclamation, pipes, symbols, brackets, stops, white, beyond, controls = (_RATIOS @ counts / n).tolist()
    used = counts[counts > 0] / n
    words = raw.split()
    m = max(1, len(words))
    common = max(Counter(words).values(), default=0)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    return [
        np.log1p(len(raw)), np.log1p(len(words)), sum(map(len, words)) / m, float(_UPPER @ counts) / max(1.0, float(_LETTER @ counts)), digits, exclamation, pipes, symbols, brackets, stops, white, beyond,
        float(-(used * np.log2(used)).sum()), len(set(words)) / m, common / m, sum(map(eq, words, words[1:])) / m, len(set(pairwise(words))) / m, np.log1p(len(lines)), len(set(lines)) / k, np.log1p(n / k),
        min(200, max(map(len, words), default=0)), controls,
    ]


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold`` of the inner nodes, ``leaf`` values; one row a tree.

    Node i has its children at 2 i + 1 and 2 i + 2; larger values go right.
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        n_trees, inner = self.feature.shape
        if not n_trees or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.bias)))
        at, tree, row = np.zeros((len(x), n_trees), np.int64), np.arange(n_trees), np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        return 1 / (1 + np.exp(-(self.bias + self.leaf[tree, at - inner].sum(1))))


def grow(x: np.ndarray, y: np.ndarray, n_trees: int = 100, depth: int = 4, rate: float = 0.15, bins: int = 64, shrink: float = 1.0, least: float = 4.0) -> Trees:
    """Boost ``n_trees`` trees on the logistic loss; splits maximise the gain over bin histograms."""
    inner, n_features = 2**depth - 1, x.shape[1]
    p = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    bias = float(np.log(p / (1 - p)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), bias)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    cell = binned + np.arange(n_features) * bins
    value = np.full(len(y), bias)
    features, thresholds, leaves = [], [], []
    for _ in range(n_trees):
        q = 1 / (1 + np.exp(-value))
        g, h = q - y, np.maximum(q * (1 - q), 1e-9)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, bins), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            key = ((at - first)[:, None] * (n_features * bins) + cell).ravel()
            hist = [np.bincount(key, np.repeat(w, n_features), nodes * n_features * bins).reshape(nodes, n_features, bins) for w in (g, h)]
            (gl, hl), (gt, ht) = (c.cumsum(2) for c in hist), (c.sum(2, keepdims=True) for c in hist)
            gr, hr = gt - gl, ht - hl
            gain = np.where((hl >= least) & (hr >= least), gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - gt**2 / (ht + shrink), 0)
            best = gain.reshape(nodes, -1).argmax(1)
            split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            feature[first : first + nodes] = np.where(split, best // bins, 0)
            cut[first : first + nodes] = np.where(split, best % bins, bins)  # no split: all go left
            at = 2 * at + 1 + (binned[np.arange(len(y)), feature[at]] > cut[at])
        sums = [np.bincount(at - inner, w, inner + 1) for w in (g, h)]
        leaf = -rate * sums[0] / (sums[1] + shrink)
        value += leaf[at - inner]
        features.append(feature)
        thresholds.append([edges[f][c] if c < len(edges[f]) else np.inf for f, c in zip(feature, cut, strict=True)])
        leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), bias)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000, **growth) -> Trees:
    """Fit on labelled documents (labels: doc_id and ``label`` 0 or 1), at most ``max_rows`` of them.

    Which rows count is decided by a hash of doc_id, so the sample is the same at every run.  Of
    repeated ids the least label and text count.  Null labels and ids, and labels without a
    document, are left out; with none left, or one class only, the score is constant.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    sample = marked.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # max_rows ids
    if not rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("r")).select("r.y", "r.text")
    rows = rows.select("y", "text")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    found = rows.mapInArrow(measured, "y int, x array<double>").toArrow()
    x = np.array(found["x"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # rows come in any order; sums of floats must not depend on it
    return grow(x[order], found["y"].to_numpy()[order].astype(np.float64), **growth)


def score_quality(docs: DataFrame, trees: Trees, score: str = "score") -> DataFrame:
    """Add ``score`` to every row: the probability of label 1 from the text alone (null: empty).

    A column of that name is replaced, others pass through.
    """
    docs = without(docs, score)
    shared, names = docs.sparkSession.sparkContext.broadcast(trees), docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(x), pa.float64())], [*names, score])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return numbered(docs).mapInArrow(run, f"{types}, `{score}` double")


def _held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "labels").where(~_held_out())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit_quality(docs, training_labels(spark, sf_dir))
    scored = score_quality(docs, trees)
    return scored.select("doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
