import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pagemill.llm.quality import FEATURES, fit_quality, grow, op9_quality, score_quality, statistics, training_labels

from .fixtures import AWKWARD, docs


def auc(y, s):
    order = np.argsort(s, kind="stable")
    _, inverse, counts = np.unique(np.array(s)[order], return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    y = np.array(y)[order]
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())


def walk(trees, row):
    total = trees.bias
    inner = trees.feature.shape[1]
    for t in range(len(trees.feature)):
        at = 0
        while at < inner:
            at = 2 * at + (2 if row[trees.feature[t, at]] > trees.threshold[t, at] else 1)
        total += trees.leaf[t, at - inner]
    return 1 / (1 + np.exp(-total))


def test_flattened_trees_equal_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < 0)).astype(float)
    trees = grow(x, y, n_trees=30, depth=3)
    assert np.allclose(trees.score(x[:50]), [walk(trees, r) for r in x[:50]])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97


def test_split_is_the_best_of_all():
    """One stump, against every threshold of every column."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        x, y = rng.integers(0, 12, (80, 3)).astype(float), rng.integers(0, 2, 80).astype(float)
        if y.min() == y.max():
            continue
        trees, p = grow(x, y, n_trees=1, depth=1, rate=1.0, bins=64, shrink=1.0, least=1.0), y.mean()
        g, h = p - y, np.full(80, p * (1 - p))
        value = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
        best = 0.0
        for f in range(3):
            for t in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= t
                if min(h[left].sum(), h[~left].sum()) >= 1.0:
                    best = max(best, value(left) + value(~left) - value(np.ones(80, bool)))
        left = x[:, trees.feature[0, 0]] <= trees.threshold[0, 0]
        if best > 1e-9:
            assert abs(value(left) + value(~left) - value(np.ones(80, bool)) - best) < 1e-9
            assert np.allclose(trees.leaf[0], [-g[r].sum() / (h[r].sum() + 1.0) for r in (left, ~left)])


def test_constant_scores():
    assert grow(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert (grow(np.zeros((4, 3)), np.ones(4)).score(np.zeros((2, 3))) > 0.99).all()


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op9_quality(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    y, s = np.array([labels[r["doc_id"]] for r in held]), [r["score"] for r in held]
    kept = np.array([r["predicted"] for r in held])
    print("AUC", auc(y, s), "accuracy", (kept == y).mean(), "clean kept", kept[y == 1].mean(), "junk rejected", 1 - kept[y == 0].mean(), len(y))
    assert auc(y, s) > 0.95 and kept[y == 1].mean() > 0.98


def test_awkward_rows(spark):
    table = docs(spark, AWKWARD)
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (99, 1), (4, 0), (5, 1), (5, 0)], "doc_id long, quality int")
    got = score_quality(table, fit_quality(table, labels, n_trees=5)).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert [r["text"] for r in got] == [t for _, t in AWKWARD]
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert score_quality(docs(spark, []), fit_quality(table, none)).collect() == []
    assert all(len(statistics(t)) == len(FEATURES) and np.isfinite(statistics(t)).all() for _, t in AWKWARD)


def test_repeated_ids_are_one_row(spark):
    copies = docs(spark, [(7, "the same text again")] * 300 + [(8, "ok fine")])
    labels = spark.createDataFrame([(7, 1)] * 50 + [(7, 0), (8, 1)], "doc_id long, quality int")
    assert abs(fit_quality(copies, labels, n_trees=1).bias) < 1e-9


def plain_statistics(text):
    """The statistics as their names say, in plain Python."""
    raw = (text or "").encode()
    size, words = max(1, len(raw)), raw.split()
    m = max(1, len(words))
    share = lambda chars: sum(b in chars for b in raw) / size
    letters = sum(chr(b).isascii() and chr(b).isalpha() for b in raw)
    counts = Counter(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    pairs = list(zip(words, words[1:], strict=False))
    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / m, sum(65 <= b <= 90 for b in raw) / max(1, letters), share(b"0123456789"), share(b"!"), share(b"|"), share(b"#$%&*@^~+="), share(b"()[]{}<>\\/_"), share(b".,;:?"), share(b" \n\r\t"),
        share(range(128, 256)), -sum(c / size * math.log2(c / size) for c in counts.values()), len(set(words)) / m, max(Counter(words).values(), default=0) / m, sum(a == b for a, b in pairs) / m, len(set(pairs)) / m, math.log1p(len(lines)), len(set(lines)) / k, math.log1p(size / k),
        min(200, max(map(len, words), default=0)), share([*range(9), 9, *range(11, 32), 127]),
    ]


def test_query_against_plain_statistics_and_plain_walks(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = fit_quality(documents.select("doc_id", "text"), training_labels(spark, sf_dir))
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}

    def walked(x):
        total = trees.bias
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + math.exp(-total))

    rows = op9_quality(spark, sf_dir).collect()
    assert len(rows) == len(texts) == len({r["doc_id"] for r in rows})
    for r in rows:
        x = plain_statistics(texts[r["doc_id"]])
        assert x == pytest.approx(statistics(texts[r["doc_id"]]), abs=1e-9)
        score = walked(statistics(texts[r["doc_id"]]))
        assert r["score"] == pytest.approx(score, abs=1e-9) and r["predicted"] == int(score >= 0.3) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
