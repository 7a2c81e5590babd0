import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pagemill.llm.components import connected_components
from pagemill.llm.simhash import drop_near_duplicates, fingerprint, near_duplicate_components, near_links, op4_simhash, rarest, shingle_set
from pagemill.llm.variants import Near, linked

from .fixtures import AWKWARD, docs


def brute_print(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(s), 42) for s in ([w[i : i + k] for i in range(len(w) - k + 1)] or [w])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most):
    parent = {i: i for i, _ in prints}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in prints:
        for j, b in prints:
            if i < j and (a ^ b).bit_count() <= most and (x := find(i)) != (y := find(j)):
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in prints}


def test_query_against_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    prints = [(i, brute_print(t)) for i, t in texts]
    want = brute_components(prints, 4)
    got = op4_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints}
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(texts)
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("crowd", [1024, 7])
def test_every_link_of_random_clusters(spark, crowd):
    rng = random.Random(4)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 30])):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6)))
            prints.append((len(prints), base ^ flips))
    prints = list({p: (i, p) for i, p in prints}.values())
    nodes = spark.createDataFrame([(i, [int(np.uint64(p).view(np.int64))]) for i, p in prints], "node long, fp array<long>")
    got = {r["node"]: r["component"] for r in connected_components(near_links(nodes, 1, 3, 4, crowd=crowd)).collect()}
    assert {i: got.get(i, i) for i, _ in prints} == brute_components(prints, 4)


def test_long_runs_are_linked_whole():
    rng = np.random.default_rng(1)
    base = np.uint64(rng.integers(0, 1 << 63))
    fps = base ^ (np.uint64(1) << rng.integers(40, 64, 500).astype(np.uint64))
    links = linked(np.zeros(500, np.int64), np.zeros(500, np.int64), 3, fps.reshape(-1, 1), np.ones(500, np.int64), Near(1, 2))
    assert len(set(links.root)) == 1 and len(links.pairs) == 499


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_awkward_rows(spark):
    rows = [*AWKWARD, (9, "one"), (6, "another text under a known id"), (20, "Another text UNDER a known id"), (None, "nobody else has this one")]
    got = near_duplicate_components(docs(spark, rows), 4, 1, 3, 4).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[1] == by[2] == by[8] == {1} and by[9] == {3} and by[6] == by[5] == by[20] == {5} and by[None] == {None}
    assert near_duplicate_components(docs(spark, []), 4, 1, 3, 4).collect() == []


def test_lanes_are_majorities():
    text = " ".join(f"w{i}" for i in range(2000))
    wide = fingerprint(text, 5, 4)
    assert wide[0] == brute_print(text, 5) and len(set(wide.tolist())) == 4


def _jaccard(a, b, k=5):
    x, y = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    rows, groups = [], []
    for _ in range(25):
        words = [word() for _ in range(rng.randrange(40, 400))]
        group = [len(rows)]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rng.randrange(0, 6)):
            copy = list(words)
            for i in rng.sample(range(len(copy)), max(1, len(copy) // 100)):
                copy[i] = word()
            if _jaccard(" ".join(copy), rows[group[0]][1]) >= 0.8:
                group.append(len(rows))
                rows.append((len(rows), " ".join(copy)))
        half = words[: len(words) // 2] + [word() for _ in range(len(words) // 2)]
        groups += [group, [len(rows)]]
        rows.append((len(rows), " ".join(half)))
    kept = sorted(r["doc_id"] for r in drop_near_duplicates(docs(spark, rows)).collect())
    assert kept == sorted(g[0] for g in groups)


def test_dropping_awkward_rows(spark):
    rows = [*AWKWARD, (6, "another text under a known id"), (None, "same text here for all of us")]
    got = drop_near_duplicates(docs(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([AWKWARD[0], AWKWARD[2], AWKWARD[3], AWKWARD[4], AWKWARD[7], AWKWARD[8], rows[-1]], key=str)
    assert drop_near_duplicates(docs(spark, [])).collect() == []


def _words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]


def _kept(spark, texts):
    return sorted(r["doc_id"] for r in drop_near_duplicates(docs(spark, list(enumerate(texts)))).collect())


def test_copies_in_a_crowd_of_one_template(spark):
    rng = random.Random(12)
    template, pages, copies = _words(rng, 240), [], []
    for _ in range(600):
        pages.append(template + _words(rng, 44))
    for page in pages[::6]:
        copy = list(page)
        for i in rng.sample(range(len(copy)), 6):
            copy[i] = _words(rng, 1)[0]
        copies.append(copy)
    texts = [" ".join(p) for p in pages + copies]
    assert all(_jaccard(texts[600 + k], texts[6 * k]) >= 0.8 for k in range(100)) and _jaccard(texts[0], texts[1]) < 0.8
    assert _kept(spark, texts) == list(range(600))


def test_unlike_texts_of_one_repeated_line_stay(spark):
    rng = random.Random(13)
    line, texts = _words(rng, 11) * 100, []
    for _ in range(40):
        texts.append(" ".join(line + _words(rng, 300)))
    assert len({fingerprint(t, 5, 4).tobytes() for t in texts}) == 1 and _jaccard(texts[0], texts[1]) < 0.1
    assert _kept(spark, texts) == list(range(40))


def test_copies_of_another_number_of_repeats(spark):
    rng, texts = random.Random(14), []
    for _ in range(20):
        line, own = _words(rng, 11), _words(rng, 100)
        texts += [" ".join(line * 20 + own), " ".join(line * 2 + own)]
    assert all(_jaccard(*texts[k : k + 2]) == 1 for k in range(0, 40, 2))
    assert _kept(spark, texts) == list(range(0, 40, 2))


@pytest.mark.parametrize("words", [8, 20, 60])
def test_every_copy_at_the_least_similarity(spark, words):
    rng, texts = random.Random(words), []
    for _ in range(150):
        page = _words(rng, words)
        n = words - 4
        texts += [" ".join(page), " ".join(page + _words(rng, n // 4)), " ".join(page + _words(rng, n // 4 + 1))]
    assert _jaccard(texts[0], texts[1]) == 0.8 and _jaccard(texts[0], texts[2]) < 0.8
    pairs = [t for k in range(0, 450, 3) for t in texts[k : k + 2]]
    assert _kept(spark, pairs) == list(range(0, 300, 2))
    pairs = [t for k in range(0, 450, 3) for t in texts[k : k + 3 : 2]]
    assert _kept(spark, pairs) == list(range(300))


def test_a_phrase_that_all_short_texts_share(spark):
    """No key is a shingle of the phrase, so texts do not meet for it; kept rows equal brute force on a part."""
    phrase = "all rights are reserved by the owner of this page"
    made = lambda i: f"{phrase} " + " ".join(f"{w}{i}" for w in ("alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu", "xi", "pi", "rho", "tau", "phi", "chi", "psi", "om"))
    rows = [(i, made(i)) for i in range(20_000)] + [(50_000 + i, made(i) + " more") for i in range(0, 20_000, 100)]
    began = time.monotonic()
    kept = {r["doc_id"] for r in drop_near_duplicates(docs(spark, rows)).select("doc_id").collect()}
    assert kept == set(range(20_000))
    assert time.monotonic() - began < 240
    table = spark.createDataFrame([(i, sorted({xxhash.xxh64_intdigest(s) >> 1 for s in shingle_set(t, 5)})) for i, t in rows[:500]], "node long, least array<long>")
    keys = rarest(table, 0.8).select(F.explode("least").alias("k")).groupBy("k").count()
    assert keys.agg(F.max("count")).first()[0] <= 16
