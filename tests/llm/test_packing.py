import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagemill.llm.packing import CapacityTree, best_fit_decreasing, op1_best_fit_packing, pack_documents

from .fixtures import AWKWARD, docs


def brute_bins(lengths, capacity):
    open_ = []
    bins = 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(open_, n)
        if at == len(open_):
            bins += 1
            room = capacity
        else:
            room = open_.pop(at)
        if room > n:
            bisect.insort(open_, room - n)
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
def test_runs_are_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, bins = best_fit_decreasing(counts, capacity)
    assert bins == brute_bins(lengths, capacity)
    places = {}
    for length, n in counts.items():
        mine = sorted(r for r in runs if r[0] == length)
        for q in range(n):
            _, rank, lo, per, offset = [r for r in mine if r[1] <= q][-1]
            places.setdefault(lo + (q - rank) // per, []).append((offset + (q - rank) % per * length, length))
    assert len(places) == bins
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity


def test_runs_do_not_grow_with_the_data():
    rng = random.Random(3)
    counts = {n: rng.randrange(1, 50) for n in range(1, 2049)}
    few, _ = best_fit_decreasing(counts, 2048)
    many, _ = best_fit_decreasing({k: v * 100_000 for k, v in counts.items()}, 2048)
    assert len(many) < 3 * len(few) < 100_000


@given(st.sets(st.integers(0, 99)), st.integers(0, 99))
@settings(deadline=None)
def test_tree_finds_the_tightest(open_, at):
    tree = CapacityTree(100)
    for x in open_:
        tree.set(x, True)
    assert tree.first_at_least(at) == min((x for x in open_ if x >= at), default=None)


def check_packing(rows, texts, capacity=2048):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    for doc_id, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        mine = sorted(got[doc_id], key=lambda r: r["piece"])
        mine = mine[: len(mine) // sum(i == doc_id for i, _ in texts)] if len(mine) > 1 and sum(i == doc_id for i, _ in texts) > 1 else mine
        at = 0
        for k, r in enumerate(mine):
            assert r["start"] == at and r["length"] <= capacity and (k == 0 or r["length"] == capacity)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids) and (len(ids) > capacity or len(mine) == 1)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(by) == brute_bins([r["length"] for r in rows], capacity)


def test_query_against_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = op1_best_fit_packing(spark, sf_dir).collect()
    check_packing(rows, texts)


def test_awkward_rows(spark):
    rows = pack_documents(docs(spark, AWKWARD)).collect()
    check_packing(rows, [x for x in AWKWARD if x[0] != 6])
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    assert pack_documents(docs(spark, [])).collect() == []


@pytest.mark.parametrize("text", ["<|endoftext|> is text", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "  <|endoftext|>  x", "a" * 5000, "日本語 текст ��", "  \n\n\t x"])
def test_ids_equal_the_tokenizer(spark, text):
    check_packing(pack_documents(docs(spark, [(1, text)])).collect(), [(1, text)])
