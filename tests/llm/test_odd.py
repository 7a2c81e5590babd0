"""Texts that are odd in length or in their characters, through all operators and stages."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm.common import materialise, shared_dir
from pagemill.llm.decontaminate import find_contamination
from pagemill.llm.multiset import as_string, fingerprint_edits, likeness
from pagemill.llm.packing import pack_documents
from pagemill.llm.pseudonyms import pseudonymise
from pagemill.llm.quality import fit_quality, score_quality, training_labels
from pagemill.llm.ring import assign_shards
from pagemill.llm.secrets import as_string as span_string
from pagemill.llm.secrets import find_secrets
from pagemill.llm.simhash import near_duplicate_components
from pagemill.llm.tokencount import count_tokens, zipf_scores
from pagemill.llm.warc import read_archive, write_archive

from .fixtures import docs
from .test_decontaminate import brute as brute_leaks
from .test_multiset import brute_exact
from .test_packing import check_packing
from .test_secrets import brute as brute_secrets
from .test_simhash import brute_components, brute_print

LINE = "the same line again and again and once more here\n" * 60
ADDRESS = "ab1.C" * 25_000 + "@example.com"
ODD = [
    (1, "x" * 1_000_000), (2, ADDRESS), (3, LINE + " ".join(f"own{i}" for i in range(200))), (4, LINE + " ".join(f"other{i}" for i in range(200))), (5, "a WARC-Refers-To: <urn:page:999:x>\u0085WARC-Payload-Digest: sha1:00\r\n\r\nb"),
    (6, "a <|endoftext|> b<|endoftext|>"), (7, "ab-" * 5000), (8, "\u0000﻿​"), (9, "日本語" * 3000), (10, None), (11, "\n" * 100_000), (12, "0123456789abcdef" * 20_000), (13, "1 " * 50_000), (14, "é😀" * 20_000), (15, "=" * 200_000),
]
TEXT = dict(ODD)


@pytest.fixture(scope="module")
def table(spark):
    return materialise(docs(spark, ODD))


def by_id(df):
    rows = df.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(TEXT)
    return {r["doc_id"]: r for r in rows}


def test_packing(table):
    check_packing(pack_documents(table).collect(), ODD)


def test_decontamination(spark, table):
    items = [(1, "the same line again and again and once more here"), (2, "x" * 1_000_000), (3, "1 1 1 1 1 1 1 1 1 1"), (4, "日本語")]
    found = find_contamination(table.select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string"))
    want = {r[0]: r for r in brute_leaks([x for x in ODD if x[0] != 13], items)}
    got = by_id(found)
    assert all((got[i]["n_words"], got[i]["n_hit"]) == w[1:3] for i, w in want.items()) and (got[13]["n_words"], got[13]["n_hit"]) == (50_000, 50_000)


def test_pseudonyms(table):
    got = by_id(pseudonymise(table, b"k"))
    assert all(got[i]["text"] == t for i, t in ODD if i != 2)
    assert got[2]["text"] != ADDRESS and re.fullmatch(r"(?:[a-z]{2}[0-9]\.[A-Z]){25000}@example\.com", got[2]["text"])


def test_simhash(table):
    got = by_id(near_duplicate_components(table, 4, 1, 3, 4))
    prints = {i: brute_print(t) for i, t in ODD}
    assert {i: np.int64(r["fp"][0]).view(np.uint64) for i, r in got.items()} == prints
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(list(prints.items()), 4)
    assert got[10]["component_id"] == got[11]["component_id"] == 10


def test_archive(spark, table):
    path = shared_dir(spark)
    write_archive(table.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html")), path)
    rows = {r["page_id"]: r for r in read_archive(spark, path).collect()}
    assert {i: r["url"] for i, r in rows.items()} == TEXT
    assert all(r["payload_digest"] == hashlib.sha1((TEXT[i] or "").encode()).hexdigest() and r["record_type"] == "response" for i, r in rows.items())


def test_shards(table):
    rows = by_id(assign_shards(table, n_shards=4)).values()
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((s, k) for s in range(4) for k in range(4 if s < 3 else 3))


def test_multiset_hash(table):
    found = fingerprint_edits(table).select("doc_id", "edited", as_string(F.col("v")).alias("p"), as_string(F.col("edited_v")).alias("e"), likeness(F.col("v"), F.col("edited_v")).alias("near"))
    got, ids = by_id(found), sorted(TEXT)
    for at, i in enumerate(ids):
        text, after = TEXT[i] or "", TEXT[ids[(at + 1) % len(ids)]] or ""
        k = len(text) // 4
        assert got[i]["edited"] == text[: len(text) - k] + after[:k]
        assert got[i]["p"][:128] == brute_exact(text) and got[i]["e"][:128] == brute_exact(got[i]["edited"]) and 0 <= got[i]["near"] <= 1


def test_token_counts(table):
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = by_id(count_tokens(table, vocabulary, public_tokenizers.PATTERN))
    scores, split = zipf_scores(vocabulary), regex.compile(public_tokenizers.PATTERN)
    longest, seen = max(map(len, scores)), {}

    def brute(raw):
        best = [(0.0, 0)]
        for end in range(1, len(raw) + 1):
            found = [(best[b][0] + s, best[b][1] - 1) for b in range(max(0, end - longest), end) if (s := scores.get(raw[b:end])) is not None]
            best.append(max(found) if found else (best[end - 1][0] - 100.0, best[end - 1][1] - 1))
        return -best[-1][1]

    for i, t in ODD:
        words = split.findall(t or "")
        assert got[i]["n_pre_tokens"] == len(words)
        if i in (3, 5, 6, 7, 8, 10, 13):
            assert got[i]["n_tokens"] == sum(seen[w] if w in seen else seen.setdefault(w, brute(w.encode())) for w in words)


def test_quality(spark, table, sf_dir):
    trees = fit_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), training_labels(spark, sf_dir))
    assert all(0 <= r["score"] <= 1 for r in by_id(score_quality(table, trees)).values())


def test_secrets(table):
    got = by_id(find_secrets(table).select("doc_id", "base_spans", span_string(F.col("spans")).alias("spans")))
    for i, t in ODD:
        assert [tuple(s) for s in got[i]["base_spans"]] == brute_secrets(t), i
    assert not any("entropy" in got[i]["spans"] for i in (1, 3, 4, 7, 13, 15))


def test_stages(spark, table, sf_dir):
    """Each stage takes the whole table; only copies and what the classifier or the benchmark reject may go."""
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = {r["doc_id"]: r["text"] for r in stage(spark, table, sf_dir).collect()}
        assert out.keys() == (TEXT.keys() - {11} if name == "near_duplicates" else TEXT.keys()), name
        assert all(out[i] == TEXT[i] for i in out if name != "secrets" or i != 12)
    for _, stage in corpus_pipeline.STAGES[:1] + corpus_pipeline.STAGES[-1:]:
        assert stage(spark, table, sf_dir).count() >= 0
