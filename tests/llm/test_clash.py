"""Extra columns, some named like those that the operators use or add."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagemill.llm.common import shared_dir
from pagemill.llm.decontaminate import find_contamination
from pagemill.llm.multiset import fingerprint_edits
from pagemill.llm.packing import pack_documents
from pagemill.llm.pseudonyms import pseudonymise
from pagemill.llm.quality import fit_quality, score_quality
from pagemill.llm.ring import assign_shards
from pagemill.llm.secrets import find_secrets
from pagemill.llm.simhash import drop_near_duplicates, near_duplicate_components
from pagemill.llm.tokencount import count_tokens
from pagemill.llm.warc import read_archive, write_archive

from .fixtures import AWKWARD, docs

ADDED = ["shard", "slot", "n_words", "n_hit", "items", "score", "pseudonyms", "n_tokens", "n_pre_tokens", "spans", "base_spans", "component_id", "piece", "sequence_id"]
INNER = ["_k_at", "_k_arc", "_r_lo", "_words", "_hit", "_items", "_hit0", "_text", "_score", "_r", "_base", "_spans", "fp", "node", "pid", "rank", "u", "v", "k", "o", "n", "y", "x", "key", "head", "sha256", "payload", "copy", "best", "Odd Name", "a.b"]


@pytest.fixture(scope="module")
def table(spark):
    return docs(spark, AWKWARD).select("*", *(F.lit("mine").alias(c) for c in ADDED + INNER))


def kept(df, added):
    """Columns that are not the operator's own still hold their value."""
    others = [c for c in ADDED + INNER if c not in added]
    rows = df.select(*(f"`{c}`" for c in others)).collect()
    assert len(rows) == len(AWKWARD) and all(set(r) == {"mine"} for r in rows)


def test_operators_that_add_columns(spark, table):
    kept(assign_shards(table, n_shards=3), ["shard", "slot"])
    bench = spark.createDataFrame([(1, "lorem ipsum dolor"), (2, "same text here")], "item_id long, text string")
    for block in (500_000, 2):
        for clean in (False, True):
            kept(find_contamination(table, bench, clean=clean, block_windows=block), ["n_words", "n_hit", "items"])
    kept(pseudonymise(table, b"k"), ["pseudonyms"])
    kept(count_tokens(table, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), ["n_tokens", "n_pre_tokens"])
    labels = spark.createDataFrame([(1, 0, "l"), (3, 1, "l")], "doc_id long, quality int, text string")
    kept(score_quality(table, fit_quality(table, labels, n_trees=2)), ["score"])
    kept(find_secrets(table), ["spans", "base_spans"])


def test_operators_with_tables_of_their_own(spark, table):
    assert pack_documents(table).count() == pack_documents(docs(spark, AWKWARD)).count()
    assert near_duplicate_components(table, 4, 1, 3, 4).count() == len(AWKWARD)
    assert fingerprint_edits(table).count() == len(AWKWARD)
    assert drop_near_duplicates(table).columns == table.columns
    pages = table.select("*", F.col("doc_id").alias("page_id"), F.lit("http://x/").alias("url"), F.col("text").alias("html"), F.lit("h").alias("header"))
    path = shared_dir(spark)
    write_archive(pages, path)
    assert read_archive(spark, path).count() == len(AWKWARD)


def test_pipeline_stages(spark, sf_dir, table):
    got = table
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, sf_dir)
        assert got.columns == table.columns
        assert all(set(r) == {"mine"} for r in got.select(*(f"`{c}`" for c in ADDED + INNER)).collect())
    assert corpus_pipeline.STAGES[-1][1](spark, got, sf_dir).count()
