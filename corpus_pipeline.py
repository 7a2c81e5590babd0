"""Corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of ``documents``.  ``run`` writes each result to
the shared folder and reads it back as the next one's input.

Rows of any shape pass: null and empty texts are scored like any empty text, have no benchmark
words and no secrets, and are packed as one end token if they are kept.  Rows without a doc_id
stay until the end.  ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.common import discard, materialise, read_table, unused
from pagemill.llm.decontaminate import find_contamination
from pagemill.llm.packing import pack_documents
from pagemill.llm.quality import fit_quality, score_quality, training_labels
from pagemill.llm.secrets import find_secrets, redact
from pagemill.llm.simhash import drop_near_duplicates

#: A document goes if at least this part of its words lies in benchmark windows; of others the spans go.
LEAKED_PART = 0.5
#: A document whose probability of good quality is below this goes.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from the labels that are not held out."""
    trees, (score,) = fit_quality(docs, training_labels(spark, sf_dir)), unused(docs, "_score")
    return score_quality(docs, trees, score).where(F.col(score) >= LEAST_QUALITY).select(*(f"`{c}`" for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    return drop_near_duplicates(docs, shingle=5, similarity=0.8)


def _with_length(docs: DataFrame, text) -> DataFrame:
    changed = ~text.eqNullSafe(F.col("text"))
    return docs.withColumns({"text": text, "n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))})


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark windows go, and documents that are mostly such spans."""
    text, words, hit, items = unused(docs, "_text", "_words", "_hits", "_items")
    found = find_contamination(docs.withColumn(text, F.col("text")), read_table(spark, sf_dir, "benchmark"), n=10, text=text, clean=True, names=(words, hit, items))
    kept = found.where(~((F.col(hit) > 0) & (F.col(hit) >= LEAKED_PART * F.col(words))))
    return _with_length(kept, F.col(text)).select(*(f"`{c}`" for c in docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    base, spans = unused(docs, "_base", "_spans")
    return _with_length(find_secrets(docs, names=(base, spans)), redact(F.col("text"), F.col(spans))).select(*(f"`{c}`" for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids."""
    return pack_documents(docs, 2048)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: Trees, fingerprints and tokens cannot be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        done, docs = docs, materialise(stage(spark, docs, sf_dir))
        discard(done)
    return STAGES[-1][1](spark, docs, sf_dir)
