"""Builds the corpus that retrieval reads: masked chunks of documents that passed their checks.

    python -m jobs.retrieval_corpus --documents IN/documents.parquet --labels IN/labels.parquet --output OUT [--config FILE] [--lang en --lang de]

Of documents with equal texts the one with the smallest doc_id counts.  Each is classified by keywords
and checked: it has text, it is of a known type, reviewers (``labels``) did not call it toxic or of low
quality.  Documents that fail a check go to ``quarantine`` with the names of their checks; of the others
personal values are masked and lines gathered to chunks with an overlap of one line.

    OUT/documents   lang=*: document_id, content_hash, document_type, has_text
    OUT/checks      lang=*: document_id, check_name, passed, severity
    OUT/quarantine  lang=*: document_id, document_type, status, failed_checks
    OUT/chunks      lang=*: document_id, document_type, chunk_index, text, char_count, n_lines
    OUT/report      lang=*: rows, documents, quarantined, chunks, chars

Each table is made of those written before it, so texts are read twice: classified, and cut to chunks.
A run writes all partitions; with ``--lang`` only those of these languages, and leaves the others as
they are.  Running it again over the same tables gives the same output.  Rows without a doc_id are
left out, and counted in the log; of rows with one doc_id that with the least content hash counts.  A
null lang is a partition of its own, a null text is an empty one.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.pii import mask
from pagemill.operators.chunk import chunk_pages
from pagemill.operators.classify import classify
from pagemill.operators.quality import quarantine
from pagemill.plans.store import latest
from pagemill.sources.exports import content_hash

from .settings import load, start

LOG = logging.getLogger("jobs.retrieval_corpus")


def classified(rows: DataFrame, keywords: dict) -> DataFrame:
    """One row a content: document_id, lang, content_hash, document_type, has_text.

    Types are found before copies are taken out, so that no texts are shuffled.
    """
    light = rows.select("document_id", "lang", "content_hash", classify(F.col("text"), keywords)["document_type"].alias("document_type"), F.col("text").rlike(r"(?U)\S").alias("has_text"))
    one = latest(light, ["document_id"], "content_hash", F.col("lang").asc_nulls_first())
    return latest(one, ["content_hash"], "document_id")


def checks(documents: DataFrame, labels: DataFrame, refuse_toxic: bool, refuse_low_quality: bool) -> DataFrame:
    """(document_id, lang, check_name, passed, severity) of classified documents."""
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("document_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    every = documents.join(said, "document_id", "left")
    named = [("text_present", F.col("has_text"), "error"), ("document_type_supported", F.col("document_type").isNotNull(), "error")]
    named += [("review_toxic", F.coalesce(F.col("toxic") == 0, F.lit(True)), "warning")] if refuse_toxic else []
    named += [("review_quality", F.coalesce(F.col("quality") == 1, F.lit(True)), "warning")] if refuse_low_quality else []
    row = lambda name, passed, severity: F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), F.lit(severity).alias("severity"))
    return every.select("document_id", "lang", F.explode(F.array(*(row(*n) for n in named))).alias("c")).select("document_id", "lang", "c.*")


def refused(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents that failed a check, with the names of these."""
    status = F.when(F.col("has_text") & F.col("document_type").isNotNull(), "checked").otherwise("failed")
    out = quarantine(documents.select("document_id", "lang", "document_type", status.alias("status")), found.drop("lang"))
    return out.withColumn("failed_checks", F.array_join("failed_checks", ","))


def as_pages(documents: DataFrame) -> DataFrame:
    """Every document as one page of lines without boxes, its text masked."""
    none: Column = F.lit(None).cast("double")
    line = lambda t, i: F.struct(i.alias("line_index"), t.alias("text"), *(none.alias(c) for c in ("x0", "y0", "x1", "y1")))
    return documents.select("document_id", F.lit(1).alias("page_number"), F.transform(F.split(mask(F.col("text")), "\n"), line).alias("lines"))


def chunked(rows: DataFrame, good: DataFrame, max_chars: int) -> DataFrame:
    """Chunks of the texts among ``rows`` of ``good`` documents (document_id, content_hash, lang, document_type)."""
    # the row of a doc_id that counts, so texts are dealt out by it once
    texts = latest(rows.select("document_id", "content_hash", "text"), ["document_id"], "content_hash").join(good, "document_id", "left_semi")
    chunks = chunk_pages(as_pages(texts), max_chars).select("document_id", "chunk_index", "text", "char_count", F.size("line_indexes").alias("n_lines"))
    return chunks.join(good.select("document_id", "lang", "document_type"), "document_id")


def run(spark: SparkSession, documents: str, labels: str, output: str, config: dict | None = None, langs: Sequence[str] = ()) -> dict[str, int]:
    """Writes the tables under ``output``; returns how many rows each has in the partitions written."""
    config = load("retrieval_corpus") if config is None else config
    source, reviewed = spark.read.parquet(documents), spark.read.parquet(labels)
    LOG.info("read %d documents (%d without an id) from %s, %d labels from %s", source.count(), source.where("doc_id is null").count(), documents, reviewed.count(), labels)
    written: dict[str, int] = {}

    def write(name: str, table: DataFrame) -> DataFrame:
        """The partitions of ``langs``, or all, anew; large ones are dealt out to several tasks."""
        table = table.where(F.col("lang").isin(*langs)) if langs else table
        table.hint("rebalance", "lang").write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if langs else "static").partitionBy("lang").parquet(f"{output}/{name}")
        back = spark.read.schema(table.schema).parquet(f"{output}/{name}")
        back = back.where(F.col("lang").isin(*langs)) if langs else back
        written[name] = back.count()
        return back

    rows = source.where("doc_id is not null").select(F.col("doc_id").alias("document_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    rows = rows.withColumn("content_hash", content_hash(F.col("text")))
    known = write("documents", classified(rows, config["keywords"]))
    found = write("checks", checks(known, reviewed, config["refuse_toxic"], config["refuse_low_quality"]))
    bad = write("quarantine", refused(known, found))
    chunks = write("chunks", chunked(rows, known.join(bad.select("document_id"), "document_id", "left_anti"), config["max_chars"]))
    n = lambda name: F.count("*").alias(name)
    counts = [source.where("doc_id is not null").groupBy("lang").agg(n("rows")), known.groupBy("lang").agg(n("documents")), bad.groupBy("lang").agg(n("quarantined")), chunks.groupBy("lang").agg(n("chunks"), F.sum("char_count").alias("chars"))]
    joined = reduce(lambda a, b: a.join(b, a["lang"].eqNullSafe(b["lang"]), "left").drop(b["lang"]), counts)
    write("report", joined.select("lang", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "documents", "quarantined", "chunks", "chars"))))
    LOG.info("wrote %s to %s", ", ".join(f"{k} {name}" for name, k in written.items()), output)
    return written


def main(argv: Sequence[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Build the corpus that retrieval reads.")
    for name in ("documents", "labels", "output"):
        options.add_argument(f"--{name}", required=True)
    options.add_argument("--config")
    options.add_argument("--lang", action="append", default=[])
    given = options.parse_args(argv)
    spark = start("retrieval_corpus")
    try:
        run(spark, given.documents, given.labels, given.output, load("retrieval_corpus", spark, given.config), given.lang)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
