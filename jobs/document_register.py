"""Registers new documents: each content once, whoever brings it again is named a duplicate.

    python -m jobs.document_register --documents IN/documents.parquet --output OUT --checkpoint CP [--config FILE]

Takes in the files of ``--documents`` that no run has seen yet, in batches of a file stream whose
checkpoint is CP, and ends when there are no more.  A document without text fails (file_missing), one of
no known type fails too (unsupported_document_type), and so do their duplicates; the first document of
a content, in this batch by doc_id, is processed, all later ones are duplicates.

    OUT/register  batch=*/outcome=*: doc_id, lang, content_hash, first_id, document_type, error_code
    OUT/runs      batch=*: processed, duplicate, failed, status

A batch that breaks off is run again and replaces its own partitions; a run with nothing new writes
nothing.  OUT and CP belong together: a new checkpoint over an old output is an error.  A row that
repeats the id and content of another in its batch counts once; rows without a doc_id come first.
"""

from __future__ import annotations

import argparse
import logging
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.text import strip
from pagemill.operators.classify import classify
from pagemill.plans.store import insert_if_absent, outcome, run_status, sent
from pagemill.sources.exports import content_hash

from .settings import load, start

LOG = logging.getLogger("jobs.document_register")
COLUMNS = ("doc_id", "lang", "content_hash", "first_id", "document_type", "error_code")


def judged(documents: DataFrame, earlier: DataFrame, keywords: dict) -> DataFrame:
    """Rows of the register for ``documents`` (doc_id, text, lang), given the ``earlier`` ones.

    Texts are hashed and classified where they are read; what is shuffled are ids, hashes and types.
    """
    full = strip(F.coalesce("text", F.lit(""))) != ""
    rows = documents.select("doc_id", "lang", F.when(full, content_hash(F.col("text"))).alias("content_hash"), F.when(full, classify(F.col("text"), keywords)["document_type"]).alias("kind"))
    rows = rows.dropDuplicates(["doc_id", "content_hash"])
    there = rows.where("content_hash is not null")
    known = earlier.where("content_hash is not null and outcome <> 'duplicate' and doc_id <=> first_id").join(sent(there.select("content_hash").distinct()), "content_hash", "left_semi")
    known = known.select("content_hash", "first_id", "document_type", "error_code").dropDuplicates(["content_hash"])
    fresh = insert_if_absent(there, known, "content_hash", F.col("doc_id").asc_nulls_first())
    fresh = fresh.select("content_hash", F.col("doc_id").alias("first_id"), F.col("kind").alias("document_type"), F.when(F.col("kind").isNull(), "unsupported_document_type").alias("error_code"))
    firsts = known.withColumn("old", F.lit(True)).unionByName(fresh.withColumn("old", F.lit(False)))
    out = rows.drop("kind").join(firsts, "content_hash", "left")
    duplicate = F.col("content_hash").isNotNull() & (F.col("old") | ~F.col("doc_id").eqNullSafe(F.col("first_id")))
    out = out.withColumn("error_code", F.when(F.col("content_hash").isNull(), "file_missing").otherwise(F.col("error_code")))
    return out.select(*COLUMNS, outcome(F.col("error_code"), duplicate).alias("outcome"))


def run(spark: SparkSession, documents: str, output: str, checkpoint: str, config: dict | None = None) -> list[dict]:
    """Takes in what is new under ``documents``; returns the counts of each batch."""
    config = load("document_register") if config is None else config
    sample = spark.read.parquet(documents)
    kinds = {f.name: f.dataType for f in sample.schema}
    register, runs = f"{output}/register", f"{output}/runs"
    stored = T.StructType([T.StructField(c, kinds.get({"first_id": "doc_id"}.get(c, c), T.StringType())) for c in COLUMNS]).add("batch", "long").add("outcome", "string")
    counts: list[dict] = []

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        everything = session.read.schema(stored).parquet(register) if number else session.createDataFrame([], stored)
        rows = judged(batch, everything.where(F.col("batch") < number), config["keywords"]).withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "outcome").parquet(register)
        mine = session.read.schema(stored).parquet(register).where(F.col("batch") == number)
        of = lambda name: F.count_if(F.col("outcome") == name).alias(name)
        total = mine.agg(of("processed"), of("duplicate"), of("failed")).withColumn("status", run_status(F.col("processed"), F.col("duplicate"), F.col("failed"))).withColumn("batch", F.lit(number).cast("long"))
        total.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(runs)
        counts.append(total.first().asDict())
        LOG.info("batch %(batch)d: %(processed)d processed, %(duplicate)d duplicate, %(failed)d failed (%(status)s)", counts[-1])

    files = spark.readStream.schema(sample.select("doc_id", "text", "lang").schema)
    files = files.option("maxFilesPerTrigger", config["files_per_batch"]) if config["files_per_batch"] else files
    begun = _begun(spark, checkpoint)
    if not begun and _begun(spark, register):
        raise ValueError(f"{output} was written with another checkpoint")
    LOG.info("reading new files of %s, checkpoint %s (%s)", documents, checkpoint, "used before" if begun else "new")
    query = files.parquet(_pattern(documents)).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    LOG.info("wrote %d rows in %d batches to %s", sum(c["processed"] + c["duplicate"] + c["failed"] for c in counts), len(counts), output)
    return counts


def _pattern(path: str) -> str:
    """A pattern that only ``path`` fits: a stream takes a plain path for a folder, and this may be one file."""
    path = path.rstrip("/")
    return path if re.search(r"[][{}*?\\]", path) else f"{path[:-1]}[{path[-1]}]"


def _begun(spark: SparkSession, folder: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def main(argv: Sequence[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Register new documents.")
    for name in ("documents", "output", "checkpoint"):
        options.add_argument(f"--{name}", required=True)
    options.add_argument("--config")
    given = options.parse_args(argv)
    spark = start("document_register")
    try:
        run(spark, given.documents, given.output, given.checkpoint, load("document_register", spark, given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
