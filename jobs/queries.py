"""The jobs as queries, and the same in SQL for DuckDB.

Each runs its job twice into a new folder of the shared one, as a rerun would, and returns what lies there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.plans.queries import MASKED, chunk_sql, keyword_sql
from pagemill.shared import shared_dir

from . import document_register, retrieval_corpus


def job1_retrieval_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks and all documents in quarantine."""
    output = shared_dir(spark)
    for _ in range(2):
        retrieval_corpus.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", output)
    chunks, refused = (spark.read.parquet(f"{output}/{name}") for name in ("chunks", "quarantine"))
    chunks = chunks.select("document_id", "lang", "document_type", "chunk_index", F.sha2("text", 256).alias("text_sha256"), "char_count", "n_lines", F.lit(None).cast("string").alias("failed_checks"))
    none = (F.lit(None).cast(t).alias(c) for c, t in chunks.dtypes[3:7])
    return chunks.unionByName(refused.select("document_id", "lang", "document_type", *none, "failed_checks"))


_TYPES = keyword_sql().replace("\nWITH ", "", 1).rsplit("\nSELECT", 1)[0]

JOB1_SQL = chunk_sql("kept", f"""{_TYPES}, firsts AS (
  SELECT doc_id, text, lang FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id, lang NULLS FIRST) AS n FROM documents WHERE doc_id IS NOT NULL) WHERE n = 1
), said AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id), judged AS (
  SELECT f.doc_id, f.text, f.lang, r.document_type, concat_ws(',', CASE WHEN r.document_type IS NULL THEN 'document_type_supported' END, CASE WHEN quality <> 1 THEN 'review_quality' END, CASE WHEN toxic <> 0 THEN 'review_toxic' END,
    CASE WHEN NOT regexp_matches(coalesce(text, ''), '\\S') THEN 'text_present' END) AS failed_checks
  FROM firsts f LEFT JOIN r ON r.doc_id = f.doc_id AND r.n = 1 LEFT JOIN said ON said.doc_id = f.doc_id
), kept AS (SELECT doc_id, {MASKED} AS text FROM judged WHERE failed_checks = ''), """) + """
SELECT c.doc_id AS document_id, j.lang, j.document_type, (row_number() OVER (PARTITION BY c.doc_id ORDER BY lo, hi) - 1)::INTEGER AS chunk_index, sha256(c.text) AS text_sha256, length(c.text)::INTEGER AS char_count, (hi - lo + 1)::INTEGER AS n_lines, NULL AS failed_checks
FROM c JOIN judged j ON j.doc_id = c.doc_id
UNION ALL SELECT doc_id, lang, document_type, NULL, NULL, NULL, NULL, failed_checks FROM judged WHERE failed_checks <> ''"""


def job2_document_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register of all documents."""
    output, checkpoint = shared_dir(spark), shared_dir(spark)
    for _ in range(2):
        document_register.run(spark, f"{sf_dir}/documents.parquet", output, checkpoint)
    return spark.read.parquet(f"{output}/register").select("doc_id", "lang", "content_hash", "first_id", "document_type", "error_code", "batch", "outcome")


JOB2_SQL = f"""
WITH {_TYPES}, rows AS (
  SELECT DISTINCT doc_id, lang, coalesce(text, '') AS text, regexp_matches(coalesce(text, ''), '\\S') AS there FROM documents
), firsts AS (
  SELECT text, arg_min(doc_id, doc_id) AS first_id FROM rows WHERE there GROUP BY text
)
SELECT d.doc_id, d.lang, CASE WHEN there THEN 'sha256:' || sha256(d.text) END AS content_hash, f.first_id, r.document_type,
       CASE WHEN NOT there THEN 'file_missing' WHEN r.document_type IS NULL THEN 'unsupported_document_type' END AS error_code, 0 AS batch,
       CASE WHEN NOT there OR r.document_type IS NULL THEN 'failed' WHEN d.doc_id <> f.first_id THEN 'duplicate' ELSE 'processed' END AS outcome
FROM rows d LEFT JOIN firsts f ON f.text = d.text AND there LEFT JOIN r ON r.doc_id = d.doc_id AND r.n = 1 AND there"""

QUERIES = {"job1_retrieval_corpus": job1_retrieval_corpus, "job2_document_register": job2_document_register}
ORACLE = {"job1_retrieval_corpus": JOB1_SQL, "job2_document_register": JOB2_SQL}
