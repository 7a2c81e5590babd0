"""Quality checks and the views over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_CONFIDENCE = 0.8
COLUMNS = ("document_id", "page_number", "check_name", "passed", "severity", "details")
#: Names that each stage replaces, as LIKE patterns.
OWNED = {
    "receive": ("file\\_json", "envelope\\_valid", "engine\\_supported", "envelope\\_country\\_code\\_invalid"),
    "extract": ("document\\_type\\_supported",),
    "quality": ("page\\_confidence", "bbox\\_clamped", "field\\_%"),
}
CLAIMANT_FIELDS = ("claimant_name", "claimant_address", "claimant_date_of_birth")


def _check(name: Column | str, passed: Column, severity: Column | str, details: dict[str, Column], page: Column | None = None) -> list[Column]:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    page = F.lit(None).cast("int") if page is None else page
    return [F.col("document_id"), page.alias("page_number"), as_column(name).alias("check_name"), passed.alias("passed"), as_column(severity).alias("severity"), F.to_json(F.struct(*(v.alias(k) for k, v in details.items()))).alias("details")]


def page_checks(pages: DataFrame, threshold: float = PAGE_CONFIDENCE) -> DataFrame:
    """Two checks a page, and one a document that lists the pages below the threshold.

    pages: document_id, page_number, mean_confidence (null fails) and clamped_count.
    """
    sure = F.coalesce(F.col("mean_confidence") >= threshold, F.lit(False))
    no = F.when(F.col("mean_confidence").isNull(), "no line confidence on page")
    confidence = pages.select(*_check("page_confidence", sure, "warning", {"threshold": F.lit(threshold), "observed": F.col("mean_confidence"), "page_number": F.col("page_number"), "message": no}, F.col("page_number")))
    clamped = pages.select(*_check("bbox_clamped", F.coalesce("clamped_count", F.lit(0)) == 0, "warning", {"clamped_count": F.coalesce("clamped_count", F.lit(0)), "page_number": F.col("page_number")}, F.col("page_number")))
    low = pages.groupBy("document_id").agg(F.array_sort(F.collect_list(F.when(~sure, F.col("page_number")))).alias("low"))
    whole = low.select(*_check("page_confidence", F.size("low") == 0, "warning", {"threshold": F.lit(threshold), "flagged_pages": F.col("low"), "level": F.lit("document")}))
    return reduce(DataFrame.unionByName, (confidence, clamped, whole))


def field_checks(fields: DataFrame) -> DataFrame:
    """field_<name>: passes if valid; a missing field is for information only."""
    severity = F.when(F.col("validation_status") == "missing", "info").otherwise("warning")
    return fields.select(*_check(F.concat(F.lit("field_"), F.col("field_name")), F.col("validation_status") == "valid", severity, {"validation_status": F.col("validation_status"), "message": F.col("validation_message")}))


def type_checks(types: DataFrame) -> DataFrame:
    """document_type_supported of classified documents (document_type null: none of the types)."""
    known = F.col("document_type").isNotNull()
    details = {"document_type": F.col("document_type"), "score": F.col("score"), "matched_keywords": F.col("matched_keywords"), "error_code": F.when(~known, "unsupported_document_type")}
    return types.select(*_check("document_type_supported", known, "error", details))


def failed_checks(checks: DataFrame) -> DataFrame:
    """Distinct names a document of checks that failed with severity error or warning."""
    return checks.where(~F.col("passed") & F.col("severity").isin("error", "warning")).select("document_id", "check_name").distinct()


def quarantine(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """Documents that failed or have a failed check, with the sorted names of those checks."""
    bad = ~F.col("passed") & F.col("severity").isin("error", "warning")
    per = checks.groupBy("document_id").agg(F.array_sort(F.collect_set(F.when(bad, F.col("check_name")))).alias("failed_checks"), F.bool_or(bad).alias("_bad"))
    joined = documents.join(per, "document_id", "left").where((F.col("status") == "failed") | F.col("_bad"))
    return joined.withColumn("failed_checks", F.coalesce("failed_checks", F.array().cast("array<string>"))).drop("_bad")


def deidentified(documents: DataFrame, fields: DataFrame) -> DataFrame:
    """Documents with their fields that do not identify anyone; one row with nulls if there are none."""
    kept = fields.where(~F.col("field_name").isin(*CLAIMANT_FIELDS)).select("document_id", "field_name", "normalised_value", "value_type", "validation_status")
    plain = documents.select(*(c for c in ("document_id", "document_type", "country_code", "status", "ocr_engine", "ocr_engine_version", "ingested_at") if c in documents.columns))
    return plain.join(kept, "document_id", "left")


def replace_owned(checks: DataFrame, new: DataFrame, owned: tuple[str, ...], documents: DataFrame | None = None) -> DataFrame:
    """``checks`` without rows whose name is like one of ``owned`` (of ``documents``, or all of ``new``'s), with ``new``."""
    mine = reduce(lambda a, b: a | b, (F.col("check_name").like(p) for p in owned))
    ids = (new if documents is None else documents).select("document_id").distinct().withColumn("_own", F.lit(True))
    kept = checks.join(ids, "document_id", "left").where(~(F.coalesce("_own", F.lit(False)) & mine)).drop("_own")
    return kept.unionByName(new)
