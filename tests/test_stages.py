from pyspark.sql import functions as F

from pagemill.plans.ingest import ingest
from pagemill.plans.stages import STAGES, Reached, stage
from pagemill.plans.store import Store

from .test_ingest import CONTENTS, files


def test_a_registered_stage_runs_in_ingest(spark, tmp_path):
    """After the others, over the documents that are left; a document that it fails fails alone."""

    @stage("audit")
    def audit(work):
        bad = work.rows("chunks").where(F.col("text").contains("TAX INVOICE")).select("document_id").distinct()
        return Reached(work.alive, bad.withColumn("error_message", F.lit("not wanted here")))

    try:
        rows = {r["filename"]: r for r in ingest(Store(spark, f"file://{tmp_path}"), files(spark, {n: CONTENTS[n] for n in ("mc.json", "receipt.json", "junk.txt")})).collect()}
    finally:
        del STAGES["audit"]
    assert rows["mc.json"]["error_code"] is None and rows["mc.json"]["status"] == "embedded" and "audit" in rows["mc.json"]["timings_ms"]
    assert rows["receipt.json"]["error_code"] == "internal_server_error" and rows["receipt.json"]["status"] == "failed" and "audit" not in rows["receipt.json"]["timings_ms"]
    assert rows["junk.txt"]["error_code"] == "unreadable_file" and not rows["junk.txt"]["timings_ms"]
