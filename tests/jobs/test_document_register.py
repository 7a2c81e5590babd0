import subprocess
import sys
from pathlib import Path

import pytest

from jobs import document_register
from jobs.queries import JOB2_SQL, job2_document_register

from ..oracle import connection, differences

DOCS = "doc_id long, text string, lang string, batch string"
ROOT = Path(__file__).parents[2]
FIRST = [(3, "the one", "en", ""), (1, "the one", "en", ""), (2, "zzz", "en", ""), (4, None, None, ""), (5, " \n", "en", ""), (None, "the nameless", "en", ""), (1, "the one", "en", "")]
SECOND = [(6, "the one", "en", ""), (7, "the two", "en", ""), (8, "zzz", "en", ""), (9, "the two", "en", ""), (10, "the nameless", "en", ""), (1, "the one", "en", "")]


def add(spark, folder, rows):
    spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(folder)


def register(spark, out):
    return sorted(((r["doc_id"], r["first_id"], r["document_type"], r["error_code"], r["outcome"], r["batch"]) for r in spark.read.parquet(f"{out}/register").collect()), key=str)


def runs(spark, out):
    return {tuple(r[c] for c in ("batch", "processed", "duplicate", "failed", "status")) for r in spark.read.parquet(f"{out}/runs").collect()}


ONE = [(1, 1, "english", None, "processed", 0), (3, 1, "english", None, "duplicate", 0), (2, 2, None, "unsupported_document_type", "failed", 0), (4, None, None, "file_missing", "failed", 0), (5, None, None, "file_missing", "failed", 0), (None, None, "english", None, "processed", 0)]
TWO = [(6, 1, "english", None, "duplicate", 1), (7, 7, "english", None, "processed", 1), (9, 7, "english", None, "duplicate", 1), (8, 2, None, "unsupported_document_type", "failed", 1), (10, None, "english", None, "duplicate", 1), (1, 1, "english", None, "duplicate", 1)]


@pytest.fixture
def paths(tmp_path):
    return tuple(f"file://{tmp_path}/{name}" for name in ("in", "out", "checkpoint"))


def test_two_runs_over_growing_input(spark, paths):
    folder, out, checkpoint = paths
    add(spark, folder, FIRST)
    assert len(document_register.run(spark, folder, out, checkpoint)) == 1
    assert register(spark, out) == sorted(ONE, key=str) and runs(spark, out) == {(0, 2, 1, 3, "partial")}
    assert document_register.run(spark, folder, out, checkpoint) == []  # nothing new
    add(spark, folder, SECOND)
    counts = document_register.run(spark, folder, out, checkpoint)
    assert [c["batch"] for c in counts] == [1]
    assert register(spark, out) == sorted(ONE + TWO, key=str) and runs(spark, out) == {(0, 2, 1, 3, "partial"), (1, 1, 4, 1, "partial")}


def test_a_batch_that_broke_off_is_run_again(spark, paths, tmp_path):
    folder, out, checkpoint = paths
    add(spark, folder, FIRST)
    document_register.run(spark, folder, out, checkpoint)
    add(spark, folder, SECOND)
    document_register.run(spark, folder, out, checkpoint)
    for name in ("1", ".1.crc"):  # as if the run had ended before it could say that the batch is done
        (tmp_path / "checkpoint/commits" / name).unlink(missing_ok=True)
    assert [c["batch"] for c in document_register.run(spark, folder, out, checkpoint)] == [1]
    assert register(spark, out) == sorted(ONE + TWO, key=str)


def test_a_file_a_batch(spark, paths):
    folder, out, checkpoint = paths
    add(spark, folder, FIRST)
    add(spark, folder, SECOND)
    config = document_register.load("document_register") | {"files_per_batch": 1}
    assert [c["batch"] for c in document_register.run(spark, folder, out, checkpoint, config)] == [0, 1]
    assert len(register(spark, out)) == len(ONE + TWO)


def test_checkpoint_and_output_belong_together(spark, paths):
    folder, out, checkpoint = paths
    add(spark, folder, FIRST)
    document_register.run(spark, folder, out, checkpoint)
    with pytest.raises(ValueError, match="another checkpoint"):
        document_register.run(spark, folder, out, f"{checkpoint}2")


def test_no_rows(spark, paths):
    folder, out, checkpoint = paths
    add(spark, folder, [])
    document_register.run(spark, folder, out, checkpoint)
    add(spark, folder, FIRST)
    document_register.run(spark, folder, out, checkpoint)
    assert [r[:5] for r in register(spark, out)] == [r[:5] for r in sorted(ONE, key=str)]


def test_command_line(spark, paths):
    folder, out, checkpoint = paths
    add(spark, folder, FIRST)
    done = subprocess.run([sys.executable, "-m", "jobs.document_register", "--documents", folder, "--output", out, "--checkpoint", checkpoint], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "batch 0: 2 processed, 1 duplicate, 3 failed (partial)" in done.stderr
    assert register(spark, out) == sorted(ONE, key=str)


def test_query(spark, sf_dir):
    assert differences(job2_document_register(spark, sf_dir), connection(sf_dir), JOB2_SQL) is None
