import json
import subprocess
import sys
from pathlib import Path

import pytest

from jobs import retrieval_corpus
from jobs.queries import JOB1_SQL, job1_retrieval_corpus

from ..oracle import connection, differences

DOCS = "doc_id long, text string, lang string, source string, `batch` int"
ROOT = Path(__file__).parents[2]


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture
def tables(spark, tmp_path):
    docs = [
        (1, "the first text\nwith 123456789 in it", "en", "s", 1), (2, "the first text\nwith 123456789 in it", "en", "s", 1), (3, None, "en", "s", 1), (4, "", "de", "s", 1), (5, "zzz", "en", "s", 1), (6, "und der Hund", "de", "s", 1), (7, "the bad one", "en", "s", 1),
        (8, "the toxic one", "en", "s", 1), (None, "the nameless one", "en", "s", 1), (9, "the text without a language", None, "s", 1), (10, "the word " * 50_000, "en", "s", 1), (6, "und der Hund", "de", "s", 1),
    ]
    labels = [(7, 0, 0), (8, 1, 1), (8, 1, 0), (None, 0, 1), (1, 1, 0), (6, None, None)]
    return write(spark, f"file://{tmp_path}/docs", docs, DOCS), write(spark, f"file://{tmp_path}/labels", labels, "doc_id long, quality int, toxic int"), f"file://{tmp_path}/out"


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{name}")


def state(spark, out):
    return {name: sorted(map(str, read(spark, out, name).collect())) for name in ("documents", "checks", "quarantine", "chunks", "report")}


def test_tables_and_rerun(spark, tables):
    docs, labels, out = tables
    written = retrieval_corpus.run(spark, docs, labels, out)
    assert written == {"documents": 8, "checks": 32, "quarantine": 4, "chunks": 4, "report": 3}
    assert {(r["document_id"], r["status"], r["failed_checks"]) for r in read(spark, out, "quarantine").collect()} == {(3, "failed", "document_type_supported,text_present"), (5, "failed", "document_type_supported"), (7, "checked", "review_quality"), (8, "checked", "review_toxic")}
    chunks = {r["document_id"]: r for r in read(spark, out, "chunks").collect()}
    assert set(chunks) == {1, 6, 9, 10} and chunks[1]["text"] == "the first text\nwith [REDACTED] in it" and chunks[10]["char_count"] == 450_000 and chunks[9]["lang"] is None
    assert {tuple(r[c] for c in ("lang", "rows", "documents", "quarantined", "chunks")) for r in read(spark, out, "report").collect()} == {("en", 7, 6, 4, 2), ("de", 3, 1, 0, 1), (None, 1, 1, 0, 1)}
    before = state(spark, out)
    assert retrieval_corpus.run(spark, docs, labels, out) == written and state(spark, out) == before


def test_one_language_is_written_anew(spark, tables):
    docs, labels, out = tables
    retrieval_corpus.run(spark, docs, labels, out)
    before = state(spark, out)
    more = [(1, "the first text", "en", "s", 1), (20, "und das Neue", "de", "s", 1)]
    write(spark, f"{docs}2", more, DOCS)
    retrieval_corpus.run(spark, f"{docs}2", labels, out, langs=["de"])
    after = state(spark, out)
    assert [r for r in after["chunks"] if "lang='de'" not in r] == [r for r in before["chunks"] if "lang='de'" not in r]
    assert [r for r in after["chunks"] if "lang='de'" in r] != [r for r in before["chunks"] if "lang='de'" in r]
    assert {r["document_id"] for r in read(spark, out, "chunks").where("lang = 'de'").collect()} == {20}


def test_empty_tables(spark, tmp_path):
    docs, labels = write(spark, f"file://{tmp_path}/docs", [], DOCS), write(spark, f"file://{tmp_path}/labels", [], "doc_id long, quality int, toxic int")
    assert set(retrieval_corpus.run(spark, docs, labels, f"file://{tmp_path}/out").values()) == {0}


def test_command_line(spark, tables, tmp_path):
    docs, labels, out = tables
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"keywords": {"any": {"the": 1}}, "refuse_toxic": False}))
    done = subprocess.run([sys.executable, "-m", "jobs.retrieval_corpus", "--documents", docs, "--labels", labels, "--output", out, "--config", f"file://{config}", "--lang", "en"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 12 documents (1 without an id)" in done.stderr and "wrote" in done.stderr
    assert {r["document_id"] for r in read(spark, out, "chunks").collect()} == {1, 8, 10}
    config.write_text(json.dumps({"no such": 1}))
    with pytest.raises(ValueError, match="no such"):
        retrieval_corpus.load("retrieval_corpus", spark, f"file://{config}")


def test_query(spark, sf_dir):
    assert differences(job1_retrieval_corpus(spark, sf_dir), connection(sf_dir), JOB1_SQL) is None
