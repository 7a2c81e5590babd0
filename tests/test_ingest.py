import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from pagemill.operators.embed import DIMENSION, Model, hashing_embedder, register
from pagemill.operators.search import InvalidRequest, Request, UnknownModel, search
from pagemill.plans.ingest import InvalidCountry, Rulepack, deidentified_view, document, embedded, ingest, quarantine_view, reembed
from pagemill.plans.reprocess import reprocess
from pagemill.plans.store import Store
from pagemill.sources.exports import scan_folder
from pagemill.streaming.folder import ingest_stream

from .exports import MC, RECEIPT, REFERRAL, azure, envelope, files, tesseract, textract

CONTENTS = {
    "azure.json": envelope("azure-document-intelligence", azure([REFERRAL[:3], [], REFERRAL[3:]])),
    "copy.json": envelope("aws-textract", textract([MC])),
    "junk.txt": b"this is not JSON",
    "low.json": envelope("aws-textract", textract([MC], confidence=58.9)),
    "mc.json": envelope("aws-textract", textract([MC])),
    "none.json": envelope("tesseract", tesseract([["nothing of interest"]])),
    "nothing.json": b"",
    "receipt.json": envelope("tesseract", tesseract([RECEIPT])),
    "unknown.json": envelope("abbyy-finereader", {}),
    "broken.json": envelope("aws-textract", textract([["RECEIPT"]], Text=5)),
}


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    s = Store(spark, f"file://{tmp_path_factory.mktemp('store')}")
    return s, {r["filename"]: r for r in ingest(s, files(spark, CONTENTS)).collect()}


def test_outcomes(done):
    _, rows = done
    assert len(rows) == len(CONTENTS)
    got = {n: (r["outcome"], r["error_code"], r["document_type"], r["chunks"] or 0) for n, r in rows.items()}
    assert got == {
        "azure.json": ("processed", None, "referral_letter", 2), "copy.json": ("processed", None, "medical_certificate", 1), "junk.txt": ("failed", "unreadable_file", None, 0), "low.json": ("processed", None, "medical_certificate", 1),
        "mc.json": ("duplicate", None, "medical_certificate", 1), "none.json": ("failed", "unsupported_document_type", None, 0), "nothing.json": ("failed", "file_missing", None, 0), "receipt.json": ("processed", None, "receipt", 1),
        "unknown.json": ("failed", "unsupported_ocr_format", None, 0), "broken.json": ("failed", "unsupported_ocr_format", None, 0),
    }
    assert rows["receipt.json"]["quality_flags"] == ["field_claimant_date_of_birth"] and rows["low.json"]["quality_flags"] == ["page_confidence"]
    assert rows["azure.json"]["pages"] == 3 and set(rows["mc.json"]["timings_ms"]) == {"receive", "normalise", "load", "extract", "quality", "chunk", "embed"}


def test_fields(done):
    store, rows = done
    kind = {r["document_id"]: n for n, r in rows.items() if n in ("copy.json", "receipt.json", "azure.json")}
    got = {(kind[r["document_id"]], r["field_name"]): (r["validation_status"], r["normalised_value"], r["line_indexes"]) for r in store.read("fields").collect() if r["document_id"] in kind}
    assert len(got) == 22
    want = {
        ("copy.json", "claimant_name"): ("valid", "TAN WEI MING", [2, 3]), ("copy.json", "claimant_date_of_birth"): ("valid", "14/03/1988", [6]), ("copy.json", "claimant_address"): ("valid", "1 Example Road", [7, 8]),
        ("copy.json", "mc_days"): ("valid", "2", [11]), ("copy.json", "icd_code"): ("valid", "A09", [10]), ("copy.json", "discharge_date_time"): ("valid", "02/09/2026 15:15", [13]), ("copy.json", "submission_date_time"): ("valid", "02/09/2026 11:05", [14, 15]),
        ("copy.json", "date_of_mc"): ("valid", "02/09/2026", [12]), ("copy.json", "provider_name"): ("valid", "HARBOUR CLINIC PTE LTD", [0]), ("receipt.json", "tax_amount"): ("valid", "770", [7]), ("receipt.json", "total_amount"): ("valid", "9320", [8, 9]),
        ("receipt.json", "claimant_date_of_birth"): ("invalid", None, [6]), ("receipt.json", "claimant_address"): ("missing", None, []), ("azure.json", "provider_name"): ("valid", "Harbour Clinic", [0]), ("azure.json", "total_amount_paid"): ("valid", "85000", [1]),
        ("azure.json", "total_approved_amount"): ("missing", None, []), ("azure.json", "signature_presence"): ("valid", "true", [3]), ("azure.json", "total_requested_amount"): ("missing", None, []),
    }
    assert {k: got[k] for k in want} == want


def test_checks_and_views(done):
    store, rows = done
    ran = {(r["document_id"], r["check_name"]): r["passed"] for r in store.read("checks").where("page_number is null").collect()}
    junk, odd, none = (rows[n]["document_id"] for n in ("junk.txt", "unknown.json", "none.json"))
    assert {k[1]: v for k, v in ran.items() if k[0] == junk} == {"file_json": False}
    assert {k[1]: v for k, v in ran.items() if k[0] == odd} == {"file_json": True, "envelope_valid": True, "engine_supported": False}
    assert ran[none, "document_type_supported"] is False
    bad = {r["upload_filename"]: r["failed_checks"] for r in quarantine_view(store).collect()}
    # the empty page of azure.json has no confidence at all, which fails its check
    assert bad == {"azure.json": ["page_confidence"], "junk.txt": ["file_json"], "unknown.json": ["engine_supported"], "none.json": ["document_type_supported"], "low.json": ["page_confidence"], "receipt.json": ["field_claimant_date_of_birth"], "broken.json": []}
    view = deidentified_view(store).collect()
    assert not any((r["field_name"] or "").startswith("claimant_") for r in view)
    assert {r["document_id"] for r in view} == {r["document_id"] for r in store.read("documents").collect()}


def test_again_is_duplicates(spark, done):
    store, rows = done
    again = {r["filename"]: r for r in ingest(store, files(spark, {"b.json": CONTENTS["mc.json"], "j.txt": CONTENTS["junk.txt"]})).collect()}
    assert again["b.json"]["outcome"] == "duplicate" and again["b.json"]["document_id"] == rows["mc.json"]["document_id"]
    assert again["j.txt"]["outcome"] == "failed" and again["j.txt"]["duplicate"]
    assert store.read("documents").count() == 8
    assert sorted(r["status"] for r in store.read("runs").collect()) == ["partial", "partial"]


def test_search(spark, done):
    store, rows = done
    tables = [store.read(t) for t in ("documents", "chunks", "embeddings", "models")]
    best = search(Request.parse({"query": " acute gastroenteritis ", "top_k": 2}), *tables).collect()
    assert len(best) == 2 and all("gastroenteritis" in r["text"] for r in best) and best[0]["score"] >= best[1]["score"]
    assert all(r["document_type"] == "receipt" for r in search(Request.parse({"query": "gst", "filters": {"document_type": "receipt", "country_code": "sg"}}), *tables).collect())
    assert search(Request.parse({"query": "gst", "filters": {"country_code": "MY"}}), *tables).count() == 0
    assert search(Request("gst"), *tables[:3], tables[3].limit(0)).count() == 0


@pytest.mark.parametrize("body", [{}, {"query": " "}, {"query": "x" * 2001}, {"query": "x", "top_k": 0}, {"query": "x", "top_k": 51}, {"query": "x", "top_k": "5"}, {"query": "x", "top_k": True}, {"query": "x", "other": 1}, {"query": "x", "filters": {"document_type": "memo"}}, {"query": "x", "filters": {"country_code": "SGP"}}, {"query": "x", "filters": {"page": 1}}])
def test_invalid_requests(body):
    with pytest.raises(InvalidRequest):
        Request.parse(body)


def _picky():
    inner = hashing_embedder()

    def encode(texts):
        if any("TAX INVOICE" in t for t in texts):
            raise RuntimeError("cannot")
        return inner(texts)

    return encode


def test_reembed(spark, done):
    store, _ = done
    before = store.read("embeddings").count()
    assert not reembed(store, register(Model("picky", "1", DIMENSION, _picky)))
    assert [r["model_name"] for r in store.read("models").where("is_active").collect()] == ["hashing-384"]
    other = register(Model("other", "2", DIMENSION, hashing_embedder))
    assert reembed(store, other) and reembed(store, other)
    assert [r["model_name"] for r in store.read("models").where("is_active").collect()] == ["other"]
    assert store.read("embeddings").where("model_name = 'other'").count() == before


def test_document_and_country(spark, done):
    store, rows = done
    one = document(store, rows["receipt.json"]["document_id"]).collect()
    assert len(one) == 1 and len(one[0]["stages"]) == 7 and [f["field_name"] for f in one[0]["fields"]] == sorted(f["field_name"] for f in one[0]["fields"])
    with pytest.raises(InvalidCountry):
        ingest(store, files(spark, {"x": b"{}"}), "SGP")


def test_country_precedence(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    raw = tesseract([RECEIPT])
    odd = envelope("tesseract", raw, country="Singapore")
    got = {r["filename"]: r for r in ingest(store, files(spark, {"a": envelope("tesseract", raw, country=" my "), "b": odd, "c": envelope("tesseract", raw, country=None)})).collect()}
    assert (got["a"]["country_code"], got["b"]["error_code"], got["b"]["country_code"], got["c"]["country_code"]) == ("MY", "invalid_country_code", "SG", "SG")
    form = Store(spark, f"file://{tmp_path}/form")
    [row] = ingest(form, files(spark, {"b": odd}), "vn").collect()
    assert row["country_code"] == "VN" and "envelope_country_code_invalid" in row["quality_flags"] and row["error_code"] is None


def test_reprocess_replaces(spark, tmp_path):
    """A rerun leaves one set of rows, of the new run, and touches no other document."""
    store = Store(spark, f"file://{tmp_path}")
    rows = {r["filename"]: r["document_id"] for r in ingest(store, files(spark, {n: CONTENTS[n] for n in ("mc.json", "receipt.json", "azure.json", "none.json")})).collect()}
    count = lambda: {t: store.read(t).count() for t in ("documents", "pages", "fields", "checks", "chunks", "embeddings", "stages")}
    before, fields = count(), sorted(map(str, store.read("fields").collect()))
    ids = spark.createDataFrame([(rows["mc.json"],), (rows["azure.json"],), ("unknown",)], "document_id string")
    again = reprocess(store, ids, ("extract", "quality")).collect()
    assert len(again) == 2 and count() == before and sorted(map(str, store.read("fields").collect())) == fields
    every = reprocess(store, store.read("documents").select("document_id")).collect()
    assert len(every) == 4 and sorted(map(str, store.read("fields").collect())) == fields
    assert {k: v for k, v in count().items() if k != "stages"} == {k: v for k, v in before.items() if k != "stages"}
    assert {r["document_type"]: r["status"] for r in every} == {"medical_certificate": "embedded", "receipt": "embedded", "referral_letter": "embedded", None: "failed"}
    # a pack that knows another word: the failed document gets a type, its check passes, the others lose theirs
    other = Rulepack(keywords={"receipt": {"nothing of interest": 1}})
    got = {r["document_id"]: r for r in reprocess(store, store.read("documents").select("document_id"), pack=other).collect()}
    assert got[rows["none.json"]]["status"] == "embedded" and got[rows["none.json"]]["chunks"] == 1 and got[rows["none.json"]]["error_code"] is None
    assert got[rows["mc.json"]]["error_code"] == "unsupported_document_type" and got[rows["mc.json"]]["quality_flags"] == ["document_type_supported"]
    assert store.read("fields").select("document_id").distinct().count() == 1
    assert {r["run_type"] for r in store.read("runs").collect()} == {"ingest", "renormalise"} and store.read("runs").where("started_at is null").count() == 4
    with pytest.raises(ValueError, match="no stages"):
        reprocess(store, ids, ("guess",))


def test_two_runs_at_once(spark, tmp_path):
    """Of two runs that take in the same files one withdraws; nothing counts twice."""
    store = Store(spark, f"file://{tmp_path}")
    names = ("mc.json", "receipt.json", "junk.txt")
    with ThreadPoolExecutor(2) as pool:
        both = [f.result().collect() for f in [pool.submit(ingest, store, files(spark, {n: CONTENTS[n] for n in names})) for _ in range(2)]]
    assert sorted(sum(r["duplicate"] for r in rows) for rows in both) == [0, 3]
    alone = Store(spark, f"file://{tmp_path}/alone")
    ingest(alone, files(spark, {n: CONTENTS[n] for n in names}))
    for t in ("documents", "raw", "pages", "fields", "checks", "chunks", "embeddings", "stages", "models"):
        assert store.read(t).count() == alone.read(t).count(), t
    found = search(Request("gastroenteritis", 50), *(store.read(t) for t in ("documents", "chunks", "embeddings", "models"))).collect()
    assert len(found) == len({(r["document_id"], r["chunk_index"]) for r in found}) == store.read("chunks").count()


def test_turns_exclude_each_other(spark, tmp_path):
    store, inside, seen = Store(spark, f"file://{tmp_path}/s"), [], []

    def enter(i):
        for _ in range(4):
            with store.turn():
                inside.append(i)
                seen.append(len(inside))
                time.sleep(0.01)
                inside.pop()

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(enter, range(4)))
    assert seen == [1] * 16


def test_broken_runs_and_cleaning(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    rows = ingest(store, files(spark, {"mc.json": CONTENTS["mc.json"]}))
    assert len(list(tmp_path.glob("work-*/*"))) == 1 and rows.count() == 1
    store.begin("broken", "ingest")
    assert {r["run_id"]: r["status"] for r in store.read("runs").collect()}["broken"] == "running"
    assert store.sweep(3600) == 0 and store.sweep(0) == 1 and not list(tmp_path.glob("work-*"))
    assert store.read("embeddings").count() == 1
    again = ingest(store, files(spark, {"receipt.json": CONTENTS["receipt.json"]}))
    reprocess(store, again.select("document_id"), ("extract",))
    tables = ("documents", "checks", "embeddings")
    before = {t: sorted(map(str, store.read(t).collect())) for t in tables}
    for t in tables:
        store.compact(t)
    assert {t: sorted(map(str, store.read(t).collect())) for t in tables} == before
    assert all(len(list(tmp_path.glob(f"{t}/_run=*"))) == 1 for t in tables)
    store.forget_model("hashing-384", "1")
    assert store.read("embeddings").count() == 0 and store.read("chunks").count() == 2
    (tmp_path / "_lock").touch()
    with store.turn(stale_s=0) as seq:
        assert seq == 4 + len(tables)
    assert not (tmp_path / "_lock").exists()


def test_documents_that_a_model_refuses(spark, tmp_path):
    """Such a document fails as a whole and has no vectors."""
    store = Store(spark, f"file://{tmp_path}")
    rows = {r["filename"]: r for r in ingest(store, files(spark, {n: CONTENTS[n] for n in ("mc.json", "receipt.json")}), model=register(Model("picky", "1", DIMENSION, _picky))).collect()}
    assert rows["receipt.json"]["error_code"] == "internal_server_error" and rows["mc.json"]["error_code"] is None
    assert {r["document_id"] for r in store.read("embeddings").collect()} == {rows["mc.json"]["document_id"]}
    assert [r["document_id"] for r in embedded(store).collect()] == [rows["mc.json"]["document_id"]]
    assert store.read("documents").where("status = 'failed'").first()["error_message"] == "RuntimeError: cannot"


def test_search_joins_texts_last(spark, done):
    store, _ = done
    plan = search(Request("gst"), *(store.read(t) for t in ("documents", "chunks", "embeddings", "models")))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    at = next(i for i, line in enumerate(plan) if "GlobalLimit" in line)
    end = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
    below = "".join(plan[at:end])
    assert "embedding#" in below and "text#" not in below and "text#" in "".join(plan)
    lost = store.read("models").withColumn("model_name", F.lit("absent"))
    with pytest.raises(UnknownModel):
        search(Request("gst"), *(store.read(t) for t in ("documents", "chunks", "embeddings")), lost)


def test_unfinished_runs_do_not_count(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.append("checks", spark.createDataFrame([("d", 1, "x", True, "info", "{}")], "document_id string, page_number int, check_name string, passed boolean, severity string, details string"), "r1")
    assert store.read("checks").count() == 0
    store.commit("r1", "ingest", 1, 0, 0)
    assert store.read("checks").count() == 1
    with pytest.raises(ValueError):
        store.append("checks", spark.range(1).withColumnRenamed("id", "other"), "r1")


def test_folder_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    for name in ("mc.json", "junk.txt"):
        (folder / name).write_bytes(CONTENTS[name])
    (folder / "sub" / "not_read.json").write_bytes(b"{}")
    assert sorted(r["filename"] for r in scan_folder(spark, str(folder)).collect()) == ["junk.txt", "mc.json"]
    store = Store(spark, f"file://{tmp_path}/store")
    for _ in range(2):
        query = ingest_stream(store, str(folder), f"file://{tmp_path}/at")
        query.awaitTermination(120)
        (folder / "late.json").write_bytes(CONTENTS["receipt.json"])
    assert sorted(r["upload_filename"] for r in store.read("documents").collect()) == ["junk.txt", "late.json", "mc.json"]
    assert store.read("documents").agg(F.count_if(F.col("status") == "embedded")).first()[0] == 2
