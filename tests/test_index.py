"""The stored index, and runs that meet."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.operators.embed import DIMENSION, Model, hashing_embedder, register
from pagemill.operators.search import FLAT, Request, best_vectors, fit_cells
from pagemill.plans.index import build_index, load_cells, placed, probe, search_store
from pagemill.plans.ingest import reembed
from pagemill.plans.store import LostTurn, Store

CHUNK = "document_id string, chunking_version string, chunk_index int"


def filled(spark, root, texts):
    """A store of embedded documents of one chunk each, without vectors."""
    store = Store(spark, f"file://{root}")
    ids = [f"d{i:04}" for i in range(len(texts))]
    rows = spark.createDataFrame([(i, "embedded", ("receipt", "referral_letter")[k % 5 == 0], "SG") for k, i in enumerate(ids)], "document_id string, status string, document_type string, country_code string")
    names = ("content_hash upload_filename error_code error_message source_sha256 source_filename source_mime_type ocr_engine ocr_engine_version ocr_processed_at raw_uri normalised_uri").split()
    rows = rows.withColumns({n: F.lit(None).cast("string") for n in names}).withColumns({"size_bytes": F.lit(1).cast("long"), "ingested_at": F.current_timestamp()})
    store.append("documents", rows, "r")
    chunks = spark.createDataFrame([(i, "1.0", 0, 1, t, len(t), [0], 0.0, 0.0, 1.0, 1.0) for i, t in zip(ids, texts, strict=True)], f"{CHUNK}, page_number int, text string, char_count int, line_indexes array<int>, x0 double, y0 double, x1 double, y1 double")
    store.append("chunks", chunks, "r")
    store.commit("r", "ingest", len(ids), 0, 0)
    return store


X, Y = (register(Model(n, "1", DIMENSION, hashing_embedder)) for n in ("model-x", "model-y"))


def test_two_reembeds_that_meet_leave_one_active_model(spark, tmp_path, monkeypatch):
    """The second begins when the first has written its rows and not yet taken its turn."""
    store = filled(spark, tmp_path, ["one", "two"])
    turn, inside = Store.turn, []

    def meeting(self, *a):
        if not inside:
            inside.append(1)
            assert reembed(store, X)
        return turn(self, *a)

    monkeypatch.setattr(Store, "turn", meeting)
    assert reembed(store, Y)
    assert [r["model_name"] for r in store.read("models").where("is_active").collect()] == ["model-y"] and store.read("models").count() == 2


def test_two_reembeds_of_one_model_leave_one_vector_a_chunk(spark, tmp_path):
    store = filled(spark, tmp_path, ["one", "two", "three"])
    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(lambda _: reembed(store, X), range(2))) == [True, True]
    keys = [tuple(r)[:3] for r in store.read("embeddings").collect()]
    assert len(keys) == len(set(keys)) == 3
    found = search_store(store, Request("two", 3)).collect()
    assert [r["document_id"] for r in found][0] == "d0001" and len(found) == 3


def test_a_holder_whose_turn_was_taken_away_cannot_commit(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.begin("slow", "ingest")
    with pytest.raises(LostTurn), store.turn() as seq:
        with store.turn(stale_s=-1) as other:  # takes it away
            store.commit("fast", "ingest", 1, 0, 0, seq=other)
            with pytest.raises(LostTurn):
                store.commit("slow", "ingest", 1, 0, 0, seq=seq)
            assert (tmp_path / "_lock").exists()
        store.commit("slow", "ingest", 1, 0, 0, seq=seq)
    assert {r["run_id"] for r in store.read("runs").where("seq is not null").collect()} == {"fast"}


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    """The given vectors, one a document, as those of a model, with an index."""
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    store = filled(spark, tmp_path_factory.mktemp("index"), ["x"] * given.count())
    vectors = given.select(F.format_string("d%04d", F.row_number().over(Window.orderBy("vec_id")) - 1).alias("document_id"), F.lit("1.0").alias("chunking_version"), F.lit(0).alias("chunk_index"), "embedding", F.lit(64).alias("dimension"), F.lit("given").alias("model_name"), F.lit("1").alias("model_version"))
    store.append("embeddings", placed(store, vectors), "v")
    store.commit("v", "reembed", 1, 0, 0)
    before = {tuple(r)[:3] for r in store.read("embeddings").collect()}
    n = build_index(store, Model("given", "1", 64, hashing_embedder))
    assert n > 30 and {tuple(r)[:3] for r in store.read("embeddings").collect()} == before
    assert store.read("embeddings").where("cell < 0").count() == 0
    return store


@pytest.mark.parametrize("kind", [None, "referral_letter"])
def test_recall_with_and_without_filters(indexed, kind):
    documents = indexed.read("documents").select("document_id", "document_type")
    documents = documents.where(F.col("document_type") == kind) if kind else documents
    vectors = indexed.read("embeddings").cache()
    queries = [[float(v) for v in r["embedding"]] for r in vectors.where("document_id like 'd%50'").collect()]
    assert len(queries) == 20
    hits = 0
    for q in queries[::2]:
        exact = {r["document_id"] for r in best_vectors(q, 10, documents, vectors).collect()}
        near = {r["document_id"] for r in probe(indexed, q, 10, documents, "given", "1").collect()}
        assert len(near) == 10
        hits += len(exact & near)
    vectors.unpersist()
    assert hits >= 0.9 * 10 * len(queries[::2])


def test_cells_are_pruned_and_new_vectors_found(spark, indexed):
    name, cells = load_cells(indexed, "given", "1")
    one = indexed.read("embeddings").where(F.col("place").isin(3, 4) & (F.col("centres") == name) & F.col("cell").isin(3, 4))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "place" in plan.split("PartitionFilters: [")[1].split("]")[0] and "In(cell" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert 0 < one.count() < indexed.read("embeddings").count() / 4
    new = spark.createDataFrame([("n1", "1.0", 0, [9.0] + [0.0] * 63, 64, "given", "1"), ("n2", "1.0", 0, [9.0] + [0.1] * 63, 64, "given", "1")], f"{CHUNK}, embedding array<float>, dimension int, model_name string, model_version string")
    indexed.append("embeddings", placed(indexed, new.where("document_id = 'n1'"), Model("given", "1", 64, hashing_embedder)), "n1")
    indexed.commit("n1", "reembed", 1, 0, 0)
    indexed.append("embeddings", placed(indexed, new.where("document_id = 'n2'")), "n2")  # by a run that knew no centres
    indexed.commit("n2", "reembed", 1, 0, 0)
    assert {(r["document_id"], r["centres"] == name) for r in indexed.read("embeddings").where("document_id like 'n%'").collect()} == {("n1", True), ("n2", False)}
    both = spark.createDataFrame([("n1",), ("n2",)], "document_id string")
    found = probe(indexed, [1.0] + [0.0] * 63, 5, both, "given", "1").collect()  # fewer than k pass: all cells are looked at
    assert [r["document_id"] for r in found] == ["n1", "n2"] and abs(found[0]["score"] - 1) < 1e-9


def test_many_cells_are_fitted_within_places(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(rng.normal(size=(3000, 8)) + 3 * rng.integers(0, 2, (3000, 8)))]
    vectors = spark.createDataFrame([*rows, (-1, None)], "vec_id long, embedding array<float>").repartition(4)
    cells = fit_cells(vectors, cells=2 * FLAT)
    assert cells.tops is not None and FLAT < len(cells.centres) <= 3 * FLAT and cells.probes < len(cells.centres)
    got = {r["vec_id"]: (r["cell"], r["place"]) for r in cells.assign(vectors).collect()}
    assert got.pop(-1) == (-1, -1) and len(got) == 3000 and all(cells.place[c] == p for c, p in got.values())


def test_one_id_is_a_filter_of_the_scan(spark, tmp_path):
    store = filled(spark, tmp_path, [f"text {i}" for i in range(40)])
    store.compact("chunks")
    ids = spark.createDataFrame([("d0007",)], "document_id string")
    one = store.read("chunks", ids)
    assert [r["text"] for r in one.collect()] == ["text 7"]
    pushed = one._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(document_id,d0007)" in pushed or "In(document_id" in pushed
    ranges = sorted(tuple(r)[1:] for r in spark.read.parquet(f"file://{tmp_path}/chunks").groupBy(F.input_file_name()).agg(F.min("document_id"), F.max("document_id")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))  # so one file's row groups hold an id
    many = spark.range(2000).select(F.format_string("d%04d", "id").alias("document_id"))
    assert store.read("chunks", many).count() == 40
