import pytest

from pagemill.operators.search import Cells, fit_cells, nearest_each
from pagemill.plans.queries import ORACLE, QUERIES

from .oracle import connection, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_embedding_query(spark, sf_dir):
    rows = QUERIES["embed_chunks"](spark, sf_dir).collect()
    assert rows and all(r["embed_error"] is None and abs(sum(x * x for x in r["embedding"]) - 1) < 1e-5 for r in rows)


def test_index_query(spark, sf_dir):
    """Recall of the index against the exact search of the same queries, at two sizes."""
    for folder in (sf_dir, sf_dir.replace("0.001", "0.01")):
        exact, near = ({(r["query_id"], r["vec_id"]): r["score"] for r in QUERIES[n](spark, folder).collect()} for n in ("search_multi", "search_index"))
        assert len(exact.keys() & near.keys()) >= 0.9 * len(exact)
        assert all(abs(near[k] - exact[k]) < 1e-9 for k in exact.keys() & near.keys())


def test_index_is_pruned_and_takes_any_vectors(spark, tmp_path, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").unionByName(spark.createDataFrame([(-1, None), (-2, [0.0] * 64)], "vec_id long, embedding array<float>"), allowMissingColumns=True)
    cells = fit_cells(vectors, cells=16)
    path = f"file://{tmp_path}/index"
    cells.assign(vectors).write.partitionBy("cell").parquet(path)
    index = spark.read.parquet(path)
    assert index.count() == vectors.count()
    query = vectors.where("vec_id = 7").selectExpr("vec_id AS query_id", "embedding AS q")
    found = nearest_each(index, query, 5, "vec_id", "query_id", cells=Cells(cells.centres, 2))
    rows = found.collect()
    assert len(rows) == 5 and min(rows, key=lambda r: r["rank"])["vec_id"] == 7
    assert "PartitionFilters: [cell" in found._jdf.queryExecution().executedPlan().toString()
    assert fit_cells(vectors.limit(0)).probes == 1
    assert nearest_each(index, query.limit(0), 5, "vec_id", "query_id").count() == nearest_each(vectors.limit(0), query, 5, "vec_id", "query_id").count() == 0
