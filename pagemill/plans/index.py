"""The stored index of vectors, and the search over it.

Vectors lie in the partitions of their model, of the centres by which they were placed and of a place,
sorted by cell.  Those that came after the fit are placed when they are written; those that no
current centres have placed are looked at by every search, so none is ever missed for being new.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunk import CHUNKING_VERSION
from ..operators.embed import CHUNK_KEY, MODELS, Model, encode
from ..operators.search import Cells, Request, answer, best_vectors, fit_cells, fitting, searched_model, with_texts
from .store import UNPLACED, Store


def load_cells(store: Store, name: str, version: str) -> tuple[str, Cells] | None:
    """The latest centres of a model and their name, or none; at most MOST_CELLS rows."""
    rows = store.read("cells").where((F.col("model_name") == name) & (F.col("model_version") == version))
    rows = rows.select("centres", "place", "cell", "centre", "probes").collect()
    if not rows:
        return None
    tops = np.array([r["centre"] for r in sorted(rows, key=lambda r: r["place"]) if r["cell"] < 0], np.float64)
    cells = sorted((r for r in rows if r["cell"] >= 0), key=lambda r: r["cell"])
    centres = np.array([r["centre"] for r in cells], np.float64)
    flat = not len(tops)
    return rows[0]["centres"], Cells(centres, cells[0]["probes"], None if flat else tops, None if flat else np.array([r["place"] for r in cells]))


def placed(store: Store, vectors: DataFrame, model: Model | None = None) -> DataFrame:
    """Rows for ``embeddings`` with their cells by the model's current centres, if it has any."""
    found = load_cells(store, model.name, model.version) if model else None
    if not found:
        return vectors.withColumns({"centres": F.lit(UNPLACED), "place": F.lit(-1), "cell": F.lit(-1)})
    return found[1].assign(vectors).withColumn("centres", F.lit(found[0]))


def build_index(store: Store, model: Model, k: int = 10, recall: float = 0.95, cells: int | None = None) -> int:
    """Fits centres on the model's vectors and places all of them anew; returns the number of cells.

    Rows are written while searches go on with the old ones and become visible with the run.
    """
    mine = (F.col("model_name") == model.name) & (F.col("model_version") == model.version)
    found = fit_cells(store.read("embeddings").where(mine), k, recall, cells)
    places = found.places()
    table = [(model.name, model.version, int(p), i, [float(v) for v in c], found.probes) for i, (p, c) in enumerate(zip(places, found.centres, strict=True))]
    table += [(model.name, model.version, i, -1, [float(v) for v in c], found.probes) for i, c in enumerate(found.tops if found.tops is not None else [])]
    centres = store.spark.createDataFrame(table, "model_name string, model_version string, place int, cell int, centre array<float>, probes int")
    name = store.new_name()

    def change(rows: DataFrame) -> DataFrame:
        others = rows.where(~mine)
        own = found.assign(rows.where(mine)).withColumn("centres", F.lit(name))
        # a place's rows go together; large places are dealt out to several tasks
        return others.unionByName(own).hint("rebalance", "model_name", "place").sortWithinPartitions("model_name", "place", "cell")

    store.compact("embeddings", change, lambda run_id: store.append("cells", centres.withColumn("centres", F.lit(name)), run_id), "index")
    return len(found.centres)


def probe(store: Store, query: list[float], k: int, documents: DataFrame, name: str, version: str) -> DataFrame | None:
    """Keys and scores of the k best chunks of ``documents`` found by widening the search; None without an index.

    Begins with the cells that the fit asks for and doubles them until there are k chunks and the
    last doubling changed none of them, or no cells are left.  Cells are read once each.
    """
    found = load_cells(store, name, version)
    if not found:
        return None
    centres, cells = found
    order, places = cells.order(np.array([query]))[0], cells.places()
    vectors = store.read("embeddings").where((F.col("model_name") == name) & (F.col("model_version") == version) & (F.col("chunking_version") == CHUNKING_VERSION))
    best: list = []
    seen, upto = 0, min(len(order), cells.probes)
    while True:
        new = order[seen:upto].tolist()
        where = (F.col("centres") == centres) & F.col("place").isin(sorted(set(places[new].tolist()))) & F.col("cell").isin(new)
        where = where if seen else where | (F.col("centres") != centres)
        rows = best_vectors(query, k, documents, vectors.where(where)).collect()  # k rows
        before, best = best, sorted({*map(tuple, rows), *best}, key=lambda r: (-r[-1], r[:-1]))[:k]
        seen = upto
        if seen == len(order) or (len(best) == k and best == before):
            break
        upto = min(len(order), 2 * seen)
    return store.spark.createDataFrame(best, f"{', '.join(f'{c} {t}' for c, t in zip(CHUNK_KEY, ('string', 'string', 'int'), strict=True))}, score double")


def search_store(store: Store, request: Request, index: bool = True) -> DataFrame:
    """``search`` over the store's tables; with ``index`` over the cells of the active model where it has any."""
    found = searched_model(store.read("models"))
    name, version = found or ("", "")
    documents = fitting(request, store.read("documents"))
    query = encode([request.query], MODELS[name])[0] if found else [0.0]
    vectors = store.read("embeddings").where((F.col("model_name") == name) & (F.col("model_version") == version) & (F.col("chunking_version") == CHUNKING_VERSION))
    best = probe(store, query, request.top_k, documents, name, version) if index and found else None
    best = best_vectors(query, request.top_k, documents, vectors if found else vectors.limit(0)) if best is None else best
    return answer(with_texts(best, documents, store.read("chunks").where(F.col("chunking_version") == CHUNKING_VERSION)), name)
