"""Top-k search by cosine similarity: exact, or over an index of cells."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunk import CHUNKING_VERSION
from .classify import KEYWORDS
from .embed import CHUNK_KEY, MODELS, active_model, encode

MAX_QUERY, MAX_K = 2000, 50


class InvalidRequest(ValueError):
    """The request breaks a rule; the message does not repeat its values."""


@dataclass(frozen=True)
class Request:
    query: str
    top_k: int = 5
    document_type: str | None = None
    country_code: str | None = None

    @classmethod
    def parse(cls, body: dict) -> Request:
        """From {query, top_k, filters{document_type, country_code}}; other keys are not allowed."""
        filters = body.get("filters") or {} if isinstance(body, dict) else None
        if not isinstance(filters, dict) or set(body) - {"query", "top_k", "filters"} or set(filters) - {"document_type", "country_code"}:
            raise InvalidRequest("unknown or malformed keys")
        query, k, kind, country = body.get("query"), body.get("top_k", 5), filters.get("document_type"), filters.get("country_code")
        if not isinstance(query, str) or not 1 <= len(query.strip()) <= MAX_QUERY:
            raise InvalidRequest(f"query must have 1 to {MAX_QUERY} characters")
        if type(k) is not int or not 1 <= k <= MAX_K:
            raise InvalidRequest(f"top_k must be 1 to {MAX_K}")
        if kind is not None and kind not in KEYWORDS:
            raise InvalidRequest("unknown document_type")
        if country is not None and not (isinstance(country, str) and re.fullmatch("[A-Za-z]{2}", country)):
            raise InvalidRequest("country_code must be two letters")
        return cls(query.strip(), k, kind, country.upper() if country else None)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, query: list[float], k: int, key: list[str], embedding: str = "embedding") -> DataFrame:
    """The k rows of largest ``score`` (1 - cosine distance); ties go by key.  One pass with k rows a task."""
    q = F.array(*(F.lit(float(x)) for x in query))
    scored = vectors.withColumn("score", cosine(F.col(embedding), q)).where(F.col("score").isNotNull())
    return scored.orderBy(F.col("score").desc(), *key).limit(k)


def _best(which: np.ndarray, score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows of each query with the largest score; ties go by key."""
    order = np.lexsort((key, -score, which))
    which = which[order]
    begin = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))) if len(which) else np.zeros(0, np.int64)
    rank = np.arange(len(which)) - np.repeat(begin, np.diff(np.append(begin, len(which))))
    return order[rank < k]


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; those of length zero become NaN and score nothing."""
    size = np.sqrt((x * x).sum(1))
    return x / np.where(size > 0, size, np.nan)[:, None]


def nearest_each(vectors: DataFrame, queries: DataFrame, k: int, key: str, query_key: str, embedding: str = "embedding", block: int = 4096, cells: Cells | None = None) -> DataFrame:
    """The same for every row of ``queries`` (query_key, q), against all rows; keys are longs.

    Queries are taken in blocks of about ``block``, so that what is sent out does not grow with
    their number.  A task scores its rows by matrix products and keeps k a query: these alone are
    shuffled.  Which rows are the best is settled by sums in a fixed order, so equal vectors tie.
    With ``cells`` a row (which has its ``cell``, and ``place``) is scored for the queries that look there.
    """
    blocks = max(1, -(-queries.count() // block))

    def scored(part: DataFrame) -> DataFrame:
        rows = part.select(query_key, "q").where("q is not null").collect()  # a block
        names, q = np.array([r[0] for r in rows], np.int64), _unit(np.array([r[1] for r in rows] or np.zeros((0, 1)), np.float64))
        looked = cells.probed(q) if cells is not None and len(rows) else None
        source = vectors.select(F.col(key).cast("long").alias(key), embedding, *(c for c in ("cell", "place") if cells is not None and c in vectors.columns))
        if looked is not None:  # reaches the scan of a table that is partitioned by cell
            found = np.flatnonzero(looked.any(0))
            source = source.where(F.col("cell").isin(found.tolist()))
            source = source.where(F.col("place").isin(np.unique(cells.places()[found]).tolist())) if "place" in source.columns else source

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]

            def add(x: np.ndarray, ids: np.ndarray, mine: np.ndarray) -> None:
                nonlocal held
                rough = np.nan_to_num(x @ q[mine].T, nan=-np.inf)
                last = max(0, len(x) - k)
                row, which = np.nonzero((rough >= np.partition(rough, last, axis=0)[last] - 1e-9) & np.isfinite(rough))
                which = mine[which]
                score = np.concatenate([(x[row[i : i + 65536]] * q[which[i : i + 65536]]).sum(1) for i in range(0, len(row), 65536)] or [np.zeros(0)])
                held = [np.concatenate(z) for z in zip(held, (which, score, ids[row]), strict=True)]
                best = _best(*held, k)
                held = [z[best] for z in held]

            for batch in batches:
                for a in range(0, len(batch), 2048):
                    part = batch.slice(a, 2048)
                    part = part.filter(pa.compute.is_valid(part.column(1)))
                    if not len(part) or not len(names):
                        continue
                    x = _unit(part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), -1))
                    ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                    if looked is None:
                        add(x, ids, np.arange(len(names)))
                        continue
                    cell = part.column(2).to_numpy(zero_copy_only=False)
                    for c in np.unique(cell):
                        if len(mine := np.flatnonzero(looked[:, c])):
                            add(x[cell == c], ids[cell == c], mine)
            if len(held[0]):
                yield pa.RecordBatch.from_arrays([pa.array(names[held[0]]), pa.array(held[2]), pa.array(held[1])], [query_key, key, "score"])

        return source.mapInArrow(run, f"{query_key} long, {key} long, score double")

    number = F.pmod(F.xxhash64(query_key), F.lit(blocks))
    found = reduce(DataFrame.unionByName, (scored(queries.where(number == i) if blocks > 1 else queries) for i in range(blocks)))
    rank = F.row_number().over(Window.partitionBy(query_key).orderBy(F.col("score").desc(), key))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


#: Cells at most, so that their centres can be sent out; up to FLAT they are fitted at once.
MOST_CELLS, FLAT = 16_384, 128


@dataclass(frozen=True)
class Cells:
    """An index for approximate search: every vector lies in the cell of its nearest centre.

    Many cells are held in places of similar ones: a vector's place is the nearest of ``tops``, its
    cell the nearest of that place (``place`` of each centre).  A query looks into the ``probes`` cells
    whose centres are nearest to it.
    """

    centres: np.ndarray
    probes: int
    tops: np.ndarray | None = None
    place: np.ndarray | None = None

    def places(self) -> np.ndarray:
        return np.arange(len(self.centres)) if self.place is None else self.place

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        if self.tops is None:
            return np.argmax(x @ self.centres.T, axis=1)
        out, top = np.zeros(len(x), np.int64), np.argmax(x @ self.tops.T, axis=1)
        for t in np.unique(top):
            own, mine = np.flatnonzero(self.place == t), top == t
            out[mine] = own[np.argmax(x[mine] @ self.centres[own].T, axis=1)] if len(own) else 0
        return out

    def order(self, q: np.ndarray) -> np.ndarray:
        """All cells, the nearest first, for each query."""
        return np.argsort(-np.nan_to_num(q @ self.centres.T), axis=1, kind="stable")

    def probed(self, q: np.ndarray) -> np.ndarray:
        """(queries, cells): where each query looks."""
        return np.argsort(self.order(q), axis=1, kind="stable") < self.probes

    def assign(self, vectors: DataFrame, embedding: str = "embedding") -> DataFrame:
        """Every row with its ``cell`` and ``place``, -1 for null vectors; written by place and sorted by cell, searches read only what they probe."""
        cells, place = self, self.places()

        @F.pandas_udf("cell int, place int")
        def nearest_centre(v: pd.Series) -> pd.DataFrame:
            out = pd.DataFrame({"cell": np.full(len(v), -1, np.int32), "place": np.full(len(v), -1, np.int32)})
            there = v.notna().to_numpy()
            if there.any():
                cell = cells.nearest(np.stack(v[there].to_list()).astype(np.float64))
                out.loc[there, "cell"], out.loc[there, "place"] = cell, place[cell]
            return out

        return vectors.withColumn("_c", nearest_centre(F.col(embedding))).select(*(f"`{c}`" for c in vectors.columns if c not in ("cell", "place")), "_c.cell", "_c.place")


def _means(x: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of length one of ``n`` groups of the rows."""
    centres = x[rng.choice(len(x), n, replace=False)]
    for _ in range(12):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        empty = ~np.any(sums, axis=1)
        sums[empty] = centres[empty]
        centres = np.nan_to_num(_unit(sums))
    return centres


def _within_places(vectors: DataFrame, tops: np.ndarray, wanted: int, embedding: str, sample: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Centres within each place, as many as its share of the rows asks for, from at most ``sample`` vectors of it chosen by hash."""
    placed = Cells(tops, 1).assign(vectors.select(F.col(embedding).alias("v"), F.xxhash64(embedding).alias("h")), "v").where("place >= 0").select("v", "h", "place")
    counts = placed.groupBy("place").agg(F.count("*").alias("n"))
    share = {r["place"]: r["n"] for r in counts.collect()}  # a row a place
    total = sum(share.values())
    want = {p: max(1, round(wanted * n / total)) for p, n in share.items()}
    few = placed.withColumn("r", F.row_number().over(Window.partitionBy("place").orderBy("h"))).where(F.col("r") <= sample)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        p = int(group["place"].iloc[0])
        x = _unit(np.stack(group.sort_values(["h"], kind="stable")["v"].to_list()).astype(np.float64))
        x = x[~np.isnan(x).any(1)]
        c = _means(x, min(len(x), want[p]), np.random.default_rng(p)) if len(x) else np.zeros((0, tops.shape[1]))
        return pd.DataFrame({"place": p, "centre": list(c)})

    rows = few.groupBy("place").applyInPandas(fit, "place int, centre array<double>").orderBy("place", "centre").collect()  # at most MOST_CELLS or so
    return np.array([r["centre"] for r in rows]), np.array([r["place"] for r in rows])


def fit_cells(vectors: DataFrame, k: int = 10, recall: float = 0.95, cells: int | None = None, sample: int = 20_000, embedding: str = "embedding") -> Cells:
    """Centres and probes from at most ``sample`` vectors, chosen by hash.

    There are as many cells as the root of the number of vectors (``cells`` if given), MOST_CELLS at
    most; beyond FLAT they are fitted within places, on a bounded sample of each.  Probes are the
    fewest with which the sample's own ``k`` nearest neighbours are found to the ``recall`` asked
    for.  Every row is indexed by ``assign``; only this fit is bounded.
    """
    there = vectors.where(F.col(embedding).isNotNull())
    rows = there.select(F.col(embedding).alias("v"), F.xxhash64(embedding).alias("h")).orderBy("h").limit(sample).collect()
    x = _unit(np.array([r["v"] for r in rows] or np.zeros((0, 1)), np.float64))
    x = x[~np.isnan(x).any(1)]
    if not len(x):
        return Cells(np.zeros((1, 1)), 1)
    wanted = min(MOST_CELLS, cells or max(1, round(math.sqrt(there.count()))))
    rng = np.random.default_rng(0)
    if wanted <= FLAT:
        found = Cells(_means(x, min(len(x), wanted), rng), 1)
    else:
        tops = _means(x, min(len(x), round(math.sqrt(wanted))), rng)
        centres, place = _within_places(there, tops, wanted, embedding)
        found = Cells(centres, 1, tops, place)
    own = found.nearest(x)
    asked = rng.choice(len(x), min(len(x), 500), replace=False)
    score = x[asked] @ x.T
    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
    rank = np.argsort(found.order(x[asked]), axis=1, kind="stable")
    needed = np.sort(np.take_along_axis(rank, own[best], axis=1), axis=None)
    return replace(found, probes=1 + int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]))


class UnknownModel(LookupError):
    """The active model is not among those registered here."""


def best_vectors(query: list[float], k: int, documents: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Keys and scores of the k best chunks of ``documents``, taken where the vectors lie; texts are not read."""
    q = F.array(*(F.lit(float(x)) for x in query))
    scored = embeddings.select(*CHUNK_KEY, cosine(F.col("embedding"), q).alias("score")).where("score is not null")
    return scored.join(documents.select("document_id"), "document_id", "left_semi").orderBy(F.col("score").desc(), *CHUNK_KEY).limit(k)


def with_texts(best: DataFrame, documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """Document columns, chunk columns and score of a few chunks, the best first."""
    return chunks.join(F.broadcast(best), CHUNK_KEY).join(documents, "document_id").orderBy(F.col("score").desc(), *CHUNK_KEY)


def search_vectors(query: list[float], k: int, documents: DataFrame, chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """The k best chunks of ``documents``: document columns, chunk columns and score.

    What is joined with the documents' ids is the key and the score, and only the k rows found meet
    their texts.
    """
    return with_texts(best_vectors(query, k, documents, embeddings), documents, chunks)


def fitting(request: Request, documents: DataFrame) -> DataFrame:
    """(document_id, document_type) of the embedded documents that the filters let through."""
    fit = documents.where(F.col("status") == "embedded")
    if request.document_type:
        fit = fit.where(F.col("document_type") == request.document_type)
    if request.country_code:
        fit = fit.where(F.col("country_code") == request.country_code)
    return fit.select("document_id", "document_type")


def searched_model(models: DataFrame) -> tuple[str, str] | None:
    """Name and version of the active model, which must be registered."""
    found = active_model(models)
    if found and found[0] not in MODELS:
        raise UnknownModel(f"the active model {found[0]!r} is not registered")
    return found


def answer(best: DataFrame, name: str) -> DataFrame:
    return best.select("document_id", "chunk_index", "document_type", F.col("page_number").alias("page"), "score", "text", "x0", "y0", "x1", "y1", F.lit(name).alias("embedding_model"))


def search(request: Request, documents: DataFrame, chunks: DataFrame, embeddings: DataFrame, models: DataFrame) -> DataFrame:
    """Best chunks of embedded documents for the active model; no active model, no rows.

    Filters hold before the top k is taken, and reach the scan of ``embeddings`` as partition
    filters where it is partitioned by model.  Every vector is scored; ``plans.index`` has a search
    over cells.
    """
    found = searched_model(models)
    name, version = found or ("", "")
    current = F.col("chunking_version") == CHUNKING_VERSION
    vectors = embeddings.where((F.col("model_name") == name) & (F.col("model_version") == version) & current)
    query = encode([request.query], MODELS[name])[0] if found else [0.0]
    best = search_vectors(query, request.top_k, fitting(request, documents), chunks.where(current), vectors if found else vectors.limit(0))
    return answer(best, name)
