"""The stages of a document: one registry, run by ingest over new documents and by reruns over stored ones.

A stage takes the work, writes its tables to it, and says which documents it reached and which of
them failed, with code and message; a failed document goes no further, and the others are not
touched by it.  New stages are registered functions.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunk import chunk_pages, without_chunks
from ..operators.classify import KEYWORDS, NO_TYPE, classify_documents
from ..operators.embed import CHUNK_KEY, Model, embed, missing_embeddings
from ..operators.extract import RULES, extract_fields
from ..operators.normalise import ENGINES, normalise
from ..operators.quality import OWNED, PAGE_CONFIDENCE, field_checks, page_checks, type_checks
from ..sources.exports import parse_exports
from .store import SCHEMAS, Scratch, Store


@dataclass(frozen=True)
class Rulepack:
    keywords: dict = None  # type: ignore[assignment]
    rules: dict = None  # type: ignore[assignment]
    engines: dict = None  # type: ignore[assignment]
    threshold: float = PAGE_CONFIDENCE

    def __post_init__(self):
        for name, default in (("keywords", KEYWORDS), ("rules", RULES), ("engines", ENGINES)):
            if getattr(self, name) is None:
                object.__setattr__(self, name, default)


@dataclass
class Work:
    """The documents of one run, what its stages have written so far and what that replaces."""

    store: Store
    documents: DataFrame
    pack: Rulepack
    model: Model
    keep: Scratch
    #: Nothing is stored of these documents yet.
    fresh: bool = False
    new: dict[str, DataFrame] = field(default_factory=dict)
    replaced: list[tuple[str, tuple[str, ...] | None]] = field(default_factory=list)
    #: Documents (document_id) that no stage has failed so far.
    alive: DataFrame | None = None

    def rows(self, table: str) -> DataFrame:
        """What the table holds of these documents, as the stages so far leave it."""
        mine = self.new.get(table)
        if self.fresh or (table, None) in self.replaced:
            return self.store.spark.createDataFrame([], SCHEMAS[table]) if mine is None else mine
        stored = self.store.read(table, self.documents)
        return stored if mine is None else stored.unionByName(mine, allowMissingColumns=True)

    def write(self, table: str, rows: DataFrame, owned: tuple[str, ...] | None = None, replace: bool = True) -> None:
        """``rows`` instead of the table's rows of these documents, or of those whose name is like one of ``owned``."""
        rows = self.keep(rows)
        self.new[table] = self.new[table].unionByName(rows) if table in self.new else rows
        if replace:
            self.replaced.append((table, owned))

    def typed(self) -> DataFrame:
        types = self.new.get("types", self.documents)
        return types.where("document_type is not null").select("document_id")


@dataclass(frozen=True)
class Reached:
    """document_id of all that a stage worked on; document_id and error_message of those that failed."""

    documents: DataFrame
    failed: DataFrame | None = None


Stage = Callable[[Work], Reached]
STAGES: dict[str, Stage] = {}
#: The error that each stage gives a document, and takes from it when it runs again.
ERRORS = {"normalise": "unsupported_ocr_format", "extract": "unsupported_document_type", "embed": "internal_server_error"}


def stage(name: str) -> Callable[[Stage], Stage]:
    """Registers a stage; stages run in the order in which they are registered."""

    def add(f: Stage) -> Stage:
        STAGES[name] = f
        return f

    return add


@dataclass(frozen=True)
class Ran:
    """What a stage did: document_id, error_code and error_message (null: succeeded), and how long it took."""

    name: str
    rows: DataFrame
    ms: int

    def logged(self) -> DataFrame:
        """Rows for ``stages``; the duration is that of the stage for the whole batch."""
        status = F.when(F.col("error_message").isNull(), "succeeded").otherwise("failed")
        return self.rows.select("document_id", F.lit(self.name).alias("stage"), status.alias("status"), F.col("error_message").alias("error"), F.current_timestamp().alias("finished_at"), F.lit(self.ms).cast("long").alias("duration_ms"))


def run_stages(work: Work, names: tuple[str, ...] | None = None) -> list[Ran]:
    """The registered stages, or those of ``names``, one after the other; each goes on with the documents that are left."""
    done = []
    for name, run in STAGES.items():
        if names is not None and name not in names:
            continue
        clock = time.monotonic()
        got = run(work)
        documents = got.documents.select("document_id")
        failed = documents.withColumn("error_message", F.lit(None).cast("string")) if got.failed is None else documents.join(got.failed.select("document_id", "error_message"), "document_id", "left")
        rows = work.keep(failed.withColumn("error_code", F.when(F.col("error_message").isNotNull(), ERRORS.get(name, "internal_server_error"))))
        work.alive = rows.where("error_message is null").select("document_id")
        done.append(Ran(name, rows, round((time.monotonic() - clock) * 1000)))
    return done


def first_failures(done: list[Ran]) -> DataFrame | None:
    """document_id and ``now``, the first error (error_code, error_message) of each document that failed."""
    out = None
    for at, ran in enumerate(done):
        bad = ran.rows.where("error_code is not null").withColumn("at", F.lit(at))
        out = bad if out is None else out.unionByName(bad)
    return None if out is None else out.groupBy("document_id").agg(F.min_by(F.struct("error_code", "error_message"), "at").alias("now"))


@stage("normalise")
def _normalise(work: Work) -> Reached:
    """Pages from the files; chunks and vectors of older pages go with these."""
    parsed = work.new.get("parsed")
    parsed = work.keep(parse_exports(work.rows("raw").select("document_id", "content"))) if parsed is None else parsed
    good = parsed.where("error_code is null").select("document_id", "ocr_engine", "raw_output")
    seen = {r[0] for r in good.select("ocr_engine").distinct().collect()}  # a few names
    engines = {k: f for k, f in work.pack.engines.items() if k in seen} or dict([next(iter(work.pack.engines.items()))])
    pages, broken = normalise(good, engines, work.keep)
    work.write("pages", pages)
    work.replaced += [(table, None) for table in ("chunks", "embeddings")]
    return Reached(good, broken.withColumnRenamed("error", "error_message"))


@stage("load")
def _load(work: Work) -> Reached:
    """Documents whose pages stand in the tables."""
    return Reached(work.alive)


@stage("extract")
def _extract(work: Work) -> Reached:
    """Type and fields."""
    pages = work.rows("pages")
    types = work.keep(work.alive.join(classify_documents(pages, work.pack.keywords), "document_id", "left"))
    work.write("types", types, replace=False)
    work.write("fields", extract_fields(pages, types.where("document_type is not null"), work.pack.rules))
    work.write("checks", type_checks(types), OWNED["extract"])
    return Reached(types, types.where("document_type is null").withColumn("error_message", F.lit(NO_TYPE)))


@stage("quality")
def _quality(work: Work) -> Reached:
    typed = work.typed()
    pages = work.rows("pages").join(typed, "document_id", "left_semi")
    work.write("checks", page_checks(pages, work.pack.threshold).unionByName(field_checks(work.rows("fields"))), OWNED["quality"])
    return Reached(typed)


@stage("chunk")
def _chunk(work: Work) -> Reached:
    """Documents that have chunks of this version keep them."""
    typed = work.typed()
    fresh = typed if work.fresh else without_chunks(typed, work.rows("chunks"))
    work.write("chunks", chunk_pages(work.rows("pages").join(fresh, "document_id", "left_semi")), replace=False)
    return Reached(typed)


@stage("embed")
def _embed(work: Work) -> Reached:
    """Vectors that are missing of the model; a document has all of its vectors or fails."""
    chunks = work.rows("chunks")
    missing = chunks if work.fresh else missing_embeddings(chunks, work.rows("embeddings"), work.model.name, work.model.version)
    vectors = work.keep(embed(missing, work.model))
    failed = work.keep(vectors.where("embed_error is not null").groupBy("document_id").agg(F.first("embed_error").alias("error_message")))
    work.write("embeddings", whole_vectors(vectors, failed), replace=False)
    return Reached(work.typed(), failed)


def whole_vectors(vectors: DataFrame, failed: DataFrame) -> DataFrame:
    """Rows for ``embeddings`` of documents all of whose texts the model took."""
    good = vectors.join(failed.select("document_id"), "document_id", "left_anti")
    return good.select(*CHUNK_KEY, "embedding", "dimension", "model_name", "model_version")
