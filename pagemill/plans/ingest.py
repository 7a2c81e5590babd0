"""Ingest, re-embedding and description of documents: the operators put together."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunk import CHUNKING_VERSION, chunk_pages, without_chunks
from ..operators.embed import CHUNK_KEY, HASHING, MODELS, Model, activate, activate_if_none, active_model, embed, missing_embeddings, upsert_model
from ..operators.normalise import NORMALISER_VERSION
from ..operators.quality import deidentified, failed_checks, quarantine
from ..sources.exports import content_hash, normalise_country, parse_exports, receive_checks, resolve_country
from .index import placed
from .stages import Ran, Rulepack, Work, first_failures, run_stages, whole_vectors
from .store import DEPENDENT, SCHEMAS, Store, insert_if_absent, latest_durations, outcome


class InvalidCountry(ValueError):
    """The form's country code is not two letters; nothing is ingested."""


def _country(store: Store, code: str | None) -> str | None:
    row = store.spark.createDataFrame([(code,)], "c string").select(normalise_country(F.col("c")).alias("n")).first()["n"]
    if row["invalid"]:
        raise InvalidCountry("country_code must be two letters")
    return row["code"]


def ingest(store: Store, files: DataFrame, country_code: str | None = None, pack: Rulepack | None = None, model: Model | None = None, run_type: str = "ingest") -> DataFrame:
    """Take in files (filename, content); returns one row a file, as ``describe`` gives it.

    Bytes that are known already, in the store or from an earlier file by name, are duplicates
    and write nothing; so are those that another run took in meanwhile, whose rows count and not
    this one's.  What is read of the store is what concerns these files.  A file that cannot be used becomes a failed document; it never fails the
    run.  Every stage of the registry is one table-wide step; its result is written and read back by the
    stages after it, which keeps plans short and lost executors harmless.
    """
    pack, run_id = pack or Rulepack(), uuid.uuid4().hex
    country = _country(store, country_code)
    keep = store.scratch(run_id)
    store.begin(run_id, run_type)

    clock = time.monotonic()
    named = files.select("filename", "content", F.when(F.length("content") > 0, content_hash(F.col("content"))).alias("content_hash"))
    ids = keep(named.where("content_hash is not null").select(F.sha2("content_hash", 256).alias("document_id")).distinct())
    known = keep(store.read("documents", ids).select("content_hash", "document_id", "error_code"))
    fresh = insert_if_absent(named.where("content_hash is not null"), known, "content_hash", F.col("filename").asc_nulls_first())
    fresh = keep(fresh.withColumn("document_id", F.sha2("content_hash", 256)))
    store.append("raw", fresh.select("document_id", "content"), run_id)
    sized = fresh.withColumn("size_bytes", F.length("content").cast("long"))
    parsed = keep(parse_exports(sized, country).withColumn("country_code", resolve_country(F.lit(country), F.col("envelope_country"))))
    received = Ran("receive", parsed.select("document_id", "error_code", "error_message"), round((time.monotonic() - clock) * 1000))
    active = active_model(store.read("models"))
    model = model or (MODELS[active[0]] if active else HASHING)
    alive = parsed.where("error_code is null").select("document_id")
    work = Work(store, parsed, pack, model, keep, fresh=True, new={"parsed": parsed, "checks": receive_checks(parsed)}, alive=alive)
    ran = [received, *run_stages(work)]

    types = work.new["types"].select("document_id", "document_type", F.lit(True).alias("loaded"))
    status = parsed.drop("error_code", "error_message").join(types, "document_id", "left").join(first_failures(ran), "document_id", "left")
    code, message = F.col("now.error_code"), F.substring("now.error_message", 1, 2000)
    digest = F.regexp_replace("content_hash", "^sha256:", "")
    documents = status.select(
        "document_id", "content_hash", F.col("filename").alias("upload_filename"), "size_bytes", "country_code", F.when(code.isNull(), "embedded").otherwise("failed").alias("status"), code.alias("error_code"), message.alias("error_message"), "document_type",
        "source_sha256", "source_filename", "source_mime_type", "ocr_engine", "ocr_engine_version", "ocr_processed_at", F.concat(F.lit("file://data/raw/"), digest, F.lit(".json")).alias("raw_uri"),
        F.when(F.coalesce("loaded", F.lit(False)), F.concat(F.lit("file://data/normalised/"), digest, F.lit(f".v{NORMALISER_VERSION}.json"))).alias("normalised_uri"), F.current_timestamp().alias("ingested_at"),
    )
    documents = keep(documents)
    for table, rows in work.new.items():
        if table in SCHEMAS:
            store.append(table, placed(store, rows, model) if table == "embeddings" else rows, run_id)
    for done in ran:
        store.append("stages", done.logged(), run_id)
    store.append("documents", documents, run_id)
    embedded_any = not work.new["chunks"].isEmpty()
    first = fresh.select("filename", F.lit(True).alias("first"))
    with store.turn() as seq:
        lost = keep(store.read("documents", fresh).select("document_id"))  # taken in by others since
        if not lost.isEmpty():
            store.void(run_id, lost, DEPENDENT, seq, seq)
        if embedded_any:  # of the models as they are now, which no other run changes before this one is committed
            store.append("models", activate_if_none(upsert_model(store.read("models"), model), model.name), run_id)
        mine = documents.select("content_hash", "document_id", "error_code").join(lost.withColumn("lost", F.lit(True)), "document_id", "left")
        every = named.select("filename", "content_hash").join(first, "filename", "left").join(known.withColumn("lost", F.lit(True)).unionByName(mine), "content_hash", "left")
        own = F.col("first").isNotNull() & F.col("lost").isNull()
        result = every.select("filename", "content_hash", "document_id", (~own & F.col("content_hash").isNotNull()).alias("duplicate"), F.when(F.col("content_hash").isNull(), "file_missing").otherwise(F.col("error_code")).alias("error_code"))
        result = keep(result.withColumn("outcome", outcome(F.col("error_code"), F.col("duplicate"))))
        n = {r["outcome"]: r["count"] for r in result.groupBy("outcome").count().collect()}
        store.commit(run_id, run_type, n.get("processed", 0), n.get("duplicate", 0), n.get("failed", 0), (model.name, model.version), seq)
    out = result.drop("error_code").join(describe(store, ids).drop("content_hash"), "document_id", "left").withColumn("error_code", F.when(F.col("content_hash").isNull(), "file_missing").otherwise(F.col("error_code")))
    out = keep(out)
    keep.clear()
    return out


def describe(store: Store, ids: DataFrame | None = None) -> DataFrame:
    """One row a document (of ``ids``): status, counts of pages and chunks, names of failed checks, stage timings."""
    documents = store.read("documents", ids).select("document_id", "content_hash", "upload_filename", "document_type", "country_code", "status", "error_code")
    count = lambda table, name: store.read(table, ids).groupBy("document_id").agg(F.count("*").alias(name))
    chunks = store.read("chunks", ids).where(F.col("chunking_version") == CHUNKING_VERSION).groupBy("document_id").agg(F.count("*").alias("chunks"))
    flags = failed_checks(store.read("checks", ids)).groupBy("document_id").agg(F.array_sort(F.collect_list("check_name")).alias("quality_flags"))
    times = latest_durations(store.read("stages", ids)).groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stage", "duration_ms")))).alias("timings_ms"))
    out = documents
    for part in (count("pages", "pages"), chunks, flags, times):
        out = out.join(part, "document_id", "left")
    return out.withColumns({"pages": F.coalesce("pages", F.lit(0)), "chunks": F.coalesce("chunks", F.lit(0)), "quality_flags": F.coalesce("quality_flags", F.array().cast("array<string>"))})


def document(store: Store, document_id: str) -> DataFrame:
    """One row: the document with its stages, checks, fields and pages, each in its order."""
    ids = store.spark.createDataFrame([(document_id,)], "document_id string")
    one = lambda table: store.read(table, ids)
    nested = lambda df, name, *order: df.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(*order, *(c for c in df.columns if c not in order and c != "document_id")))).alias(name))
    out = one("documents")
    for name, df, *order in (("stages", one("stages"), "finished_at", "stage"), ("quality_checks", one("checks"), "check_name", "page_number"), ("fields", one("fields"), "field_name"), ("page_list", one("pages").drop("lines"), "page_number")):
        out = out.join(nested(df, name, *order), "document_id", "left")
    return out


def embedded(store: Store) -> DataFrame:
    """All embedded documents in the order in which they came."""
    return store.read("documents").where("status = 'embedded'").orderBy("ingested_at", "document_id")


def quarantine_view(store: Store) -> DataFrame:
    return quarantine(store.read("documents"), store.read("checks"))


def deidentified_view(store: Store) -> DataFrame:
    return deidentified(store.read("documents"), store.read("fields"))


def reembed(store: Store, model: Model) -> bool:
    """Vectors of ``model`` for all embedded documents; the model becomes active only if none failed."""
    run_id = uuid.uuid4().hex
    store.begin(run_id, "reembed")
    keep = store.scratch(run_id)
    documents = store.read("documents").where("status = 'embedded'").select("document_id")
    chunks = store.read("chunks")
    fresh = without_chunks(documents, chunks)
    more = keep(chunk_pages(store.read("pages").join(fresh, "document_id", "left_semi")))
    current = chunks.where(F.col("chunking_version") == CHUNKING_VERSION).join(documents, "document_id", "left_semi").unionByName(more)
    missing = missing_embeddings(current, store.read("embeddings"), model.name, model.version)
    vectors = keep(embed(missing, model))
    bad = keep(vectors.where("embed_error is not null").select("document_id").distinct())
    failed = bad.count()
    store.append("chunks", more, run_id)
    done = keep(whole_vectors(vectors, bad))
    store.append("embeddings", placed(store, done, model), run_id)
    n = documents.count()
    with store.turn() as seq:
        # what other runs have written since counts, and not this run's rows
        now = store.read("embeddings", done).where((F.col("model_name") == model.name) & (F.col("model_version") == model.version))
        _withdraw(store, run_id, "embeddings", done, now, CHUNK_KEY, seq)
        _withdraw(store, run_id, "chunks", more, store.read("chunks", more), CHUNK_KEY, seq)
        models = upsert_model(store.read("models"), model)
        store.append("models", models if failed else activate(models, model.name), run_id)
        store.commit(run_id, "reembed", n - failed, 0, failed, (model.name, model.version), seq)
    keep.clear()
    return not failed


def _withdraw(store: Store, run_id: str, table: str, mine: DataFrame, now: DataFrame, key: list[str], seq: int) -> None:
    """Voids this run's rows of documents of which ``now`` has any of the same keys."""
    lost = mine.select(*key).join(now.select(*key), key, "left_semi").select("document_id").distinct()
    if not lost.isEmpty():
        store.void(run_id, lost, (table,), seq, seq)
