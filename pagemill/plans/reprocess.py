"""Stages run again on stored documents, each replacing what it wrote before."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.embed import HASHING, MODELS, Model, active_model
from .index import placed
from .ingest import describe
from .stages import ERRORS, STAGES, Ran, Rulepack, Work, first_failures, run_stages
from .store import SCHEMAS, Store


def reprocess(store: Store, ids: DataFrame, stages: tuple[str, ...] | None = None, pack: Rulepack | None = None, model: Model | None = None) -> DataFrame:
    """Runs stages again on the documents ``ids`` (document_id); returns what ``describe`` says of them.

    Each stage replaces its own rows and leaves those of others; readers see the old rows until the
    run is committed, and then the new ones.  Documents that are not in the store are left out.
    """
    stages = tuple(STAGES) if stages is None else stages
    if unknown := set(stages) - set(STAGES):
        raise ValueError(f"no stages {sorted(unknown)}")
    run_id = uuid.uuid4().hex
    store.begin(run_id, "renormalise")
    keep = store.scratch(run_id)
    active = active_model(store.read("models"))
    documents = keep(store.read("documents", ids))
    work = Work(store, documents, pack or Rulepack(), model or (MODELS[active[0]] if active else HASHING), keep)
    work.alive = documents.select("document_id").join(work.rows("pages"), "document_id", "left_semi")
    ran = run_stages(work, stages)
    done = _outcome(work, stages, ran)
    for table, rows in work.new.items():
        if table in SCHEMAS:
            store.append(table, placed(store, rows, work.model) if table == "embeddings" else rows, run_id)
    for one in ran:
        store.append("stages", one.logged(), run_id)
    store.append("documents", done, run_id)
    bad, n = done.where("status = 'failed'").count(), done.count()
    with store.turn() as seq:
        for table, owned in dict.fromkeys(work.replaced):
            store.void(run_id, documents, (table,), 0, seq - 1, owned)
        store.commit(run_id, "renormalise", n - bad, 0, bad, (work.model.name, work.model.version), seq)
    out = keep(describe(store, documents))
    keep.clear()
    return out


def _outcome(work: Work, stages: tuple[str, ...], ran: list[Ran]) -> DataFrame:
    """The documents' rows after the stages: the first failure counts, earlier ones of these stages are forgotten."""
    out = work.documents
    if "types" in work.new:
        out = out.drop("document_type").join(work.new["types"].select("document_id", "document_type"), "document_id", "left")
    cleared = F.col("error_code").isNull() | F.col("error_code").isin(*(ERRORS[s] for s in stages if s in ERRORS))
    first = first_failures(ran)
    out = out.withColumn("now", F.lit(None).cast("struct<error_code:string,error_message:string>")) if first is None else out.join(first, "document_id", "left")
    names = [f.split()[0] for f in SCHEMAS["documents"].split(", ")]
    status = F.when(F.col("now").isNotNull() | ~cleared, "failed").when(F.lit("embed" in stages) | (F.col("status") == "embedded"), "embedded").otherwise("extracted")
    code, message = (F.coalesce(f"now.{c}", F.when(~cleared, F.col(c))) for c in ("error_code", "error_message"))
    return work.keep(out.withColumns({"status": status, "error_code": code, "error_message": F.substring(message, 1, 2000)}).select(*names))
