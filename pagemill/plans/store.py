"""Tables of the engine on Parquet.

Rows are appended under the run that wrote them and count once the run is committed, that is once
its row in ``runs`` has a place in the order of commits; a run that broke off leaves its start and
nothing else that is read.  There is no update in place: of keyed tables the latest row of a key
wins, and ``voids`` names rows of earlier runs that a later one replaced; one without a document
stands for all.  Commits take turns, so
that of two runs which took in the same document at once the second sees the first and withdraws.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.normalise import NORMALISER_VERSION
from ..version import code_version

RUN_TYPES = ("ingest", "reembed", "renormalise", "compact", "index")
SCHEMAS = {
    "documents": "document_id string, content_hash string, upload_filename string, size_bytes long, country_code string, status string, error_code string, error_message string, document_type string, source_sha256 string, source_filename string, source_mime_type string, ocr_engine string, ocr_engine_version string, ocr_processed_at string, raw_uri string, normalised_uri string, ingested_at timestamp",
    "raw": "document_id string, content binary",
    "pages": "document_id string, page_number int, width double, height double, size_unit string, size_reason string, mean_confidence double, line_count int, clamped_count int, lines array<struct<line_index:int,text:string,x0:double,y0:double,x1:double,y1:double,confidence:double,confidence_source:string,bbox_clamped:boolean>>",
    "fields": "document_id string, field_name string, value_type string, raw_value string, page_number int, line_indexes array<int>, validation_status string, normalised_value string, validation_message string",
    "checks": "document_id string, page_number int, check_name string, passed boolean, severity string, details string",
    "chunks": "document_id string, chunking_version string, chunk_index int, page_number int, text string, char_count int, line_indexes array<int>, x0 double, y0 double, x1 double, y1 double",
    "embeddings": "document_id string, chunking_version string, chunk_index int, embedding array<float>, dimension int, model_name string, model_version string, centres string, place int, cell int",
    "cells": "model_name string, model_version string, centres string, place int, cell int, centre array<float>, probes int",
    "models": "model_name string, model_version string, dimension int, is_active boolean",
    "stages": "document_id string, stage string, status string, error string, finished_at timestamp, duration_ms long",
    "runs": "run_id string, run_type string, status string, processed long, duplicate long, failed long, normaliser_version string, code_version string, embedding_model string, embedding_model_version string, started_at timestamp, finished_at timestamp, seq long",
    "voids": "document_id string, table_name string, patterns array<string>, lo long, hi long",
}
#: What hangs on a document and goes with it.
DEPENDENT = ("documents", "raw", "pages", "fields", "checks", "chunks", "embeddings", "stages")
#: Folders within a run's rows.
PARTITIONS = {"embeddings": ["model_name", "model_version", "centres", "place"], "cells": ["model_name", "model_version"]}
#: ``centres`` of vectors that lie in no cell.
UNPLACED = "none"
#: Ids up to which a lookup names each of them, so that row groups without them are not read.
FEW_IDS = 1000
#: Rows up to which a table of runs, voids or ids is broadcast.
SMALL = 1 << 20
#: Rows of later runs replace those of earlier ones with the same key.
KEYS = {"documents": ["document_id"], "models": ["model_name"], "stages": ["document_id", "stage"], "runs": ["run_id"], "cells": ["model_name", "model_version"]}


def latest(df: DataFrame, key: list[str], *order) -> DataFrame:
    """The last row of each key; WindowGroupLimit keeps one row a key and task before the shuffle."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def latest_durations(stages: DataFrame) -> DataFrame:
    """Duration of the latest succeeded run of each stage of a document; no end time counts as latest."""
    done = stages.where("status = 'succeeded'")
    return latest(done, ["document_id", "stage"], F.col("finished_at").desc_nulls_first(), F.col("duration_ms").desc()).select("document_id", "stage", "duration_ms")


def insert_if_absent(new: DataFrame, existing: DataFrame, key: str, *order) -> DataFrame:
    """Rows of ``new`` whose key is neither in ``existing`` nor in an earlier row of ``new``."""
    return latest(new, [key], *order).join(existing.select(key), key, "left_anti")


def run_status(processed, duplicate, failed):
    """succeeded if nothing failed, failed if everything did, else partial."""
    return F.when(F.coalesce(failed, F.lit(0)) == 0, "succeeded").when(failed == failed + processed + duplicate, "failed").otherwise("partial")


def outcome(error_code, duplicate):
    """An error counts before being a duplicate."""
    return F.when(error_code.isNotNull(), "failed").when(duplicate, "duplicate").otherwise("processed")


def sent(df: DataFrame) -> DataFrame:
    """Broadcast if small, otherwise joined as the optimiser sees fit."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    named = [r[0] for r in ids.limit(FEW_IDS + 1).collect()]
    return rows.where(F.col("document_id").isin(named)) if len(named) <= FEW_IDS else rows.join(sent(ids), "document_id", "left_semi")


def unvoided(rows: DataFrame, voids: DataFrame, name: Column | None = None) -> DataFrame:
    """Rows (document_id, seq) without those of a void (document_id, patterns, lo, hi): its document's of seq lo to hi.

    A void with patterns takes only rows whose ``name`` is like one of them.
    """
    v = voids.select(F.col("document_id").alias("_d"), F.col("patterns").alias("_p"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    gone = (F.col("document_id") == F.col("_d")) & F.col("seq").between(F.col("_lo"), F.col("_hi"))
    if name is not None:
        gone &= F.col("_p").isNull() | F.exists("_p", lambda p: F.like(name, p))
    return rows.join(v, gone, "left_anti")


class LostTurn(RuntimeError):
    """The turn was taken away, since its holder kept it too long; nothing was committed."""


class Place(int):
    """The place of a commit, and the word that its holder left in the turn's file."""

    token: str


@dataclass
class Scratch:
    """Writes tables of a run's own and reads them back."""

    store: Store
    run_id: str
    paths: list[str] = field(default_factory=list)

    def __call__(self, df: DataFrame) -> DataFrame:
        self.paths.append(self.store._path(f"work-{self.run_id}/{len(self.paths)}"))
        df.write.parquet(self.paths[-1])
        return df.sparkSession.read.schema(df.schema).parquet(self.paths[-1])

    def clear(self) -> None:
        """All but the last one are deleted."""
        for path in self.paths[:-1]:
            self.store._delete(path)


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _file(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _exists(self, table: str) -> bool:
        fs, path = self._file(self._path(table))
        return fs.exists(path)

    def _delete(self, path: str) -> None:
        fs, at = self._file(path)
        fs.delete(at, True)

    @staticmethod
    def new_name() -> str:
        return uuid.uuid4().hex

    def scratch(self, run_id: str) -> Scratch:
        return Scratch(self, run_id)

    def sweep(self, older_than_s: float = 7 * 86400) -> int:
        """Deletes what runs that broke off have left in their own folders; returns how many folders."""
        fs, root = self._file(self.root)
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(root, "work-*")) or []
        old = [f.getPath() for f in found if time.time() - f.getModificationTime() / 1000 >= older_than_s]
        for path in old:
            fs.delete(path, True)
        return len(old)

    @contextmanager
    def turn(self, stale_s: float = 3600.0) -> Iterator[Place]:
        """The place of the next commit; others wait until it is left.

        Rests on a file that only one can create (HDFS, a local disk) and that names its holder.  One
        left behind for ``stale_s`` seconds is taken away; its holder, should it still run, cannot
        commit any more and does not take away the turn of another.
        """
        fs, lock = self._file(self._path("_lock"))
        token = uuid.uuid4().hex
        while True:
            try:
                if fs.getScheme() == "file":  # whose create looks first and makes the file afterwards
                    local = lock.toUri().getPath()
                    os.makedirs(os.path.dirname(local), exist_ok=True)
                    at = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
                    os.write(at, token.encode())
                    os.close(at)
                else:
                    out = fs.create(lock, False)
                    out.write(token.encode())
                    out.close()
                break
            except (FileExistsError, Py4JJavaError) as e:
                if isinstance(e, Py4JJavaError) and "AlreadyExists" not in str(e.java_exception):
                    raise
                if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > stale_s:
                    fs.delete(lock, False)
                time.sleep(0.2)
        try:
            place = Place(1 + (self._last() or 0))
            place.token = token
            yield place
        finally:
            if self._holder() == token:
                fs.delete(lock, False)

    def _holder(self) -> str | None:
        """The word in the turn's file."""
        fs, lock = self._file(self._path("_lock"))
        if not fs.exists(lock):
            return None
        stream = fs.open(lock)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _last(self) -> int | None:
        return self._committed().agg(F.max("seq")).first()[0]

    def append(self, table: str, rows: DataFrame, run_id: str) -> None:
        if table not in SCHEMAS:
            raise KeyError(table)
        names = [f.split()[0] for f in SCHEMAS[table].split(", ")]
        if unknown := set(rows.columns) - set(names):
            raise ValueError(f"{table} has no columns {sorted(unknown)}")
        # into the run's own folder, since writers of one folder clear each other's unfinished files
        rows = rows.select(*names)
        if table in DEPENDENT and table not in PARTITIONS:  # row groups hold ranges of ids
            rows = rows.sortWithinPartitions("document_id")
        rows.write.mode("append").partitionBy(*PARTITIONS.get(table, [])).parquet(self._path(f"{table}/_run={run_id}"))

    def _rows(self, table: str) -> DataFrame:
        if not self._exists(table):
            return self.spark.createDataFrame([], f"{SCHEMAS[table]}, _run string")
        return self.spark.read.schema(f"{SCHEMAS[table]}, _run string").parquet(self._path(table))

    def _committed(self) -> DataFrame:
        return self._rows("runs").where("seq is not null").select(F.col("run_id").alias("_run"), "seq")

    def read(self, table: str, ids: DataFrame | None = None) -> DataFrame:
        """Rows of committed runs that nothing replaced, of keyed tables the latest a key.

        With ``ids`` (document_id) only those of these documents, which are picked out first: few of
        them as a filter that the scan takes, many as a join.
        """
        columns = [f.split()[0] for f in SCHEMAS[table].split(", ")]
        rows = self._rows(table)
        if table == "runs":
            return latest(rows, KEYS[table], F.col("seq").desc_nulls_last()).select(*columns)
        if ids is not None:
            rows = _of(rows, ids.select("document_id").distinct())
        rows = rows.join(sent(self._committed()), "_run")
        if table in DEPENDENT and self._exists("voids"):
            voids = self._rows("voids").where(F.col("table_name") == table).join(sent(self._committed()).drop("seq"), "_run")
            floor, n = voids.agg(F.max(F.when(F.col("document_id").isNull(), F.col("hi"))), F.count("document_id")).first()
            rows = rows if floor is None else rows.where(F.col("seq") > floor)
            if n:
                rows = unvoided(rows, sent(voids), F.col("check_name") if table == "checks" else None)
        if table == "cells":  # all rows of a model's latest fit
            newest = rows.groupBy(*KEYS[table]).agg(F.max("seq").alias("seq"))
            rows = rows.join(newest, [*KEYS[table], "seq"], "left_semi")
        elif table in KEYS:
            rows = latest(rows, KEYS[table], F.col("seq").desc(), F.col("_run").desc())
        return rows.select(*columns)

    def begin(self, run_id: str, run_type: str) -> None:
        """The run's first row; it stays the only one if the run breaks off."""
        self._log(run_id, run_type, F.lit("running"), seq=None)

    def commit(self, run_id: str, run_type: str, processed: int, duplicate: int, failed: int, model: tuple[str, str] | None = None, seq: int | None = None) -> None:
        """The run's last row: from now on its rows count.  Takes a turn unless it is in one and gives its ``seq``."""
        with nullcontext(seq) if seq else self.turn() as place:
            if isinstance(place, Place) and self._holder() != place.token:
                raise LostTurn(f"{self.root}: another run has taken the turn of {run_id}")
            self._log(run_id, run_type, run_status(F.col("processed"), F.col("duplicate"), F.col("failed")), place, (processed, duplicate, failed), model)

    def _log(self, run_id: str, run_type: str, status: Column, seq: int | None, counts: tuple = (None, None, None), model: tuple[str, str] | None = None) -> None:
        if run_type not in RUN_TYPES:
            raise ValueError(f"run_type must be one of {RUN_TYPES}")
        row = self.spark.createDataFrame([(run_id, run_type, *counts, None if seq is None else int(seq))], "run_id string, run_type string, processed long, duplicate long, failed long, seq long")
        name, version = model or (None, None)
        made = {"normaliser_version": NORMALISER_VERSION, "code_version": code_version(), "embedding_model": name, "embedding_model_version": version}
        started, finished = (F.when(F.lit(seq).isNull() == first, F.current_timestamp()) for first in (True, False))
        self.append("runs", row.select("*", status.alias("status"), *(F.lit(v).cast("string").alias(k) for k, v in made.items()), started.alias("started_at"), finished.alias("finished_at")), run_id)

    def void(self, run_id: str, documents: DataFrame, tables: tuple[str, ...], lo: int, hi: int, patterns: tuple[str, ...] | None = None) -> None:
        """Rows of the documents that runs of place lo to hi wrote do not count any more."""
        named = F.array(*map(F.lit, patterns)) if patterns else F.lit(None).cast("array<string>")
        rows = documents.select("document_id").distinct().select("document_id", F.explode(F.array(*map(F.lit, tables))).alias("table_name"), named.alias("patterns"), F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi"))
        self.append("voids", rows, run_id)

    def compact(self, table: str, change: Callable[[DataFrame], DataFrame] | None = None, before: Callable[[str], None] | None = None, run_type: str = "compact") -> None:
        """Rewrites what counts of a table, with a ``change`` if any, as the rows of one run, and deletes the folders of the runs before.

        Files hold ranges of ids.  Rows are written first and committed in a short turn; if another run was committed meanwhile
        they are written anew.  ``before`` may write other rows of the run.  Readers see either; one
        that began before and is not done when the folders go has to begin anew.
        """
        if table not in DEPENDENT:
            raise KeyError(table)
        while True:
            run_id, last = uuid.uuid4().hex, self._last() or 0
            self.begin(run_id, run_type)
            old = [row["_run"] for row in self._rows(table).select("_run").distinct().join(sent(self._committed()), "_run").collect()]  # a name a run
            rows = self.read(table)
            self.append(table, change(rows) if change else rows.sortWithinPartitions("place", "cell") if table in PARTITIONS else rows.repartitionByRange("document_id"), run_id)
            if before:
                before(run_id)
            with self.turn() as seq:
                if seq == last + 1:
                    self.append("voids", self.spark.createDataFrame([(None, table, None, 0, last)], SCHEMAS["voids"]), run_id)
                    self.commit(run_id, run_type, 0, 0, 0, seq=seq)
                    break
            self._delete(self._path(f"{table}/_run={run_id}"))
        for run in old:
            self._delete(self._path(f"{table}/_run={run}"))

    def forget_model(self, name: str, version: str) -> None:
        """Deletes the vectors of one model version, which are partitions of their own."""
        fs, root = self._file(self._path("embeddings"))
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(root, f"_run=*/model_name={name}/model_version={version}")) or []
        for status in found:
            fs.delete(status.getPath(), True)
