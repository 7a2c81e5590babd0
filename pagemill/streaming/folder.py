"""Continuous ingest of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import Rulepack, ingest
from ..plans.store import Store


def ingest_stream(store: Store, folder: str, checkpoint: str, country_code: str | None = None, pack: Rulepack | None = None, trigger: dict | None = None) -> StreamingQuery:
    """New files of ``folder`` go through ``ingest`` in batches.

    A batch that is run again after a failure finds its documents known and writes nothing twice.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = store.spark.readStream.format("binaryFile").schema(schema).load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "content")

    def each(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ingest(store, batch, country_code, pack)

    return named.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
