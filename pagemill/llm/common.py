"""Shared folder, materialised tables and Arrow helpers of the training-data operators."""

from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_dir

__all__ = ["discard", "materialise", "numbered", "read_table", "shared_dir", "text_or_empty", "unused", "utf8_buffer", "without"]


def materialise(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _WRITTEN[out] = path
    return out


_WRITTEN: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialise`` wrote for these tables; nothing may read them any more."""
    for df in tables:
        if path := _WRITTEN.pop(df, None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, longer by underscores where the table has such columns already."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """The table without columns of these names, which its operator is about to add."""
    gone = {n.lower() for n in names}
    return df.select(*(f"`{c}`" for c in df.columns if c.lower() not in gone))


def numbered(df: DataFrame) -> DataFrame:
    """Columns named by their place: what maps over Arrow batches takes no names with dots."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and the n + 1 offsets of its rows; null counts as empty."""
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
