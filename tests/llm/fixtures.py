"""Awkward tables that every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """rows: (doc_id, text)."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


LONG = "lorem ipsum dolor sit amet " * 8000
AWKWARD = [(1, None), (2, ""), (3, "one"), (4, LONG), (5, "same text here for all of us"), (6, "same text here for all of us"), (6, "same text here for all of us"), (None, "an id is missing here"), (7, "émoji 😀 naïve\r\nline two\n\nline three"), (8, " \t\n ")]
