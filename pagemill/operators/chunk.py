"""Line-based chunks with an overlap of one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNKING_VERSION = "1.0"
MAX_CHARS = 400


def fold_lines(lines: Column, max_chars: int = MAX_CHARS) -> Column:
    """array<struct<first, last>>: positions (from 0) of the lines of each chunk.

    Lines gather while their text, joined by line feeds, has at most ``max_chars`` characters.
    The next chunk begins with the last line of the one before if it and the new line fit
    together, else with the new line.  A line longer than that is a chunk of its own.
    """

    def step(acc: Column, i: Column) -> Column:
        size, before = F.char_length(lines[i]["text"]), F.char_length(lines[i - 1]["text"])
        fits = acc["chars"] + 1 + size <= max_chars
        overlap = before + 1 + size <= max_chars
        done = F.array_append(acc["out"], F.struct(acc["first"].alias("first"), (i - 1).alias("last")))
        fresh = F.struct(F.when(overlap, i - 1).otherwise(i).alias("first"), F.when(overlap, before + 1 + size).otherwise(size).alias("chars"), done.alias("out"))
        more = F.struct(acc["first"].alias("first"), (acc["chars"] + 1 + size).alias("chars"), acc["out"].alias("out"))
        return F.when(fits, more).otherwise(fresh)

    zero = F.struct(F.lit(0).alias("first"), F.char_length(lines[0]["text"]).alias("chars"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))
    rest = F.filter(F.sequence(F.lit(0), F.size(lines)), lambda i: (i > 0) & (i < F.size(lines)))
    folded = F.aggregate(rest, zero, step, lambda acc: F.array_append(acc["out"], F.struct(acc["first"].alias("first"), (F.size(lines) - 1).alias("last"))))
    return F.when(F.size(lines) > 0, folded).otherwise(F.array().cast("array<struct<first:int,last:int>>"))


def union_box(lines: Column) -> Column:
    """struct<x0, y0, x1, y1> around all lines."""
    edge = lambda name: F.transform(lines, lambda x: x[name])
    return F.struct(F.array_min(edge("x0")).alias("x0"), F.array_min(edge("y0")).alias("y0"), F.array_max(edge("x1")).alias("x1"), F.array_max(edge("y1")).alias("y1"))


def chunk_pages(pages: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunks of pages (document_id, page_number, lines of line_index, text, x0, y0, x1, y1, in order).

    Chunks do not cross pages; chunk_index counts them across the document.
    """
    # cut before they become rows, so that no chunk carries its whole page
    parts = F.transform(fold_lines(F.col("lines"), max_chars), lambda c: F.slice("lines", c["first"] + 1, c["last"] - c["first"] + 1))
    cut = pages.select("document_id", "page_number", F.posexplode(parts).alias("pos", "part"))
    order = Window.partitionBy("document_id").orderBy("page_number", "pos")
    text = F.array_join(F.transform("part", lambda x: x["text"]), "\n")
    cut = cut.select("document_id", (F.row_number().over(order) - 1).alias("chunk_index"), "page_number", text.alias("text"), F.transform("part", lambda x: x["line_index"]).alias("line_indexes"), union_box(F.col("part")).alias("box"))
    return cut.select("document_id", F.lit(CHUNKING_VERSION).alias("chunking_version"), "chunk_index", "page_number", "text", F.char_length("text").alias("char_count"), "line_indexes", "box.*")


def without_chunks(documents: DataFrame, chunks: DataFrame, version: str = CHUNKING_VERSION) -> DataFrame:
    """Documents that have no chunks of this version yet."""
    return documents.join(chunks.where(F.col("chunking_version") == version).select("document_id"), "document_id", "left_anti")
