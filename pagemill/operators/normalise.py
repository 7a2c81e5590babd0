"""Engine outputs to pages and lines in page fractions.

Every engine gives the same two tables; what does not fit the schema fails its document, as a row
of ``errors``, and leaves nothing else behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, strip
from ..sources.exports import AZURE, TESSERACT, TEXTRACT, finite_number, plain_text

NORMALISER_VERSION = "1.1.0"
# fixed values
NO_SIZE = "aws-textract reports only ratio coordinates, no absolute page size"
AZURE_UNITS = {"inch": "inch", "pixel": "px"}
# fixed values: what is said of outputs that do not fit
MESSAGES = {
    "textract page": "aws-textract block Page must be an int >= 1",
    "textract twice": "aws-textract PAGE blocks have duplicate page numbers",
    "textract orphan": "aws-textract LINE block has no Page and is not a CHILD of any PAGE block",
    "textract line": "aws-textract raw_output is malformed: text, box or confidence",
    "tesseract lengths": "tesseract raw_output arrays differ in length",
    "tesseract word": "tesseract raw_output is malformed: box or conf of a word",
    "tesseract page": "tesseract words on a page without a level-1 page row",
    "tesseract size": "tesseract page width and height must be finite numbers",
    "azure unit": "azure page unit is not one of ['inch', 'pixel']",
    "azure page": "azure raw_output is malformed: page number or size",
    "azure twice": "azure page numbers are not unique",
    "azure line": "azure raw_output is malformed: text, polygon or span of a line",
    "azure word": "azure raw_output is malformed: offset or confidence of a word",
    "box": "bbox must satisfy x0<=x1 and y0<=y1",
    "confidence": "confidence must be in [0, 1]",
    "size": "page number and size must be positive",
}


@dataclass(frozen=True)
class Parts:
    """pages: document_id, page_number, width, height, size_unit, size_reason; lines: document_id,
    page_number, line_index, text, x0, y0, x1, y1, confidence, confidence_source; errors: document_id, error."""

    pages: DataFrame
    lines: DataFrame
    errors: DataFrame


def _errors(df: DataFrame, cases: dict[str, Column]) -> DataFrame:
    """The least message a row of the ``cases`` that hold; a condition that is null holds too."""
    said = [F.when(F.coalesce(bad, F.lit(True)), MESSAGES[name]) for name, bad in cases.items()]
    return df.select("document_id", F.array_min(F.array(*said)).alias("error")).where("error is not null")


Keep = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _list(df: DataFrame, schema: str, path: str) -> DataFrame:
    # a filter, as Spark infers it of an inner explode, would parse the JSON once more
    return df.withColumn("j", F.from_json("raw_output", schema)).select("document_id", F.posexplode_outer(path).alias("pos", "b")).where("pos is not null")


def from_textract(docs: DataFrame, keep: Keep = _as_is) -> Parts:
    """LINE blocks in engine order, on the page they name or on that whose CHILD they are."""
    block = "BlockType:string,Id:string,Page:variant,Text:variant,Confidence:variant,Geometry:struct<BoundingBox:struct<Left:variant,Top:variant,Width:variant,Height:variant>>,Relationships:array<struct<Type:string,Ids:array<string>>>"
    blocks = _list(docs, f"Blocks array<struct<{block}>>", "j.Blocks").select("document_id", "pos", "b.*").where("BlockType in ('PAGE', 'LINE')")
    whole = F.schema_of_variant("Page") == "BIGINT"
    blocks = blocks.withColumn("own", F.when(whole, F.try_variant_get("Page", "$", "int"))).withColumn("odd", F.col("Page").isNotNull() & ~(F.coalesce(whole & (F.col("own") >= 1), F.lit(False))))
    box = lambda k: finite_number(F.col(f"Geometry.BoundingBox.{k}"))
    blocks = keep(blocks.select("document_id", "pos", "BlockType", "Id", "own", "odd", "Relationships", plain_text(F.col("Text")).alias("text"), *(box(k).alias(k[0].lower()) for k in ("Left", "Top", "Width", "Height")), (finite_number(F.col("Confidence")) / 100).alias("confidence")))
    page_order = Window.partitionBy("document_id").orderBy("pos")
    heads = blocks.where("BlockType = 'PAGE'").withColumn("page_number", F.coalesce("own", F.row_number().over(page_order)))
    children = heads.select("document_id", "page_number", "pos", F.explode("Relationships").alias("r")).where("r.Type = 'CHILD'").select("document_id", "page_number", "pos", F.explode("r.Ids").alias("Id"))
    parent = children.groupBy("document_id", "Id").agg(F.max_by("page_number", "pos").alias("parent"))
    lines = blocks.where("BlockType = 'LINE'").join(parent, ["document_id", "Id"], "left").select("document_id", "pos", F.coalesce("own", "parent").alias("page_number"), "text", "l", "t", "w", "h", "confidence")
    order = Window.partitionBy("document_id", "page_number").orderBy("pos")
    shaped = lines.select("document_id", "page_number", (F.row_number().over(order) - 1).alias("line_index"), "text", F.col("l").alias("x0"), F.col("t").alias("y0"), (F.col("l") + F.col("w")).alias("x1"), (F.col("t") + F.col("h")).alias("y1"), "confidence", F.lit("engine_line").alias("confidence_source"))
    numbers = heads.select("document_id", "page_number").unionByName(lines.select("document_id", "page_number")).distinct()
    none = lambda t: F.lit(None).cast(t)
    pages = numbers.select("document_id", "page_number", none("double").alias("width"), none("double").alias("height"), none("string").alias("size_unit"), F.lit(NO_SIZE).alias("size_reason"))
    twice = heads.groupBy("document_id", "page_number").agg(F.count("*").alias("n"))
    errors = [
        _errors(blocks, {"textract page": F.col("odd")}),
        _errors(twice, {"textract twice": F.col("n") > 1}),
        _errors(lines, {"textract orphan": F.col("page_number").isNull(), "textract line": F.col("text").isNull() | (F.col("l") + F.col("t") + F.col("w") + F.col("h") + F.col("confidence")).isNull()}),
    ]
    return Parts(pages, shaped, reduce(DataFrame.unionByName, errors))


def from_tesseract(docs: DataFrame, keep: Keep = _as_is) -> Parts:
    """Parallel arrays turned to rows; words of one (page, block, paragraph, line) are a line.

    A document whose arrays differ in length is one row without a position, so that JSON is parsed once.
    """
    keys = ("page_num", "block_num", "par_num", "line_num")
    columns = ("level", "text", "conf", "left", "top", "width", "height", *keys)
    parsed = docs.withColumn("j", F.from_json("raw_output", ", ".join(f"`{c}` array<variant>" for c in columns))).select("document_id", *(F.col(f"j.{c}").alias(c) for c in columns))
    uneven = reduce(lambda a, b: a | b, (F.coalesce(F.size(c) != F.size("level"), F.lit(True)) for c in keys))
    # what is told of a document's arrays is told before they become rows, which else carry them
    zipped = parsed.select("document_id", uneven.alias("uneven"), F.when(~uneven, F.arrays_zip(*columns)).alias("zipped"))
    rows = zipped.select("document_id", "uneven", F.posexplode_outer("zipped").alias("pos", "r")).where("pos is not null or uneven").select("document_id", "uneven", "pos", "r.*")
    number = lambda c: finite_number(F.col(c))
    conf = F.coalesce(number("conf"), F.when(plain_text(F.col("conf")).rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), F.trim(plain_text(F.col("conf"))).try_cast("double")))
    rows = keep(rows.select("document_id", "uneven", "pos", number("level").alias("level"), plain_text(F.col("text")).alias("text"), conf.alias("conf"), *(number(c).alias(c) for c in ("left", "top", "width", "height")), *(number(c).cast("long").alias(c) for c in keys)).where("level in (1, 5) or uneven"))
    sizes = rows.where("level = 1").groupBy("document_id", "page_num").agg(F.max_by(F.struct("width", "height"), "pos").alias("s")).select("document_id", F.col("page_num").cast("int").alias("page_number"), "s.width", "s.height", F.lit(True).alias("sized"))
    words = rows.where(F.col("level") == 5).withColumn("text", strip(F.col("text"))).where("text <> ''")
    grouped = words.groupBy("document_id", *keys).agg(
        F.min("pos").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda w: w["text"]), " ").alias("text"),
        F.min("left").alias("x0"), F.min("top").alias("y0"), F.max(F.col("left") + F.col("width")).alias("x1"), F.max(F.col("top") + F.col("height")).alias("y1"), F.avg(F.when(F.col("conf") >= 0, F.col("conf") / 100)).alias("confidence"),
    )
    order = Window.partitionBy("document_id", "page_number").orderBy("first")
    placed = grouped.withColumn("page_number", F.col("page_num").cast("int")).join(sizes, ["document_id", "page_number"], "left")
    lines = placed.select("document_id", "page_number", (F.row_number().over(order) - 1).alias("line_index"), "text", *((F.col(c) / F.nullif(F.col(s), F.lit(0.0))).alias(c) for c, s in (("x0", "width"), ("y0", "height"), ("x1", "width"), ("y1", "height"))), "confidence", F.lit("mean_of_words").alias("confidence_source"))
    errors = [
        _errors(rows, {"tesseract lengths": F.col("uneven")}),
        _errors(words, {"tesseract word": (F.col("left") + F.col("top") + F.col("width") + F.col("height") + F.col("conf")).isNull()}),
        _errors(placed, {"tesseract page": F.col("sized").isNull()}),
        _errors(sizes, {"tesseract size": (F.col("width") + F.col("height")).isNull()}),
    ]
    return Parts(sizes.drop("sized").select("*", F.lit("px").alias("size_unit"), F.lit(None).cast("string").alias("size_reason")), lines, reduce(DataFrame.unionByName, errors))


#: Halving steps of a search among up to 2 ** 24 words of a page.
_HALVES = tuple(1 << b for b in range(24, -1, -1))


def _before(words: Column, offset: Column) -> Column:
    """How many of the words, sorted by ``at``, begin before the offset."""
    step = lambda n, s: F.when((n + s <= F.size(words)) & (F.get(words, n + s - 1)["at"] < offset), n + s).otherwise(n)
    return F.aggregate(F.array(*map(F.lit, _HALVES)), F.lit(0), step)


def _read_line(line: Column, words: Column) -> Column:
    """text, polygon, extent of the first span, and mean and completeness of the confidences of the words in it."""
    span = F.get(line["spans"], F.lit(0))

    def measured(at: Column) -> Column:
        return let(F.struct(at.alias("at"), _before(words, at["begin"]).alias("lo"), _before(words, at["begin"] + at["size"]).alias("hi")), judged)

    def judged(found: Column) -> Column:
        # added up in the order of the page's list
        inside = F.array_sort(F.transform(F.slice(words, found["lo"] + 1, F.greatest(F.lit(0), found["hi"] - found["lo"])), lambda w: F.struct(w["i"].alias("i"), w["conf"].alias("conf"))))
        mean = lambda ws: F.aggregate(ws, F.lit(0.0), lambda a, w: a + w["conf"]) / F.nullif(F.size(ws), F.lit(0))
        return let(inside, lambda ws: F.struct(found["at"]["begin"].alias("begin"), found["at"]["size"].alias("size"), mean(ws).alias("mean"), F.exists(ws, lambda w: w["conf"].isNull()).alias("unsure")))

    extent = F.struct(finite_number(span["offset"]).alias("begin"), finite_number(span["length"]).alias("size"))
    return F.struct(plain_text(line["content"]).alias("text"), F.transform(line["polygon"], finite_number).alias("polygon"), let(extent, measured).alias("span"))


def from_azure(docs: DataFrame, keep: Keep = _as_is) -> Parts:
    """Lines with polygons; a line's confidence is the mean of the words that begin inside its first span.

    Words are sorted by their offset once a page and found by halving, so a line costs its own words
    and a logarithm of the page's; they do not leave the page's row.
    """
    span = "struct<offset:variant,length:variant>"
    page = f"struct<pageNumber:variant,width:variant,height:variant,unit:variant,lines:array<struct<content:variant,polygon:array<variant>,spans:array<{span}>>>,words:array<struct<confidence:variant,span:{span}>>>"
    pages = _list(docs, f"analyzeResult struct<pages:array<{page}>>", "j.analyzeResult.pages").select("document_id", "pos", "b.*")
    unit = F.element_at(F.create_map(*(F.lit(x) for kv in AZURE_UNITS.items() for x in kv)), plain_text(F.col("unit")))
    number = F.when(F.schema_of_variant("pageNumber") == "BIGINT", F.try_variant_get("pageNumber", "$", "int"))
    words = F.transform(F.coalesce("words", F.array()), lambda w, i: F.struct(finite_number(w["span"]["offset"]).alias("at"), i.alias("i"), finite_number(w["confidence"]).alias("conf")))
    lost = lambda ws: F.exists(ws, lambda w: w["at"].isNull())
    ordered = lambda ws: F.array_sort(F.filter(ws, lambda w: w["at"].isNotNull()))
    lines = lambda ws: let(ordered(ws), lambda o: F.transform(F.coalesce("lines", F.array()), lambda x: _read_line(x, o)))
    read = let(words, lambda ws: F.struct(lost(ws).alias("lost"), lines(ws).alias("lines")))
    pages = pages.select("document_id", number.alias("page_number"), finite_number(F.col("width")).alias("width"), finite_number(F.col("height")).alias("height"), unit.alias("size_unit"), read.alias("r"))
    pages = keep(pages.select("document_id", "page_number", "width", "height", "size_unit", "r.lost", "r.lines"))
    lines = pages.select("document_id", "page_number", "width", "height", "lost", F.posexplode("lines").alias("line_index", "l")).select("document_id", "page_number", "width", "height", "lost", "line_index", "l.text", "l.polygon", "l.span.*")
    axis = lambda odd: F.filter("polygon", lambda v, i: i % 2 == odd)
    shaped = lines.select("document_id", "page_number", "line_index", "text", *((f(axis(odd)) / F.nullif(F.col(s), F.lit(0.0))).alias(c) for c, f, odd, s in (("x0", F.array_min, 0, "width"), ("y0", F.array_min, 1, "height"), ("x1", F.array_max, 0, "width"), ("y1", F.array_max, 1, "height"))), F.col("mean").alias("confidence"), F.lit("mean_of_words").alias("confidence_source"))
    good = (F.size("polygon") >= 8) & (F.size("polygon") % 2 == 0) & ~F.exists("polygon", lambda v: v.isNull()) & F.col("text").isNotNull() & (F.col("begin") + F.col("size")).isNotNull()
    twice = pages.groupBy("document_id", "page_number").agg(F.count("*").alias("n"))
    errors = [
        _errors(pages, {"azure unit": F.col("size_unit").isNull(), "azure page": F.col("page_number").isNull() | (F.col("width") + F.col("height")).isNull()}),
        _errors(twice, {"azure twice": F.col("n") > 1}),
        _errors(lines, {"azure line": ~good, "azure word": F.col("lost") | F.col("unsure")}),
    ]
    return Parts(pages.select("document_id", "page_number", "width", "height", "size_unit", F.lit(None).cast("string").alias("size_reason")), shaped, reduce(DataFrame.unionByName, errors))


#: Engine name -> normaliser; a new engine is one entry.
ENGINES: dict[str, Callable[[DataFrame, Keep], Parts]] = {TEXTRACT: from_textract, TESSERACT: from_tesseract, AZURE: from_azure}


def clamp(lines: DataFrame) -> DataFrame:
    """Coordinates into [0, 1]; ``bbox_clamped`` says whether that changed any."""
    names = ("x0", "y0", "x1", "y1")
    inside = {c: F.greatest(F.least(F.col(c), F.lit(1.0)), F.lit(0.0)) for c in names}
    changed = reduce(lambda a, b: a | b, (F.col(c) != inside[c] for c in names))
    return lines.withColumns({"bbox_clamped": changed} | inside)


def normalise(docs: DataFrame, engines: dict[str, Callable[[DataFrame, Keep], Parts]] = ENGINES, keep: Keep = _as_is) -> tuple[DataFrame, DataFrame]:
    """(pages, errors) of documents (document_id, ocr_engine, raw_output).

    Several results come from one parsed table of each engine, and from its lines; ``keep`` may
    write these (or cache them) so that JSON is parsed once.

    Pages hold their lines as an array in reading order, and mean_confidence (null if no line has
    one), line_count and clamped_count.  A document with an error has no pages.
    """
    parts = [f(docs.where(F.col("ocr_engine") == name), keep) for name, f in engines.items()]
    pages, lines, errors = (reduce(DataFrame.unionByName, (getattr(p, k) for p in parts)) for k in ("pages", "lines", "errors"))
    lines = keep(clamp(lines))
    errors = errors.unionByName(_errors(lines, {"box": (F.col("x0") > F.col("x1")) | (F.col("y0") > F.col("y1")), "confidence": F.coalesce(~F.col("confidence").between(0, 1), F.lit(False))}))
    errors = errors.unionByName(_errors(pages, {"size": (F.col("page_number") < 1) | F.coalesce((F.col("width") <= 0) | (F.col("height") <= 0), F.lit(False))}))
    errors = errors.groupBy("document_id").agg(F.min("error").alias("error"))
    fields = ("line_index", "text", "x0", "y0", "x1", "y1", "confidence", "confidence_source", "bbox_clamped")
    grouped = lines.groupBy("document_id", "page_number").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("lines"), F.avg("confidence").alias("mean_confidence"), F.count("*").cast("int").alias("line_count"), F.count_if("bbox_clamped").cast("int").alias("clamped_count"))
    joined = pages.join(grouped, ["document_id", "page_number"], "left").join(errors.select("document_id"), "document_id", "left_anti")
    empty = F.array().cast(grouped.schema["lines"].dataType)
    return joined.withColumns({"lines": F.coalesce("lines", empty), "line_count": F.coalesce("line_count", F.lit(0)), "clamped_count": F.coalesce("clamped_count", F.lit(0))}), errors
