"""Homomorphic multiset hash of documents.

A document is the multiset of its paragraphs (lines with text).  Each paragraph is hashed to a
wide vector, and the fingerprint is the sum of the vectors modulo powers of two, so it does not
depend on order and paragraphs can be added to or taken from it without the rest of the text.

The vector has two parts.  ``exact`` has 16 lanes modulo 2 ** 32 cut from the paragraph's
SHA-512: equal multisets have equal sums, and unequal ones differ.  ``near`` has 64 lanes modulo
2 ** 32, packed two to a long, that count the hash bits of the paragraph's overlapping word
n-grams; the counts, with the number of n-grams, give a random projection of the n-gram multiset,
and the angle between two projections says how alike two documents are.  All of it adds up, so
edits are incremental, and all of it is in the published fingerprint.

Everything here is an SQL expression; nothing runs outside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table, text_or_empty

EXACT_LANES = 16
NEAR_WORDS = 32  # longs of two lanes each
_LOW = 0xFFFFFFFF
_BYTES = 0x0101010101010101
_BYTE_PAIR = 0xFF000000FF
_BLOCK = 127  # bits that are counted in a byte; more would reach the sign
GRAM = 3
#: Words end at white space; ideographs, kana and Thai letters are words, as are the characters of a run after its first 16.
WORD = r"\s+|(?<=[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}])|(?<=\S{16})"
PARAGRAPH = r"[\r\n]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; what lambdas use directly is computed each time."""
    return F.transform(F.array(value), body)[0]


def _parts(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(text, pattern), lambda p: F.btrim(p, F.lit(" \t"))), lambda p: p != "")


def _grams(paragraph: Column) -> Column:
    """Hashes of the n-grams of a paragraph; one of fewer words is one n-gram."""
    words = F.filter(F.split(paragraph, WORD), lambda w: w != "")
    hashes = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(w, *(F.get(ws, i + k) for k in range(1, GRAM))))
    return _let(words, lambda ws: F.slice(hashes(ws), 1, F.greatest(F.lit(1), F.size(ws) - (GRAM - 1))))


def _add(a: Column, b: Column) -> Column:
    """Lane-wise sum of two 2-lane longs modulo 2 ** 32; no carry passes from one lane to the other."""
    low = (a.bitwiseAND(F.lit(_LOW)) + b.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))
    high = (F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32)).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(high, 32).bitwiseOR(low)


def vector(text: Column) -> Column:
    """struct(exact, near, grams) of a text; null counts as empty, and empty texts give zeros."""
    text = F.coalesce(text, F.lit(""))
    digests = F.transform(_parts(text, PARAGRAPH), lambda p: F.sha2(p, 512))
    hashes = F.flatten(F.transform(_parts(text, PARAGRAPH), _grams))

    def widened(i: int):
        return lambda a, x: a + F.shiftrightunsigned(x[i % 8], i // 8 * 8).bitwiseAND(F.lit(_BYTE_PAIR))

    def lanes(s: Column) -> Column:
        exact = F.transform(F.sequence(F.lit(0), F.lit(EXACT_LANES - 1)), lambda i: F.aggregate(s["d"], F.lit(0).cast("long"), lambda a, d: (a + F.conv(F.substring(d, i * 8 + 1, F.lit(8)), 16, 10).cast("long")).bitwiseAND(F.lit(_LOW))))
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(s["h"]) / _BLOCK).cast("int")), lambda b: F.slice(s["h"], b * _BLOCK + 1, _BLOCK))
        # eight lanes a long while a byte holds them, then two a long
        counts = F.transform(blocks, lambda h: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + F.call_function("shiftrightunsigned", x, i).bitwiseAND(F.lit(_BYTES)))))
        near = _let(counts, lambda c: F.array(*(F.aggregate(c, F.lit(0).cast("long"), widened(i)) for i in range(NEAR_WORDS))))
        return F.struct(exact.alias("exact"), near.alias("near"), F.size(s["h"]).cast("long").alias("grams"))

    return _let(F.struct(digests.alias("d"), hashes.alias("h")), lanes)


def added(a: Column, b: Column) -> Column:
    """Vector of the union of two multisets: insert ``b``'s paragraphs into ``a``."""
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: (x + y).bitwiseAND(F.lit(_LOW))).alias("exact"),
        F.zip_with(a["near"], b["near"], _add).alias("near"), (a["grams"] + b["grams"]).alias("grams"),
    )


def removed(a: Column, b: Column) -> Column:
    """Vector of ``a`` without ``b``'s paragraphs."""
    negative = F.transform(b["near"], lambda x: F.shiftleft((F.lit(1 << 32) - F.shiftrightunsigned(x, 32)).bitwiseAND(F.lit(_LOW)), 32).bitwiseOR((F.lit(1 << 32) - x.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW))))
    return F.struct(
        F.zip_with(a["exact"], b["exact"], lambda x, y: (x - y).bitwiseAND(F.lit(_LOW))).alias("exact"),
        F.zip_with(a["near"], negative, _add).alias("near"), (a["grams"] - b["grams"]).alias("grams"),
    )


def as_string(v: Column) -> Column:
    """Lower-case hexadecimal of the whole vector: 8 digits for each exact lane, 16 for each pair of near lanes, 16 for the number of n-grams."""
    lanes = F.concat(F.transform(v["exact"], lambda x: F.lpad(F.hex(x), 8, "0")), F.transform(F.array_append(v["near"], v["grams"]), lambda x: F.lpad(F.hex(x), 16, "0")))
    return F.lower(F.array_join(lanes, ""))


def _packed(v: Column) -> Column:
    return F.concat(v["exact"], F.array_append(v["near"], v["grams"]))


def _unpacked(lanes: Column, at: int) -> Column:
    """The vector of number ``at`` among packed ones."""
    first = at * (EXACT_LANES + NEAR_WORDS + 1) + 1
    return F.struct(F.slice(lanes, first, EXACT_LANES).alias("exact"), F.slice(lanes, first + EXACT_LANES, NEAR_WORDS).alias("near"), F.element_at(lanes, first + EXACT_LANES + NEAR_WORDS).alias("grams"))


def open_line(text: Column) -> Column:
    """What stands after the last line break."""
    return F.substring_index(F.translate(text, "\r", "\n"), "\n", -1)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the two projections, at least 0; 1 for equal vectors, 0 if just one is empty."""

    def signs(v: Column) -> Column:
        n = v["grams"]
        return F.concat(F.transform(v["near"], lambda x: (x.bitwiseAND(F.lit(_LOW)) * 2 - n).cast("double")), F.transform(v["near"], lambda x: (F.shiftrightunsigned(x, 32) * 2 - n).cast("double")))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)

    def cosine(s: Column) -> Column:
        size = F.sqrt(dot(s["x"], s["x"])) * F.sqrt(dot(s["y"], s["y"]))
        return F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(s["x"], s["y"]) / size))).otherwise(0.0)

    value = _let(F.struct(signs(a).alias("x"), signs(b).alias("y")), cosine)
    return F.when((a["exact"] == b["exact"]) & (a["grams"] == b["grams"]), 1.0).otherwise(value)


def following(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, next) of every distinct key: the next larger one, after the largest the smallest.

    Keys are dealt into ranges and followed within each; only the first key of each range
    crosses to another, so what meets in one task is one row a range.  Null keys are left out.
    """
    from pyspark.sql import Window

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(F.col(key).alias("k")).where("k is not null").distinct()
    # written, since the bounds of ranges are sampled and both uses below must see the same
    ranged = materialise(keys.repartitionByRange(parts, "k").withColumn("r", F.spark_partition_id()))
    ranged = ranged.withColumn("next", F.lead("k").over(Window.partitionBy("r").orderBy("k")))
    firsts = ranged.groupBy("r").agg(F.min("k").alias("f"))
    whole = Window.orderBy("r")
    # one row a range
    heads = firsts.select("r", F.coalesce(F.lead("f").over(whole), F.first("f").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("f"))
    return ranged.join(heads, "r").select(F.col("k").alias(key), F.coalesce("next", "f").alias("next"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every document with its vector, its next document's and that of an edited text.

    The edited text has the last quarter of the code points replaced by the first as many of the
    next document; its vector is the text's, without the paragraphs from the cut on and with those
    that stand there afterwards, so the text before is hashed once.  Rows of one doc_id follow the same document and precede it alike; if the next
    id has several texts the least counts.  A null doc_id comes first, null texts are empty, and a
    single document follows itself.  Columns other than doc_id and text are not read.
    """
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    light = docs.select("doc_id", order.alias("k"), F.char_length(text_or_empty()).alias("n"))
    quarter = light.groupBy("k").agg(F.max(F.floor(F.col("n") / 4)).cast("int").alias("most"))
    links = following(light, "k").withColumnRenamed("k", "o").join(quarter.withColumnRenamed("k", "q"), F.col("o") == F.col("q")).select("o", "next", "most")
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    started = F.col("started")
    texts = docs.select(order.alias("k"), text_or_empty().alias("text"))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.select(F.spark_partition_id().alias("p")).distinct().count() < cores:  # few row groups: all cores are to hash
        texts = texts.repartition(cores, "k")
    texts = texts.withColumn("started", (n - cut - F.char_length(open_line(F.substring("text", F.lit(1), n - cut)))).cast("int"))
    parts = F.struct(vector(F.substring("text", F.lit(1), started)).alias("a"), vector(F.substring("text", started + 1, n)).alias("b"))
    # one array, since a struct's unread fields would be pruned on one side and the exchange not read twice
    texts = texts.withColumn("vs", _let(parts, lambda p: F.concat(_packed(added(p["a"], p["b"])), _packed(p["b"]))))
    # dealt out once by key: both joins below read the same exchange, and only heads of texts move again
    rows = texts.select("k", "text", "vs").repartition("k")
    heads = rows
    if not light.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        heads = rows.groupBy("k").agg(F.min(F.struct("text", "vs")).alias("m")).select("k", "m.text", "m.vs")
    after = links.join(heads, F.col("next") == F.col("k")).select("o", F.expr("left(text, most)").alias("head"), _unpacked(F.col("vs"), 0).alias("next_v"))
    kept, head = F.substring("text", F.lit(1), n - cut), F.substring("head", F.lit(1), cut)
    out = rows.join(after, F.col("k") == F.col("o")).select(
        F.nullif("k", F.lit(-(1 << 63))).alias("doc_id"), "text", _unpacked(F.col("vs"), 0).alias("v"), _unpacked(F.col("vs"), 1).alias("ending"), "next_v",
        n.cast("long").alias("n_chars"), F.concat(kept, head).alias("edited"), vector(F.concat(open_line(kept), head)).alias("new_ending"),
    )
    return out.withColumn("edited_v", added(removed(F.col("v"), F.col("ending")), F.col("new_ending")))


def op7_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and their edited texts."""
    found = fingerprint_edits(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("v")).alias("fingerprint"), as_string(F.col("edited_v")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("edited_v")).alias("near_edited"), likeness(F.col("v"), F.col("next_v")).alias("near_next"),
    )
