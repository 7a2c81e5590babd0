"""Secret scan: rules for known forms, and sliding-window entropy for unknown ones.

Candidate strings are long runs of token characters that no base rule covers.  Each is slid over
by a window whose character counts are kept up by one character in and one out; the Shannon
entropy of the fullest window decides, against a threshold for the character class.  Candidates
of an allowed form (words, numbers, UUIDs, rulers) are suppressed first.

Everything here is an SQL expression; nothing runs outside the JVM.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_or_empty, without

# fixed values: the base rules; a run of at least n characters is what is left of the
# shorter pattern after its short matches are dropped
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# repeated groups are possessive: Java would go one frame deeper for each turn of a greedy one
ALLOWED = (
    r"[A-Za-z]+(?:[-_/+=]+[A-Za-z]+)*+[-_/+=]*",  # words
    r"[0-9]+(?:[-_/+=]+[0-9]+)*+",  # numbers
    r"[-_/+=]+",  # rulers
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
    r"(?:[a-z]+[0-9]{0,4}[-_/])++[a-z]*[0-9]{0,4}",  # paths and slugs
)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Values that a running fold appends to one array, and code points of a piece of text.
_RUN, _PIECE = 256, 1024


@dataclass(frozen=True)
class CharacterClass:
    """Candidates that match ``pattern`` as a whole need ``bits`` of entropy a character."""

    pattern: str
    bits: float


CLASSES = (CharacterClass(r"[0-9a-fA-F]+", 3.0), CharacterClass(r"[A-Z0-9_+=/-]+|[a-z0-9_+=/-]+", 3.5), CharacterClass(r".*", 3.7))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _running(values: Column, op, zero: int = 0) -> Column:
    """array<int> of ``op`` over all values up to each place; in runs, since every append copies its array."""

    def fold(xs: Column) -> Column:
        start = F.struct(F.lit(zero).alias("last"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: _let(op(acc["last"], x), lambda y: F.struct(y.alias("last"), F.array_append(acc["out"], y).alias("out")))
        return F.aggregate(xs, start, step, lambda acc: acc["out"])

    def joined(runs: Column) -> Column:
        before = F.concat(F.array(F.lit(zero)), fold(F.transform(runs, lambda r: F.element_at(r, -1))))
        return F.flatten(F.zip_with(runs, F.slice(before, 1, F.size(runs)), lambda r, b: F.transform(r, lambda x: op(x, b))))

    def runs(xs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.floor(F.size(xs) / _RUN).cast("int")), lambda r: r * _RUN < F.size(xs))
        return _let(F.transform(starts, lambda r: fold(F.slice(xs, r * _RUN + 1, _RUN))), joined)

    return _let(values, runs)


def _located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of the matches, in code points.

    Splitting at the pattern and extracting it walk over the same matches, so the lengths of the
    parts between them give the places.  Texts without a match are searched once.
    """

    def walk(p: Column) -> Column:
        sizes = F.zip_with(F.slice(p["parts"], 1, F.size(p["found"])), p["found"], lambda a, b: F.char_length(a) + F.char_length(b))
        ends = _running(sizes, lambda a, b: a + b)
        return F.zip_with(ends, p["found"], lambda end, m: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("match")))

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda f: F.when(F.size(f) > 0, _let(F.struct(F.split(text, pattern, -1).alias("parts"), f.alias("found")), walk)).otherwise(none))


def _span(kind: str, m: Column) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the base rules, by start and then by kind."""
    assign = _located(text, ASSIGN)
    value = lambda m: F.regexp_extract(m["match"], ASSIGN, 2)
    assign = F.transform(F.filter(assign, lambda m: F.char_length(value(m)) >= 8), lambda m: _span("assign", m))
    access = F.transform(_located(text, ACCESS), lambda m: _span("access", m))
    hexes = F.transform(_located(text, HEX), lambda m: _span("hex", m))
    return F.array_sort(F.concat(assign, access, hexes))


def window_entropy(s: Column, window: int) -> Column:
    """Largest Shannon entropy (bits a character) of a window of ``window`` characters of ``s``.

    A shorter string is one window.  The counts of the characters lie side by side in a few longs;
    one character in and one out change them by a long each, and ``sum`` of c * log2(c) by two
    terms each.
    """
    gain = F.array(*(F.lit((c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0)) for c in range(window + 1)))
    width = window.bit_length()
    per = 63 // width
    longs = -(-len(_ALPHABET) // per)
    # what one character adds to the longs; the last row, of no character, adds nothing
    ones = F.array(*(F.array(*(F.lit(1 << c % per * width if c // per == k else 0).cast("long") for k in range(longs))) for c in range(len(_ALPHABET) + 1)))

    def count(counts: Column, c: Column) -> Column:
        return F.call_function("shiftrightunsigned", F.get(counts, F.floor(c / per).cast("int")), c % per * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int")

    def step(acc: Column, x: Column, n: Column) -> Column:
        def moved(y: Column) -> Column:
            total = acc["sum"] - F.when(x["out"] < len(_ALPHABET), F.get(gain, count(acc["counts"], x["out"]) - 1)).otherwise(0.0) + F.get(gain, count(y, x["in"]))
            return _let(total, lambda t: F.struct(F.zip_with(y, F.get(ones, x["in"]), lambda a, b: a + b).alias("counts"), t.alias("sum"), F.when(acc["at"] >= n, F.least(acc["least"], t)).otherwise(acc["least"]).alias("least"), (acc["at"] + 1).alias("at")))

        return _let(F.zip_with(acc["counts"], F.get(ones, x["out"]), lambda a, b: a - b), moved)

    def slid(p: Column) -> Column:
        codes, n = p["codes"], p["n"]
        leaving = F.concat(F.array_repeat(F.lit(len(_ALPHABET)), n), codes)
        moves = F.zip_with(codes, F.slice(leaving, 1, F.size(codes)), lambda c, o: F.struct(c.alias("in"), o.alias("out")))
        zero = F.struct(F.array_repeat(F.lit(0).cast("long"), longs).alias("counts"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"), F.lit(1).alias("at"))
        return F.aggregate(moves, zero, lambda acc, x: step(acc, x, n), lambda acc: F.log2(n.cast("double")) - acc["least"] / n)

    codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(_ALPHABET), c) - 1)
    whole = F.struct(codes.alias("codes"), F.least(F.lit(window), F.char_length(s)).alias("n"))
    return F.when(F.char_length(s) > 0, _let(whole, slid)).otherwise(0.0)


def entropy_spans(text: Column, base: Column, window: int = 20) -> Column:
    """Spans of candidates in what the base spans leave whose fullest window is random enough."""

    def random_enough(m: Column) -> Column:
        s, limit = m["match"], None
        for c in reversed(CLASSES):
            limit = F.lit(c.bits) if limit is None else F.when(s.rlike(f"^(?:{c.pattern})$"), c.bits).otherwise(limit)
        return F.when(s.rlike("^(?:" + "|".join(ALLOWED) + ")$"), False).otherwise(window_entropy(s, window) >= limit)

    rest = _replaced(text, base, lambda n, apart: F.repeat(F.lit(" "), n))
    return _let(rest, lambda t: F.transform(F.filter(_located(t, CANDIDATE), random_enough), lambda m: _span("entropy", m)))


def find_secrets(docs: DataFrame, text: str = "text", window: int = 20, names: tuple[str, str] = ("base_spans", "spans")) -> DataFrame:
    """Add ``names``: base_spans and spans (base and entropy), arrays of start, kind number and end.

    Offsets are code points, ends exclusive.  Null and empty texts have no spans; equal rows get
    equal spans; columns of the added names are replaced, others pass through.
    """
    value, (base, spans) = F.coalesce(F.col(text), F.lit("")), names
    docs = without(docs, *names).withColumn(base, base_spans(value))
    return docs.withColumn(spans, F.array_sort(F.concat(base, entropy_spans(value, F.col(base), window))))


def as_string(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with spans, in order of their start, replaced by ``by(characters that no span before covers, if the span is apart from those)``."""

    def cut(pieces: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / _PIECE).cast("int"), F.floor(end / _PIECE).cast("int")
        piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
        within = F.substring(piece(first), start % _PIECE + 1, end - start)
        across = F.concat(F.substring(piece(first), start % _PIECE + 1, F.lit(_PIECE)), F.array_join(F.slice(pieces, first + 2, F.greatest(F.lit(0), last - first - 1)), ""), F.substring(piece(last), F.lit(1), end % _PIECE))
        return F.when(first == last, within).otherwise(across)

    def built(p: Column) -> Column:
        at = F.zip_with(spans, F.slice(p["ends"], 1, F.size(spans)), lambda s, e: F.struct(e.alias("from"), s["start"].alias("to"), s["end"].alias("end")))

        def part(x: Column) -> Column:
            apart = x["to"] >= x["from"]
            before = F.when(apart, cut(p["pieces"], x["from"], x["to"])).otherwise("")
            return F.concat(before, by(F.greatest(F.lit(0), x["end"] - F.greatest(x["from"], x["to"])), apart))

        rest = cut(p["pieces"], F.element_at(p["ends"], -1), F.char_length(text))
        return F.concat(F.array_join(F.transform(at, part), ""), rest)

    ends = F.concat(F.array(F.lit(0)), _running(F.transform(spans, lambda s: s["end"]), F.greatest))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, _let(F.struct(pieces.alias("pieces"), ends.alias("ends")), built)).otherwise(text)


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with the union of the spans replaced; spans are in order of their start."""
    return _replaced(text, spans, lambda n, apart: F.when(apart, mask).otherwise(""))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and entropy spans of all documents."""
    found = find_secrets(read_table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text")))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(as_string(F.col("base_spans")), 256).alias("base_sha256"), as_string(F.col("spans")).alias("spans"))
