"""Regular expressions and white space as the rule packs expect them.

Rules are written for Unicode classes, case-insensitive matching and line anchors at line feeds
only; ``FLAGS`` sets the JVM's engine to that.  Positions are code points.
"""

from __future__ import annotations

import re
import string
import sys
import unicodedata
from functools import reduce
from operator import and_
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAGS = "(?imdU)"


#: Decimal digits of all scripts but ASCII's own, by Unicode's own property.
_DIGITS = [chr(i) for i in range(128, sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Nd"]


def ascii_digits(c: Column) -> Column:
    """Decimal digits of other scripts as those of ASCII."""
    return F.translate(c, "".join(_DIGITS), "".join(str(unicodedata.decimal(d)) for d in _DIGITS))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


#: Words of ASCII with one blank between two: most values, and neither ``strip`` nor ``collapse`` changes them.
PLAIN = r"\A[!-~]++(?: [!-~]++)*+\z"


def stripped(c: Column) -> Column:
    """``strip`` for many short values: one look at those that are plain. ``c`` is read more than once."""
    return F.when(c.rlike(PLAIN), c).otherwise(strip(c))


def collapsed(c: Column) -> Column:
    """``collapse`` in the same way."""
    return F.when(c.rlike(PLAIN), c).otherwise(collapse(c))


def required(pattern: str) -> list[str]:
    """Characters that every match of a pattern holds, of those without case; a text without one needs no search."""

    def of(parts) -> set[str]:
        found: set[str] = set()
        for kind, what in parts:
            if kind is _parser.LITERAL and chr(what) in string.punctuation:
                found.add(chr(what))
            elif kind is _parser.SUBPATTERN:
                found |= of(what[3])
            elif kind in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and what[0]:
                found |= of(what[2])
        return found

    try:
        return sorted(of(_parser.parse(pattern.removeprefix(FLAGS))))
    except re.error:  # Java's engine alone reads it
        return []


#: A match of up to so many characters is looked for in its text as it stands, to get its place.
_SHORT = 1000


def first_match(text: Column, pattern: str, groups: int = 0) -> Column:
    """struct<start, end, value> of the leftmost match, or null; a pattern must not match nothing.

    ``value`` is the first of ``groups`` groups that took part, else the whole match.  What matched
    mostly stands in the text once, and that is its place.  Else the engine counts the characters
    before it in halves of UTF-16; where a text has characters of two halves, splitting at the
    pattern, which is read anew each time, gives its place in code points.
    """
    pattern = FLAGS + pattern

    def searched() -> Column:
        return F.when(text.rlike(r"[\x{10000}-\x{10FFFF}]"), F.char_length(F.split(text, pattern, 2)[0])).otherwise(F.regexp_instr(text, F.lit(pattern)) - 1)

    def placed(whole: Column) -> Column:
        once = let(F.position(whole, text), lambda at: F.when((at > 0) & (F.position(whole, text, at + 1) == 0), at - 1))
        start = F.coalesce(F.when(F.char_length(whole) <= _SHORT, once), searched())
        value = F.coalesce(*(let(F.regexp_extract(text, pattern, g), lambda part: F.when(part != "", part)) for g in range(1, groups + 1)), whole)
        found = let(start, lambda at: F.struct(at.alias("start"), (at + F.char_length(whole)).alias("end"), let(value, stripped).alias("value")))
        return F.when(whole != "", found)

    needed = required(pattern)
    whole = F.regexp_extract(text, pattern, 0)
    if needed:
        whole = F.when(reduce(and_, (F.contains(text, F.lit(x)) for x in needed)), whole)
    return let(whole, placed)


def join_lines(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda x: x["text"]), "\n")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; what lambdas use directly is computed each time.

    An aggregate over no elements, whose result is taken as it is; a transform of one element would be
    copied, and its type be made out anew for each row.
    """
    return F.aggregate(F.array(), value, lambda acc, _: acc, body)


#: Values of a run, and levels of runs.
_RUN, _LEVELS = 64, 3


def prefix_sums(values: Column, levels: int = _LEVELS) -> Column:
    """Sum of the integers before each place.

    An array grows by being copied, so sums are taken in runs of few values, the sums of runs in
    runs again, and each run is moved by what stands before it.
    """

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["sum"] + x).alias("sum"), F.array_append(acc["before"], acc["sum"]).alias("before"))

    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("before"))
    run = lambda xs: F.aggregate(xs, zero, step)
    values = F.transform(values, lambda x: x.cast("long"))
    if levels == 1:
        return run(values)["before"]

    def moved(runs: Column) -> Column:
        return F.flatten(F.zip_with(F.transform(runs, lambda r: r["before"]), prefix_sums(F.transform(runs, lambda r: r["sum"]), levels - 1), lambda xs, s: F.transform(xs, lambda x: x + s)))

    last = lambda vs: F.greatest(F.lit(0), F.floor((F.size(vs) - 1) / _RUN).cast("int"))
    long = lambda vs: let(F.transform(F.sequence(F.lit(0), last(vs)), lambda i: run(F.slice(vs, i * _RUN + 1, _RUN))), moved)
    return let(values, lambda vs: F.when(F.size(vs) <= _RUN, run(vs)["before"]).otherwise(long(vs)))


def with_offsets(lines: Column) -> Column:
    """array<struct<line_index, text, start, end>>: where each line lies in the joined text."""

    def placed(x: Column, start: Column) -> Column:
        start = start.cast("int")
        return F.struct(x["line_index"].alias("line_index"), x["text"].alias("text"), start.alias("start"), (start + F.char_length(x["text"])).alias("end"))

    return F.zip_with(lines, prefix_sums(F.transform(lines, lambda x: F.char_length(x["text"]) + 1)), placed)


def overlapping(spans: Column, start: Column, end: Column) -> Column:
    return F.filter(spans, lambda s: (s["start"] < end) & (s["end"] > start))
