"""Weighted keyword classification of document texts."""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_match, join_lines, let

# fixed values: type -> keyword -> weight
KEYWORDS: dict[str, dict[str, int]] = {
    "medical_certificate": {"medical certificate": 3, "unfit for duty": 2, "medical leave": 2, "sick leave": 1},
    "referral_letter": {"referral": 3, "referral letter": 2, "referring provider": 2, "kindly review": 1},
    "receipt": {"receipt": 3, "tax invoice": 3, "official receipt": 2, "gst": 1},
}
#: What is said of a document of none of the types.
NO_TYPE = "no keyword found in the document text"


#: Letters whose only partner in the other case is not their ``lower``: what patterns without case take as equal.
_FOLDED = ("ſİıςµ", "siiσμ")


def _folded(text: Column) -> Column:
    """``lower``, and letter by letter only where a text has one of those, or the sigma that becomes one."""
    return F.when(text.rlike(f"[{_FOLDED[0]}Σ]"), F.translate(F.lower(F.translate(text, *_FOLDED)), *_FOLDED)).otherwise(F.lower(text))


def _fold(text: str) -> str:
    table = str.maketrans(*_FOLDED)
    return text.translate(table).lower().translate(table)


def keyword_pattern(keyword: str) -> str:
    """Whole words; white space of any length, line breaks too, between them."""
    return r"\b" + r"\s+".join(rf"\Q{w}\E" for w in keyword.split()) + r"\b"


_MAPS = 64
#: Up to so many keywords are looked for one by one.
_FEW = 64


def _constant(value, schema: str) -> Column:
    """A value as one literal, whatever its size."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _grams(words: Column, n: int) -> Column:
    """At the place of each word the ``n`` words from there on, or null beyond the end."""
    return words if n == 1 else F.transform(words, lambda _, i: F.when(i + n <= F.size(words), F.concat_ws(" ", *(F.get(words, i + k) for k in range(n)))))


def _searched(text: Column, plain: dict[str, str]) -> Column:
    """The hits of few keywords, folded and by name: each is searched for in the text's words.

    Every word stands after one blank there, and a mark as a word of its own where other characters
    than white space lie between words.
    """
    spaced = F.concat(F.lit(" "), F.regexp_replace(_folded(text), r"(?U)[^\w\s]+", " \x01 "), F.lit(" "))
    spaced = F.regexp_replace(spaced, r"(?U)\s{2,}|[^\S ]", " ")
    times = lambda s, what: F.length(s) - F.length(F.replace(s, F.lit(what), F.lit("")))

    def hit(words: Column, folded: str, name: str) -> Column:
        before = lambda at: let(F.substring(words, F.lit(1), at - 1), lambda s: (times(s, " ") - times(s, "\x01")).cast("long"))
        # most are absent, which is seen sooner by a letter than by the blank before it
        return let(F.when(F.contains(words, F.lit(f"{folded} ")), F.instr(words, F.lit(f" {folded} "))), lambda at: F.when(at > 0, F.struct(F.lit(name).alias("keyword"), before(at).alias("at"))))

    return let(spaced, lambda words: F.filter(F.array(*(hit(words, *k) for k in plain.items())), lambda h: h.isNotNull()))


def found_keywords(text: Column, keywords: list[str]) -> Column:
    """array<struct<keyword, at>> of the keywords that occur, each once, with the number of words before it.

    Up to _FEW keywords are searched for in the text's words.  For more, the text is cut into words once,
    in stretches that hold white space only between words, and its word n-grams are met with the pack by
    hashing; so the cost does not grow with the pack but by its reading.  Keywords with other characters
    than those of words are looked for by patterns.
    """
    plain = {" ".join(_fold(k).split()): k for k in keywords if re.fullmatch(r"\w+(\s+\w+)*", k.strip())}
    odd = [k for k in keywords if k not in plain.values()]
    lengths = sorted({len(k.split()) for k in plain}) or [1]
    stretches = F.transform(F.split(_folded(text), r"(?U)[^\w\s]+"), lambda s: F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""))
    grams = lambda ss: F.array(*(F.flatten(F.transform(ss, lambda ws: _grams(ws, n))) for n in lengths))  # noqa: B023, E731
    pack = _constant(sorted(plain), "array<string>")
    spelt = {a: b for a, b in plain.items() if a != b}
    name = lambda k: F.coalesce(F.element_at(_constant(spelt, "map<string,string>"), k), k) if spelt else k
    place = lambda gs, k: F.array_min(F.transform(gs, lambda g: F.nullif(F.array_position(g, k), F.lit(0)))) - 1
    hits = _searched(text, plain) if plain and len(plain) <= _FEW else let(stretches, lambda ss: let(grams(ss), lambda gs: F.transform(F.filter(F.array_intersect(F.flatten(gs), pack), lambda k: k.isNotNull()), lambda k: F.struct(name(k).alias("keyword"), place(gs, k).cast("long").alias("at"))))) if plain else None
    ordinal = lambda m: F.size(F.regexp_extract_all(F.substring(text, F.lit(1), m["start"]), F.lit(r"(?U)(\w+)"), F.lit(1))).cast("long")
    looked = [let(first_match(text, keyword_pattern(k)), lambda m: F.when(m.isNotNull(), F.struct(F.lit(k).alias("keyword"), ordinal(m).alias("at")))) for k in odd]  # noqa: B023
    more = F.filter(F.array(*looked), lambda h: h.isNotNull()) if odd else None
    return F.concat(*(x for x in (hits, more) if x is not None))


def classify(text: Column, keywords: dict[str, dict[str, int]] = KEYWORDS) -> Column:
    """struct<document_type, score, matched_keywords>, null if no keyword occurs.

    Each keyword counts once, those within others too.  The largest sum of weights wins, then the
    earliest first match, then the name.
    """
    of = {k: [(t, words[k]) for t, words in keywords.items() if k in words] for words in keywords.values() for k in words}
    # a map is read from its beginning, so the pack is dealt over many
    dealt: list[dict] = [{} for _ in range(_MAPS)]
    for k, entries in of.items():
        dealt[zlib.crc32(k.encode()) % _MAPS][k] = [{"type": t, "weight": w} for t, w in entries]
    maps = _constant(dealt, "array<map<string,array<struct<type:string,weight:int>>>>")
    pack = lambda k: F.element_at(F.get(maps, (F.crc32(k) % _MAPS).cast("int")), k)

    def ranked(hits: Column, name: str) -> Column:
        mine = F.filter(hits, lambda h: h["type"] == name)
        return let(mine, lambda m: F.struct((-F.aggregate(m, F.lit(0), lambda a, h: a + h["weight"])).alias("rank"), F.array_min(F.transform(m, lambda h: h["at"])).alias("first"), F.lit(name).alias("document_type"), F.array_sort(F.transform(m, lambda h: h["keyword"])).alias("matched_keywords")))

    def best(hits: Column) -> Column:
        return F.array_min(F.filter(F.array(*(ranked(hits, t) for t in keywords)), lambda t: t["rank"] < 0))

    typed = lambda h: F.transform(pack(h["keyword"]), lambda e: F.struct(h["keyword"].alias("keyword"), h["at"].alias("at"), e["type"].alias("type"), e["weight"].alias("weight")))
    named = lambda b: F.when(b.isNotNull(), F.struct(b["document_type"].alias("document_type"), (-b["rank"]).alias("score"), b["matched_keywords"].alias("matched_keywords")))
    hits = F.flatten(F.transform(found_keywords(text, list(of)), typed))
    return let(let(hits, best), named)


def document_texts(pages: DataFrame) -> DataFrame:
    """(document_id, text): lines of all pages (document_id, page_number, lines) in page order."""
    parts = F.array_sort(F.collect_list(F.struct("page_number", join_lines(F.col("lines")).alias("text"))))
    return pages.where(F.size("lines") > 0).groupBy("document_id").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))


def classify_documents(pages: DataFrame, keywords: dict[str, dict[str, int]] = KEYWORDS) -> DataFrame:
    found = document_texts(pages).withColumn("c", classify(F.col("text"), keywords))
    return found.select("document_id", "c.document_type", "c.score", "c.matched_keywords")
