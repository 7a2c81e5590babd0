import logging
import random
import time

import pytest
from pyspark.sql import functions as F

from pagemill.functions.pii import BARE, LABELLED, MASK, MaskingFilter, install_masking, mask, mask_text
from pagemill.functions.text import collapse, collapsed, first_match, let, overlapping, required, strip, stripped, with_offsets
from pagemill.functions.validate import parse_amount, parse_bool, parse_date, parse_datetime, parse_non_negative_int, validate_field

VALID = [
    (parse_date, "08/03/2026", "08/03/2026"), (parse_date, "8/3/2026", "08/03/2026"), (parse_date, "08-03-2026", "08/03/2026"), (parse_date, "08.03.2026", "08/03/2026"), (parse_date, "2026-03-08", "08/03/2026"),
    (parse_date, "8 Mar 2026", "08/03/2026"), (parse_date, "8 March 2026", "08/03/2026"), (parse_date, "08-Sept-2026", "08/09/2026"), (parse_date, "Mar 8, 2026", "08/03/2026"), (parse_date, " 14/03/1988\t", "14/03/1988"), (parse_date, "29 feb 2024", "29/02/2024"),
    (parse_datetime, "02/09/2026 10:20", "02/09/2026 10:20"), (parse_datetime, "2/9/2026 9:05", "02/09/2026 09:05"), (parse_datetime, "2026-09-02T10:20:33", "02/09/2026 10:20"), (parse_datetime, "2 Sep 2026, 3:15 pm", "02/09/2026 15:15"), (parse_datetime, "02/09/2026 12:05 AM", "02/09/2026 00:05"), (parse_datetime, "2026-09-02 at 12:00 p.m.", "02/09/2026 12:00"),
    (parse_amount, "S$93.20", "9320"), (parse_amount, "SGD 1,200.00", "120000"), (parse_amount, "S$1,234.50", "123450"), (parse_amount, "$8.5", "850"), (parse_amount, "S$45", "4500"), (parse_amount, "850.00 SGD", "85000"), (parse_amount, "RM 12.30", "1230"), (parse_amount, "VND 1,200,000", "1200000"), (parse_amount, "7.70", "770"), (parse_amount, "usd 1 USD", "100"),
    (parse_non_negative_int, " 007 ", "7"), (parse_non_negative_int, "٣٠", "30"), (parse_non_negative_int, "0", "0"), (parse_bool, " Yes", "true"), (parse_bool, "0", "false"),
]
INVALID = [
    (parse_date, "31/02/2026", "not a calendar date"), (parse_date, "08/03/26", "two-digit year is ambiguous"), (parse_date, "13/13/2026", "not a calendar date"), (parse_date, "yesterday", "unrecognised date format"), (parse_date, "", "unrecognised date format"), (parse_date, "30 Feb 2026", "unrecognised date format"),
    (parse_datetime, "02/09/2026", "expected a date followed by a time (HH:MM)"), (parse_datetime, "02/09/2026 25:00", "time out of range"), (parse_datetime, "02/09/2026 13:00 pm", "12-hour time out of range"), (parse_datetime, "31/02/2026 10:00", "not a calendar date"),
    (parse_amount, "-S$5.00", None), (parse_amount, "S$-5.00", None), (parse_amount, "EUR 5.00", "unknown currency"), (parse_amount, "S$1.234", "more than 2 decimal places"), (parse_amount, "1,20", None), (parse_amount, "abc", None), (parse_amount, "S$ 5 RM", "unknown currency"), (parse_amount, "9" * 30, None),
    (parse_non_negative_int, "-1", "must be non-negative"), (parse_non_negative_int, "2.5", "must be a whole number"), (parse_non_negative_int, "two", "not an integer"), (parse_bool, "maybe", "not a boolean"),
]


def run(spark, parser, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", parser(F.col("t")).alias("p")).orderBy("i").collect()
    return [r["p"] for r in rows]


@pytest.mark.parametrize("parser", sorted({p for p, *_ in VALID}, key=lambda f: f.__name__), ids=lambda f: f.__name__)
def test_parsers(spark, parser):
    good, bad = ([x for x in table if x[0] is parser] for table in (VALID, INVALID))
    got = run(spark, parser, [t for _, t, _ in good] + [t for _, t, _ in bad] + [None])
    assert [(r["value"], r["message"]) for r in got[: len(good)]] == [(v, None) for _, _, v in good]
    for r, (_, text, message) in zip(got[len(good) : -1], bad, strict=True):
        assert r["value"] is None and r["message"] and (message is None or r["message"] == message), text
        assert not text or text not in r["message"]
    assert got[-1] is None


def test_validate_field(spark):
    rows = [("provider_name", "text", "Panel of Fullerton Health network"), ("provider_name", "text", "FULLERTON  HEALTH"), ("provider_name", "text", " Harbour  Clinic "), ("icd_code", "text", None), ("signature_presence", "bool", "[signed]"), ("mc_days", "int", "2"), ("other", "text", " \t ")]
    got = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f string, k string, r string").orderBy("i").select(validate_field(F.col("f"), F.col("k"), F.col("r")).alias("v")).collect()
    assert [(r["v"]["validation_status"], r["v"]["normalised_value"]) for r in got] == [("invalid", None), ("invalid", None), ("valid", "Harbour Clinic"), ("missing", None), ("valid", "true"), ("valid", "2"), ("invalid", None)]
    assert got[3]["v"]["validation_message"] == "not found in document text"


SECRET = ["S1234567A", "patient born DOB: 14/03/1988 here", "claimant_name='TAN WEI' x", "claimant_address: Somewhere", "079188001234", "Date of Birth 1988-03-14", 'claimant_dob="1 2"', "123456789"]


def test_masking(spark):
    got = spark.createDataFrame([(t,) for t in SECRET], "t string").select("t", mask(F.col("t")).alias("m")).collect()
    for r in got:
        assert MASK in r["m"] and r["m"] == mask_text(r["t"])
    plain = ["ordinary words 12345678", "1234567890123", "XS1234567AB", None]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in plain], "t string").select(mask(F.col("t"))).collect()] == plain


def test_log_records_are_masked():
    log, seen = logging.getLogger("masked"), []
    handler = logging.Handler()
    handler.emit = lambda record: seen.append(record)
    handler.addFilter(MaskingFilter())
    log.addHandler(handler)
    log.propagate = False
    try:
        raise ValueError("S1234567A")
    except ValueError:
        log.exception("id %s of %s", "S7654321B", "TAN", extra={"claimant_name": "TAN"})
    r = seen[0]
    assert r.getMessage() == f"id {MASK} of {MASK}" and r.claimant_name == MASK and "S1234567A" not in r.exc_text and r.exc_info is None
    install_masking("masked")
    install_masking("masked")
    assert sum(isinstance(f, MaskingFilter) for f in handler.filters) == 1


def test_offsets_and_overlaps_against_plain_python(spark):
    rng = random.Random(2)
    pages = [["".join(rng.choice("ab 😀é") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(1, 7))] for _ in range(60)]
    rows = spark.createDataFrame([(i, [(k, t) for k, t in enumerate(p)]) for i, p in enumerate(pages)], "i int, lines array<struct<line_index:int,text:string>>")
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    got = rows.select("i", with_offsets(F.col("lines")).alias("s"), first_match(text, r"b[^a]*a", 0).alias("m")).select("i", "s", "m", F.transform(overlapping(F.col("s"), F.col("m.start"), F.col("m.end")), lambda s: s["line_index"]).alias("o")).collect()
    import re

    for r in got:
        lines, at, spans = pages[r["i"]], 0, []
        for t in lines:
            spans.append((at, at + len(t)))
            at += len(t) + 1
        assert [(s["start"], s["end"]) for s in r["s"]] == spans
        m = re.search(r"b[^a]*a", "\n".join(lines), re.I)
        assert (r["m"] is None) == (m is None)
        if m:
            assert (r["m"]["start"], r["m"]["end"], r["m"]["value"]) == (m.start(), m.end(), m[0].strip())
            assert r["o"] == [k for k, (s, e) in enumerate(spans) if s < m.end() and e > m.start()]


def test_code_version(tmp_path, monkeypatch):
    from pagemill.version import code_version

    monkeypatch.delenv("PAGEMILL_VERSION", raising=False)
    assert code_version(tmp_path) == "unknown"
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git/HEAD").write_text("ref: refs/heads/main\n")
    (tmp_path / ".git/packed-refs").write_text("# pack\nabc refs/heads/main\n")
    assert code_version(tmp_path) == "abc"
    (tmp_path / ".git/HEAD").write_text("def\n")
    assert code_version(tmp_path) == "def"
    (tmp_path / "VERSION").write_text("1.2\n")
    assert code_version(tmp_path) == "1.2"
    monkeypatch.setenv("PAGEMILL_VERSION", "9")
    assert code_version(tmp_path) == "9"


def test_first_match_beside_characters_of_two_halves(spark):
    """Places are code points wherever such characters stand; a text without what a pattern needs has no match."""
    rows = spark.createDataFrame([("ab 12?",), ("\U0001f600b 12?",), ("12? \U0001f600",), ("12",), ("",), (None,)], "text string")
    found = rows.select(first_match(F.col("text"), r"(\d+)\?", 1).alias("m")).collect()
    assert [r["m"] and (r["m"]["start"], r["m"]["end"], r["m"]["value"]) for r in found] == [(3, 6, "12"), (3, 6, "12"), (0, 3, "12"), None, None, None]


def test_required_characters():
    assert required(r"([^\n]*\?)") == ["?"] and required(r"(?:a\.)+x(\(\d\))?") == ["."]
    assert required(r"\?|b") == required(r"\?*") == required(r"(?!\?)a") == required(r"[?]?x") == []


def test_a_pattern_of_quadratic_cost_is_not_tried_in_vain(spark):
    """Long lines without the question mark that the pattern ends with."""
    rows = spark.range(40).select(F.repeat(F.concat(F.lit("no question "), F.col("id").cast("string")), 15_000).alias("text"))
    begun = time.monotonic()
    assert rows.where(first_match(F.col("text"), r"([^\n]*\?)", 1).isNotNull()).count() == 0
    assert time.monotonic() - begun < 20


def test_masking_where_only_some_texts_have_values(spark):
    """Every spelling that the rules take passes the search for what they have in common."""
    texts = ["D.O.B 1.1.90", "do.b: x", "d.ob y", "DOB=z", "Birth  Date 1", "date of BİRTH: 2", "date of bırth: 2", "CLAIMANT_name: Q", "claımant_name: Q", "S1234567D", "S١234567D", "١" * 9, "1" * 13, "none", "", None]
    want = spark.createDataFrame([(t,) for t in texts], "text string")
    plain = F.col("text")
    for p in LABELLED:
        plain = F.regexp_replace(plain, "(?U)" + p, "$1[REDACTED]")
    for p in BARE:
        plain = F.regexp_replace(plain, "(?U)" + p, "[REDACTED]")
    assert all(a == b for a, b in want.select(mask(F.col("text")), plain).collect())


def test_first_match_whose_text_stands_before_it(spark):
    """Or after it, or is long: the place is the match's own."""
    long = "Name: " + "y" * 1500
    rows = spark.createDataFrame([("xName: A\nName: A",), ("Name: A\nName: A",), ("Name: aName: a",), (f"x{long}\n{long}\n{long}",), ("\U0001f600Name: A\nName: A",)], "text string")
    found = rows.select(first_match(F.col("text"), r"^Name: (\w+)", 1).alias("m")).collect()
    assert [(r["m"]["start"], r["m"]["end"]) for r in found] == [(9, 16), (0, 7), (0, 11), (1508, 3014), (9, 16)]


def test_plain_values_are_not_changed(spark):
    texts = ["", " ", "a", "a b", " a", "a ", "a  b", "a\tb", "a\n", "\na", "a\u00a0b", "\u3000a", "é", "é é ", "~!", "a \u2028", "x" * 5000, "x " * 3000, None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(strip(F.col("t")).alias("a"), stripped(F.col("t")).alias("b"), collapse(F.col("t")).alias("c"), collapsed(F.col("t")).alias("d"))
    assert all((r["a"], r["c"]) == (r["b"], r["d"]) for r in rows.collect())


def test_a_value_is_computed_once(spark):
    """However often and deeply it is used, and null values are values."""
    once = let(F.uuid(), lambda u: let(F.concat(u, F.lit("!")), lambda v: F.struct((v == F.concat(u, F.lit("!"))).alias("same"), (u == u).alias("it"))))
    assert [tuple(r["x"]) for r in spark.range(5).select(once.alias("x")).collect()] == [(True, True)] * 5
    assert spark.range(1).select(let(F.lit(None).cast("string"), lambda x: F.coalesce(x, F.lit("none")))).first()[0] == "none"
