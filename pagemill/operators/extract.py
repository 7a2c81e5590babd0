"""Field extraction with rule packs."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import FLAGS, first_match, join_lines, let, overlapping, stripped, with_offsets
from ..functions.validate import validate_field

# --- fixed values: value patterns -------------------------------------------------------------
TEXT = r"(?![^\n]*:[ \t]*$)[^\n]*[^\s:]"  # the rest of a line that is no label itself
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|sept|oct|nov|dec)[a-z]*\.?"
DATE = rf"(?:\d{{1,2}}[/.\-]\d{{1,2}}[/.\-]\d{{2,4}}|\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}[ \t\-]+{_MONTH},?[ \t\-]+\d{{4}}|{_MONTH}[ \t]+\d{{1,2}},?[ \t]+\d{{4}})"
TIME = r"\d{1,2}:\d{2}(?::\d{2})?(?:[ \t]*[ap]\.?m\.?)?"
DATETIME = rf"{DATE}(?:[ \t]*(?:T|,|at)?[ \t]*{TIME})?"
_CURRENCY = r"(?:[A-Z]{1,3}\$|SGD|MYR|RM|PHP|USD|VND|₱|₫|\$)"
AMOUNT = rf"(?:{_CURRENCY}[ \t]*)?-?\d[\d,]*(?:\.\d+)?(?:[ \t]*{_CURRENCY})?"
NUMBER = r"-?\d+(?:\.\d+)?"
ICD10 = r"[A-Z]\d{2}(?:\.[0-9A-Z]{1,4})?"
EXCLUDED_LINE = r"fullerton\s+health"


@dataclass(frozen=True)
class Rule:
    """A field, the type of its value, and a pattern whose first group that took part is the value."""

    field: str
    value_type: str
    pattern: str

    @property
    def groups(self) -> int:
        return re.compile(self.pattern).groups


def beside(value: str, *labels: str) -> str:
    """A line that opens with one of the labels; ``value`` follows its colon, there or on the next line, or fills the next line.

    A label is words, which blanks hold apart; a ``~`` allows blanks and does not ask for any.
    """
    gap, maybe = r"[ \t]+", r"[ \t]*"
    opening = "|".join(maybe.join(gap.join(words.split()) for words in label.split("~")) for label in labels)
    return rf"^{maybe}(?:{opening}){maybe}(?::{maybe}\n?|\n){maybe}({value})"


# --- fixed values: labels and rules by document type -------------------------------------------
# a look at the next character stands before a word's edge, which the JVM's engine takes long to tell
_NAME = beside(TEXT, "Patient's Name", "Patient Name", "Name of Patient", "Claimant Name", "Claimant", "Member Name", "Employee Name", "Re:~Patient", "Patient", "Name")
_ADDRESS = beside(TEXT, "Address", "Home Address", "Residential Address", "Mailing Address", "Patient Address")
_BIRTH = beside(DATE, "Date of Birth", "Birth Date", r"D\.?O\.?B\.?")
_PROVIDER = beside(TEXT, "Referring Provider", "Referring Clinic", "Provider Name", "Provider", "Clinic Name", "Issuing Clinic", "Issued by")
_RATE = r"(?:~@?~\(?~\d+(?:\.\d+)?~%~\)?)?"
_INCLUDING = r"(?:~\((?:incl|including)[^)\n]*\))?"
RULES: dict[str, tuple[Rule, ...]] = {
    "referral_letter": (
        Rule("claimant_name", "text", _NAME),
        Rule("provider_name", "text", _PROVIDER),
        Rule("signature_presence", "bool", r"(?=s)\bsignature\b|\[signed\]"),
        Rule("total_amount_paid", "amount", beside(AMOUNT, "Total Amount Paid", "Total Paid", "Amount Paid", "Paid Amount")),
        Rule("total_approved_amount", "amount", beside(AMOUNT, "Total Approved Amount", "Total Amount Approved", "Approved Amount", "Amount Approved")),
        Rule("total_requested_amount", "amount", beside(AMOUNT, "Total Requested Amount", "Total Amount Requested", "Requested Amount", "Amount Requested")),
    ),
    "medical_certificate": (
        Rule("claimant_name", "text", _NAME),
        Rule("claimant_address", "text", _ADDRESS),
        Rule("claimant_date_of_birth", "date", _BIRTH),
        Rule("diagnosis_name", "text", beside(TEXT, "Diagnosis", "Provisional Diagnosis", "Final Diagnosis", "Primary Diagnosis")),
        Rule("discharge_date_time", "datetime", beside(DATETIME, "Discharge Date~(?:/|&|and)~Time", "Date~/~Time of Discharge", "Discharge Date", "Discharged on", "Discharged at")),
        Rule("icd_code", "text", beside(ICD10, "ICD(?:~-?~10)?", "ICD(?:~-?~10)? Code", "Diagnosis Code")),
        Rule("provider_name", "text", _PROVIDER),
        Rule("submission_date_time", "datetime", beside(DATETIME, "Submission Date~(?:/|&|and)~Time", "Date~/~Time of Submission", "Submission Date", "Submitted on", "Submitted at")),
        Rule("date_of_mc", "date", beside(DATE, "Date of MC", "MC Date", "Date of Medical Certificate", "Date of Issue", "Issue Date", "Date Issued")),
        Rule(
            "mc_days", "int",
            beside(NUMBER, "MC Days", r"No\.? of Days", "Number of Days", "Days of MC", "Days of Medical Leave", "Days of Sick Leave")
            + rf"|(?=p)\bperiod[ \t]+of[ \t]+({NUMBER})[ \t]*(?:\(\w+\)[ \t]*)?day|(?=[-\d])\b({NUMBER})[ \t]*day(?:\(s\)|s)?[ \t]+(?:of[ \t]+)?(?:medical|sick)[ \t]+leave",
        ),
    ),
    "receipt": (
        Rule("claimant_name", "text", _NAME),
        Rule("claimant_address", "text", _ADDRESS),
        Rule("claimant_date_of_birth", "date", _BIRTH),
        Rule("provider_name", "text", _PROVIDER),
        Rule("tax_amount", "amount", beside(AMOUNT, *(f"(?:GST|VAT|SST|Tax){more}{_RATE}" for more in ("", " Amount")))),
        Rule("total_amount", "amount", beside(AMOUNT, *(f"{whose}Total{what}{when}{_INCLUDING}" for whose in ("", "Grand ", "Net ", "Nett ") for what in ("", " Amount") for when in ("", " Payable", " Due")), "Amount Due", "Amount Payable")),
    ),
}
#: A field that falls back to the first line with text of the first page.
LETTERHEAD_FIELD = "provider_name"


HIT = "struct<page_number:int,value:string,line_indexes:array<int>>"


def _readable(lines: Column) -> Column:
    """struct<text, spans> of a page."""
    return F.struct(join_lines(lines).alias("text"), with_offsets(lines).alias("spans"))


def _hit(page: Column, rule: Rule) -> Column:
    """struct<value, line_indexes> of a rule's match in a readable page, or null."""

    def located(m: Column) -> Column:
        at = F.transform(overlapping(page["spans"], m["start"], m["end"]), lambda s: s["line_index"])
        return F.when(m.isNotNull(), F.struct(m["value"].alias("value"), at.alias("line_indexes")))

    return let(first_match(page["text"], rule.pattern, rule.groups), located)


def page_matches(lines: Column, rules: tuple[Rule, ...], names: list[str]) -> Column:
    """struct of a struct<value, line_indexes> or null for each of the ``names`` of fields; all in one projection."""

    def found(page: Column) -> Column:
        hits = {rule.field: _hit(page, rule) for rule in reversed(rules)}  # of two rules of a field the first counts
        return F.struct(*(hits.get(name, F.lit(None).cast("struct<value:string,line_indexes:array<int>>")).alias(name) for name in names))

    return let(_readable(lines), found)


def _letterhead(lines: Column) -> Column:
    """First line with text that does not name the network; mostly one of the first few."""
    fit = lambda some: F.get(F.filter(some, lambda x: (stripped(x["text"]) != "") & ~x["text"].rlike(FLAGS + EXCLUDED_LINE)), F.lit(0))
    line = F.coalesce(fit(F.slice(lines, 1, 3)), fit(lines))
    return let(line, lambda x: F.when(x.isNotNull(), F.struct(stripped(x["text"]).alias("value"), F.array(x["line_index"]).alias("line_indexes"))))


def _placed(number: Column, found: Column) -> Column:
    return F.struct(number.cast("int").alias("page_number"), found["value"].alias("value"), found["line_indexes"].alias("line_indexes"))


def _by_type(of: dict[str, Column]) -> Column:
    """The column of the row's document_type."""
    (name, first), *rest = of.items()
    return reduce(lambda chosen, kv: chosen.when(F.col("document_type") == kv[0], kv[1]), rest, F.when(F.col("document_type") == name, first))


def _fields(pack: tuple[Rule, ...], hits: list[Column]) -> Column:
    """Array of the fields of a pack, each with its hit or none."""
    return F.array(*(F.struct(F.lit(r.field).alias("field_name"), F.lit(r.value_type).alias("value_type"), h.alias("hit")) for r, h in zip(pack, hits, strict=True)))


def _dense(documents: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """One row per document and field of its type, validated."""
    long = documents.select("document_id", "document_type", F.explode(_by_type(fields)).alias("r"))
    found = long.select("document_id", "document_type", "r.field_name", "r.value_type", F.col("r.hit.value").alias("raw_value"), F.col("r.hit.page_number").alias("page_number"), F.coalesce("r.hit.line_indexes", F.array().cast("array<int>")).alias("line_indexes"))
    return found.withColumn("_v", validate_field(F.col("field_name"), F.col("value_type"), F.col("raw_value"))).select(*found.columns, "_v.*")


def document_fields(documents: DataFrame, rules: dict[str, tuple[Rule, ...]] = RULES) -> DataFrame:
    """What ``extract_fields`` gives, with the document_type, for documents that hold their pages; rows stay where they lie.

    documents: document_id, document_type, pages (array of page_number and lines, in order).  A page
    is searched for those fields only that no page before it has.
    """

    def hit(pages: Column, rule: Rule) -> Column:
        on = lambda page: let(_hit(page, rule), lambda h: F.when(h.isNotNull(), _placed(page["page_number"], h)))
        return F.aggregate(pages, F.lit(None).cast(HIT), lambda found, page: F.coalesce(found, on(page)))

    def pack_of(name: str) -> Column:
        def each(pages: Column) -> Column:
            hits = {rule.field: hit(pages, rule) for rule in reversed(rules[name])}
            if LETTERHEAD_FIELD in hits:
                head = let(_letterhead(F.col("pages")[0]["lines"]), lambda h: F.when(h.isNotNull(), _placed(F.col("pages")[0]["page_number"], h)))
                hits[LETTERHEAD_FIELD] = F.coalesce(hits[LETTERHEAD_FIELD], head)
            return _fields(rules[name], [hits[rule.field] for rule in rules[name]])

        readable = F.transform("pages", lambda p: F.struct(p["page_number"].alias("page_number"), *(_readable(p["lines"])[x].alias(x) for x in ("text", "spans"))))
        return F.when(F.size("pages") > 0, let(readable, each))

    filled = documents.select("document_id", "document_type", F.filter("pages", lambda p: F.size(p["lines"]) > 0).alias("pages"))
    return _dense(filled, {name: pack_of(name) for name in rules})


def extract_fields(pages: DataFrame, types: DataFrame, rules: dict[str, tuple[Rule, ...]] = RULES) -> DataFrame:
    """One row per document and field of its type, missing ones too.

    pages: document_id, page_number, lines (array of line_index and text, in order); types:
    document_id, document_type.  The first page with a match counts.  Pages without lines do not
    exist here, so the first page is the first with lines.  Returns document_id, field_name,
    value_type, raw_value, page_number and line_indexes of the source, validation_status,
    normalised_value and validation_message.
    """
    typed = pages.where(F.size("lines") > 0).join(types.select("document_id", "document_type"), "document_id").where(F.col("document_type").isin(*rules))
    names = list(dict.fromkeys(rule.field for pack in rules.values() for rule in pack))
    matches = _by_type({name: page_matches(F.col("lines"), pack, names) for name, pack in rules.items()})
    per_page = typed.select("document_id", "document_type", "page_number", matches.alias("hits"), _letterhead(F.col("lines")).alias("head"))
    # the first page with a match counts: one struct a field, combined before the shuffle
    hit = lambda field: F.col("hits")[field]
    best = per_page.groupBy("document_id", "document_type").agg(
        F.min_by(F.when(F.col("head").isNotNull(), _placed(F.col("page_number"), F.col("head"))), "page_number").alias("head"),
        *(F.min_by(_placed(F.col("page_number"), hit(field)), F.when(hit(field).isNotNull(), F.col("page_number"))).alias(f"hit_{field}") for field in names),
    )
    best_of = lambda field: F.coalesce(f"hit_{field}", "head") if field == LETTERHEAD_FIELD else F.col(f"hit_{field}")
    return _dense(best, {name: _fields(pack, [best_of(r.field) for r in pack]) for name, pack in rules.items()}).drop("document_type")
