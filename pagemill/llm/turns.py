"""Repair of conversation structure by a min-plus matrix scan.

A repaired conversation is empty or an optional system message and then pairs of user and
assistant, a language of four states.  Each turn becomes a 4 x 4 matrix whose element (i, j) is the
cheapest way from state i to state j over it, as (cost, audit): kept, given another role, deleted,
with any messages inserted before and after (the insert closure).  Elements are added by taking the
lesser and multiplied by adding costs and joining audits; costs follow from the audits' letters, so
of equal costs none is the beginning of another, and the product is associative and keeps the order.

So conversations need not be in one place: turns are dealt out in ranges of (conversation, turn),
blocks of at most 2 ** ``BLOCK`` rows are multiplied where they lie, and the blocks of long
conversations in a tree.  The cheapest audit is then cut into the blocks' pieces, and every
block writes its own messages.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, read_table

#: Blocks have 2 ** BLOCK rows at most, and 2 ** FAN of them are multiplied at once.
BLOCK, FAN = 10, 6
#: Bits of a row's number within its partition.
_PLACES = 33
DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: (state, initial of a role) -> state; start, after system, after user, after assistant.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
LEGAL = frozenset(("su", "ua", "au"))
WRITTEN = {"u": "user", "a": "assistant", "s": "system"}

Element = tuple[int, str] | None
Matrix = tuple[tuple[Element, ...], ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b, strict=True))

    def cell(row: tuple[Element, ...], column: tuple[Element, ...]) -> Element:
        ways = [(x, y) for x, y in zip(row, column, strict=True) if x is not None and y is not None]
        if not ways:
            return None
        least = min(x[0] + y[0] for x, y in ways)
        return least, min(x[1] + y[1] for x, y in ways if x[0] + y[0] == least)

    return tuple(tuple(cell(row, column) for column in columns) for row in a)


def least(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min((e for e in pair if e is not None), default=None) for pair in zip(r, s, strict=True)) for r, s in zip(a, b, strict=True))


def _matrix(ways: list[tuple[int, int, Element]]) -> Matrix:
    return tuple(tuple(min((e for i, j, e in ways if (i, j) == (row, column)), default=None) for column in range(4)) for row in range(4))


ONE = _matrix([(i, i, (0, "")) for i in range(4)])


def closure() -> Matrix:
    """Any number of inserted messages; more of them than it takes to reach a state never pay."""
    once = _matrix([(i, j, (INSERT, "I")) for (i, r), j in STEPS.items() if r in "ua"])
    out = ONE
    while (more := least(ONE, times(out, once))) != out:
        out = more
    return out


CLOSURE = closure()


def power(m: Matrix, n: int) -> Matrix:
    out = ONE
    while n:
        out, m, n = times(out, m) if n & 1 else out, times(m, m) if n > 1 else m, n >> 1
    return out


@lru_cache(maxsize=4096)
def turn_matrix(initial: str, goes: bool, truncated: bool, copies: int = 1) -> Matrix:
    """A turn and its further ``copies``, which are deleted."""
    gone = [(i, i, (DELETE, "D")) for i in range(4)]
    ways, extra = list(gone), TRUNCATED if truncated else 0
    if not goes:
        ways += [(i, STEPS[i, initial], (extra, "K")) for i in range(4) if (i, initial) in STEPS]
        ways += [(i, STEPS[i, r], (REROLE + extra, "R")) for i in range(4) for r in "ua" if (i, r) in STEPS]
    between = lambda w: times(times(CLOSURE, _matrix(w)), CLOSURE)
    return between(ways) if copies == 1 else times(between(ways), power(between(gone), copies - 1))


@lru_cache(maxsize=4096)
def _short(kinds: tuple) -> Matrix:
    return turn_matrix(*kinds[0]) if len(kinds) == 1 else times(_short(kinds[: len(kinds) // 2]), _short(kinds[len(kinds) // 2 :]))


def product(kinds: tuple) -> Matrix:
    """Of turns (initial, goes, truncated, copies), in a tree."""
    return _short(kinds) if len(kinds) <= 16 else times(product(kinds[: len(kinds) // 2]), product(kinds[len(kinds) // 2 :]))


def cheapest(m: Matrix) -> tuple[int, str]:
    return min(e for j in ENDS if (e := m[0][j]) is not None)


@dataclass
class Summary:
    """What is known of consecutive rows of a conversation; ``+`` puts two side by side."""

    m: Matrix
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    lead: str
    last: str
    low: int | None
    high: int | None
    turns: int
    blocks: list[int]
    letters: list[int]

    def __add__(self, other: Summary) -> Summary:
        both = self.turns + other.turns - (self.high is not None and self.high == other.low)
        seam = self.last + other.lead not in LEGAL
        first = lambda a, b: b if a is None else a
        return Summary(
            times(self.m, other.m), self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated, self.illegal + other.illegal + seam, self.lead, other.last,
            first(self.low, other.low), first(other.high, self.high), both, self.blocks + other.blocks, self.letters + other.letters,
        )

    def row(self) -> list:
        cells = [e for r in self.m for e in r]
        return [
            [None if e is None else e[0] for e in cells], [None if e is None else e[1] for e in cells], self.blank, self.duplicate, self.truncated, self.illegal, self.lead, self.last, self.low, self.high, self.turns, self.blocks, self.letters,
        ]

    @classmethod
    def of(cls, row: dict) -> Summary:
        cells = [None if c is None else (c, a) for c, a in zip(row["costs"], row["audits"], strict=True)]
        return cls(tuple(tuple(cells[i : i + 4]) for i in range(0, 16, 4)), *(row[c] for c in _COUNTS))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "lead", "last", "low", "high", "turns", "blocks", "letters")
_SUMMARY = "costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, lead string, last string, low long, high long, turns long, blocks array<long>, letters array<long>"
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("digest", pa.binary()), ("copies", pa.int64())]))
_TYPES = [pa.list_(pa.int64()), pa.list_(pa.string()), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = ["costs", "audits", *_COUNTS]


def _batch(rows: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(names), types, strict=True)], names)


def _grouped(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of equal keys, which lie side by side."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            k = tuple(row[c] for c in key)
            if k != at and held:
                yield at, held
                held = []
            at = k
            held.append(row)
    if held:
        yield at, held


def _in_batches(rows: Iterator[list], names: list[str], types: list[pa.DataType], size: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, names, types)
            held = []
    yield _batch(held, names, types)


def _block(rows: list[dict], number: int) -> Summary:
    """Rows of one conversation in order; each stands for all of its copies."""
    kinds, counts, illegal, initials = [], [0, 0, 0], 0, []
    for r in rows:
        initial, blank, again = r["role"][:1], r["blank"], not r["blank"] and not r["first"]
        truncated = not blank and not again and r["truncated"]
        kinds.append((initial if initial in WRITTEN else "", blank or again, truncated, r["copies"]))
        counts = [c + n for c, n in zip(counts, (r["copies"] * blank, (r["copies"] - (not again)) * (not blank), truncated), strict=True)]
        illegal += (r["copies"] - 1) * (initial + initial not in LEGAL)
        initials.append(initial)
    illegal += sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    ends = (turns[0], turns[-1]) if turns else (None, None)
    return Summary(product(tuple(kinds)), *counts, illegal, initials[0], initials[-1], *ends, len(set(turns)), [number], [sum(r["copies"] for r in rows)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of a range, each with its rows and their summary."""

    def blocks() -> Iterator[list]:
        for (k, block), rows in _grouped(batches, "k", "block"):
            yield [k, block, [{c: r[c] for c in ("role", "digest", "copies")} for r in rows], *_block(rows, block).row()]

    return _in_batches(blocks(), ["k", "block", "rows", *_NAMES], [pa.string(), pa.int64(), _ROWS, *_TYPES])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged() -> Iterator[list]:
        for (k, place), rows in _grouped(batches, "k", "place"):
            parts = [Summary.of(r) for r in rows]
            while len(parts) > 1:
                parts = [parts[i] + parts[i + 1] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            yield [k, place, *parts[0].row()]

    return _in_batches(merged(), ["k", "place", *_NAMES], [pa.string(), pa.int64(), *_TYPES], 64)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[list]:
        for batch in batches:
            for r in batch.to_pylist():
                s = Summary.of(r)
                gaps = 0 if s.low is None else s.high - s.low + 1 - s.turns
                yield [r["k"], gaps, s.blank, s.duplicate, s.truncated, s.illegal, *cheapest(s.m), s.blocks, s.letters]

    return _in_batches(rows(), ["k", *_REPORT, "blocks", "letters"], [pa.string(), *[pa.int64()] * 6, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())])


_REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's part of its conversation's audit, with the place of its first message."""

    def rows() -> Iterator[list]:
        for batch in batches:
            for r in batch.to_pylist():
                audit, at, place = r["audit"], 0, 0
                length = len(audit) - audit.count("D")
                for i, (block, n) in enumerate(zip(r["blocks"], r["letters"], strict=True)):
                    end = at
                    while n:
                        n -= audit[end] != "I"
                        end += 1
                    end = len(audit) if i + 1 == len(r["blocks"]) else end
                    yield [r["k"], block, audit[at:end], place, length % 2 == 1]
                    place += end - at - audit.count("D", at, end)
                    at = end

    return _in_batches(rows(), ["k", "block", "piece", "place", "system"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()])


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block keeps and inserts; inserted messages have no digest."""

    def rows() -> Iterator[list]:
        for batch in batches:
            for b in batch.to_pylist():
                turns, place = iter(b["rows"]), b["place"]
                turn, left = None, 0
                for letter in b["piece"]:
                    if letter != "I":
                        if not left:
                            turn = next(turns)
                            left = turn["copies"]
                        left -= 1
                    if letter == "D":
                        continue
                    new = WRITTEN["s" if b["system"] and not place else "ua"[(place - b["system"]) % 2]]
                    was = None if letter == "I" else turn["role"]
                    yield [b["k"], place, was if letter == "K" else new, was, None if letter == "I" else turn["digest"]]
                    place += 1

    return _in_batches(rows(), ["k", "place", "role", "was", "digest"], [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()], 8192)


@dataclass(frozen=True)
class Repaired:
    """report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation
    with rows; messages: conv_id, place (from 0), role, text of the repaired ones."""

    report: DataFrame
    messages: DataFrame


def _key(conv_id):
    return F.when(conv_id.isNull(), "n").otherwise(F.concat(F.lit("v"), conv_id.cast("string")))


def repair_conversations(turns: DataFrame, block: int = BLOCK, fan: int = FAN) -> Repaired:
    """Repairs conversations (conv_id, turn, role, text).

    Null roles and texts are one space, a null conv_id is a conversation like others, null turns
    come first.  Rows of one turn go by role and then by the digest of their text; repeated rows lie
    side by side, and all but the first are duplicates.  A row's first fault counts: blank (no
    character but white space), duplicate (role and text seen earlier), truncated (the last such
    character is none of ``.!?``).  Blank and duplicate rows are deleted.  Edits cost: another role 1,
    deletion 2, an inserted empty message 5, an undeleted truncated row 5; of the cheapest audits the
    ASCII-least counts.  Texts and conversations may be of any length that a column can hold (an
    audit is a string).  Other columns are not read; an empty table gives none.
    """
    kind = turns.schema["conv_id"].dataType
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(_key(F.col("conv_id")).alias("k"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"))
    ink = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    rows = rows.select("*", F.unhex(F.sha2("text", 256)).alias("digest"), (ink == "").alias("blank"), (~F.right(ink, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    known = materialise(rows.where("not blank").groupBy("k", "role", "digest").agg(F.bool_or(F.col("turn").isNull()).alias("early"), F.min("turn").alias("since"), F.any_value("text").alias("text")))
    light = rows.groupBy("k", "turn", "role", "digest", "blank", "truncated").agg(F.count("*").alias("copies"))
    light = light.join(known.select("k", "role", "digest", "early", "since"), ["k", "role", "digest"], "left")
    first = F.col("turn").isNull() | (~F.col("early") & (F.col("turn") == F.col("since")))
    light = light.select("k", "turn", "role", "digest", "copies", "blank", "truncated", F.coalesce(first, F.lit(False)).alias("first"))
    order = ("k", "turn", "role", "digest")
    dealt = light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("block", F.shiftright(F.monotonically_increasing_id(), block))
    blocks = materialise(dealt.mapInArrow(_cut, f"k string, block long, rows array<struct<role:string,digest:binary,copies:long>>, {_SUMMARY}"))

    done = materialise(_whole(blocks, _PLACES - block, fan).mapInArrow(_settle, "k string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, blocks array<long>, letters array<long>"))
    pieces = done.select("k", "audit", "blocks", "letters").mapInArrow(_pieces, "k string, block long, piece string, place long, system boolean")
    entries = blocks.select("k", "block", "rows").join(pieces, ["k", "block"]).select("k", "rows", "piece", "place", "system").mapInArrow(_messages, "k string, place long, role string, was string, digest binary")
    entries = materialise(entries)
    kept = entries.where("digest is not null").join(known.select("k", F.col("role").alias("was"), "digest", "text"), ["k", "was", "digest"]).select("k", "place", "role", "text")
    messages = kept.unionByName(entries.where("digest is null").select("k", "place", "role", F.lit("").alias("text")))
    named = F.when(F.col("k") != "n", F.expr("substring(k, 2)")).cast(kind).alias("conv_id")
    return Repaired(done.select(named, *_REPORT), messages.select(named, "place", "role", "text"))


def _whole(blocks: DataFrame, bits: int, fan: int) -> DataFrame:
    """One summary a conversation; ``bits`` of a block's number count within its partition.

    Blocks of a conversation are numbered without gaps, and 2 ** ``fan`` of them multiplied at once,
    until one is left.
    """
    part, within = F.shiftright("block", bits), F.col("block").bitwiseAND(F.lit((1 << bits) - 1))
    # a row for each partition
    sizes = blocks.groupBy(part.alias("part")).agg((F.max(within) + 1).alias("n")).orderBy("part").collect()
    starts = [(r["part"], sum(x["n"] for x in sizes[:i])) for i, r in enumerate(sizes)]
    starts = F.broadcast(blocks.sparkSession.createDataFrame(starts, "part long, start long"))
    numbered = blocks.withColumn("part", part).join(starts, "part").withColumn("number", F.col("start") + within)
    several = materialise(numbered.groupBy("k").agg(F.count("*").alias("n"), F.min("number").alias("origin")).where("n > 1").select("k", "origin"))
    single = blocks.join(several, "k", "left_anti").select("k", *_NAMES)
    left = numbered.join(several, "k").select("k", (F.col("number") - F.col("origin")).alias("place"), *_NAMES)
    while left.agg(F.max("place")).first()[0]:
        ordered = left.withColumn("within", F.col("place")).withColumn("place", F.shiftright("place", fan))
        merged = materialise(ordered.repartition("k", "place").sortWithinPartitions("k", "place", "within").drop("within").mapInArrow(_merge, f"k string, place long, {_SUMMARY}"))
        discard(left)
        left = merged
    return single.unionByName(left.drop("place"))


def message_digests(messages: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the ``role:text`` of all messages (conv_id, place, role, text), joined by line feeds.

    A digest is taken from first to last by its definition: a conversation's messages pass through
    one task in their order, of which it holds a batch.
    """
    kind = messages.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            at, digest = None, None
            for batch in batches:
                for k, role, text in zip(*(batch.column(c).to_pylist() for c in ("k", "role", "text")), strict=True):
                    if k != at:
                        if digest:
                            yield [at, digest.hexdigest()]
                        at, digest = k, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(f"{role}:{text}".encode())
            if digest:
                yield [at, digest.hexdigest()]

        return _in_batches(rows(), ["k", "sha256"], [pa.string(), pa.string()])

    ordered = messages.select(_key(F.col("conv_id")).alias("k"), "place", "role", "text").repartition("k").sortWithinPartitions("k", "place")
    found = ordered.select("k", "role", "text").mapInArrow(run, "k string, sha256 string")
    return found.select(F.when(F.col("k") != "n", F.expr("substring(k, 2)")).cast(kind).alias("conv_id"), "sha256")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn`` modulo 20, nulls being one space.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes it the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), case.alias("_case")).where("_case <> 0")
    text = F.when(F.col("_case") == 1, "").when(F.col("_case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("_case") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_case")
    return rows.unionByName(rows.where("_case = 3")).drop("_case")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = repair_conversations(damage(turns))
    every = turns.select("conv_id").distinct()
    same = lambda other: every["conv_id"].eqNullSafe(other["conv_id"])
    report, digests = fixed.report, message_digests(fixed.messages)
    joined = every.join(report, same(report), "left").join(digests, same(digests), "left")
    counts = (F.coalesce(report[c], F.lit(0)).cast("long").alias(c) for c in _REPORT[:-1])
    return joined.select(every["conv_id"], *counts, F.coalesce(report["audit"], F.lit("")).alias("audit"), F.coalesce(digests["sha256"], F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _more(state: str, cost: str, letter: str, line: str = "''") -> str:
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}} END"


def _least_of(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}], 'ASC', 'NULLS LAST')[1]"


def _closed(s0: str, s1: str, s2: str, s3: str) -> tuple[str, str]:
    """States 2 and 3 with inserted messages."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    after_user = _least_of(s2, *(_more(s, str(INSERT), "I", user) for s in (s0, s1, s3)))
    return after_user, _least_of(s3, *(_more(f"({w})", str(INSERT), "I", assistant) for w in (s2, *(_more(s, str(INSERT), "I", user) for s in (s0, s1)))))


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_OWN, _AS_USER, _AS_ASSISTANT = "chr(10) || role || ':' || text", "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN initial = '{initial}' AND NOT goes THEN {_more(state, 'extra', 'K', _OWN)} END"


def _reroled(state: str, line: str) -> str:
    return f"CASE WHEN NOT goes THEN {_more(state, f'extra + {REROLE}', 'R', line)} END"


#: The same by a walk over the turns, which carries the cheapest way to each state.
OP11_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), cased AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, [ord(c)::BIGINT for c in string_split(key, '')]),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS fate FROM keyed
), broken AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM cased, range(CASE fate WHEN 3 THEN 2 ELSE 1 END) WHERE fate <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n, rtrim(text, {_SPACE}) AS ink, substr(role, 1, 1) AS initial FROM broken
), judged AS (
  SELECT *, ink = '' AS blank, ink <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial NOT IN ('su', 'ua', 'au') AS odd FROM numbered
), faults AS (
  SELECT *, blank OR again AS goes, NOT blank AND NOT again AND right(ink, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
), turns AS (
  SELECT *, CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END AS extra FROM faults
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (odd) AS illegal FROM turns GROUP BY conv_id
), walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c INTEGER, a VARCHAR, t VARCHAR) AS s1, {{'c': {INSERT}, 'a': 'I', 't': chr(10) || 'user:'}} AS s2, {{'c': {2 * INSERT}, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s3 FROM counts
  UNION ALL
  SELECT conv_id, n, s0, s1, {_closed('s0', 's1', 's2', 's3')[0]}, {_closed('s0', 's1', 's2', 's3')[1]} FROM (
    SELECT w.conv_id, t.n, {_more('s0', str(DELETE), 'D')} AS s0, {_least_of(_more('s1', str(DELETE), 'D'), _kept('s0', 's'))} AS s1,
      {_least_of(_more('s2', str(DELETE), 'D'), *(f(s, *a) for s in ('s0', 's1', 's3') for f, a in ((_kept, ('u',)), (_reroled, (_AS_USER,)))))} AS s2,
      {_least_of(_more('s3', str(DELETE), 'D'), _kept('s2', 'a'), _reroled('s2', _AS_ASSISTANT))} AS s3
    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n + 1)
), ended AS (
  SELECT w.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, {_least_of('s0', 's3')} AS best FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.n
)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM k.conv_id"""
