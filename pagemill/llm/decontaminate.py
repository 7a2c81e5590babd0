"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against token windows.

Windows of n benchmark words are hashed; every window of a document is hashed the same way, all
at once per Arrow batch, looked up in the set, and a hit is verified on its bytes.  A benchmark
larger than ``block_windows`` windows is scanned in blocks, each broadcast by itself, so that the
size of what is broadcast is bounded whatever the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, numbered, read_table, unused, utf8_buffer, without

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# a word is a run of digits, letters and bytes beyond ASCII, after lower-casing
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, (64, 256), dtype=np.int64).astype(np.uint64) | np.uint64(1)
_TIMES = np.random.default_rng(21).integers(0, 1 << 63, 4096, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_STEP = 1 << 18


@dataclass
class Words:
    """Words of many texts: bytes in lower case, start, end and row of each word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = _WORD[data]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        begins[edge] = inside[1:-1][edge]  # words end with their text
        ends[edge - 1] = inside[1:-1][edge - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        low = _LOWER[data]
        return cls(low, start, end, np.searchsorted(offsets, start, side="right") - 1, _word_hashes(low, start, end))

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n words from each word on; the last n - 1 words have none."""
        m = len(self.hash) - n + 1
        total = np.zeros(max(m, 0), np.uint64)
        for j in range(n if m > 0 else 0):
            total += self.hash[j : j + m] * _TIMES[j % len(_TIMES)]
        return total ^ (total >> np.uint64(29))

    def key(self, at: int, n: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[at : at + n].tolist(), self.end[at : at + n].tolist(), strict=True))


def _word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.zeros(len(start), np.uint64)
    size = end - start
    for a in range(0, len(start), _STEP):  # so that memory does not grow with the text
        length = size[a : a + _STEP]
        first = np.concatenate(([0], np.cumsum(length)[:-1]))
        within = np.arange(length.sum()) - np.repeat(first, length)
        chars = low[np.repeat(start[a : a + _STEP], length) + within]
        out[a : a + _STEP] = np.add.reduceat(_RANDOM[within & 63, chars], first)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


@dataclass
class NgramSet:
    """Windows of benchmark items by their number of words."""

    n: int
    items: dict[int, dict[bytes, tuple[str, ...]]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)
    seen: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def build(cls, items: Iterator[tuple[object, str | None]], n: int) -> NgramSet:
        found: dict[int, dict[bytes, set[str]]] = {}
        hashes: dict[int, set[int]] = {}
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            words = Words.of(raw, np.array([0, len(raw)]))
            size = min(n, len(words.start))
            if size == 0:
                continue
            for at, h in enumerate(words.windows(size).tolist()):
                found.setdefault(size, {}).setdefault(words.key(at, size), set()).add("" if item_id is None else str(item_id))
                hashes.setdefault(size, set()).add(h)
        out = cls(n)
        for size, windows in found.items():
            out.items[size] = {k: tuple(sorted(v)) for k, v in windows.items()}
            out.hashes[size] = np.array(sorted(hashes[size]), np.uint64)
            out.seen[size] = np.zeros(1 << 22, bool)
            out.seen[size][out.hashes[size] >> np.uint64(42)] = True
        return out

    def scan(self, words: Words) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, number of words, items) of every window that occurs."""
        for size, hashes in self.hashes.items():
            h = words.windows(size)
            at = np.flatnonzero(self.seen[size][h >> np.uint64(42)])
            at = at[words.row[at] == words.row[at + size - 1]] if len(at) else at
            near = np.minimum(np.searchsorted(hashes, h[at]), len(hashes) - 1)
            for i in at[hashes[near] == h[at]].tolist():
                if items := self.items[size].get(words.key(i, size)):
                    yield i, size, items


def _remove(data: np.ndarray, words: Words, hit: np.ndarray, lo: int, hi: int) -> str:
    """The text between bytes lo and hi without the runs of hit words; a line break stands for each."""
    at = np.flatnonzero(hit)
    runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
    out, begin = [], lo
    for run in runs:
        out.append(data[begin : words.start[run[0]]].tobytes())
        begin = words.end[run[-1]]
    out.append(data[begin:hi].tobytes())
    return b"\n".join(out).decode("utf-8", "replace")


def _cleaned(text: str, ngrams: NgramSet) -> str:
    """Remove windows until none is left: taking a span out can bring two parts together."""
    while True:
        raw = np.frombuffer(text.encode(), np.uint8)
        words = Words.of(raw, np.array([0, len(raw)]))
        hit = np.zeros(len(words.start), bool)
        for at, size, _ in ngrams.scan(words):
            hit[at : at + size] = True
        if not hit.any():
            return text
        text = _remove(raw, words, hit, 0, len(raw))


def _scan_block(docs: DataFrame, ngrams: NgramSet, text: str, clean: bool, out: tuple[str, str, str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ngrams)
    names, (n_words_name, hit_name, items_name) = docs.columns, out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = shared.value
        for batch in batches:
            column = batch.column(names.index(text))
            data, offsets = utf8_buffer(column)
            words = Words.of(data, offsets)
            hit, items = np.zeros(len(words.start), bool), [set() for _ in range(len(batch))]
            for at, size, found in ngrams.scan(words):
                hit[at : at + size] = True
                items[words.row[at]].update(found)
            n_words = np.bincount(words.row, minlength=len(batch))
            rows_of = np.concatenate(([0], np.cumsum(n_words)))
            starts = [np.flatnonzero(hit[a:b]).tolist() if found else [] for a, b, found in zip(rows_of[:-1].tolist(), rows_of[1:].tolist(), items, strict=True)]
            if clean:
                kept = [_cleaned(t, ngrams) if found else t for t, found in zip(column.to_pylist(), items, strict=True)]
            out = [pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))]
            arrays = [pa.array(kept, pa.string()) if clean and c == text else batch.column(i) for i, c in enumerate(names)]
            yield pa.RecordBatch.from_arrays(arrays + out, [*names, n_words_name, hit_name, items_name])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return numbered(docs).mapInArrow(run, f"{types}, `{n_words_name}` long, `{hit_name}` array<int>, `{items_name}` array<string>")


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", clean: bool = False, block_windows: int = 500_000, names: tuple[str, str, str] = ("n_words", "n_hit", "items")) -> DataFrame:
    """Add ``names``: n_words, n_hit and items (array of item ids as sorted strings) to the documents.

    ``n_hit`` counts words inside any occurring window.  Items of fewer than n words are one
    window; null and empty items have none, and a null item_id is reported as an empty string.
    With ``clean`` the spans of hit words are taken out of ``text``, again until none is left;
    null texts stay null.  Columns of the input that are named like the added ones are replaced,
    others pass through.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    blocks = max(1, -(-max((size["b"] or 0) // 2, size["n"]) // block_windows))  # a word takes two bytes at least
    docs = without(docs, *names)
    ids, out = docs.columns, docs
    words, hit, found, hit0, found0 = unused(docs, "_words", "_hit", "_items", "_hit0", "_items0")
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        ngrams = NgramSet.build(((r["item_id"], r["text"]) for r in mine.toLocalIterator()), n)
        if k == 0:
            out = _scan_block(docs, ngrams, text, clean and blocks == 1, (words, hit, found))
        else:
            state = materialise(out.select(*(_column(c) for c in ids), F.col(hit).alias(hit0), F.col(found).alias(found0)))
            out = _scan_block(state, ngrams, text, False, (words, hit, found)).select(*(_column(c) for c in ids), words, F.array_union(hit0, hit).alias(hit), F.array_sort(F.array_union(found0, found)).alias(found))
    out = out.select(*(_column(c) for c in ids), F.col(words).alias(names[0]), F.size(hit).cast("long").alias(names[1]), F.col(found).alias(names[2]))
    clear = 0 if clean and blocks > 1 else blocks
    k = 0
    while clear < blocks:  # a span taken out for one block can bring words of another's window together
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        ngrams = NgramSet.build(((r["item_id"], r["text"]) for r in mine.toLocalIterator()), n)
        more = unused(out, "_words", "_hit", "_items")
        state = materialise(_scan_block(out, ngrams, text, True, tuple(more)))
        clear = clear + 1 if state.where(F.size(more[1]) > 0).isEmpty() else 0
        out, k = state.select(*(_column(c) for c in out.columns)), (k + 1) % blocks
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, windows of ten words."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read_table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') for i in range(1, greatest(len(w) - 9, 1) + 1)]) AS k FROM b WHERE len(w) > 0),
dw AS (SELECT doc_id, n, unnest([{{'i': i, 'k': array_to_string(w[i : i + n - 1], ' ')}} for i in range(1, len(w) - n + 2)]) AS x FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
h AS (SELECT dw.doc_id, dw.n, dw.x.i AS i, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.k = dw.x.k),
p AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)
"""
