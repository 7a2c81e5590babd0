"""Best-fit-decreasing packing of tokenised documents into sequences.

Best fit decreasing looks only at lengths, and there are at most ``capacity`` of them.  The
counts of pieces per length therefore settle the whole packing: ``best_fit_decreasing`` runs it
exactly on those counts, with a segment tree over remaining capacities that finds the tightest
open bin in logarithmic time, and treats bins with equal room as runs.  The executors tokenise,
rank pieces of equal length and look their bin up in the resulting table of rank ranges.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table


class CapacityTree:
    """Segment tree over remaining capacities 0..size-1; a leaf is set while it has open bins."""

    def __init__(self, size: int):
        self.leaves = 1 << max(1, (size - 1).bit_length())
        self.any = bytearray(2 * self.leaves)

    def set(self, at: int, open_: bool) -> None:
        at += self.leaves
        self.any[at] = open_
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def first_at_least(self, at: int) -> int | None:
        """The smallest capacity >= ``at`` that has an open bin."""
        at += self.leaves
        while not self.any[at]:
            while at & 1:  # a right child: nothing further right below this parent
                at //= 2
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:  # wrapped to the next level
                return None
        while at < self.leaves:
            at = 2 * at + (not self.any[2 * at])
        return at - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, first bin, pieces a bin, offset) and the number of bins.

    The piece of rank q of its length lies in bin ``first bin + (q - first rank) // pieces`` at
    ``offset + (q - first rank) % pieces * length``.  A run ends where the next one of its
    length begins.  Two runs a length can split a run of bins, so their number depends on the
    capacity alone, not on the number of pieces.
    """
    tree = CapacityTree(capacity + 1)
    open_: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]
    runs: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def give(room: int, lo: int, hi: int) -> None:
        if room and lo < hi:
            open_[room].append((lo, hi))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = tree.first_at_least(length)
            if room is None:
                room = capacity
                new = -(-left // (capacity // length))
                lo, hi = bins, bins + new
                bins += new
            else:
                lo, hi = open_[room].popleft()
                tree.set(room, bool(open_[room]))
            per = room // length
            full = min(hi - lo, left // per)
            if full:
                runs.append((length, rank, lo, per, capacity - room))
                rank, left = rank + full * per, left - full * per
                give(room - per * length, lo, lo + full)
            elif left:
                runs.append((length, rank, lo, left, capacity - room))
                give(room - left * length, lo, lo + 1)
                rank, left, full = rank + left, 0, 1
            if lo + full < hi and room < capacity:  # the rest keep their place at the head
                open_[room].appendleft((lo + full, hi))
                tree.set(room, True)
            elif lo + full < hi:  # of bins just opened only the last can be partly filled
                if left:
                    runs.append((length, rank, lo + full, left, 0))
                    give(room - left * length, lo + full, hi)
                    left = 0
    return runs, bins


def added_tokens(path: str) -> dict[str, int]:
    """Tokens that a ``tokenizers`` file matches in the text before anything else, and their ids."""
    with open(path, "rb") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in tokens):
        raise ValueError("an added token takes in what stands around it")
    return {t["content"]: t["id"] for t in tokens}


@lru_cache(maxsize=4)
def _encoder(name: str, pattern: str, added: tuple[tuple[str, int], ...]):
    import tiktoken

    with open(name, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


def tokenised_pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 2048, end_id: int = 0, added: dict[str, int] | None = None) -> DataFrame:
    """Pieces of every document: pid, doc_id, piece, start, length, ids_crc32, rank.

    ``vocabulary`` is a file of byte-pair ranks and ``pattern`` its pre-token rule.  Strings of
    ``added`` have the id given there wherever they stand in a text.  Every
    document gets ``end_id`` at its end, so null and empty texts are one piece of length 1.
    Documents of more than ``capacity`` ids are cut so that only the first piece may be shorter.
    ``rank`` counts pieces of equal length within the task ``pid``.
    """
    schema = "pid int, doc_id long, piece int, start long, length long, ids_crc32 long, rank long"
    names = [f.split()[0] for f in schema.split(", ")]
    extra = tuple(sorted((added or {}).items()))
    types = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pid = _encoder(vocabulary, pattern, extra), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "", allowed_special="all", disallowed_special=())
                ids.append(end_id)
                n, raw = len(ids), np.array(ids, "<u4").tobytes()
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    out.append((pid, doc_id, piece, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), seen[b - a]))
                    seen[b - a] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to tokenised pieces.

    An empty table stays empty; equal pieces are separate pieces.  The pieces are written to the
    shared folder first, since ranks given by tasks must not change afterwards.
    """
    pieces = materialise(pieces)
    held = pieces.groupBy("pid", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    runs, _ = best_fit_decreasing(counts, capacity)
    runs.sort()
    length, rank, bin_, per, offset = np.array(runs, np.int64).reshape(-1, 5).T
    key = (length << 48) + rank
    plan = pieces.sparkSession.sparkContext.broadcast((key, rank, bin_, per, offset))

    @F.pandas_udf("sequence_id long, offset long")
    def locate(size: pd.Series, at: pd.Series) -> pd.DataFrame:
        key, rank, bin_, per, offset = plan.value
        size, at = size.to_numpy(), at.to_numpy()
        run = np.searchsorted(key, (size << 48) + at, side="right") - 1
        step = at - rank[run]
        return pd.DataFrame({"sequence_id": bin_[run] + step // per[run], "offset": offset[run] + step % per[run] * size})

    placed = pieces.join(starts, ["pid", "length"]).withColumn("_at", locate("length", F.col("rank") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    import public_tokenizers

    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack(tokenised_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, capacity, added=added), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return pack_documents(read_table(spark, sf_dir, "documents"), 2048)
