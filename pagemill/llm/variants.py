"""One-wildcard variants of segments: dealing rows out by segment, linking and pairing within groups.

A segment of a fingerprint gives two rows, one for each half that may be exact; within a group of
one exact half the variants of the other half are indexed by sorting and joined on equality.
Groups emit a spanning forest of their links or the pairs across components; crowded ones are cut
into chunks of a fixed number of rows, and every pair of chunks meets in a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Rows of a unit of work, and of a chunk of a crowded group.
_ROWS, CROWD = 1 << 17, 1 << 16
_EPS = 1e-9


def majority(first: np.ndarray, lanes: int) -> np.ndarray:
    """Bit i of a lane is set if over half of the hashes have it; further lanes are mixed from the first."""
    hashes = np.empty((len(first), lanes), np.uint64)
    hashes[:, 0] = first
    for lane in range(1, lanes):
        z = first + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        hashes[:, lane] = z ^ (z >> np.uint64(31))
    total = np.zeros(64 * lanes, np.int64)
    for a in range(0, len(hashes), 255 * 64):  # sums of 255 rows fit a byte
        bits = np.unpackbits(hashes[a : a + 255 * 64].view(np.uint8), axis=1, bitorder="little")
        for b in range(0, len(bits), 255):
            total += np.add.reduce(bits[b : b + 255], axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)


@dataclass(frozen=True)
class Near:
    """When the sketches of two rows may be near, with their sizes.

    The first ``words`` longs may differ in ``bits`` bits.  The others hold the parity of a set's
    hashes in each of their bits; they differ in no more bits than the sets have members apart, so
    too many prove a Jaccard similarity below ``similarity``.  Sizes more than that apart prove it too.
    """

    words: int
    bits: int
    similarity: float | None = None

    def distance(self, sketch: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(sketch[a, : self.words] ^ sketch[b, : self.words]).sum(1, dtype=np.int64)

    def may(self, sketch: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good = self.distance(sketch, a, b) <= self.bits
        if (t := self.similarity) is not None:
            x, y = n[a], n[b]
            good &= np.minimum(x, y) >= t * np.maximum(x, y) - _EPS
            if sketch.shape[1] > self.words:
                apart = np.bitwise_count(sketch[a, self.words :] ^ sketch[b, self.words :]).sum(1, dtype=np.int64)
                good &= apart <= (1 - t) / (1 + t) * (x + y) + _EPS
        return good


class Links:
    """Union of linked rows of one batch of groups, and the pairs that made it (a spanning forest)."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.root = np.arange(n)
        self.pairs: list[tuple[int, int]] = []

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.root[a] != self.root[b]
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            if (x := self.find(i)) != (y := self.find(j)):
                self.parent[max(x, y)] = min(x, y)
                self.pairs.append((i, j))
        if apart.any():
            up = np.array(self.parent)
            while (up[up] != up).any():
                up = up[up]
            self.root = up


def _starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def meetings(group: np.ndarray, other: np.ndarray, wild: int, root) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose ``other`` is equal but for one of its ``wild`` bits.

    Runs of equal variants whose rows have one ``root()`` already are left out.
    """
    for bit in range(max(1, wild)):
        key = (group << 32) | (other & ~(1 << bit) if wild else other)
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(_starts(key)) if len(key) else np.zeros(0, np.int64)
        at, step = np.flatnonzero(key[:-1] == key[1:]), 1
        while len(at):
            if step & 15 == 1:
                now = root()[order]
                mixed = np.minimum.reduceat(now, begin) != np.maximum.reduceat(now, begin)
                at = at[np.repeat(mixed, np.diff(np.append(begin, len(key))))[at]]
                if not len(at):
                    break
            yield order[at], order[at + step]
            step += 1
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]


def linked(group: np.ndarray, other: np.ndarray, wild: int, sketch: np.ndarray, n: np.ndarray, near: Near) -> Links:
    """Rows of a group are linked where their variants meet and they may be near; closer ones first."""
    links = Links(len(group))
    for most in dict.fromkeys((near.bits // 2, near.bits)):
        band = Near(near.words, most, near.similarity)
        for a, b in meetings(group, other, wild, lambda: links.root):
            good = band.may(sketch, n, a, b)
            links.join(a[good], b[good])
    return links


def deal(nodes: DataFrame, width: int, crowd: int = CROWD) -> DataFrame:
    """Rows (key, other, node, n, sketch, comp) of nodes with ``segs``, integers of ``width`` bits.

    Each segment gives two rows: its low half as the key and the high half beside it, and the
    other way round.  With a width of 0 ``segs`` are keys as they stand.
    """
    low = width // 2
    if width:
        side = lambda k, exact, rest: F.struct((F.shiftleft(k.cast("long"), 32) + exact).alias("key"), rest.cast("int").alias("other"))
        parts = lambda v: (v.bitwiseAND(F.lit((1 << low) - 1)), F.shiftright(v, low))
        halves = F.flatten(F.transform("segs", lambda v, k: F.array(side(2 * k, *parts(v)), side(2 * k + 1, *parts(v)[::-1]))))
    else:
        halves = F.transform("segs", lambda v: F.struct(v.alias("key"), F.lit(0).alias("other")))
    columns = ["node", "n", "sketch", *(["comp"] if "comp" in nodes.columns else [])]
    dealt = nodes.select(*columns, F.explode(halves).alias("k")).select("k.key", "k.other", *columns)
    big = materialise(dealt.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > crowd).select("key", F.ceil(F.col("c") / crowd).cast("int").alias("chunks")))
    if crowded := big.count():
        own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
        meets = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: F.xxhash64("key", F.least(own, j), F.greatest(own, j)))
        keys = F.when(F.col("chunks").isNull(), F.array("key")).otherwise(meets)
        big = F.broadcast(big) if crowded <= 1 << 20 else big
        dealt = dealt.join(big, "key", "left").select("other", *columns, F.explode(keys).alias("key"))
    return dealt.select("key", "other", *columns)


def in_groups(dealt: DataFrame, task, schema: str) -> DataFrame:
    """``task`` of whole groups of one key: batches from a table and the number of each row's group."""

    def unit(t: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(_starts(t.column("key").to_numpy()))
        words = t.column("sketch").combine_chunks()
        sketch = words.flatten().to_numpy().view(np.uint64).reshape(len(t), -1)
        return task(t, group, t.column("other").to_numpy().astype(np.int64), sketch, t.column("n").to_numpy().astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if sum(map(len, held)) < _ROWS:
                continue
            t = pa.Table.from_batches(held)
            key = t.column("key").to_numpy()
            last = np.flatnonzero(key != key[-1])
            if len(last):  # the group that the batch ends in stays for the next
                yield from unit(t.slice(0, last[-1] + 1))
                held = t.slice(last[-1] + 1).to_batches()
        if held:
            yield from unit(pa.Table.from_batches(held))

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, schema)


def forest(dealt: DataFrame, width: int, near: Near) -> DataFrame:
    """Edges (u > v, d) that connect all rows of a group that may be near; d bits of their sketches differ."""
    wild = width - width // 2

    def task(t: pa.Table, group: np.ndarray, other: np.ndarray, sketch: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        pairs = np.array(linked(group, other, wild, sketch, n, near).pairs, np.int64).reshape(-1, 2)
        if len(pairs):
            a, b = pairs.T
            node = t.column("node").to_numpy()
            d = np.bitwise_count(sketch[a] ^ sketch[b]).sum(1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(node[a], node[b])), pa.array(np.minimum(node[a], node[b])), pa.array(d)], ["u", "v", "d"])

    return in_groups(dealt, task, "u long, v long, d int").groupBy("u", "v").agg(F.min("d").alias("d"))


def across(dealt: DataFrame, width: int, near: Near) -> DataFrame:
    """All pairs (u > v) of a group that may be near and lie in two components (``comp``)."""
    wild = width - width // 2

    def task(t: pa.Table, group: np.ndarray, other: np.ndarray, sketch: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        comp, node = t.column("comp").to_numpy(), t.column("node").to_numpy()
        for a, b in meetings(group, other, wild, lambda: comp):
            apart = comp[a] != comp[b]
            a, b = a[apart], b[apart]
            good = near.may(sketch, n, a, b)
            if good.any():
                a, b = node[a[good]], node[b[good]]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["u", "v"])

    return in_groups(dealt, task, "u long, v long").distinct()
