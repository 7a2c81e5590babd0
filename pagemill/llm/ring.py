"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points of the ring and with them the arcs that end there.
A key belongs to the arc its hash falls in; keys that find their shard full continue clockwise
to the next shard with room.  The arcs are few and their number does not depend on the data, so
the flow of overflowing keys is settled on per-arc counts alone: the executors only rank keys
within arcs, and one broadcast table of rank ranges tells them where each key goes.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, read_table, text_or_empty, unused, without

_MASK = (1 << 63) - 1
#: A key with more rows than this many average arcs is ranked in parts.  Of distinct keys an arc of
#: 5,120 holds that many with a probability below 1e-3, so tables without such keys pay nothing.
HOT_ARCS = 16


@dataclass(frozen=True)
class Ring:
    """Points in ascending order and the shard that owns each."""

    points: np.ndarray
    owners: np.ndarray

    @classmethod
    def build(cls, n_shards: int, virtual_nodes: int) -> Ring:
        at = sorted((xxhash.xxh64_intdigest(f"{s}/{v}") & _MASK, s) for s in range(n_shards) for v in range(virtual_nodes))
        return cls(np.array([p for p, _ in at], np.int64), np.array([s for _, s in at], np.int64))


def capacities(total: int, n_shards: int, load_factor: float) -> list[int]:
    """Places of each shard.  Factor 1 deals out exactly ``total`` places, at most one apart."""
    if load_factor < 1:
        raise ValueError("load_factor must be at least 1")
    if load_factor == 1:
        return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    return [-int(-load_factor * total // n_shards)] * n_shards


def place(counts: dict[int, int], ring: Ring, room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of every run of keys that move together.

    Keys that fit at home stay there, in ring order; the others continue clockwise, those that
    have come furthest first.  There are at most two runs an arc and one more a shard.
    """
    room, slot = list(room), [0] * len(room)
    runs, left = [], {}

    def put(arc: int, lo: int, hi: int, shard: int) -> None:
        runs.append((arc, lo, hi, shard, slot[shard]))
        slot[shard] += hi - lo
        room[shard] -= hi - lo

    for arc, shard in enumerate(ring.owners.tolist()):
        n = counts.get(arc, 0)
        if fits := min(n, room[shard]):
            put(arc, 0, fits, shard)
        if fits < n:
            left[arc] = (fits, n)
    moving: deque[tuple[int, int, int]] = deque()
    for turn in range(2):
        for arc, shard in enumerate(ring.owners.tolist()):
            if turn == 0 and arc in left:
                moving.append((arc, *left[arc]))
            while moving and room[shard]:
                source, lo, hi = moving.popleft()
                end = min(hi, lo + room[shard])
                put(source, lo, end, shard)
                if end < hi:
                    moving.appendleft((source, end, hi))
    if moving:
        raise ValueError("the shards have fewer places than there are keys")
    return runs


def _hot_places(df: DataFrame, k_at: str, k_arc: str, counts: dict[int, int], n_points: int) -> list[tuple[int, int, int]]:
    """(hash, arc, rows) of the keys that hold over ``HOT_ARCS`` average arcs: at most ``n_points / HOT_ARCS``."""
    least = HOT_ARCS * sum(counts.values()) / n_points
    arcs = [a for a, n in counts.items() if n > max(least, 1)]
    if not arcs:
        return []
    held = df.where(F.col(k_arc).isin(arcs)).groupBy(k_arc, k_at).agg(F.count("*").alias("n")).where(F.col("n") > max(least, 1))
    return sorted((r[k_at], r[k_arc], r["n"]) for r in held.collect())


def _ranked(df: DataFrame, k_at: str, k_arc: str, k_rank: str, order: tuple[str, ...], hot: list[tuple[int, int, int]], room: int) -> DataFrame:
    """Add the rank of every row in its arc, by hash; rows of a hot key are ranked in parts of about ``room`` rows.

    Parts are drawn at random, since rows of one key may agree in every column.  The drawn rows are
    written and read back, so that a task that runs again ranks the same rows.  Counts of parts tell
    where each begins, and rows of other keys add the hot rows that stand before them.
    """
    in_arc = F.row_number().over(Window.partitionBy(k_arc).orderBy(k_at, *order)) - 1
    if not hot:
        return df.withColumn(k_rank, in_arc.cast("long"))
    is_hot = F.col(k_at).isin([at for at, _, _ in hot])

    @F.pandas_udf("long")
    def hot_before(arc: pd.Series, at: pd.Series) -> pd.Series:
        before = np.zeros(len(at), np.int64)
        for h, a, n in hot:
            before += n * ((arc.to_numpy() == a) & (at.to_numpy() > h))
        return pd.Series(before)

    cold = df.where(~is_hot)
    arcs = sorted({a for _, a, _ in hot})
    # rows of other keys before each hot key, counted over the hot arcs alone and in one pass
    before = [F.count_if((F.col(k_arc) == a) & (F.col(k_at) < h)) for h, a, _ in hot]
    first = cold.where(F.col(k_arc).isin(arcs)).agg(F.array(*before).alias("n")).first()["n"]
    starts = {h: first[i] + sum(m for g, b, m in hot if b == a and g < h) for i, (h, a, _) in enumerate(hot)}

    (k_part, p_at, p_part, p_start) = unused(df, "_k_part", "_p_at", "_p_part", "_p_start")
    n_parts = max(1, -(-max(n for _, _, n in hot) // max(room, 1)))
    salted = materialise(df.where(is_hot).withColumn(k_part, F.floor(F.rand() * n_parts).cast("int")))
    sizes = sorted((r[k_at], r[k_part], r["n"]) for r in salted.groupBy(k_at, k_part).agg(F.count("*").alias("n")).collect())
    places = []
    for at, part, n in sizes:
        places.append((at, part, starts[at]))
        starts[at] += n
    # at most n_points / HOT_ARCS keys, each in as many parts
    places = F.broadcast(df.sparkSession.createDataFrame(places, f"{p_at} long, {p_part} int, {p_start} long"))
    in_part = F.row_number().over(Window.partitionBy(k_at, k_part).orderBy(*order)) - 1
    parts = salted.withColumn(k_rank, in_part).join(places, (F.col(k_at) == F.col(p_at)) & (F.col(k_part) == F.col(p_part)))
    parts = parts.withColumn(k_rank, (F.col(k_rank) + F.col(p_start)).cast("long")).drop(k_part, p_at, p_part, p_start)
    return cold.withColumn(k_rank, in_arc + hot_before(k_arc, k_at)).unionByName(parts)


def assign_shards(df: DataFrame, key: str = "doc_id", n_shards: int = 40, virtual_nodes: int = 128, load_factor: float = 1.0, order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to every row.

    ``order`` names further columns that rank rows of one key.  Null keys hash like any other
    value, repeated keys share an arc and take separate slots, an empty table stays empty.
    A key that holds very many rows (over ``HOT_ARCS`` average arcs) is ranked in random parts, by
    ``order`` in each part only, so that no task gathers its rows.
    Columns of the input that are named like the added ones are replaced, others pass through.
    """
    df = without(df, "shard", "slot")
    k_at, k_arc, k_rank, r_arc, r_lo, r_hi, r_slot = unused(df, "_k_at", "_k_arc", "_k_rank", "_r_arc", "_r_lo", "_r_hi", "_r_slot")
    spark, ring = df.sparkSession, Ring.build(n_shards, virtual_nodes)
    points = ring.points

    @F.pandas_udf("int")
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(points, at.to_numpy(), side="left") % len(points)).astype("int32")

    at = F.xxhash64(F.col(key)).bitwiseAND(F.lit(_MASK))
    counts = {r["arc"]: r["n"] for r in df.select(arc_of(at).alias("arc")).groupBy("arc").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    runs = place(counts, ring, capacities(total, n_shards, load_factor))
    table = spark.createDataFrame(pd.DataFrame(runs, columns=[r_arc, r_lo, r_hi, "shard", r_slot]).astype({r_arc: "int32", "shard": "int32"}), f"{r_arc} int, {r_lo} long, {r_hi} long, shard int, {r_slot} long")
    keyed = df.withColumn(k_at, at).withColumn(k_arc, arc_of(k_at))
    hot = _hot_places(keyed, k_at, k_arc, counts, len(points))
    ranked = _ranked(keyed, k_at, k_arc, k_rank, (key, *order), hot, HOT_ARCS * total // len(points))
    # at most two runs an arc and one a shard, whatever the data: small enough to broadcast
    hit = (F.col(k_arc) == F.col(r_arc)) & (F.col(k_rank) >= F.col(r_lo)) & (F.col(k_rank) < F.col(r_hi))
    return ranked.join(F.broadcast(table), hit).select(*(f"`{c}`" for c in df.columns), "shard", (F.col(r_slot) + F.col(k_rank) - F.col(r_lo)).alias("slot"))


def op6_ring_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of the ring; counts at most one apart."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"), F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    placed = assign_shards(docs, "doc_id", n_shards=40, order=("text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
