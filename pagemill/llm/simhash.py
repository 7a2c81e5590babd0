"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint is cut into so few segments that two fingerprints within the distance asked for
differ by at most one bit in some segment.  Such a segment is equal after one bit of it is struck
out of both.  The bit struck out lies in one half of the segment, so the other half is equal as it
stands: fingerprints are dealt out by (segment, exact half), two rows a segment instead of one for
every bit, and within a group the one-wildcard variants of the other half are indexed and joined
on equality (``variants``).  Every candidate is verified, on the whole fingerprint or on the texts.

Near-duplicate texts by the similarity of their shingle sets are found the same way.  A set has a
fingerprint of as many bits as the number of texts and the similarity ask for: segments grow with
the logarithm of the texts, so that a text meets about as many strangers in any corpus, and there
are so many segments that a pair of just the similarity differs by more than one bit in all of
them with a probability below ``missed``.  Fingerprints of few shingles are coarse; sets of at
most ``FEW`` are met exactly, by their rarest shingles: two sets of the similarity have one of the
first few in common whatever order all sets are taken in, and in the order of frequency what many
texts share comes last and is no key unless a text consists of it.

Candidates are verified on the texts, in three rounds.  First the nearest candidate of every text,
which connects most copies; then the other edges of the candidates' forests that still cross two
components and that the parity of the sets' hashes does not rule out.  Where a forest edge was refused, other pairs of its components may still be similar:
in the third round all of them meet again and are verified the same way.  After it no candidate that crosses two components is unverified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialise, read_table
from .components import connected_components
from .variants import CROWD, Near, across, deal, forest, majority

_SURROGATE = 1 << 62
#: Sets of at most so many shingles are met exactly.
FEW = 64
#: Lanes of the fingerprint by which candidates are checked, and bits of the parity of a set's hashes.
_LANES, _PARITY = 2, 1024
#: Cells in which the shingles of small sets are counted, and the count up to which all are alike.
_CELLS, _RARE = 1 << 20, 16
_EPS = 1e-9


def fingerprint(text: str | None, shingle: int, lanes: int = 1, seed: int = 42) -> np.ndarray:
    """SimHash of the word shingles of a text, repeats included.

    A-Z are lower-cased and words end at ASCII white space.  A text of fewer words than a
    shingle is one shingle; one without words has the fingerprint zero.
    """
    joined = b" ".join((text or "").encode().lower().split())
    if not joined:
        return np.zeros(lanes, np.uint64)
    space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    start, end = [0, *(space + 1).tolist()], [*space.tolist(), len(joined)]
    shingles = [joined[s:e] for s, e in zip(start, end[shingle - 1 :], strict=False)] or [joined]
    return majority(np.array([xxhash.xxh64_intdigest(x, seed) for x in shingles], np.uint64), lanes)


def with_fingerprints(docs: DataFrame, shingle: int, lanes: int = 1, seed: int = 42, text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, an array of ``lanes`` longs, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, lanes, seed) for t in batch.column(1)]
            flat = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(fps) + 1, dtype=np.int32) * lanes), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp array<long>")


def near_links(nodes: DataFrame, lanes: int, segments: int, max_bits: int, crowd: int = CROWD) -> DataFrame:
    """Edges (u, v) that connect all of ``nodes`` (node, fp) within ``max_bits`` of each other.

    Each lane is cut into ``segments``.  All links are found if ``max_bits`` is less than twice the
    number of segments; beyond that a pair is found if some segment differs by one bit at most.
    """
    cuts = [(lane, 64 * k // segments, 64 * (k + 1) // segments) for lane in range(lanes) for k in range(segments)]
    segs = F.array(*(F.shiftrightunsigned(F.col("fp")[lane], a).bitwiseAND(F.lit((1 << b - a) - 1)).cast("int") for lane, a, b in cuts))
    width = max(b - a for _, a, b in cuts)
    return forest(deal(nodes.select("node", F.lit(1).alias("n"), F.col("fp").alias("sketch"), segs.alias("segs")), width, crowd), width, Near(lanes, max_bits)).select("u", "v")


def near_duplicate_components(docs: DataFrame, shingle: int, lanes: int, segments: int, max_bits: int, text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable.

    Null and empty texts have the fingerprint zero and are linked like any other.  Rows of one
    doc_id are one document.  Rows with a null doc_id link like others but name no component:
    theirs is the smallest id they reach, or null if there is none.  Other columns are not read.
    """
    prints = materialise(with_fingerprints(docs, shingle, lanes, text=text))
    stand_in = F.lit(_SURROGATE) + F.xxhash64("fp").bitwiseAND(F.lit(_SURROGATE - 1))  # above any real id
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("node")).select("fp", F.coalesce("node", stand_in).alias("node")))
    edges = near_links(nodes, lanes, segments, max_bits)
    # a doc_id with several texts links their fingerprints
    several = prints.join(nodes, "fp").where("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    repeated = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null")
    several = several.join(repeated.select(F.col("doc_id").alias("u")), "u", "left_semi").select("u", "v")
    found = connected_components(edges.unionByName(several))
    of_print = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("c"))
    return prints.join(of_print, "fp").select("doc_id", "fp", F.when(F.col("c") < _SURROGATE, F.col("c")).alias("component_id"))


@lru_cache(maxsize=32)
def shingle_set(text: str | None, k: int) -> frozenset[bytes]:
    """Distinct shingles of k words; A-Z are lower-cased, words end at ASCII white space.

    A text of fewer words than a shingle is one shingle.
    """
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def differing_share(similarity: float) -> float:
    """Share of bits that differ in fingerprints of two large sets; equal sizes differ most."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def segment_plan(rows: int, similarity: float, missed: float = 1e-4) -> tuple[int, int]:
    """Width and number of segments for a table of so many rows."""
    width, p = min(24, max(12, max(1, rows - 1).bit_length() - 3)), differing_share(similarity)
    within_one = (1 - p) ** width + width * p * (1 - p) ** (width - 1)
    return width, math.ceil(math.log(missed) / math.log1p(-within_one))


def candidate_bits(similarity: float) -> int:
    """Bits of the checked lanes that a pair of the similarity exceeds with a probability of about 3e-7."""
    p, n = differing_share(similarity), 64 * _LANES
    return math.ceil(p * n + 5 * math.sqrt(p * (1 - p) * n))


def described(texts: DataFrame, k: int, similarity: float, width: int, segments: int, seed: int) -> DataFrame:
    """Every row with its set's name (id, check: 126 bits of its hash), size, sketch, segments and, if it is small, all hashes."""
    lanes = _LANES + -(-segments * width // 64)
    names = ["doc_id", "t1", "t2", "id", "check", "n", "sketch", "segs", "least"]
    weights = 1 << np.arange(width, dtype=np.int64)

    def lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, checks, sizes, sketches, segs, least = [], [], [], [], [], []
            for t in batch.column(3):
                h = np.unique(np.array([xxhash.xxh64_intdigest(s) for s in shingle_set(t.as_py(), k)], np.uint64))
                whole, n = xxhash.xxh3_128_intdigest(h.tobytes(), seed), len(h)
                ids.append(whole >> 65)  # not negative
                checks.append(whole & (1 << 63) - 1)
                sizes.append(n)
                fp = majority(h, lanes)
                odd = np.packbits(np.bincount((h >> np.uint64(54)).astype(np.int64), minlength=_PARITY) & 1, bitorder="little").view(np.int64)
                sketches.append(np.concatenate((fp[:_LANES].view(np.int64), odd)))
                bits = np.unpackbits(fp[_LANES:].view(np.uint8), bitorder="little")[: segments * width]
                segs.append(bits.reshape(segments, width) @ weights if n > FEW else np.zeros(0, np.int64))
                least.append(h.view(np.int64) if similarity * n <= FEW else np.zeros(0, np.int64))
            arrays = [pa.array(ids, pa.int64()), pa.array(checks, pa.int64()), pa.array(sizes, pa.int32()), lists(sketches, np.int64), lists(segs, np.int32), lists(least, np.int64)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *arrays], names)

    return texts.mapInArrow(run, "doc_id long, t1 long, t2 long, id long, check long, n int, sketch array<long>, segs array<int>, least array<long>")


def rarest(nodes: DataFrame, similarity: float) -> DataFrame:
    """``least`` of each small set cut to as many of its rarest hashes as sets of the similarity must share one of.

    Shingles of all small sets are counted in a table of fixed size by some bits of their hash; any
    order will do for exactness, so those of one cell may share a count.
    """
    cell = F.col("h").bitwiseAND(F.lit(_CELLS - 1)).cast("int")
    counted = nodes.select(F.explode("least").alias("h")).groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).where(F.col("n") > _RARE).collect()  # at most _CELLS rows
    table = np.zeros(_CELLS, np.int32)
    table[[r["cell"] for r in counted]] = [min(r["n"], (1 << 31) - 1) for r in counted]
    sent, at = nodes.sparkSession.sparkContext.broadcast(table), nodes.columns.index("least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            ends, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy(zero_copy_only=False)
            n = np.diff(ends)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((flat, sent.value[flat & (_CELLS - 1)], row))
            wanted = np.where(n > 0, n - np.ceil(similarity * n - _EPS).astype(np.int64) + 1, 0)
            first = order[np.arange(len(flat)) - ends[row] < wanted[row]]
            kept = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *wanted]).astype(np.int32)), pa.array(flat[first]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], kept, *batch.columns[at + 1 :]], batch.schema.names)

    return nodes.mapInArrow(run, nodes.schema)


def _sent(df: DataFrame, rows: int = 1 << 20) -> DataFrame:
    """Broadcast if the table has at most so many rows, otherwise left to the optimiser."""
    return F.broadcast(df) if df.count() <= rows else df


def verified(pairs: DataFrame, texts: DataFrame, k: int, similarity: float) -> DataFrame:
    """Pairs (u, v) whose ``texts`` (id, text) share at least ``similarity`` of their shingles."""
    both = pairs.select("u", "v").join(texts.withColumnsRenamed({"id": "v", "text": "b"}), "v").join(texts.withColumnsRenamed({"id": "u", "text": "a"}), "u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column("a"), batch.column("b"), strict=True):
                x, y = shingle_set(a.as_py(), k), shingle_set(b.as_py(), k)
                common = len(x & y)
                good.append(common >= similarity * (len(x) + len(y) - common))
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs that sizes and parities do not rule out (see ``Near``)."""
    both = pairs.select("u", "v")
    for end in ("u", "v"):
        both = both.join(nodes.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.slice("sketch", _LANES + 1, _PARITY // 64).alias(f"p{end}")), end)
    apart = F.aggregate(F.zip_with("pu", "pv", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    sizes = F.least("nu", "nv") >= similarity * F.greatest("nu", "nv") - _EPS
    return both.where(sizes & (apart <= (1 - similarity) / (1 + similarity) * (F.col("nu") + F.col("nv")) + _EPS)).select("u", "v")


def _crossing(edges: DataFrame, found: DataFrame) -> DataFrame:
    """Edges whose ends lie in two components of ``found`` (node, component), with these, cu and cv."""
    found = _sent(found)
    for end in ("u", "v"):
        edges = edges.join(found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return edges.where("cu <> cv")


def similar_components(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, text: str = "text", missed: float = 1e-4) -> DataFrame:
    """(doc_id, component_id) of every row; component_id is the smallest doc_id reachable.

    Rows are linked if their sets of shingles have the similarity; no pair below it links, one of
    just the similarity is not seen with a probability of ``missed``, closer ones far less often.
    Null and empty texts have the empty shingle and are linked like any other.  Rows of one doc_id
    are one document.  Rows with a null doc_id link like others but name no component: theirs is
    the smallest id they reach, or null if there is none.
    """
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    typed = typed.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")
    (width, segments), seed = segment_plan(docs.count(), similarity, missed), 0
    while True:
        rows = materialise(described(typed, shingle, similarity, width, segments, seed))
        facts = [F.any_value(c).alias(c) for c in ("n", "sketch", "segs", "least")]
        nodes = rows.groupBy(F.col("id").alias("node")).agg(F.min("doc_id").alias("first"), F.min("check").alias("lo"), F.max("check").alias("hi"), F.min(F.struct("t1", "t2")).alias("t"), *facts)
        nodes = materialise(nodes)
        if nodes.where("lo <> hi").isEmpty():  # else two sets have one name: take others
            break
        seed += 1
    counted, nodes = nodes, materialise(rarest(nodes, similarity))
    discard(counted)

    few, many = Near(0, 0, similarity), Near(_LANES, candidate_bits(similarity), similarity)
    coarse = F.slice("sketch", 1, _LANES).alias("sketch")
    parity = F.slice("sketch", _LANES + 1, _PARITY // 64).alias("sketch")
    by_least = lambda df, *more: df.where(F.size("least") > 0).select("node", "n", parity, F.col("least").alias("segs"), *more)
    by_segment = lambda df, sketch, *more: df.where(F.size("segs") > 0).select("node", "n", sketch, "segs", *more)
    edges = materialise(forest(deal(by_segment(nodes, coarse), width), width, many).unionByName(forest(deal(by_least(nodes), 0), 0, few)).groupBy("u", "v").agg(F.min("d").alias("d")))
    ends = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    wanted = materialise(nodes.select("node", "t.t1", "t.t2").join(ends, "node", "left_semi"))
    texts = typed.join(_sent(wanted), ["t1", "t2"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
    texts = materialise(texts)

    check = lambda pairs: materialise(verified(pairs, texts, shingle, similarity))
    closest = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.struct("d", "u", "v").alias("e")), F.struct(F.col("v").alias("node"), F.struct("d", "u", "v").alias("e")))).alias("x"))
    closest = closest.groupBy("x.node").agg(F.min("x.e").alias("e")).select("e.u", "e.v").distinct()
    links = [check(closest)]
    found = materialise(connected_components(links[0]))
    links.append(check(_possible(_crossing(edges, found).join(closest, ["u", "v"], "left_anti"), nodes, similarity)))
    if not links[1].isEmpty():
        found = materialise(connected_components(links[0].unionByName(links[1])))

    refused = materialise(_crossing(edges, found))
    open_ = refused.select(F.explode(F.array("cu", "cv")).alias("comp")).distinct()
    placed = nodes.join(_sent(found).withColumnRenamed("component", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = materialise(placed.join(_sent(open_), "comp", "left_semi").select("node", "n", "sketch", "segs", "least", "comp"))
    pairs = across(deal(by_segment(placed, F.col("sketch"), "comp"), width), width, many).unionByName(across(deal(by_least(placed, "comp"), 0), 0, few)).distinct()
    links.append(check(pairs.join(refused.select("u", "v"), ["u", "v"], "left_anti")))

    # a doc_id with several texts links them
    named = rows.select("doc_id", "id").where("doc_id is not null")
    lead = named.groupBy("doc_id").agg(F.min("id").alias("v"), F.max("id").alias("most")).where("v <> most")
    links.append(named.join(lead, "doc_id").where("id <> v").select(F.col("id").alias("u"), "v"))
    if not (links[2].isEmpty() and links[3].isEmpty()):
        found = materialise(connected_components(links[0].unionByName(links[1]).unionByName(links[2]).unionByName(links[3])))
    discard(edges, wanted, texts, refused, placed)
    names = nodes.select("node", "first").join(found, "node", "left").select("node", "first", F.coalesce("component", "node").alias("c"))
    least = names.groupBy("c").agg(F.min("first").alias("component_id"))
    return rows.select("doc_id", F.col("id").alias("node")).join(names.select("node", "c").join(least, "c"), "node").select("doc_id", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id.

    Groups are the components of all pairs whose sets of shingles have the Jaccard similarity (see
    ``similar_components``).  Rows without a doc_id cannot be named as copies and stay; of rows
    with one doc_id the least text stays.
    """
    found = similar_components(docs, shingle, similarity)
    copies = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(copies, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
    if docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return kept
    row = F.struct("text", *(f"`{c}`" for c in docs.columns if c != "text"))
    one = kept.where("doc_id is not null").groupBy("doc_id").agg(F.min(row).alias("row"))
    return one.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns)).unionByName(kept.where("doc_id is null"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 64 bits of four-word shingles, linked at four differing bits or fewer."""
    found = near_duplicate_components(read_table(spark, sf_dir, "documents"), shingle=4, lanes=1, segments=3, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex(F.col("fp")[0])), 16, "0").alias("fingerprint"), "component_id")
