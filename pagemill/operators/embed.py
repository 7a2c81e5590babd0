"""Embedding of chunk texts with pluggable models."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pii import install_masking, mask_text

DIMENSION = 384
BATCH = 32


@dataclass(frozen=True)
class Model:
    """A named embedder: ``load`` gives a function from texts to unit vectors, once a Python worker."""

    name: str
    version: str
    dimension: int
    load: Callable[[], Callable[[list[str]], np.ndarray]]


def hashing_embedder() -> Callable[[list[str]], np.ndarray]:
    """Words and pairs of words hashed to signed places; needs no files and always gives the same."""

    hashed = partial(hashlib.blake2b, digest_size=8)

    def encode(texts: list[str]) -> np.ndarray:
        digests, sizes = [], []
        for text in texts:
            words = " ".join(text.casefold().split()).encode().split(b" ")  # no words: one empty term
            terms = words + [b" ".join(pair) for pair in zip(words, words[1:], strict=False)]
            digests += [hashed(term).digest() for term in terms]
            sizes.append(len(terms))
        h = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64)
        at = np.repeat(np.arange(len(texts)), sizes) * 2 * DIMENSION + (h >> np.uint64(63)).astype(np.int64) * DIMENSION + (h % np.uint64(DIMENSION)).astype(np.int64)
        signed = np.bincount(at, minlength=len(texts) * 2 * DIMENSION).reshape(-1, 2, DIMENSION)
        out = (signed[:, 1] - signed[:, 0]).astype(np.float64)
        size = np.linalg.norm(out, axis=1, keepdims=True)
        out[size[:, 0] == 0, 0] = 1.0  # opposite signs cancelled everything
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    return encode


def resolve_snapshot(name: str, cache: str) -> tuple[str, str]:
    """(folder, version) of a model's files: a folder as it stands, or the snapshot of a hub cache that its main branch names.

    The version is the 40 hexadecimal digits of the commit, or ``unknown``.  Nothing is downloaded.
    """
    folder = Path(name)
    if not folder.is_dir():
        repo = Path(cache, "models--" + name.replace("/", "--"))
        main = repo / "refs" / "main"
        folder = repo / "snapshots" / (main.read_text().strip() if main.is_file() else "")
        if not main.is_file() or not folder.is_dir():
            raise LookupError(f"no files of the model {name!r}")
    return str(folder), folder.name if re.fullmatch("[0-9a-f]{40}", folder.name) else "unknown"


def word_vectors(folder: str, dimension: int) -> Callable[[list[str]], np.ndarray]:
    """Mean of the vectors of a text's known words, from ``vocab.txt`` (a word a line) and ``vectors.npy`` (a row a word).

    The vectors are mapped, not read, so workers of one machine share their pages.  A text without
    known words points to the first axis.
    """
    place = {w: i for i, w in enumerate(Path(folder, "vocab.txt").read_text(encoding="utf-8").split("\n")) if w}
    vectors = np.load(Path(folder, "vectors.npy"), mmap_mode="r")
    if vectors.ndim != 2 or vectors.shape[1] != dimension or len(vectors) < len(place):
        raise ValueError(f"{Path(folder).name} has vectors of {vectors.shape}, expected {len(place)} of {dimension}")

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for row, text in enumerate(texts):
            if found := [place[w] for w in re.findall(r"\w+", text.casefold()) if w in place]:
                out[row] = vectors[found].sum(0)
        size = np.linalg.norm(out, axis=1, keepdims=True)
        out[size[:, 0] == 0, 0] = 1.0
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    return encode


def _shipped(name: str, dimension: int) -> Callable[[list[str]], np.ndarray]:
    return word_vectors(SparkFiles.get(name), dimension)


def snapshot_model(spark: SparkSession, name: str, cache: str = "") -> Model:
    """A model of word vectors from its snapshot (see ``resolve_snapshot``), registered under ``name``.

    The folder is sent to every worker once; its version is that of the snapshot.
    """
    folder, version = resolve_snapshot(name, cache)
    encode = word_vectors(folder, DIMENSION)  # an unfit folder is an error here, not in tasks
    encode(["probe"])
    spark.sparkContext.addFile(folder, recursive=True)
    return register(Model(name, version, DIMENSION, partial(_shipped, Path(folder).name, DIMENSION)))


MODELS: dict[str, Model] = {}


def register(model: Model) -> Model:
    if model.dimension != DIMENSION:
        raise ValueError(f"{model.name} has dimension {model.dimension}, the schema needs {DIMENSION}")
    MODELS[model.name] = model
    return model


HASHING = register(Model("hashing-384", "1", DIMENSION, hashing_embedder))


@lru_cache(maxsize=4)
def _loaded(load: Callable) -> Callable[[list[str]], np.ndarray]:
    return load()


def encode(texts: list[str], model: Model = HASHING) -> list[list[float]]:
    """On the driver: query texts."""
    return _loaded(model.load)(texts).tolist() if texts else []


def embed(chunks: DataFrame, model: Model = HASHING, text: str = "text") -> DataFrame:
    """Add ``embedding`` (null text: null), the model's name, version and dimension.

    Texts go to the model in batches of BATCH; a text that it cannot take gets a null embedding
    and its reason (type and text of the error, masked) in ``embed_error``, and the others of its batch are encoded one by one.
    """
    load, dimension = model.load, model.dimension

    @F.arrow_udf("embedding array<float>, embed_error string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        install_masking()  # what a model logs in this worker is masked as well
        encode = _loaded(load)

        def several(texts: list[str]) -> list[tuple[np.ndarray | None, str | None]]:
            try:
                got = np.asarray(encode(texts))
                if got.shape != (len(texts), dimension):
                    raise ValueError(f"expected vectors of {dimension}, got {got.shape[1:]}")
                return [(v, None) for v in got.astype(np.float32)]
            except Exception as e:  # noqa: BLE001  whatever a model raises concerns its texts only
                return [x for t in texts for x in several([t])] if len(texts) > 1 else [(None, mask_text(f"{type(e).__name__}: {e}")[:2000])]

        for texts in batches:
            errors: list[str | None] = [None] * len(texts)
            vectors, there = np.zeros((len(texts), dimension), np.float32), np.zeros(len(texts), bool)
            given = np.flatnonzero(texts.is_valid())
            for a in range(0, len(given), BATCH):
                some = given[a : a + BATCH]
                for i, (v, errors[i]) in zip(some, several(texts.take(pa.array(some)).to_pylist()), strict=True):
                    if v is not None:
                        vectors[i], there[i] = v, True
            # the values of the rows that have a vector lie one after the other
            ends = pa.array(np.r_[0, np.cumsum(there) * dimension].astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(vectors[there].ravel()), mask=pa.array(~there))
            yield pa.StructArray.from_arrays([lists, pa.array(errors, pa.string())], ["embedding", "embed_error"])

    found = chunks.withColumn("_e", run(F.col(text)))
    return found.select(*chunks.columns, "_e.embedding", "_e.embed_error", F.lit(model.name).alias("model_name"), F.lit(model.version).alias("model_version"), F.lit(dimension).alias("dimension"))


CHUNK_KEY = ["document_id", "chunking_version", "chunk_index"]


def missing_embeddings(chunks: DataFrame, embeddings: DataFrame, model_name: str, model_version: str) -> DataFrame:
    """Chunks without a vector of this model and version."""
    have = embeddings.where((F.col("model_name") == model_name) & (F.col("model_version") == model_version)).select(*CHUNK_KEY)
    return chunks.join(have, CHUNK_KEY, "left_anti")


# --- the table of models: model_name, model_version, dimension, is_active ----------------------


def upsert_model(models: DataFrame, model: Model) -> DataFrame:
    """A known name gets the new version and dimension and keeps its state; a new one is inactive."""
    spark = models.sparkSession
    new = spark.createDataFrame([(model.name, model.version, model.dimension)], "model_name string, v string, d int")
    joined = models.join(new, "model_name", "full_outer")
    return joined.select("model_name", F.coalesce("v", "model_version").alias("model_version"), F.coalesce("d", "dimension").alias("dimension"), F.coalesce("is_active", F.lit(False)).alias("is_active"))


def activate_if_none(models: DataFrame, name: str) -> DataFrame:
    """Activates ``name`` unless some model is active."""
    return models if models.agg(F.bool_or("is_active")).first()[0] else models.withColumn("is_active", F.col("model_name") == name)


def activate(models: DataFrame, name: str) -> DataFrame:
    """Exactly ``name`` becomes active; an unknown name is an error."""
    if models.where(F.col("model_name") == name).isEmpty():
        raise LookupError(f"no embedding model {name!r}")
    return models.withColumn("is_active", F.col("model_name") == name)


def active_model(models: DataFrame) -> tuple[str, str] | None:
    row = models.where("is_active").select("model_name", "model_version").first()
    return tuple(row) if row else None
