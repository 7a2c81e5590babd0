"""Token counts by unigram segmentation, shared over a trie of pre-tokens.

Texts are split into pre-tokens; the distinct ones go into a trie.  The best unigram score of a
prefix does not depend on what follows it, so the forward step of the dynamic programme runs once
for each trie node however many pre-tokens pass through it, and the number of pieces of the best
segmentation is stored where a pre-token ends.  A document's count is a sum of stored counts.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, read_table, without


def zipf_scores(path: str) -> dict[bytes, float]:
    """Log-probability of every piece of a rank file under Zipf's law for its rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    total = math.log(sum(1 / (r + 1) for r in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class SharedTrie:
    """Forward scores of prefixes.  A trie of over ``most`` nodes is begun anew, which changes no count."""

    def __init__(self, scores: dict[bytes, float], most: int = 1_000_000):
        self.scores, self.most = scores, most
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.next: dict[int, int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # score, and minus the number of pieces: fewer pieces win a tie
        self.counts: dict[str, int] = {}

    def insert(self, pre_token: str) -> int:
        """The number of pieces of a pre-token; bytes that no piece covers count one each."""
        raw = pre_token.encode()
        if len(self.best) + len(raw) > self.most:
            self.clear()
        node, path = 0, [0]
        nxt, best, scores, longest = self.next, self.best, self.scores, self.longest
        for end in range(1, len(raw) + 1):
            edge = node << 8 | raw[end - 1]
            child = nxt.get(edge)
            if child is None:
                child = nxt[edge] = len(best)
                top = None
                for begin in range(max(0, end - longest), end):
                    s = scores.get(raw[begin:end])
                    if s is not None:
                        score, pieces = best[path[begin]]
                        if top is None or (score + s, pieces - 1) > top:
                            top = (score + s, pieces - 1)
                if top is None:
                    score, pieces = best[node]
                    top = (score - 100.0, pieces - 1)
                best.append(top)
            node = child
            path.append(node)
        self.counts[pre_token] = -best[node][1]
        return self.counts[pre_token]

    def count(self, pre_token: str) -> int:
        found = self.counts.get(pre_token)
        return self.insert(pre_token) if found is None else found


@lru_cache(maxsize=2)
def _trie(path: str, pattern: str):
    import regex

    return SharedTrie(zipf_scores(path)), regex.compile(pattern)


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Add n_pre_tokens and n_tokens to every row; null and empty texts have none.

    ``vocabulary`` is a file of piece ranks that every executor has, ``pattern`` the rule that
    splits texts into pre-tokens.  Columns of the added names are replaced, others pass through.
    """
    docs = without(docs, "n_pre_tokens", "n_tokens")
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, split = _trie(vocabulary, pattern)
        for batch in batches:
            n, tokens = [], []
            for x in batch.column(at):
                seen = Counter(split.findall(x.as_py() or ""))
                n.append(seen.total())
                tokens.append(sum(k * trie.count(p) for p, k in seen.items()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(tokens, pa.int64())], [*names, "n_pre_tokens", "n_tokens"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return numbered(docs).mapInArrow(run, f"{types}, n_pre_tokens long, n_tokens long")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id"), "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).select("doc_id", "n_pre_tokens", "n_tokens")
