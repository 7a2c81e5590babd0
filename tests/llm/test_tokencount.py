import public_tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.tokencount import SharedTrie, count_tokens, op8_token_counts, zipf_scores

from .fixtures import AWKWARD, docs

SCORES = zipf_scores(public_tokenizers.path("byte_bpe_50k.tiktoken"))
SPLIT = regex.compile(public_tokenizers.PATTERN)


def brute(raw, scores=SCORES):
    best = [(0.0, 0)] + [None] * len(raw)
    for end in range(1, len(raw) + 1):
        found = [(best[b][0] + scores[raw[b:end]], best[b][1] - 1) for b in range(end) if raw[b:end] in scores]
        best[end] = max(found) if found else (best[end - 1][0] - 100.0, best[end - 1][1] - 1)
    return -best[-1][1]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="ab é", max_size=9), max_size=30), st.sampled_from([8, 10_000]))
def test_trie_equals_a_table_a_word(words, most):
    scores = {b"a": -1.0, b"ab": -1.5, b"ba": -1.4, b"b": -2.0, b" ab": -2.0, "é".encode(): -1.0}
    trie = SharedTrie(scores, most)
    assert [trie.count(w) for w in words] == [brute(w.encode(), scores) for w in words]


def test_query_against_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    seen = {}
    rows = op8_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = SPLIT.findall(texts[r["doc_id"]])
        for w in words:
            if w not in seen:
                seen[w] = brute(w.encode())
        assert (r["n_pre_tokens"], r["n_tokens"]) == (len(words), sum(seen[w] for w in words))


def test_awkward_rows(spark):
    rows = count_tokens(docs(spark, AWKWARD), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert len(rows) == len(AWKWARD)
    by = {r["doc_id"]: (r["n_pre_tokens"], r["n_tokens"]) for r in rows}
    assert by[1] == by[2] == (0, 0) and by[3] == (1, brute(b"one"))
    assert count_tokens(docs(spark, []), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect() == []
