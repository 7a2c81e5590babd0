import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.decontaminate import OP2_SQL, NgramSet, Words, find_contamination, op2_decontaminate

from ..oracle import connection, differences
from .fixtures import AWKWARD, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, n=10):
    windows = {}
    for item_id, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item_id))
    out = []
    for doc_id, text in texts:
        w, hit, found = words_of(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if k := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= k
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(texts, items)
    assert sorted((tuple(r) for r in op2_decontaminate(spark, sf_dir).collect()), key=str) == want
    assert any(r[5] for r in want)


def test_query_equals_sql(spark, sf_dir):
    for folder in (sf_dir, sf_dir.replace("0.001", "0.01")):
        assert differences(op2_decontaminate(spark, folder), connection(folder), OP2_SQL) is None


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "short item"), (3, None), (4, ""), (5, "b c d e f g h i j k"), (6, "a a a")]
TEXTS = [(1, "x A b-c d e f g h i j k! y"), (2, "Short, ITEM short item"), (3, "a b c d e f g h i"), (4, "a a a a"), (5, None), (6, ""), (7, "a b c d e"), (8, "f g h i j k l"), (9, "SHORT éitem"), (10, "Z" * 100_000 + " short item")]


def test_small_fixture_and_blocks(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (500_000, 3):
        got = find_contamination(docs(spark, TEXTS), bench, block_windows=block).collect()
        want = brute(TEXTS, ITEMS)
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["n_hit"] > 0) for r in got), key=str) == want


def test_cleaning_leaves_no_window_and_other_texts_alone(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [*TEXTS, (11, "keep a b c d e f g h short item i j k l this")]
    for block in (500_000, 3):
        got = {r["doc_id"]: r["text"] for r in find_contamination(docs(spark, rows), bench, clean=True, block_windows=block).collect()}
        assert not any(r[5] for r in brute(got.items(), ITEMS))
        assert got[3] == "a b c d e f g h i" and got[5] is None and got[1].startswith("x ") and got[1].endswith("! y")


def test_awkward_tables(spark):
    bench = spark.createDataFrame([(None, "lorem ipsum dolor sit amet lorem ipsum dolor sit amet"), (1, None)], "item_id long, text string")
    got = find_contamination(docs(spark, AWKWARD), bench).collect()
    assert len(got) == len(AWKWARD)
    assert next(r for r in got if r["doc_id"] == 4)["items"] == [""]
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 for r in find_contamination(docs(spark, AWKWARD), none).collect())
    assert find_contamination(docs(spark, []), bench).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbc éZ0-\n", max_size=40), min_size=1, max_size=6))
def test_words_of_a_batch(texts):
    raw = [t.encode() for t in texts]
    words = Words.of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = [(r, words.data[s:e].tobytes().decode()) for r, s, e in zip(words.row, words.start, words.end, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in words_of(t)]
    assert list(NgramSet.build([], 10).scan(words)) == []
