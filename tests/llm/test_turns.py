import hashlib
import random
import re
import zlib
from itertools import groupby

from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.turns import ONE, OP11_SQL, cheapest, damage, message_digests, op11_turn_repair, power, product, repair_conversations, times, turn_matrix

from ..oracle import connection, differences

TURNS = "conv_id long, turn long, role string, text string"
FULL = re.compile(r"(s?(ua)+)?\Z")


def best(kinds):
    """(cost, audit, messages) of turns (initial, goes, truncated), by trying everything that could be cheapest."""
    found = {0: (0, "", ())}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(ways):
        out = list(ways)
        for _ in range(3):
            ways = [(step[q, r], (c + 5, a + "I", m + ((r, None),))) for q, (c, a, m) in ways for r in "ua" if (q, r) in step]
            out += ways
        return out

    def lowest(ways):
        out = {}
        for q, w in ways:
            out[q] = min(out.get(q, w), w, key=lambda x: x[:2])
        return out

    found = lowest(inserted(found.items()))
    for i, (initial, goes, truncated) in enumerate(kinds):
        ways, extra = [], 5 if truncated else 0
        for q, (c, a, m) in found.items():
            ways.append((q, (c + 2, a + "D", m)))
            if not goes:
                ways += [(step[q, r], (c + e + extra, a + x, m + ((r if x == "R" else None, i),))) for r, e, x in ((initial, 0, "K"), ("u", 1, "R"), ("a", 1, "R")) if (q, r) in step]
        found = lowest(inserted(ways))
    return min((w for q, w in found.items() if q in (0, 3)), key=lambda x: x[:2])


def brute(rows):
    """conv_id -> row of the query, of damaged rows (conv_id, turn, role, text)."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest())
    out = {}
    for conv, group in groupby(sorted(((c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows), key=order), key=lambda r: r[0]):
        group, seen, kinds, counts = list(group), set(), [], [0, 0, 0]
        for _, _, role, text in group:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not ink else 1 if (role, text) in seen else 2 if ink[-1] not in ".!?" else 3
            if fault < 3:
                counts[fault] += 1
            seen.add((role, text))
            kinds.append((role[:1], fault < 2, fault == 2))
        turns = [r[1] for r in group if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:], strict=False))
        cost, audit, messages = best(kinds)
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names[r] if r else group[i][2]}:{'' if i is None else group[i][3]}" for r, i in messages]
        assert FULL.match("".join(x[:1] for x in lines))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def damaged(rows):
    out = []
    for c, t, r, x in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        case = zlib.crc32(key.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if case == 4 else r, "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x)
        out += [row] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


KIND = st.tuples(st.sampled_from(["s", "u", "a", ""]), st.booleans(), st.booleans())


@settings(max_examples=300, deadline=None)
@given(st.lists(KIND, max_size=9))
def test_scan_finds_the_cheapest(kinds):
    m = product(tuple((*k, 1) for k in kinds)) if kinds else ONE
    assert cheapest(m) == best(kinds)[:2]


@settings(max_examples=100, deadline=None)
@given(st.lists(KIND, min_size=3, max_size=8), st.data())
def test_product_is_associative(kinds, data):
    parts = [turn_matrix(*k) for k in kinds]
    whole = product(tuple((*k, 1) for k in kinds))
    while len(parts) > 1:
        i = data.draw(st.integers(0, len(parts) - 2))
        parts[i : i + 2] = [times(parts[i], parts[i + 1])]
    assert parts[0] == whole


def test_copies_are_a_power():
    gone = turn_matrix("u", True, False)
    assert turn_matrix("u", False, False, 5) == times(turn_matrix("u", False, False), power(gone, 4)) == product((("u", False, False, 1), *[("u", True, False, 1)] * 4))


def compared(spark, rows, **how):
    fixed = repair_conversations(spark.createDataFrame(rows, TURNS), **how)
    digests = {r[0]: r[1] for r in message_digests(fixed.messages).collect()}
    got = {r[0]: (*r[1:], digests.get(r[0], hashlib.sha256().hexdigest())) for r in fixed.report.collect()}
    assert got == brute(rows)


ROLES = ["system", "user", "assistant", "tool", "", None, "User", "super"]
TEXTS = ["Yes.", "No!", "What?", "open end", "", " \t\n\x0b\x0c\r ", None, " ", "é.\n", "a\r\n", "Yes.  "]


def test_random_conversations_in_blocks_of_two(spark):
    rng = random.Random(1)
    rows = []
    for conv in [*range(40), None]:
        for _ in range(rng.randrange(1, 14)):
            turn = rng.choice([None, *range(9), *range(9), 50])
            role, text = rng.choice(ROLES[: rng.choice([3, 8])]), rng.choice(TEXTS) if rng.random() < 0.4 else f"{rng.random()}{rng.choice(['.', '', '?'])}"
            rows += [(conv, turn, role, text)] * rng.choice([1, 1, 1, 2, 3])
    compared(spark, rows, block=1, fan=1)
    compared(spark, rows)


def test_a_long_conversation(spark):
    rng = random.Random(2)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), f"{i % 1500}{rng.choice(['.', '', '.'])}") for i in range(4000)]
    rows += [(7, None, "user", "same."), (7, None, "user", "same.")] * 2000 + [(8, 0, "user", "x" * 300_000), (8, 1, "assistant", "é" * 300_000 + "!")]
    compared(spark, rows, block=5, fan=2)


def test_odd_tables(spark):
    rows = [(1, 0, "user", "Hi.", 1, "x"), (1, 1, "assistant", "Ho.", 2, "y")]
    columns = "conv_id string, turn int, role string, text string, k int, `a.b` string"
    table = spark.createDataFrame([(str(r[0]), *r[1:]) for r in rows] + [(None, None, None, None, None, None), ("", 3, "user", "n", 0, "")], columns)
    fixed = repair_conversations(table)
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in fixed.report.collect()} == {"1": (0, "KK"), None: (2, "D"), "": (2, "D")}
    assert [tuple(r) for r in fixed.messages.orderBy("place").collect()] == [("1", 0, "user", "Hi."), ("1", 1, "assistant", "Ho.")]
    none = repair_conversations(table.limit(0))
    assert none.report.count() == none.messages.count() == message_digests(none.messages).count() == 0


def test_query(spark, sf_dir):
    for folder in (sf_dir, sf_dir.replace("0.001", "0.01")):
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert sorted(map(str, damaged(rows))) == sorted(str(tuple(r)) for r in damage(spark.createDataFrame(rows, TURNS)).collect())
        want = brute(damaged(rows))
        none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
        assert {r[0]: tuple(r[1:]) for r in op11_turn_repair(spark, folder).collect()} == {c: want.get(c, none) for c in {r[0] for r in rows}}
        assert len(want) > 10
        assert differences(op11_turn_repair(spark, folder), connection(folder), OP11_SQL) is None
