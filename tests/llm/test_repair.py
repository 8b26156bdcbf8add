"""Conversation repair against a search that knows nothing of chunks."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tripmart.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, kind int, cost string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
#: The states after s, u and a.
STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit, lines) of (role, text, fault) rows by a search over whole prefixes."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        for letter, role in (("u", "user"), ("a", "assistant")):
            if letter in STEPS[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, STEPS[state][letter], (*lines, (role, ""))))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        extra = int(fault == "truncated")
        if role[:1] in STEPS[state]:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, STEPS[state][role[:1]], (*lines, (role, text))))
        for letter, other in (("u", "user"), ("a", "assistant")):
            if letter in STEPS[state]:
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, STEPS[state][letter], (*lines, (other, text))))
    raise AssertionError


def with_faults(rows):
    """(role, text, fault) of (turn, role, text) rows in order."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] if r[1] is not None else " ", hashlib.md5((r[2] if r[2] is not None else " ").encode()).digest()))
    out, seen = [], set()
    for _, role, text in ordered:
        role, text = role if role is not None else " ", text if text is not None else " "
        solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    turns = [t for t, _, _ in rows if t is not None]
    marked = with_faults(rows)
    cost, audit, lines = cheapest(marked)
    assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in lines))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    }


def conversation(draw, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sys", "u"]
    texts = ["Yes.", "no", "", " \n", None, "é!", "ok? ", "x" * 50, "What.\t"]
    return [(draw.choice([None, *range(-2, n)]), draw.choice(roles), draw.choice(texts) if draw.random() < 0.4 else f"{draw.random()}{draw.choice('.!? x')}") for _ in range(n)]


def table(spark, found):
    return spark.createDataFrame([(conv, *r, 8, "c") for conv, rows in found.items() for r in rows], SCHEMA)


@pytest.mark.parametrize("chunk_bits", [1, 3, 12])
def test_repairs_equal_a_whole_search(spark, chunk_bits):
    draw = random.Random(chunk_bits)
    found = {i: conversation(draw, draw.randint(1, 9)) for i in range(60)}
    found |= {None: conversation(draw, 30), 100: conversation(draw, 120), 101: [(i, "user", "a.") for i in range(40)], 102: [(0, "user", "b.")] * 33}
    out = {r["conv"]: r for r in repair.report(table(spark, found), chunk_bits).collect()}
    assert len(out) == len(found)
    for conv, rows in found.items():
        got = out["n" if conv is None else f"v{conv}"].asDict()
        assert {k: got[k] for k in expected(rows)} == expected(rows)


def test_repaired_messages(spark):
    draw = random.Random(9)
    found = {i: conversation(draw, draw.randint(1, 12)) for i in range(30)}
    out = {}
    for r in repair.repaired(table(spark, found), 2).orderBy("conv_id", "place").collect():
        out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, rows in found.items():
        assert tuple(out.get(str(conv), [])) == cheapest(with_faults(rows))[2]


def test_vectors_settle_after_few_passes(spark):
    """A long conversation in hundreds of chunks, and one whose vectors depend on its end."""
    draw = random.Random(4)
    rows = [(i, draw.choice(["user", "assistant"]), f"{i}.") for i in range(600)]
    marks = repair.marked(repair.placed(table(spark, {1: rows, 2: [(0, "user", "a."), (1, "assistant", "b.")]}), 1))
    chunks, passes = repair.converged(marks)
    assert chunks.count() > 300 and 1 < passes < 40


def test_search_agrees_on_every_short_case():
    """All vectors that short conversations lead to, from every state."""
    search = repair.Search()
    for kinds in ([a, b, c] for a in range(9) for b in range(9) for c in range(9)):
        vectors = search.vectors(repair.as_long(repair.END), kinds)
        steps = list(repair._trace(search, kinds, repair.as_long(repair.END), repair.START, True))
        rows = [("sua?"[k & 3] if k != 8 else "u", "", "blank" if k == 8 else "truncated" if k >= 4 else None) for k in kinds]
        cost, audit, _ = cheapest(rows)
        assert ("".join(s[0] for s in steps), sum(s[1] for s in steps)) == (audit, cost)
        assert len(vectors) == 4 and all(min(repair.as_vector(v)) == 0 for v in vectors)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        out += [(conv, turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return out


def test_query_repairs_every_damaged_conversation(spark, tmp_path):
    draw = random.Random(6)
    rows = [(conv, *r) for conv in [*range(80), None] for r in conversation(draw, draw.randint(1, 8))]
    rows += [(1000 + i, 0, "user", "alone.") for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(str, (tuple(r) for r in repair.damaged(frame).collect()))) == sorted(map(str, damaged(rows)))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    left = {}
    for conv, *r in damaged(rows):
        left.setdefault(conv, []).append(tuple(r))
    found = {r["conv_id"]: r.asDict() for r in repair.query(spark, str(tmp_path)).collect()}
    assert found.keys() == {r[0] for r in rows} and len(left) < len(found)
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()} | dict.fromkeys(["gaps", "blank", "duplicate", "truncated", "illegal", "cost"], 0)
    for conv, got in found.items():
        assert got == {"conv_id": conv} | (expected(left[conv]) if conv in left else nothing)


def test_no_messages(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.damaged(spark.createDataFrame([], SCHEMA)).where(F.lit(True)).count() == 0
