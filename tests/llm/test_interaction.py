"""The filter audit against documents played through every order one by one."""

import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm import cases
from tripmart.llm import interaction

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failures(text, own, first):
    words, text = cases.words(text), text or ""
    out = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
    out += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
    return out + "E" * (own is not None and first is not None and own > first)


def played(rows, labels):
    """{(part, order, step): Counter} and {(part, order, step): shapley}."""
    firsts = defaultdict(list)
    for own, text, _ in rows:
        if own is not None:
            firsts[text or ""].append(own)
    counts, removed = defaultdict(Counter), Counter()
    for own, text, lang in rows:
        failed = failures(text, own, min(firsts[text or ""], default=None))
        good = any(q == 1 for i, q, _ in labels if i is not None and i == own)
        toxic = any(t == 1 for i, _, t in labels if i is not None and i == own)
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, letter in enumerate(order, 1):
                at = counts[lang or "", order, step]
                fails = letter in failed
                at["unique_fails"] += failed == letter
                at["redundant"] += fails and gone
                if fails and not gone:
                    gone = True
                    at["removed"] += 1
                    at["good_lost"] += good
                    at["toxic_lost"] += toxic
                    removed[lang or "", letter] += 1
                at["kept"] += not gone
    return counts, removed


def test_audit_equals_every_document_in_every_order(spark):
    draw = random.Random(2)
    texts = [None, "", " ", "x", "# x", "ABC", "a b " * 60, "A b " * 60, "é" * 9 + "A", "éA", cases.sentence(draw, 120, "abcdefghij"), cases.sentence(draw, 120, "abcdefghij") + " #"]
    texts += [t.upper() if t and draw.random() < 0.3 else t for t in texts]
    rows = [(i, draw.choice(texts), draw.choice(["en", "fr", "", None])) for i in range(80)]
    rows += [rows[3], rows[3], (None, texts[10], "en"), (None, texts[10], "en"), (None, None, None)]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 80, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    documents = spark.createDataFrame([(*r, "z", True) for r in rows], "doc_id long, text string, lang string, A string, e boolean")
    found = interaction.document_audit(documents, spark.createDataFrame([(*r, "q") for r in labels], "doc_id long, quality int, toxic int, lang string")).collect()
    counts, removed = played(rows, labels)
    assert len(found) == 3 * 600 and {(r["part"], r["filter_order"], r["step"]) for r in found} == set(counts)
    for r in found:
        at = counts[r["part"], r["filter_order"], r["step"]]
        assert {c: r[c] for c in COLUMNS} == {c: at[c] for c in COLUMNS}
        assert r["shapley"] == removed[r["part"], r["filter_order"][r["step"] - 1]]


def test_no_rows_no_parts(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction.document_audit(cases.nothing(spark), labels).count() == 0
    assert interaction.document_audit(cases.documents(spark), labels).groupBy("part").count().where("count <> 600").count() == 0


@pytest.mark.parametrize("filters", ["A", "XYZ"])
def test_fields_hold_counts_beyond_32_bits(filters):
    layout = interaction.Layout(filters)
    table = interaction.packed(layout)
    many = (1 << 40) + 3
    total = sum(t * (many + k) for k, t in enumerate(table))
    expected = sum(
        interaction.outcomes(layout, k >> 2, bool(k & 2), bool(k & 1)).astype(object) * (many + k) for k in range(len(table))
    )
    assert (interaction.unpacked(layout, total) == expected).all()


def test_many_parts_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(interaction, "MOST_PARTS", 4)
    rows = spark.range(0, 3000, 1, 8).select(F.col("id"), (F.col("id") % 11).alias("p"))
    found = interaction.audit(rows, {"X": F.col("id") % 2 == 0, "Y": F.col("id") % 3 == 0}, F.col("p"), F.lit(None).cast("boolean"), F.col("id") % 5 == 0)
    for part in range(11):
        ids = range(part, 3000, 11)
        got = {(r["filter_order"], r["step"]): r for r in found.where(F.col("part") == str(part)).collect()}
        assert len(got) == 4
        last = got["XY", 2]
        assert last["kept"] == sum(i % 2 > 0 and i % 3 > 0 for i in ids)
        assert last["removed"] == sum(i % 2 > 0 and i % 3 == 0 for i in ids)
        assert last["toxic_lost"] == sum(i % 2 > 0 and i % 15 == 0 for i in ids)
        assert last["redundant"] == sum(i % 6 == 0 for i in ids)
        assert last["shapley"] == last["removed"] + got["YX", 1]["removed"] and last["good_lost"] == 0
