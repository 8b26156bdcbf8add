import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import cases
from tripmart.llm import components, jaccard, language, packing, ranking, repetition, spotsigs, text, urls
from tripmart.llm.mixing import stored

SF = "/root/testdata/sf0.01"


# Repetition


def repeated(text):
    found, n = cases.words(text), len(cases.words(text))
    covered, longest = set(), 0
    for size in range(8, n):
        places = defaultdict(list)
        for i in range(n - size + 1):
            places[tuple(found[i : i + size])].append(i)
        many = [i for at in places.values() if len(at) > 1 for i in at]
        if not many:
            break
        longest = size
        if size == 8:
            covered = {j for i in many for j in range(i, i + 8)}
    return n, len(covered), longest


def test_repeats_equal_brute_force(spark):
    draw = random.Random(1)
    texts = [None, "", " ", "a", "x " * 30, "a b c d e f g h " * 2] + [" ".join(draw.choice("ab") for _ in range(draw.randint(0, 120))) for _ in range(40)]
    rows = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    found = {r["doc_id"]: r for r in repetition.judge(rows).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["n_repeat_words"], r["longest_repeat"]) == repeated(text)
        assert sum(b - a for a, b in repetition.spans(text)) == r["n_repeat_words"]
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert repetition.judge(cases.nothing(spark)).count() == 0
    assert repetition.judge(cases.documents(spark)).count() == cases.documents(spark).count()


def test_line_and_symbol_counts(spark):
    rows = spark.createDataFrame([(1, "é #a\né #a\n\n \n \n x\n x \né #a")], "doc_id long, text string")
    r = repetition.judge(rows).first()
    assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (3 * 3 + 2, 3, 2)


# Language


def parsed(text, reference):
    """Phrases of a text: a symbol that continues no match ends the phrase."""
    count = len(range(0, len(text), language.PIECE))
    for at in range(0, len(text), language.PIECE):
        match = ""
        for c in text[at : at + language.PIECE]:
            if match + c in reference:
                match += c
            else:
                count, match = count + 1, c if c in reference else ""
    return count


def test_phrases_equal_a_greedy_parse():
    draw = random.Random(2)
    samples = {"x": [cases.sentence(draw, 300, "abc")], "y": [cases.sentence(draw, 200, "abd")]}
    model = language.learn(samples)
    texts = [cases.sentence(draw, n, "abcd") for n in (1, 5, 40, 600)]
    points = [language.symbols(t) for t in texts]
    breaks = np.cumsum([0, *map(len, points)])
    numbers, cuts = language._squeezed(language._numbered(np.concatenate(points), model.classes, model.shared), breaks)
    got = language.phrases(model, numbers, cuts)
    for i, text in enumerate(texts):
        assert got[i].tolist() == [parsed(text, samples[name][0]) for name in model.languages]


def test_languages_of_held_out_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.query(spark, SF).join(rows.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_edges(spark):
    rows = cases.documents(spark)
    model = language.fit(rows)
    out = language.identify(rows, model).collect()
    assert len(out) == rows.count() and set(model.languages) <= {"en", "fr"}
    assert {r["lang_pred"] for r in out} <= {"en", "fr", "und"}
    texts = [None, "", "123 !!", "abc"]
    names, scores = language.predictions(model, texts)
    assert names[:3] == ["und"] * 3 and names[3] != "und" and not scores[:3].any()
    none = language.fit(cases.nothing(spark))
    assert language.predictions(none, ["abc", None])[0] == ["und", "und"]
    assert language.identify(cases.nothing(spark), none).count() == 0


def test_only_letters_of_any_plane_make_a_language():
    model = language.learn({"de": ["der hund und die katze"], "got": ["\U00010330\U00010332\U00010330 \U00010344"]})
    texts = ["\U0001f600 123", "\U0001d7ce", "\u0301 12", "\U000e0100", "\U0001f600 der hund", "\U00010330\U00010332", "\U00020000"]
    names, scores = language.predictions(model, texts)
    assert names[:4] == ["und"] * 4 and not scores[:4].any()
    assert names[4:6] == ["de", "got"] and names[6] != "und"
    assert language.predictions(model, ["der hund", "der\U0001f600hund"])[1].std() == 0


def test_one_long_text_does_not_fill_the_sample():
    draw = random.Random(8)
    good = {"a": [cases.sentence(draw, 60, "abcde") for _ in range(59)], "b": [cases.sentence(draw, 60, "cdefg") for _ in range(60)]}
    good["a"].insert(0, cases.sentence(draw, 30_000, "xyz"))
    model = language.learn(good)
    names, _ = language.predictions(model, [cases.sentence(draw, 20, "abcde") for _ in range(200)])
    assert names.count("a") > 190
    assert language.shares([5, 100, 7], 32) == [5, 20, 7] and language.shares([3, 3], 10) == [3, 3] and language.shares([9, 9, 9], 2) == [1, 1, 0]
    parts = language._shared(["x" * 40, "0123456789" * 10], 80)
    assert parts == ["x" * 40, "\n".join(("0123456789" * 10)[a : a + 10] for a in (0, 30, 60, 90))]


def test_every_language_keeps_a_floor_of_symbols():
    draw = random.Random(9)
    signs = [chr(0x4E00 + i) for i in range(300)]
    texts = {f"l{i:03}": [" ".join(cases.sentence(draw, 2, "abcdefgh") + signs[i] for _ in range(300))] for i in range(300)}
    model = language.learn(texts)
    sizes = np.diff([*model.roots, len(model.table)])
    assert len(model.languages) == 300 and sizes.min() > language.FLOOR


# Quality ranking


def plain_measures(text):
    """The measures by their definitions, with no numpy."""
    text = text or ""
    data, words, lines = text.encode(), cases.words(text), [x for x in text.split("\n") if cases.words(x)]
    n_bytes, n_words, n_lines, distinct = max(1, len(data)), max(1, len(words)), max(1, len(lines)), max(1, len(set(words)))
    inside = sum(map(len, words))
    symbols, others = "#*$%&|<>", "!?()[]{}=+-_/\\@^~`'\""
    of = lambda signs: sum(text.count(c) for c in signs) / n_bytes
    return [
        np.log1p(len(words)), np.log1p(len(text)), inside / n_words, of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), of("0123456789"), of(symbols), of(".,;:"), of(others),
        (len(text) - inside) / n_bytes, sum(b >= 128 for b in data) / n_bytes, np.log(n_words / distinct), np.log(distinct) / np.log(n_words + 1),
        (len(lines) - len(set(lines))) / n_lines, np.log(n_words / n_lines), sum(w[-1] in symbols + others for w in words) / n_words,
        sum("A" <= w[0] <= "Z" for w in words) / n_words,
    ]


def test_measures_equal_their_definitions(spark):
    texts = [r["text"] for r in cases.documents(spark).collect()] + ODD + ["Ab c!\nAb c!\n\n  \nx#\t$ 1,2.\n"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(100).collect()]
    found = ranking.measures(pa.array(texts, pa.string()))
    assert found.shape == (len(texts), len(ranking.MEASURES))
    for text, row in zip(texts, found, strict=True):
        assert row.tolist() == pytest.approx(plain_measures(text), abs=1e-12), text


def plain_grams(text, buckets):
    """Signed counts of words and neighbours by their hashes, with no numpy."""
    whole = (1 << 64) - 1
    base = 0x9E3779B97F4A7C15

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & whole
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & whole
        return x ^ (x >> 31)

    hashes = [mix(sum((b + 1) * pow(base, i, 1 << 64) for i, b in enumerate(w.encode())) & whole) for w in cases.words(text)]
    every = hashes + [mix((b + mix(a)) & whole) for a, b in zip(hashes, hashes[1:], strict=False)]
    sums = [0] * buckets
    for h in every:
        sums[(h >> 1) % buckets] += -1 if h & 1 else 1
    damped = [np.copysign(np.log1p(abs(x)), x) if x else 0.0 for x in sums]
    size = sum(x * x for x in damped) ** 0.5
    return [x / size for x in damped] if size else damped


def test_grams_equal_plain_counts(spark):
    texts = [r["text"] for r in cases.documents(spark).collect()] + ODD
    found = ranking.measures(pa.array(texts, pa.string()), 64)
    assert found.shape == (len(texts), len(ranking.MEASURES) + 64)
    for text, row in zip(texts, found[:, len(ranking.MEASURES) :], strict=True):
        assert row.tolist() == pytest.approx(plain_grams(text, 64), abs=1e-9), text
    assert ranking.measures(pa.array([], pa.string()), 64).shape == (0, len(ranking.MEASURES) + 64)


def test_learning_needs_little_memory(spark):
    """Stored rows hold 2 KB and lose nothing; hashing and learning work in place and in small pieces."""
    texts = pa.array([*ODD, None, "", "a " * 70_000, "Ab c! 1,2.\nAb c!"], pa.string())
    packed = ranking._packed(texts)
    assert {len(x) for x in packed} == {8 * len(ranking.MEASURES) + 4 * ranking.BUCKETS}
    assert (ranking._values(packed) == ranking.measures(texts, ranking.BUCKETS)).all()
    draw = np.random.default_rng(4)
    good, bad = (draw.normal(at, 1, (1000, len(ranking.MEASURES) + ranking.BUCKETS)) for at in (0.1, 0))
    model = ranking.learn(good[:50], bad[:50], 0.5, pairs=100)
    data = draw.integers(97, 123, 1 << 20).astype(np.uint8)
    edges = np.arange(0, len(data), 1 << 10)
    tracemalloc.start()
    try:
        ranking.block_weights(good, bad, model.steps, model.centre, model.spread)
        learned = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        text.Hasher().ranges(data, edges[:-1], edges[1:])
        hashed = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert learned < 35e6 and hashed < 30 * len(data)


def test_words_alone_tell_labels_apart(spark):
    # Both labels have words of one length and no other signs: no measure differs but by chance.
    draw = random.Random(4)
    said = {q: ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(40)] for q in (0, 1)}
    rows = [(i, " ".join(draw.choice(said[i % 2] if draw.random() < 0.5 else said[0] + said[1]) for _ in range(60))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, quality int")
    out = ranking.score(docs, ranking.fit(docs, labels)).where(ranking.held_out(F.col("doc_id"))).collect()
    good, bad = ([r["score"] for r in out if r["doc_id"] % 2 == q] for q in (1, 0))
    assert len(good) > 40 and len(bad) > 40 and np.mean([a > b for a in good for b in bad]) > 0.97


@pytest.mark.parametrize("buckets", [0, 24])
def test_weights_solve_the_pairwise_loss(buckets):
    draw = np.random.default_rng(3)
    width = len(ranking.MEASURES) + buckets
    good, bad = draw.normal(0.4, 1, (80, width)), draw.normal(0, 1.2, (50, width))
    model = ranking.learn(good, bad, 0.25, pairs=2000)
    again = np.random.default_rng(ranking.SEED)
    spread = lambda x: ranking._spread_out(x, model.steps, model.centre, model.spread)
    ours, theirs = spread(good), spread(bad)
    difference = ours[again.integers(len(good), size=2000)] - theirs[again.integers(len(bad), size=2000)]
    loss = lambda w: np.mean(np.logaddexp(0, -difference @ w)) + ranking.RIDGE / 2 * w @ w
    least = loss(model.weights)
    for k in range(len(model.weights)):
        step = np.zeros(len(model.weights))
        step[k] = 1e-4
        assert loss(model.weights + step) > least and loss(model.weights - step) > least
    assert all(loss(model.weights + draw.normal(0, 0.1, len(model.weights))) > least for _ in range(50))
    # The threshold is the quantile that the share of bad labels names.
    below = 0.75 * np.mean(ours @ model.weights < model.threshold) + 0.25 * np.mean(theirs @ model.weights < model.threshold)
    assert abs(below - 0.25) <= 0.02
    at = ranking.scores(np.concatenate([good, bad]), model)
    raw = np.concatenate([ours, theirs]) @ model.weights
    assert ((at >= ranking.CUT) == (raw >= model.threshold)).all()



def test_every_labelled_text_is_learned_from(spark):
    """Texts dealt out in many blocks: each block counts, each text is in a pair, and a rare label is in all blocks."""
    draw = random.Random(5)
    said = {q: ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(40)] for q in (0, 1)}
    kinds = [int(i % 12 != 0) for i in range(1800)]
    rows = [(i, " ".join(draw.choice(said[q] if draw.random() < 0.5 else said[0] + said[1]) for _ in range(60))) for i, q in enumerate(kinds)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, quality int")
    learned = sum(1 for i in range(1800) if zlib.crc32(str(i).encode()) % 5)
    seen = spark.sparkContext.accumulator(0)
    solved = ranking.solved

    def counting(x_good, x_bad, i, j):
        seen.add(len(set(i.tolist())) + len(set(j.tolist())))
        assert len(set(i.tolist())) == len(x_good) and len(set(j.tolist())) == len(x_bad) >= 60
        return solved(x_good, x_bad, i, j)

    ranking.solved = counting
    try:
        model = ranking.fit(docs, labels, block=300)
    finally:
        ranking.solved = solved
    assert seen.value > learned
    out = ranking.score(docs, model).where(ranking.held_out(F.col("doc_id"))).collect()
    good, bad = ([r["score"] for r in out if kinds[r["doc_id"]] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.95
    again = ranking.fit(docs.repartition(7), labels.repartition(3), block=300)
    assert np.allclose(again.weights, model.weights, atol=1e-9) and again.threshold == pytest.approx(model.threshold)


def test_ranking_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = ranking.query(spark, SF).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50 and np.mean([r["quality"] == r["predicted"] for r in found]) > 0.95
    assert all((r["score"] >= 0.3) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in found)
    good, bad = ([r["score"] for r in found if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_ranking_edges(spark):
    rows = cases.documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    out = ranking.score(rows, ranking.fit(rows, labels))
    assert out.count() == rows.count() and "_extra" in out.columns
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert ranking.accepted(rows, labels).columns == rows.columns
    nobody = ranking.fit(rows, labels.where("false"))
    assert {r["predicted"] for r in ranking.score(rows, nobody).collect()} == {1}
    only_bad = ranking.fit(rows, labels.where("quality = 0"))
    assert {r["predicted"] for r in ranking.score(rows, only_bad).collect()} == {0}
    assert ranking.score(cases.nothing(spark), nobody).count() == 0


# Packing

ODD = [
    None, "", "   ", "don't I'll 'd ΑΣ x", "<|endoftext|> a <|STARTOFTEXT|>b", "á ́b é e\u0301", "x\ty\x0bz q r", "İstanbul ß ﬁ", "日本語 🙂🙂",
    "A1b22.C3", "x<y a'b", "\x1c\x1d a\x7fb\x00", "Ångström ŒUVRE ÀÉÎ×÷Ÿ ÿ", "AbC!!D,.E \u00a0x", "a\n\nb's 't",
]


def test_ids_are_those_of_the_tokenizer(spark):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    whole = Tokenizer.from_file(packing.tokenizer_path())
    for text, got in zip(texts, packing.Ids(packing.tokenizer_path(), 2000).of(pa.array(texts)), strict=True):
        assert got.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40), packing.Limits(100, 1, 7)])
def test_every_id_is_packed_once(limits):
    draw = random.Random(3)
    documents = [(i, np.arange(n, dtype="<u4") + i) for i, n in enumerate([1, 1, 5000, 2048, 2047, 64] + [draw.randint(1, 300) for _ in range(200)])]
    sequences = []
    packer = packing.Packer(limits, 16, sequences.append)
    for key, ids in documents:
        packer.add(packing.Piece(key, len(ids), 0, ids))
    packer.finish()
    parts = defaultdict(list)
    for sequence in sequences:
        size = sum(len(p.ids) for p in sequence)
        assert size == limits.tokens or size & (size - 1) == 0
        assert len(sequence) <= limits.segments and sum(p.loss for p in sequence) <= limits.loss
        for piece in sequence:
            parts[piece.key].append(piece)
    for key, ids in documents:
        joined = sorted(parts[key], key=lambda p: p.start)
        assert np.concatenate([p.ids for p in joined]).tolist() == ids.tolist()
        assert [p.start for p in joined] == np.cumsum([0, *(len(p.ids) for p in joined[:-1])]).tolist()


def test_the_limit_on_loss_closes_sequences():
    draw = random.Random(6)
    limits, sequences = packing.Limits(256, 50, 40), []
    packer = packing.Packer(limits, 64, sequences.append)
    documents = {}
    for i in range(300):
        prompt, answer = draw.choice([0, 1, 20, 60, 700]), draw.choice([1, 10, 25, 90])
        documents[i] = (prompt, np.arange(prompt + answer, dtype="<u4"))
        packer.add(packing.Piece(i, prompt + answer, 0, documents[i][1], max(1, prompt)))
    packer.finish()
    packed = Counter()
    for sequence in sequences:
        size = sum(len(p.ids) for p in sequence)
        loss = sum(sum(at >= max(1, documents[p.key][0]) for at in range(p.start, p.start + len(p.ids))) for p in sequence)
        assert loss == sum(p.loss for p in sequence) <= limits.loss and size <= limits.tokens and len(sequence) <= limits.segments
        assert size == limits.tokens or size & (size - 1) == 0
        packed.update((p.key, p.start + k) for p in sequence for k in range(len(p.ids)))
    assert packed == Counter((i, k) for i, (_, ids) in documents.items() for k in range(len(ids)))
    # Without that limit sequences go on to bear more loss, and fewer are needed.
    free = []
    packer = packing.Packer(limits._replace(loss=limits.tokens), 64, free.append)
    for i, (prompt, ids) in documents.items():
        packer.add(packing.Piece(i, len(ids), 0, ids, max(1, prompt)))
    packer.finish()
    assert sum(sum(p.loss for p in x) > limits.loss for x in free) > 50 and len(free) < len(sequences)


def test_prompts_bear_no_loss(spark):
    pairs = [("What is it?", "A dog."), (None, "no prompt"), ("no answer", None), ("", ""), (None, None), ("long " * 3000, "short"), ("x", "y " * 5000)]
    rows = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(pairs)], "doc_id long, asked string, text string")
    out = packing.pack(rows, packing.tokenizer_path(), prompt="asked", limits=packing.Limits(512, 8, 100)).collect()
    whole = Tokenizer.from_file(packing.tokenizer_path())
    for i, (prompt, text) in enumerate(pairs):
        first, rest = (whole.encode(x or "", add_special_tokens=False).ids for x in (prompt, text))
        ids = np.array([*first, *rest, 1], "<u4")
        mine = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["start"])
        assert sum(r["length"] for r in mine) == len(ids) and {r["doc_tokens"] for r in mine} == {len(ids)}
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in mine)
        assert sum(r["loss_tokens"] for r in mine) == len(ids) - max(1, len(first))
    loss = Counter()
    for r in out:
        loss[r["sequence_id"]] += r["loss_tokens"]
    assert 0 < max(loss.values()) <= 100


def test_packed_rows(spark):
    rows = cases.documents(spark)
    out = packing.pack(rows.repartition(3), packing.tokenizer_path()).collect()
    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids = defaultdict(list)
    for r in rows.collect():
        ids[r["doc_id"]].append(np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4"))
    crcs = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    for (key, start, length, crc), number in crcs.items():
        assert sum(zlib.crc32(x[start : start + length].tobytes()) == crc for x in ids[key]) >= min(number, 1)
    assert sum(r["length"] for r in out) == sum(len(x) for many in ids.values() for x in many)
    by_sequence = defaultdict(list)
    for r in out:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for at in by_sequence.values():
        at.sort()
        assert [a for a, _ in at] == np.cumsum([0, *(n for _, n in at[:-1])]).tolist()
    assert packing.pack(cases.nothing(spark), packing.tokenizer_path()).count() == 0


# Similarity join


def brute_classes(rows):
    sets = []
    for _, text in rows:
        w = cases.words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    links, parent = Counter(), list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(i)
    out = Counter()
    for at in members.values():
        known = [rows[i][0] for i in at if rows[i][0] is not None]
        for i in at:
            out[rows[i][0], min(known) if known else None, links[i]] += 1
    return out, len(members)


@pytest.mark.parametrize("block", [256, 3])
def test_similar_documents_equal_brute_force(spark, block):
    rows = cases.documents(spark)
    pairs = [(r["doc_id"], r["text"]) for r in rows.collect()]
    expected, classes = brute_classes(pairs)
    forest = jaccard.Forest(block=block)
    assert Counter(map(tuple, jaccard.join(rows, forest).collect())) == expected
    kept = jaccard.deduplicated(rows, forest)
    assert kept.columns == rows.columns and kept.count() == classes
    assert jaccard.join(cases.nothing(spark)).count() == 0
    assert jaccard.deduplicated(cases.nothing(spark)).count() == 0


def test_large_groups_lose_no_link(spark):
    draw = random.Random(4)
    base = cases.sentence(draw, 100).split(" ")
    rows = []
    for i in range(120):
        text = list(base)
        for _ in range(draw.randint(0, 4)):
            text[draw.randrange(100)] = f"w{draw.randrange(1000)}"
        rows.append((i, " ".join(text)))
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.Forest(block=16))
    assert Counter(map(tuple, found.collect())) == brute_classes(rows)[0]


def test_prefix_reaches_the_recall():
    forest = jaccard.Forest()
    length = forest.prefix(np.array([]))
    assert forest.chance(0.8, length) >= forest.recall > forest.chance(0.8, length + 1)
    # Pairs of one band do not make up for those of another.
    assert forest.prefix(np.array([0.99] * 1000)) == forest.depth
    assert forest.prefix(np.array([0.99] * 1000 + [0.81])) == forest.prefix(np.array([0.81]), 2) < forest.depth


def changed(draw, words, share):
    return " ".join(w if draw.random() > share else f"n{draw.random()}" for w in words)


def test_data_sets_end_at_different_depths(spark):
    """Nearly equal texts need long prefixes only, texts at the threshold short ones; both are found."""
    draw = random.Random(12)
    forest, lengths = jaccard.Forest(), []
    for share in (0.001, 0.02):
        bases = [[f"w{draw.randrange(10**6)}" for _ in range(300)] for _ in range(150)]
        rows = [(i, t) for i, t in enumerate(t for b in bases for t in (" ".join(b), changed(draw, b, share)))]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        keyed = frame.select(jaccard.text_key(F.col("text")).alias("key"), "text")
        found = stored(jaccard._labelled(keyed, forest), "labels")
        lengths.append(jaccard.prefix_length(keyed, found.dropDuplicates(["key"]), forest))
        assert Counter(map(tuple, jaccard.join(frame, forest).collect())) == brute_classes(rows)[0]
    assert lengths[0] > lengths[1]


def test_prefix_length_sees_every_pair(spark):
    """A few pairs at the threshold among thousands of texts and nearly equal pairs shorten the prefix."""
    draw = random.Random(21)
    bases = [[f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(9000)]
    texts = [t for b in bases[:6000] for t in (" ".join(b), " ".join(b) + " end")] + [" ".join(b) for b in bases]
    low = [" ".join(w if k != 20 else f"n{side}" for k, w in enumerate(b)) for b in bases[8990:] for side in "xy"]
    forest, lengths = jaccard.Forest(), []
    for some in (texts, texts + low):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "doc_id long, text string").repartition(8)
        keyed = frame.select(jaccard.text_key(F.col("text")).alias("key"), "text")
        found = stored(jaccard._labelled(keyed, forest), "labels").dropDuplicates(["key"])
        lengths.append(jaccard.prefix_length(keyed, found, forest))
    assert lengths[0] == forest.depth > lengths[1]


def test_texts_of_buckets_are_among_the_compared(spark):
    """Texts that share levels with another are known before buckets are made, also where labels are cut into ranges."""
    draw = random.Random(33)
    bases = [[f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(t for b in bases for t in (" ".join(b), changed(draw, b, 0.01), changed(draw, b, 1)))], "doc_id long, text string")
    forest = jaccard.Forest(trees=1)
    keyed = frame.select(jaccard.text_key(F.col("text")).alias("key"), "text")
    labelled = stored(jaccard._labelled(keyed, forest), "labels").dropDuplicates(["key"])
    members = defaultdict(set)
    for r in labelled.collect():
        for tree in range(forest.trees):
            members[tree, r["labels"][2 * tree] & (2**64 - 1) >> 32 << 32].add(bytes(r["key"]))
    expected = {k for group in members.values() if len(group) > 1 for k in group}
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(held, ("150", "false"), strict=True):
            spark.conf.set(k, v)
        pairs, found = jaccard._compared(keyed, labelled, forest)
        linked = {bytes(k) for r in pairs.collect() for k in r}
        keys = [bytes(r["key"]) for r in found.collect()]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(keys) == len(set(keys)) and set(keys) >= expected and len(expected) > 20
    assert linked < expected, "no range cuts a pair of neighbours here"


def test_hashing_of_grams_needs_little_memory():
    column = pa.array([cases.sentence(random.Random(i), 320) for i in range(3000)])
    tracemalloc.start()
    try:
        sets = jaccard.gram_sets(column, jaccard.Hasher(), 5)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert column.nbytes > 3 * jaccard.HASHED_BYTES and len(sets) == 3000
    assert most - sum(s.nbytes for s in sets) < 60 * jaccard.HASHED_BYTES


def test_salted_classes_are_not_broadcast(spark):
    kept = jaccard.deduplicated(cases.documents(spark))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_neighbours_are_those_of_the_sorted_tries(spark):
    block = next(jaccard.blocks(pa.array([cases.sentence(random.Random(i % 30), 40) + f" {i % 45}" for i in range(90)])))
    forest = jaccard.Forest(trees=2, depth=6)
    found = jaccard.labels(block, jaccard.Hasher(), forest).view(np.int64)
    levels = [[(h >> s) & 0xFFFF for half in (0, 1) for h in [int(row[half]) & (2**64 - 1)] for s in (48, 32, 16, 0)] for row in found]
    order = sorted(range(90), key=lambda i: tuple(map(int, found[i][:2])))
    high, low = (np.array([found[i][half] for i in order]) for half in (0, 1))
    expected = [0] + [next((k for k in range(8) if levels[a][k] != levels[b][k]), 8) for a, b in zip(order, order[1:])]
    assert jaccard.common_levels(high, low).tolist() == expected and max(expected) == 8 and min(expected[1:]) == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 299), (299, 300), (None, 1)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(roots) == len(found)
    assert roots == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 299: 299, 300: 299}


# Spot signatures


def test_fingerprints_of_awkward_documents(spark):
    rows = cases.documents(spark)
    found = spotsigs.compare(rows).collect()
    assert len(found) == rows.count()
    texts = {r["doc_id"]: r["text"] for r in rows.where("doc_id is not null").collect()}
    ids = sorted(texts)
    by_text = {}
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is not None:
            text = texts[r["doc_id"]] or ""
            assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"] and r["n_chars"] == len(text)
    assert ids[0] == 0 and spotsigs.compare(cases.nothing(spark)).count() == 0


def test_few_anchors_do_not_stand_for_a_long_text(spark):
    draw = random.Random(3)
    long = cases.sentence(draw, 200, "bcdfgklm")
    rows = [(0, f"the {long}"), (1, long), (2, "the " + cases.sentence(draw, 5, "bcdfgklm")), (3, " ".join(f"the {w}" for w in long.split())), (4, "a of the")]
    found = {r["doc_id"]: r for r in spotsigs.compare(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sizes = {i: len(r["fingerprint"]) // 8 for i, r in found.items()}
    assert sizes[0] > 150 and sizes[1] > 150 and sizes[2] == 1 and sizes[3] > 150 and sizes[4] == 1
    # The true index, however unlike the sizes are.
    assert found[0]["near_next"] > 0.98 and found[0]["alike_next"] and not found[1]["alike_next"]
    sets = spark.sql("select transform(sequence(1, 9), x -> string(x)) a, transform(sequence(1, 100), x -> string(x)) b")
    r = sets.select(spotsigs.likeness(F.col("a"), F.col("b")).alias("n"), spotsigs.alike(F.col("a"), F.col("b"), spotsigs.likeness(F.col("a"), F.col("b")), 0.05).alias("x")).first()
    assert r["n"] == 0.09 and r["x"]


# URLs


def test_globs_equal_a_plain_matcher():
    import re

    draw = random.Random(6)
    globs = ["a*b", "**x", "?b**", "a**c?", "*", "**", "ab/c", "é?*", "*a*/**b"] + ["".join(draw.choice("ab*?/") for _ in range(draw.randint(1, 9))) for _ in range(40)]
    texts = ["", "a", "ab", "a/b", "aéb", "éxx", "ab/c"] + ["".join(draw.choice("abcé/x") for _ in range(draw.randint(0, 12))) for _ in range(120)]
    machine = urls.compile_globs(globs)
    assert machine.width > 1
    raw = [t.encode() for t in texts]
    found = urls.run_automaton(machine, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for g, glob in enumerate(globs):
        pattern = re.sub(r"\*\*|\*|\?|[^*?]", lambda m: {"**": ".*", "*": "[^/]*", "?": "."}.get(m[0], re.escape(m[0])), glob)
        assert [bool(re.fullmatch(pattern, t, re.S)) for t in texts] == found[:, g].tolist(), glob


def test_url_edges(spark):
    cases_ = [
        (None, "", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("http://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.example.org/en/12?x", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("http://org", "org", "", None, "allow"),
        ("x://É.com/fr/#a", "É.com", "/fr/", "com/fr/", "allow"),
        ("http://a.com?/de/", "a.com", "", None, "allow"),
        ("http://a://b.com/de/x", "a:", "//b.com/de/x", None, "allow"),
        ("http://cheap-pills.net/x", "cheap-pills.net", "/x", None, "block"),
        ("http://x.net/" + "y" * 9000, "x.net", "/" + "y" * 9000, None, "allow"),
    ]
    rows = spark.createDataFrame([(i, c[0], "old") for i, c in enumerate(cases_)] + [(None, None, None)] * 2, "page_id long, url string, verdict string")
    found = {r["page_id"]: r for r in urls.judge(rows).collect()}
    for i, case in enumerate(cases_):
        assert tuple(found[i][c] for c in ("host", "path", "rule", "verdict")) == case[1:]
    assert urls.judge(rows).count() == len(cases_) + 2 and urls.judge(rows.where("false")).count() == 0
    with pytest.raises(ValueError):
        urls.compile_globs([""])
