"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text of each language knows all of its substrings. A
text is parsed against it greedily: each phrase is the longest match from where the
last one ended. A language in which the text falls into few phrases, weighed by
log2 of the reference's length per letter, is a language like the reference; the
smallest such rate wins, equal ones by the language's name.

Letters and combining marks of all planes are lower-cased and all else is one
separator. A text is cut into pieces of ``PIECE`` symbols that are parsed side by
side, a step of all pieces and languages being one array lookup; each piece ends its
last phrase. All symbols count.

The automata come from a bounded sample: ``SAMPLE_TEXTS`` texts of a language with
even shares of ``SAMPLE_SYMBOLS`` symbols, ``SAMPLE_ALL`` in all languages or ``FLOOR`` in each
if that is more. A symbol takes about 0.4 KB; the automata are sent to the workers. Texts are read in one narrow pass.
"""

from __future__ import annotations

import sys
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.text import in_batches

#: Texts and symbols of each language that are learned from, at most; and in all.
SAMPLE_TEXTS = 60
SAMPLE_SYMBOLS = 24_000
SAMPLE_ALL = 240_000
#: Symbols that each language may give, however many languages there are.
FLOOR = 2_000
#: Parts of a text that is longer than its share of the sample.
SLICES = 4
#: Symbols with a number of their own; the others share the last SHARED numbers.
OWN = 48
SHARED = 15
PIECE = 1024
BATCH_SYMBOLS = 1 << 21
UNKNOWN = "und"
SEED = 11


class Model(NamedTuple):
    """``table[s, c]`` is the state after symbol c in state s of all automata, row
    0 of each language its root; negative, and off by one, where a phrase ended."""

    languages: list[str]
    roots: np.ndarray
    rates: np.ndarray  # bits that a phrase costs
    table: np.ndarray
    classes: np.ndarray  # number of each code point, 0 a separator; the first shared one for all that share
    shared: int  # first shared number
    letters: np.ndarray  # whether a code point is a letter


def symbols(text: str) -> np.ndarray:
    """The code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _categories() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point of all planes is a letter, and whether a combining mark."""
    first = np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    return first == "L", first == "M"


def _numbered(points: np.ndarray, classes: np.ndarray, shared: int) -> np.ndarray:
    out = classes[points]
    shares = np.flatnonzero(out == shared)
    out[shares] = shared + points[shares] % SHARED
    return out


def _squeezed(numbers: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without separators that follow a separator or a text's start; new breaks."""
    keep = numbers != 0
    keep[1:] |= numbers[:-1] != 0
    first = breaks[:-1][breaks[:-1] < len(numbers)]
    keep[first] = numbers[first] != 0
    sums = np.zeros(len(numbers) + 1, np.int64)
    np.cumsum(keep, out=sums[1:])
    return numbers[keep], sums[breaks]


def automaton(sequence: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the suffix automaton of a sequence; -1 where there is none."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in sequence.tolist():
        state = len(length)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in following[at]:
            following[at][symbol] = state
            at = link[at]
        if at != -1:
            old = following[at][symbol]
            if length[at] + 1 == length[old]:
                link[state] = old
            else:
                copy = len(length)
                following.append(dict(following[old]))
                length.append(length[at] + 1)
                link.append(link[old])
                while at != -1 and following[at].get(symbol) == old:
                    following[at][symbol] = copy
                    at = link[at]
                link[old] = link[state] = copy
        last = state
    table = np.full((len(length), width), -1, np.int32)
    for state, moves in enumerate(following):
        if moves:
            table[state, list(moves)] = list(moves.values())
    return table


def shares(sizes: list[int], most: int) -> list[int]:
    """Even shares of ``most`` for texts of these sizes, none above its text's size."""
    out, left = [0] * len(sizes), most
    for rank, at in enumerate(sorted(range(len(sizes)), key=sizes.__getitem__)):
        out[at] = min(sizes[at], -(-left // (len(sizes) - rank)))
        left -= out[at]
    return out


def _shared(texts: list[str], most: int) -> list[str]:
    """The parts of each text that are learned from: evenly spaced slices of its share."""
    out = []
    for text, share in zip(texts, shares([len(t) for t in texts], most), strict=True):
        each = -(-share // SLICES)
        if share == len(text) or each * SLICES >= len(text):
            out.append(text)
        else:
            starts = [k * (len(text) - each) // (SLICES - 1) for k in range(SLICES)]
            out.append("\n".join(text[a : a + each] for a in starts))
    return out


def learn(samples: dict[str, list[str]], most: int = SAMPLE_SYMBOLS, most_all: int = SAMPLE_ALL) -> Model:
    """Automata of the languages' sample texts, each up to ``most`` symbols.

    All languages together get ``most_all`` symbols, but none less than ``FLOOR``.
    The texts of a language have even shares; what short texts leave is given to the
    longer ones, and of a text longer than its share ``SLICES`` slices are taken.
    """
    languages = sorted(samples)
    most = max(1, min(most, max(FLOOR, most_all // max(1, len(languages)))))
    letters, marks = _categories()
    used = letters | marks
    joined = {name: symbols("\n".join(_shared(samples[name], most))) for name in languages}
    plain = np.concatenate([*joined.values(), np.zeros(0, np.uint32)])
    often = np.bincount(plain, minlength=len(used)) * used
    ranked = [int(c) for c in np.argsort(-often, kind="stable")[: OWN - 1] if often[c]]
    shared, width = OWN, OWN + SHARED
    classes = np.zeros(len(used), np.uint8)
    classes[used] = shared
    classes[ranked] = np.arange(1, len(ranked) + 1)
    tables, roots, rates, base = [], [], [], 0
    for name in languages:
        numbers = _numbered(joined[name], classes, shared)
        numbers, _ = _squeezed(numbers, np.array([0, len(numbers)]))
        table = automaton(numbers[:most], width)
        # A symbol that continues no match ends the phrase and begins the next.
        restart = np.where(table[0] >= 0, table[0], 0) + base
        moved = np.where(table >= 0, table + base, -1 - restart[None, :])
        tables.append(moved.astype(np.int32))
        roots.append(base)
        rates.append(np.log2(max(2, min(most, len(numbers)))))
        base += len(table)
    table = np.concatenate(tables) if tables else np.zeros((0, width), np.int32)
    return Model(languages, np.array(roots, np.int32), np.array(rates), table, classes, shared, letters)


def phrases(model: Model, numbers: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Phrases of each text in each language: a matrix (texts, languages)."""
    sizes = np.diff(breaks)
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = breaks[:-1][owner] + within * PIECE
    lengths = np.minimum(PIECE, sizes[owner] - within * PIECE)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    # Pieces by columns, so that a step reads one row.
    width = model.table.shape[1]
    flat = model.table.ravel()
    state = np.repeat(model.roots[:, None], len(order), axis=1)
    found = np.zeros(state.shape, np.int32)
    alive = len(order)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        alive = int(np.searchsorted(-lengths[:alive], -step, "left"))
        at = state[:, :alive] * width + numbers[starts[:alive] + step]
        after = flat.take(at)
        ended = after >> 31
        found[:, :alive] -= ended
        state[:, :alive] = after ^ ended
    found += 1
    out = np.zeros((len(sizes), len(model.languages)))
    for k in range(len(model.languages)):
        out[:, k] = np.bincount(owner[order], found[k], len(sizes))
    return out


def _counted(flags: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """How many flags are set between each break and the next."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[breaks[1:]] - sums[breaks[:-1]]


def predictions(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is how much cheaper than the
    next language's the winning parse is, 0 (equal) to 1."""
    names = np.full(len(texts), UNKNOWN, object)
    scores = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        points, breaks = [], [0]
        first = at
        while at < len(texts) and (at == first or breaks[-1] < BATCH_SYMBOLS):
            points.append(symbols(texts[at] or ""))
            breaks.append(breaks[-1] + len(points[-1]))
            at += 1
        if not model.languages:
            continue
        joined = np.concatenate(points)
        letters = _counted(model.letters[joined], np.array(breaks))
        numbers, cuts = _squeezed(_numbered(joined, model.classes, model.shared), np.array(breaks))
        used = _counted(numbers > 0, cuts)
        rate = phrases(model, numbers, cuts) * model.rates[None, :] / np.maximum(used, 1)[:, None]
        best = rate.argmin(axis=1)
        ordered = np.sort(rate, axis=1)
        gain = 1 - ordered[:, 0] / np.maximum(ordered[:, 1], 1e-12) if len(model.languages) > 1 else np.ones(len(rate))
        known = letters > 0
        names[first:at][known] = np.array(model.languages, object)[best[known]]
        scores[first:at][known] = np.clip(gain[known], 0, 1)
    return names.tolist(), scores


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _middle(text: Column, most: int) -> Column:
    """At most ``most`` characters from the middle of a text."""
    return F.substring(text, F.greatest(F.lit(0), F.floor((F.length(text) - most) / 2)).cast("int") + 1, F.lit(most))


def fit(documents: DataFrame, texts: int = SAMPLE_TEXTS) -> Model:
    """Learns from rows with an id that is not held out, a text and a language.

    Each language gives the texts with the lowest hashes: Spark cuts the row number
    off before its shuffle, so a frequent language meets in no task. At most
    ``texts`` texts of a language reach the driver, of a very long one its middle.
    """
    known = documents.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}"))
    rows = known.select("lang", _middle(F.col("text"), 4 * SAMPLE_SYMBOLS).alias("text"), F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(SEED)).alias("_hash"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_hash", "text"))
    sample = rows.withColumn("_place", place).where(F.col("_place") <= texts)
    found = sample.select("lang", "_place", "text").collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["_place"])):
        samples.setdefault(row["lang"], []).append(row["text"])
    return learn(samples)


def identify(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` without the text, with ``lang_pred`` and ``score``.

    Texts that are null or have no letter are ``und`` with score 0, as are all
    texts of a model that learned no language. Rows are neither dropped nor merged;
    columns with a result's name are replaced.
    """
    kept = [c for c in documents.columns if c != text and c.lower() not in ("lang_pred", "score")]
    rows = documents.select(*(documents[f"`{c}`"] for c in kept), documents[f"`{text}`"])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            names, scores = predictions(sent.value, batch.column(len(kept)).to_pylist())
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "score"])

    return in_batches(rows, work, ", ".join([*fields, "lang_pred string", "score double"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op4_language_id``: the language of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents.select("doc_id", "lang", "text"))
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, model)
