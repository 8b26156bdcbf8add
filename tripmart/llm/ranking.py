"""Document quality by pairwise preferences (a Bradley-Terry model).

Each text becomes a few surface measures, taken from all of its bytes, and the counts
of its words and pairs of neighbouring words, hashed into buckets. Measures are
spread over steps at their quantiles over all labelled texts, so a preference need not
be linear in them; counts are damped by a logarithm and brought to length 1. The
labelled texts are dealt out in blocks of bounded size. In each block pairs of a good and
a bad text are formed, in which every text occurs; the probability that the good one is
preferred is the logistic function of the difference of their scores, and the block's
weights minimise the logistic loss over its pairs. The weights of the model are the mean
of all blocks'. A score quantile then separates the texts: as many labelled texts lie
under it as are labelled bad. Learning reads every labelled text, scoring every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.mixing import stored
from tripmart.llm.text import Hasher, blocks, characters, counts, in_batches, lines, mixed, repeats, words

#: Texts of a label in a block, about; those it has at least, if there are as many; and its pairs.
BLOCK = 2000
LEAST = 200
PAIRS = 20000
#: Pairs whose differences are in memory at once.
CHUNK = 500
#: Labelled ids that are broadcast, at most.
BROADCAST = 1 << 20
#: Bounds the rank error of quantiles over all labelled texts: one part in this many.
ACCURACY = 100_000
STEPS = 12
RIDGE = 1e-3
#: Buckets of hashed words and pairs of words.
BUCKETS = 512
ROUNDS = 25
#: Score of a text that lies just at the threshold, by the query contract.
CUT = 0.3
SEED = 7
MEASURES = [
    "log_words",
    "log_characters",
    "characters_per_word",
    "capital_share",
    "digit_share",
    "symbol_share",
    "sentence_mark_share",
    "other_mark_share",
    "space_share",
    "beyond_ascii_share",
    "log_words_per_distinct_word",
    "distinct_growth",
    "repeated_line_share",
    "log_words_per_line",
    "marked_word_share",
    "capital_start_share",
]


def _table(characters_: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters_]] = True
    return out


_CAPITALS = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _table("0123456789")
_SYMBOLS = _table("#*$%&|<>")
_SENTENCE = _table(".,;:")
_OTHER = _table("!?()[]{}=+-_/\\@^~`'\"")


def grams(owner: np.ndarray, hashes: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Sums in a row of ``buckets`` for each of ``n`` texts, from the hashes of their words, in order.

    Each word, and each pair of neighbours, adds 1 to a bucket or takes 1 off, by its
    hash, so words that share a bucket cancel rather than pile up. Words that differ and
    have the same 64-bit hash count as one: nothing checks for them.
    """
    beside = owner[1:] == owner[:-1]
    pairs = mixed(hashes[1:] + mixed(hashes[:-1]))[beside]
    every, at = np.concatenate([hashes, pairs]), np.concatenate([owner, owner[1:][beside]])
    bucket = (every >> np.uint64(1)) % np.uint64(buckets)
    sign = 1.0 - 2.0 * (every & np.uint64(1)).astype(float)
    return np.bincount(at * buckets + bucket.astype(np.int64), sign, n * buckets).reshape(n, buckets).astype("<i4")


def damped(sums: np.ndarray) -> np.ndarray:
    """Sums as ``sign * log(1 + size)``, each row brought to length 1; without words it is zero."""
    logs = np.sign(sums) * np.log1p(np.abs(sums))
    return logs / np.maximum(np.sqrt((logs**2).sum(axis=1, keepdims=True)), 1e-12)


def measures(column: pa.Array, buckets: int = 0) -> np.ndarray:
    """A row of MEASURES for each text, and of ``buckets`` of its damped grams behind them.

    Null and empty texts: all zero.
    """
    out = [np.concatenate([found, damped(sums)], axis=1) for found, sums in _counted(column, buckets)]
    return np.concatenate(out) if out else np.zeros((0, len(MEASURES) + buckets))


def _counted(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The measures, and the sums of grams, of each block of texts."""
    hasher = Hasher()
    for block in blocks(column):
        data = block.data
        starts, ends, owner = words(block)
        n_words = np.bincount(owner, minlength=block.n)
        hashes = hasher.ranges(data, starts, ends)
        distinct = n_words - repeats(owner, hashes, block.n)
        _, _, line_owner, line_hashes = lines(block, hasher)
        n_lines = np.bincount(line_owner, minlength=block.n)
        n_bytes = np.diff(block.offsets)
        n_chars = counts(block, characters(data))
        some_bytes, some_words, some_lines = np.maximum(n_bytes, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
        word_chars = n_chars - counts(block, (data == 32) | ((data >= 9) & (data <= 13)))
        marked = np.bincount(owner, (_SYMBOLS | _OTHER)[data[ends - 1]] if len(ends) else None, block.n)
        capital = np.bincount(owner, _CAPITALS[data[starts]] if len(starts) else None, block.n)
        share = lambda table, data=data, block=block, some=some_bytes: counts(block, table[data]) / some
        found = np.stack(
            [
                np.log1p(n_words),
                np.log1p(n_chars),
                word_chars / some_words,
                share(_CAPITALS),
                share(_DIGITS),
                share(_SYMBOLS),
                share(_SENTENCE),
                share(_OTHER),
                (n_chars - word_chars) / some_bytes,
                counts(block, data >= 0x80) / some_bytes,
                np.log(some_words / np.maximum(distinct, 1)),
                np.log(np.maximum(distinct, 1)) / np.log(some_words + 1.0),
                repeats(line_owner, line_hashes, block.n) / some_lines,
                np.log(some_words / some_lines),
                marked / some_words,
                capital / some_words,
            ],
            axis=1,
        )
        yield found, grams(owner, hashes, block.n, buckets) if buckets else np.zeros((block.n, 0), "<i4")


def _packed(column: pa.Array) -> list[bytes]:
    """The measures of each text as doubles and its sums of grams as 4-byte integers: exact, and half the size of doubles."""
    return [m.tobytes() + g.tobytes() for found, sums in _counted(column, BUCKETS) for m, g in zip(found.astype("<f8"), sums, strict=True)]


def _values(packed: list[bytes]) -> np.ndarray:
    """What ``measures`` returns, from packed rows."""
    found = np.empty((len(packed), len(MEASURES) + BUCKETS))
    for row, x in zip(found, packed, strict=True):
        row[: len(MEASURES)] = np.frombuffer(x, "<f8", len(MEASURES))
        row[len(MEASURES) :] = np.frombuffer(x, "<i4", BUCKETS, 8 * len(MEASURES))
    found[:, len(MEASURES) :] = damped(found[:, len(MEASURES) :])
    return found


class Model(NamedTuple):
    """Steps of each measure, weights of measures, steps and buckets, and the score's scale."""

    steps: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float
    scale: float


def _spread_out(values: np.ndarray, steps: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    measured_, hashed = values[:, : len(MEASURES)], values[:, len(MEASURES) :]
    linear = np.clip((measured_ - centre) / spread, -5, 5)
    above = (measured_[:, :, None] > steps[None, :, :]).reshape(len(values), -1)
    return np.concatenate([linear, above.astype(float), hashed], axis=1)


def solved(x_good: np.ndarray, x_bad: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Weights by Newton's method on the logistic loss of the pairs ``i, j`` of rows."""
    weights = np.zeros(x_good.shape[1])
    for _ in range(ROUNDS):
        slope, bend = RIDGE * weights, RIDGE * np.eye(len(weights))
        for low in range(0, len(i), CHUNK):
            difference = x_good[i[low : low + CHUNK]]
            difference -= x_bad[j[low : low + CHUNK]]
            wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -500, 500)))
            slope -= difference.T @ wrong / len(i)
            bend += (difference * (wrong * (1 - wrong))[:, None]).T @ difference / len(i)
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def block_weights(good: np.ndarray, bad: np.ndarray, steps: np.ndarray, centre: np.ndarray, spread: np.ndarray, pairs: int = PAIRS) -> np.ndarray:
    """The weights of one block, from pairs in which each of its texts occurs."""
    draw = np.random.default_rng(SEED)
    pairs = max(pairs, len(good), len(bad))
    i, j = (np.concatenate([draw.permutation(n) for _ in range(-(-pairs // n))])[:pairs] for n in (len(good), len(bad)))
    return solved(*(_spread_out(x, steps, centre, spread) for x in (good, bad)), i, j)


def learn(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int = PAIRS) -> Model:
    """The model of one block that is in memory, from ``pairs`` drawn pairs.

    ``bad_share`` is the share of label 0 among all labelled rows; the threshold is
    that quantile of the sample's scores, each label weighted by its true share.
    Without texts of both labels there is nothing to prefer: all weights are zero.
    """
    buckets = good.shape[1] - len(MEASURES)
    both = np.concatenate([good, bad])[:, : len(MEASURES)] if len(good) + len(bad) else np.zeros((1, len(MEASURES)))
    steps = np.quantile(both, np.linspace(0, 1, STEPS + 2)[1:-1], axis=0).T
    centre, spread = both.mean(axis=0), both.std(axis=0) + 1e-9
    if not len(good) or not len(bad):
        width = len(MEASURES) * (1 + STEPS) + buckets
        return Model(steps, centre, spread, np.zeros(width), -1.0 if not len(bad) else 1.0, 1.0)
    draw = np.random.default_rng(SEED)
    x_good, x_bad = (_spread_out(x, steps, centre, spread) for x in (good, bad))
    weights = solved(x_good, x_bad, draw.integers(len(good), size=pairs), draw.integers(len(bad), size=pairs))
    scores = np.concatenate([x_good @ weights, x_bad @ weights])
    share = np.concatenate([np.full(len(good), (1 - bad_share) / len(good)), np.full(len(bad), bad_share / len(bad))])
    order = np.argsort(scores, kind="stable")
    at = int(np.searchsorted(np.cumsum(share[order]), bad_share + 1e-12))
    # The middle of the two scores around the quantile.
    threshold = (scores[order[max(at - 1, 0)]] + scores[order[min(at, len(order) - 1)]]) / 2
    gap = np.median(x_good @ weights) - np.median(x_bad @ weights)
    return Model(steps, centre, spread, weights, float(threshold), float(max(gap, 1e-9) / 10))


def scores(values: np.ndarray, model: Model) -> np.ndarray:
    """0 to 1; CUT exactly at the threshold."""
    raw = _spread_out(values, model.steps, model.centre, model.spread) @ model.weights
    level = np.log(CUT / (1 - CUT)) + (raw - model.threshold) / model.scale
    return 1 / (1 + np.exp(-np.clip(level, -500, 500)))


def _rows_of(kept: list[str], model: Model | None):
    def work(batches):
        for batch in batches:
            text, arrays = batch.column(len(kept)), [batch.column(i) for i in range(len(kept))]
            if model is None:
                arrays.append(pa.array(_packed(text), pa.binary()))
            else:
                arrays.append(pa.array(scores(measures(text, BUCKETS), model), pa.float64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "_out"])

    return work


def measured(rows: DataFrame, text: str, model: Model | None = None) -> DataFrame:
    """All columns but ``text`` with ``_out``: the measures and grams as bytes, or the scores of a model."""
    kept = [c for c in rows.columns if c != text]
    ordered = rows.select(*(rows[f"`{c}`"] for c in kept), rows[f"`{text}`"].alias("_text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in ordered.schema.fields[:-1])
    return in_batches(ordered, _rows_of(kept, model), fields + ("_out binary" if model is None else "_out double"))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _columns() -> list[Column]:
    """The measures of a stored row as doubles."""
    return [F.col("_measures")[i] for i in range(len(MEASURES))]


def _unpacked(rows: DataFrame) -> DataFrame:
    """``(doc_id, quality, _out)`` with the measures as an array of doubles."""

    def work(batches):
        for batch in batches:
            values = [np.frombuffer(x.as_py(), "<f8", len(MEASURES)).tolist() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "quality", "_out", "_measures"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_batches(rows, work, f"doc_id {kind}, quality int, _out binary, _measures array<double>")


def _weights_of_blocks(rows: DataFrame, steps: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> DataFrame:
    """``(block, weights)`` of every block that has texts of both labels."""

    def work(key, table):
        packed, quality = table.column("_out"), table.column("quality").to_numpy()
        order = np.lexsort([table.column("place").to_numpy()])
        good, bad = (_values([packed[int(i)].as_py() for i in order if quality[i] == q]) for q in (1, 0))
        found = [block_weights(good, bad, steps, centre, spread).tolist()] if len(good) and len(bad) else []
        return pa.table({"block": pa.array([key[0].as_py()] * len(found), pa.int64()), "weights": pa.array(found, pa.list_(pa.float64()))})

    return rows.groupBy("block").applyInArrow(work, "block long, weights array<double>")


def _raw_scores(rows: DataFrame, model: Model) -> DataFrame:
    """``(quality, raw)``: scores before they are brought to 0 to 1."""

    def work(batches):
        for batch in batches:
            raw = _spread_out(_values(batch.column(1).to_pylist()), model.steps, model.centre, model.spread) @ model.weights
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.float64())], names=["quality", "raw"])

    return in_batches(rows.select("quality", "_out"), work, "quality int, raw double")


def fit(documents: DataFrame, labels: DataFrame, block: int = BLOCK) -> Model:
    """Learns from all labelled rows that are not held out.

    Rows without a text or without a label 0 or 1 teach nothing. Of repeated labels
    of an id the smallest counts. Texts go to blocks by a hash of their id; a rare label's
    texts go to several, so that a block has about ``LEAST`` of them. Measures and grams
    of labelled texts are stored, some 2 KB each. The driver gets the weights of each
    block, some 6 KB for ``block`` texts, and quantiles.
    """
    width = len(MEASURES) + BUCKETS
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull())
    # Up to this many ids spare the texts a shuffle; more would be too large to broadcast.
    side = F.broadcast(known) if known.count() <= BROADCAST else known
    joined = texts.join(side, "doc_id").select("doc_id", "quality", "text")
    # One row for each id, however often it is repeated.
    found = measured(joined, "text").groupBy("doc_id", "quality").agg(F.min("_out").alias("_out"))
    rows = stored(_unpacked(found), "labelled-measures")
    numbers = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    n_good, n_bad = numbers.get(1, 0), numbers.get(0, 0)
    if not n_good or not n_bad:
        return learn(np.zeros((n_good, width)), np.zeros((n_bad, width)), 0.0)

    cuts = np.linspace(0, 1, STEPS + 2)[1:-1].tolist()
    columns = _columns()
    facts = rows.agg(
        *(F.percentile_approx(c, cuts, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)),
        *(F.avg(c).alias(f"a{i}") for i, c in enumerate(columns)),
        *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    steps, centre, spread = (np.array([facts[f"{k}{i}"] for i in range(len(MEASURES))]) for k in "qas")
    spread = spread + 1e-9

    n_blocks = max(1, -(-max(n_good, n_bad) // block))
    shares = {1: min(n_blocks, -(-n_blocks * LEAST // n_good)), 0: min(n_blocks, -(-n_blocks * LEAST // n_bad))}
    times = F.when(F.col("quality") == 1, shares[1]).otherwise(shares[0])
    place = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    dealt = rows.select("quality", "_out", place.alias("place"), F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"))
    dealt = dealt.select("quality", "_out", "place", F.pmod(F.col("place") + F.col("copy"), F.lit(n_blocks)).alias("block"))
    blocks_ = sorted(_weights_of_blocks(dealt, steps, centre, spread).collect())
    weights = np.mean([r["weights"] for r in blocks_], axis=0) if blocks_ else np.zeros(len(MEASURES) * (1 + STEPS) + BUCKETS)

    model = Model(steps, centre, spread, weights, 0.0, 1.0)
    scored = stored(_raw_scores(rows, model), "labelled-scores")
    of = lambda q: F.percentile_approx(F.when(F.col("quality") == q, F.col("raw")), 0.5, ACCURACY)
    below = F.percentile_approx("raw", F.lit(n_bad / (n_good + n_bad)), ACCURACY)
    at = scored.agg(below.alias("below"), of(1).alias("good"), of(0).alias("bad")).first()
    above = scored.where(F.col("raw") > at["below"]).agg(F.min("raw")).first()[0]
    # The middle of the two scores around the quantile.
    threshold = (at["below"] + (at["below"] if above is None else above)) / 2
    return model._replace(threshold=float(threshold), scale=float(max(at["good"] - at["bad"], 1e-9) / 10))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``score`` and ``predicted`` (1 from CUT on), all rows and columns.

    Null and empty texts score like texts whose measures are all zero. Columns of
    the input with a result's name are replaced. One narrow pass without a shuffle.
    """
    rows = documents.select(*(documents[f"`{c}`"] for c in documents.columns if c.lower() not in ("score", "predicted", "_out")))
    names = rows.columns
    out = measured(rows.withColumn("_copy", F.col(f"`{text}`")), "_copy", model)
    return out.select(*(out[f"`{c}`"] for c in names), out["_out"].alias("score"), (out["_out"] >= CUT).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that a model learned from ``labels`` does not reject; all columns."""
    rows = documents.select(F.struct("*").alias("_row"), F.col("text").alias("_copy"))
    return measured(rows, "_copy", fit(documents, labels)).where(F.col("_out") >= CUT).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op7_quality_classifier``: the score of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    out = measured(rows, "text", model)
    return out.select("doc_id", "held_out", F.col("_out").alias("score"), (F.col("_out") >= CUT).cast("int").alias("predicted"))
