"""Filter interaction audit by wide packed counters.

Filters run one after the other, and what a filter removes depends on those before
it. The audit plays every order of the filters. What happens to a document depends
on its mask alone, one bit for each filter that it fails, and on its labels. So each
mask has one big integer whose fields hold all outcomes: for each order, step and
count a field of 64 bits that is 0 or 1. A task adds up the integers of its rows, one
sum for each part; sums of tasks are added in two levels, each as a stream; and the
fields of a part's total are its counts. No carry leaves a field, because a table has
fewer than 2^64 rows.

A document is a duplicate if the same text has a smaller id. Texts are known by their
SHA-256; only the first id of each repeated text is joined back, to rows without
texts. First ids are stored, so both sides of that join are dealt out by their own
shuffle and a text that very many documents share can be split.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.mixing import stored
from tripmart.llm.text import SPACES, Hasher, blocks, characters, counts, in_batches, repeats, words

#: Counts of a step, in the order of their fields; ``shapley`` follows from ``removed``.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8
#: Parts whose sums a task holds at a time; further ones are handed on first.
MOST_PARTS = 256
#: Streams that a part's sums are added in before the last one.
SALTS = 32

LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_UPPER_PERCENT = 10
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|")] = True
FILTERS = "ABCDE"


class Layout(NamedTuple):
    """The filters' letters; bit i of a mask is the i-th letter."""

    filters: str

    @property
    def orders(self) -> list[str]:
        return ["".join(p) for p in permutations(self.filters)]

    @property
    def fields(self) -> int:
        return len(self.orders) * len(self.filters) * len(COUNTS)


def outcomes(layout: Layout, mask: int, good: bool, toxic: bool) -> np.ndarray:
    """0 or 1 for each order, step and count: what happens to one such document."""
    out = np.zeros((len(layout.orders), len(layout.filters), len(COUNTS)), np.uint64)
    bit = {letter: 1 << i for i, letter in enumerate(layout.filters)}
    for k, order in enumerate(layout.orders):
        before = 0
        for step, letter in enumerate(order):
            fails, gone = bool(mask & bit[letter]), bool(mask & before)
            removed = fails and not gone
            out[k, step] = (not fails and not gone, removed, fails and gone, mask == bit[letter], removed and good, removed and toxic)
            before |= bit[letter]
    return out


def packed(layout: Layout) -> list[int]:
    """The big integer of each mask with its labels: index mask * 4 + good * 2 + toxic."""
    return [
        int.from_bytes(outcomes(layout, mask, bool(marks & 2), bool(marks & 1)).astype("<u8").tobytes(), "little")
        for mask in range(1 << len(layout.filters))
        for marks in range(4)
    ]


def unpacked(layout: Layout, total: int) -> np.ndarray:
    """The fields of a sum as counts: (orders, steps, counts)."""
    fields = np.frombuffer(total.to_bytes(layout.fields * FIELD_BYTES, "little"), "<u8")
    return fields.reshape(len(layout.orders), len(layout.filters), len(COUNTS)).astype(np.int64)


def _sums(totals: dict[str, int], layout: Layout) -> pa.RecordBatch:
    size = layout.fields * FIELD_BYTES
    values = [v.to_bytes(size, "little") for v in totals.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(values, pa.binary())], names=["part", "total"])


def _summed(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows ``(part, code)`` to sums ``(part, total)`` of each task."""
    sent = rows.sparkSession.sparkContext.broadcast(packed(layout))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, totals = sent.value, {}
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            pairs = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(table) + batch.column(1).to_numpy()
            found, number = np.unique(pairs, return_counts=True)
            names = parts.dictionary.to_pylist()
            for pair, n in zip(found.tolist(), number.tolist(), strict=True):
                name = names[pair // len(table)]
                totals[name] = totals.get(name, 0) + table[pair % len(table)] * n
            if len(totals) > MOST_PARTS:
                yield _sums(totals, layout)
                totals = {}
        if totals:
            yield _sums(totals, layout)

    return in_batches(rows, work, "part string, total binary")


def _added(rows: DataFrame, layout: Layout) -> DataFrame:
    """Sums sorted by part: one sum for each run of equal parts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != part:
                    if part is not None:
                        yield _sums({part: total}, layout)
                    part, total = name, 0
                total += int.from_bytes(value, "little")
        if part is not None:
            yield _sums({part: total}, layout)

    return in_batches(rows, work, "part string, total binary")


def _reported(rows: DataFrame, layout: Layout) -> DataFrame:
    """Whole sums to a row for each part, order and step."""
    orders, steps = layout.orders, len(layout.filters)
    letters = np.array([[layout.filters.index(c) for c in order] for order in orders])
    columns = [*COUNTS, "shapley"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = unpacked(layout, int.from_bytes(total, "little"))
                of_filter = np.zeros(steps, np.int64)
                np.add.at(of_filter, letters.ravel(), found[:, :, COUNTS.index("removed")].ravel())
                arrays = [
                    pa.array([part] * (len(orders) * steps), pa.string()),
                    pa.array(np.repeat(orders, steps).tolist(), pa.string()),
                    pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))),
                    *(pa.array(found[:, :, k].ravel()) for k in range(len(COUNTS))),
                    pa.array(of_filter[letters].ravel()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *columns])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in columns)
    return in_batches(rows, work, schema)


def audit(rows: DataFrame, filters: Mapping[str, Column], part: Column, good: Column, toxic: Column) -> DataFrame:
    """Every order of the filters played over ``rows``: a row for each part, order and step.

    ``filters`` has, for each one-letter name, the condition under which a row fails
    it; null means that it does not. ``part`` null counts as the empty string, labels
    null as no. Repeated rows all count. Without rows there is no part and so no
    result. ``shapley`` is what the step's filter removes, summed over all orders.
    """
    layout = Layout("".join(filters))
    yes = lambda c, bit: F.when(c, F.lit(bit)).otherwise(F.lit(0))
    code = yes(toxic, 1) + yes(good, 2)
    for i, condition in enumerate(filters.values()):
        code = code + yes(condition, 4 << i)
    coded = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), code.cast("int").alias("code"))
    sums = _summed(coded, layout).withColumn("_salt", F.spark_partition_id() % SALTS)
    level = sums.repartition("part", "_salt").sortWithinPartitions("part").select("part", "total")
    whole = _added(level, layout).repartition("part").sortWithinPartitions("part")
    return _reported(_added(whole, layout), layout)


def measured(documents: DataFrame) -> DataFrame:
    """``documents`` without the text: ``text_key`` and the failures ``A`` to ``D`` of each row.

    Null texts count as empty. Other columns stay; those with a result's name are
    replaced. Words are compared by 64-bit hashes.
    """
    kept = [c for c in documents.columns if c.lower() not in ("text", "text_key", "a", "b", "c", "d")]
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("text_key")
    rows = documents.select(*(documents[f"`{c}`"] for c in kept), key, "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    upper = np.zeros(256, bool)
    upper[ord("A") : ord("Z") + 1] = True

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            failures = []
            for block in blocks(batch.column(batch.num_columns - 1)):
                starts, ends, owner = words(block)
                n = np.bincount(owner, minlength=block.n)
                distinct = n - repeats(owner, hasher.ranges(block.data, starts, ends), block.n)
                shouting = 100 * counts(block, upper[block.data]) > MOST_UPPER_PERCENT * counts(block, characters(block.data))
                failures.append([n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT_PERCENT * n, shouting, counts(block, SYMBOLS[block.data]) > 0])
            if not failures:
                continue
            arrays = [pa.array(np.concatenate(f)) for f in zip(*failures, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *"ABCD"])

    return in_batches(rows, work, ", ".join([*fields, *(f"{c} boolean" for c in "ABCD")]))


def document_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five document filters by language; see ``audit``.

    Of several labels of an id any that says so counts; ids without labels are
    neither good nor toxic. A null id is no smaller than another, nor is another
    smaller than it. Rows that repeat an id and its text are no duplicates of each
    other. Clashing column names do no harm: only the named columns are read.
    """
    rows = measured(documents.select(F.col("doc_id").alias("_id"), F.coalesce("lang", F.lit("")).alias("_part"), "text"))
    rows = stored(rows, "measured")
    # First ids of the texts that occur more than once.
    firsts = rows.groupBy("text_key").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    firsts = stored(firsts.select(F.col("text_key").alias("_key"), "_first"), "first-ids")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_labelled"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"))
    marks = stored(marks.where(F.col("_good") | F.col("_toxic")), "marks")
    joined = rows.join(firsts, F.col("text_key") == F.col("_key"), "left").withColumn("E", F.col("_id") > F.col("_first"))
    joined = joined.join(marks, F.col("_id") == F.col("_labelled"), "left")
    return audit(joined, {c: F.col(c) for c in FILTERS}, F.col("_part"), F.col("_good"), F.col("_toxic"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op12_filter_audit``: all orders of the five filters over all documents."""
    return document_audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
w as (select doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
f as (select t, min(doc_id) as first_id from d group by t),
l as (
    select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic
    from labels group by doc_id
),
m as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n,
        case when len(ws) < 100 then 1 else 0 end
        + case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end
        + case when 100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 10 * length(w.t) then 4 else 0 end
        + case when regexp_matches(w.t, '[#$%&*|]') then 8 else 0 end
        + case when w.doc_id > first_id then 16 else 0 end as mask
    from w join f on w.t = f.t left join l on w.doc_id = l.doc_id
    group by all
),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as c, unnest([1, 2, 4, 8, 16]) as bit),
o as (
    select a.c || b.c || c.c || d.c || e.c as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from x a, x b, x c, x d, x e
    where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
s as (
    select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as earlier
    from o, (select unnest([1, 2, 3, 4, 5]) as step)
),
r as (
    select part, filter_order, step, bit,
        sum(case when mask & (earlier | bit) = 0 then n else 0 end) as kept,
        sum(case when mask & bit > 0 and mask & earlier = 0 then n else 0 end) as removed,
        sum(case when mask & bit > 0 and mask & earlier > 0 then n else 0 end) as redundant,
        sum(case when mask = bit then n else 0 end) as unique_fails,
        sum(case when mask & bit > 0 and mask & earlier = 0 and good then n else 0 end) as good_lost,
        sum(case when mask & bit > 0 and mask & earlier = 0 and toxic then n else 0 end) as toxic_lost
    from m, s group by all
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
    redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
    toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""
