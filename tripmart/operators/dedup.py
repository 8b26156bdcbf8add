"""Exact duplicates: who is first, who is repeated, and the full ranking.

One record may hold a large share of all rows (for example the record with all
fields empty), so no operator here needs the copies of a record in one task. What
aggregations find is stored before it is joined to the rows: both sides of the join
are then dealt out by a shuffle of their own, which lets the planner split a hot key.
Joined to the aggregation itself, the rows would have to follow its partitioning.

* ``keep_first`` filters a row number to 1. Spark limits each group before the
  shuffle, so a map task sends at most one row per record.
* ``repeated_keys`` and ``first_copies`` are aggregations with a partial step
  directly over the rows.
* ``marked_repeated`` tells, by a broadcast of bits, most rows of unrepeated keys.
* ``in_slices`` deals rows out by key, for work that is done a slice after the other so
  that only one slice is shuffled at a time.
* ``rank_in_place`` needs every rank and shuffles each row once, if its key may be repeated.
* ``duplicate_rank`` does so for rows whose order columns may be empty or alike. It numbers the repeated records' origins
  inside bounded blocks of a record and adds the sizes of the blocks before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.session import stored

BLOCK_ROWS = 1 << 20
# Bits that mark hashes of repeated keys: 2^20 words of two longs at most, whatever the input.
MARK_BITS = 1 << 26
# Fixed value: bits of a long.
WORD_BITS = 64
# Rows that are shuffled at a time, about, where work is done in slices.
SLICE_ROWS = 1 << 24


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    position = "__position"
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn(position, F.row_number().over(window))
        .filter(F.col(position) == 1)
        .drop(position)
    )


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. Shuffles the key and a count only."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def first_copies(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row, as a struct of the ``order`` columns, of each key held by several rows.

    One aggregation: each task sends one row per key, however often it repeats.
    """
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(*order)).alias("first_copy"))
        .filter(F.col("copies") > 1)
        .select(*key, "first_copy")
    )


def flag_first(
    df: DataFrame, key: Sequence[str], order: Sequence[str], firsts: DataFrame, into: str
) -> DataFrame:
    """Mark the first row of each key. Keys missing in ``firsts`` occur once.

    The ``order`` columns tell all rows apart. ``firsts`` should be a stored table, so
    that the copies of a hot record can be split.
    """
    own = F.struct(*order)
    return (
        df.join(firsts.select(*key, "first_copy"), list(key), "left")
        .withColumn(into, F.col("first_copy").isNull() | (F.col("first_copy") == own))
        .drop("first_copy")
    )


def in_slices(df: DataFrame, key: Sequence[str], rows: int, slice_rows: int | None = None) -> list[DataFrame]:
    """The rows as frames of about ``slice_rows``, if there are ``rows``; a key's rows are in one.

    Each frame reads ``df``, so that should be stored and narrow.
    """
    parts = max(1, -(-rows // (slice_rows or SLICE_ROWS)))
    # Marks use the hash's other half.
    part = F.pmod(F.shiftright(F.xxhash64(*key), 32), F.lit(parts))
    return [df.filter(part == i) for i in range(parts)] if parts > 1 else [df]


def _words(hashes: DataFrame, bits: int) -> DataFrame:
    """A row per word with a set bit: the bits of the hashes, and the most copies of any."""
    word = F.expr(f"__place div {WORD_BITS}").alias("__word")
    found = hashes.select(F.pmod("__hash", F.lit(bits)).alias("__place"), "copies").groupBy(word)
    set_bit = F.expr(f"shiftleft(1L, cast(__place % {WORD_BITS} as int))")
    return found.agg(F.bit_or(set_bit).alias("__marks"), F.max("copies").alias("__most"))


def repeated_marks(df: DataFrame, key: Sequence[str], bits: int = MARK_BITS) -> DataFrame:
    """Words with a bit for each key that is repeated. Shuffles 64-bit hashes only."""
    counted = df.select(F.xxhash64(*key).alias("__hash")).groupBy("__hash").agg(F.count(F.lit(1)).alias("copies"))
    return _words(counted.filter(F.col("copies") > 1), bits)


def marks(df: DataFrame, key: Sequence[str], bits: int = MARK_BITS) -> DataFrame:
    """Words with a bit for each key."""
    return _words(df.select(F.xxhash64(*key).alias("__hash"), F.lit(1).cast("long").alias("copies")), bits)


def marked(
    df: DataFrame, key: Sequence[str], words: DataFrame, into: str, bits: int = MARK_BITS, most: str | None = None
) -> DataFrame:
    """Mark the rows whose key has a bit in ``words``; ``most`` is the most copies in its word."""
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    mark = F.coalesce(F.getbit(F.col("__marks"), (place % WORD_BITS).cast("int")) == 1, F.lit(False))
    words = F.broadcast(words if most else words.drop("__most"))
    wide = df.withColumn("__word", F.shiftright(place, WORD_BITS.bit_length() - 1)).join(words, "__word", "left")
    copies = {most: F.coalesce(F.col("__most"), F.lit(0).cast("long"))} if most else {}
    return wide.withColumns({into: mark, **copies}).drop("__word", "__marks", "__most")


def marked_repeated(df: DataFrame, key: Sequence[str], into: str, bits: int = MARK_BITS) -> DataFrame:
    """Mark every row whose key is repeated, and a few others, without a shuffle of the rows.

    Only 64-bit hashes of the keys are shuffled. The bits of those that occur twice are
    set in words, which are stored and broadcast; words without a bit are left out. Hashes
    or bits that coincide mark a row too many, never one too few.
    """
    return marked(df, key, stored(repeated_marks(df, key, bits), "marks"), into, bits)


def first_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], also: Sequence[str]) -> DataFrame:
    """The first row of every key: its ``order`` columns as a struct, ``also`` and the key's copies.

    One aggregation: each task sends one row per key, however often it repeats.
    """
    first = F.min(F.struct(*order, *also)).alias("first")
    found = df.groupBy(*key).agg(first, F.count(F.lit(1)).alias("copies"))
    own = F.struct(*(F.col(f"first.{c}").alias(c) for c in order))
    return found.select(*key, own.alias("first_copy"), *(f"first.{c}" for c in also), "copies")


def only_first(df: DataFrame, key: Sequence[str], order: Sequence[str], firsts: DataFrame) -> DataFrame:
    """The rows of ``df`` that are first copies: they are in ``firsts``, which has one row per key.

    The ``order`` columns tell all rows apart. The bits of the first copies' order are
    broadcast, so that other rows are dropped where they lie. ``firsts`` should be stored.
    """
    wanted, place, own = "__wanted", "__place", "__own"
    firsts = firsts.select(*key, F.col("first_copy").alias(own))
    words = stored(marks(firsts.select(f"{own}.*"), order), "marks")
    left = marked(df, order, words, wanted).filter(wanted).drop(wanted).withColumn(place, F.xxhash64(*order))
    right = firsts.withColumn(place, F.xxhash64(*(F.col(f"{own}.{c}") for c in order)))
    return left.join(right, [*key, place]).filter(F.col(own) == F.struct(*order)).drop(place, own)


def duplicate_rank(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    into: str = "duplicate_rank",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number all rows of each key in ``order``; the last order column is a number.

    A key that occurs once has rank 1, so only the key and order columns of
    repeated keys are numbered; the ranks then meet the rows. ``order`` tells the
    rows of a key apart. A block is a stretch of ``block_rows`` numbers under equal
    leading order columns, so no window group is larger than that, however often a
    record repeats. Only the block sizes are then ordered per key. Repeated keys are
    stored, and their rows dealt out by key and block, so neither join nor window needs
    a record's rows together. Rows whose key cannot be repeated are told by marks and
    never shuffled. ``df`` is read four times: store it before.
    """
    *lead, row = order
    block, before, local, maybe = "__block", "__before", "__local", "__maybe"
    blocks = [*lead, block]
    marked = marked_repeated(df, key, maybe)
    alone, shared = marked.filter(~F.col(maybe)).drop(maybe), marked.filter(maybe).drop(maybe)
    narrow = stored(shared.select(*key, *order), "marked")
    several = stored(repeated_keys(narrow, key).select(*key), "repeated")
    numbered = narrow.join(several, list(key), "left_semi")
    numbered = numbered.withColumn(block, F.expr(f"`{row}` div {block_rows}")).repartition(*key, *blocks)
    inside = Window.partitionBy(*key, *blocks).orderBy(F.col(row).asc_nulls_last())
    earlier = (
        Window.partitionBy(*key)
        .orderBy(*(F.col(c).asc_nulls_last() for c in blocks))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        numbered.groupBy(*key, *blocks)
        .agg(F.count(F.lit(1)).alias("__size"))
        .withColumn(before, F.sum("__size").over(earlier))
        .filter(F.col(before) > 0)
        .drop("__size")
    )
    ranks = (
        numbered.withColumn(local, F.row_number().over(inside))
        .join(offsets, [*key, *blocks], "left")
        .withColumn(into, (F.col(local) + F.coalesce(F.col(before), F.lit(0))).cast("long"))
        .select(*key, *order, into)
    )
    first = F.lit(1).cast("long")
    ranked = shared.join(ranks, [*key, *order], "left").withColumn(into, F.coalesce(F.col(into), first))
    # The join brings its columns to the front.
    return ranked.unionByName(alone.withColumn(into, first))


def rank_in_place(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    into: str = "duplicate_rank",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``duplicate_rank`` for rows whose ``order`` columns are present and tell all rows apart.

    A row whose key may be repeated is shuffled once, with its other columns, and numbered
    there; others have rank 1 where they lie. Keys of more than ``block_rows`` rows are
    numbered inside blocks, and the sizes of the blocks before are added. ``df`` is read
    several times: store it before.
    """
    *lead, row = order
    block, before, local, maybe, most = "__block", "__before", "__local", "__maybe", "__copies"
    blocks = [*lead, block]
    words = stored(repeated_marks(df, key), "marks")
    known = marked(df, key, words, maybe, most=most)
    hot = F.col(maybe) & (F.col(most) > block_rows)
    in_order = [F.col(c).asc_nulls_last() for c in order]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*in_order)).cast("long")
    alone = known.filter(~F.col(maybe)).withColumn(into, F.lit(1).cast("long"))
    few = known.filter(F.col(maybe) & ~hot).withColumn(into, rank)
    first = [*key, *order]
    out = [*first, *(c for c in df.columns if c not in first), into]
    ranked = alone.select(*out).unionByName(few.select(*out))
    if words.filter(F.col("__most") > block_rows).isEmpty():
        return ranked
    many = known.filter(hot).withColumn(block, F.expr(f"`{row}` div {block_rows}")).repartition(*key, *blocks)
    inside = Window.partitionBy(*key, *blocks).orderBy(F.col(row).asc_nulls_last())
    earlier = (
        Window.partitionBy(*key)
        .orderBy(*(F.col(c).asc_nulls_last() for c in blocks))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = many.groupBy(*key, *blocks).agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.withColumn(before, F.sum("__size").over(earlier)).drop("__size")
    numbered = many.withColumn(local, F.row_number().over(inside)).join(offsets, [*key, *blocks], "left")
    numbered = numbered.withColumn(into, (F.col(local) + F.coalesce(F.col(before), F.lit(0))).cast("long"))
    return ranked.unionByName(numbered.select(*out))
