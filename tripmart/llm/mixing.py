"""Mixing sources to target weights by Sainte-Lague apportionment, in SQL functions only.

Sources get weights in the order of their names. Their targets share the words of
the whole corpus by weight, but never exceed ``most`` times what a source has; what
is left over goes to the others by weight. Targets become blocks of equal size:
the blocks go to the highest quotients target / (2 k + 1). A source's blocks go in
the same way to its shards, by their words. Inside a shard the documents follow one
another in a seeded order, and the blocks are cut from that stream of words, again
from its start when it ends. So a shard takes exactly its blocks, and a document is
taken once more than another at most, and partly only at the stream's cut.

A source that holds a third of all rows is as many window groups as there are
shards; a window row is an id, a size and a hash. Sources are summed before their
shuffle. Only scalars reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.session import shared_dir

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 8
SHARDS = 256
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Divisors tried by one pass over the sources.
_WAYS = 24


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows written to the shared folder once and read from there."""
    folder = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Adds ``number``, 0 and up, in the order of a unique key, null last, over many tasks.

    Rows are cut into ranges of the key and stored with the range's number. The
    ranges' counts, as many rows as there are shuffle partitions, are summed up in
    one window and broadcast.
    """
    order = F.col(key).asc_nulls_last()
    ranged = stored(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranged.join(F.broadcast(before), "_range").withColumn("number", F.col("_before") + within).drop("_range", "_before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` with ``weight``, ``target`` and whether it is ``capped``.

    Each round caps the sources whose share of what is left exceeds ``most`` times
    their size; it ends when a round caps none, so at most once for each source
    and in practice after a few rounds.
    """
    cycle = F.array(*(F.lit(w).cast("long") for w in weights))
    rows = numbered(sources, "source").withColumn("weight", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int"))).drop("number")
    rows = stored(rows, "weighted").withColumn("_cap", F.lit(most) * F.col("source_size"))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    left, share, capped = total, rows.agg(F.sum("weight")).first()[0] or 1, -1
    while True:
        over = F.col("_cap") * F.lit(share) < F.lit(left) * F.col("weight")
        found = rows.agg(
            F.count_if(over).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(over, F.col("weight"))), F.lit(0)).alias("w"),
            F.sum("weight").alias("all"),
        ).first()
        if found["n"] == capped or found["all"] is None or found["all"] == found["w"]:
            break
        capped, left, share = found["n"], total - found["cap"], found["all"] - found["w"]
    exact = (F.lit(left).cast("decimal(20,0)") * F.col("weight").cast("decimal(10,0)")).cast("double") / F.lit(float(share))
    return rows.withColumn("target", F.when(over, F.col("_cap").cast("double")).otherwise(exact)).withColumn("capped", over).drop("_cap")


def seats(parties: DataFrame, votes: str, limit: str, total: int, order: str) -> DataFrame:
    """Adds ``seats``: ``total`` seats by the highest quotients votes / (2 k + 1).

    ``limit`` names the most seats a party can hold. A divisor d gives a party the
    seats whose quotient is d at least. Each pass tries several divisors and keeps
    the narrowest pair that gives too few and enough; the last seats go to the
    highest quotients between the two, equal ones by ``order``.
    """

    def given(divisor: Column) -> Column:
        return F.least(F.col(limit), F.floor((F.col(votes) / divisor + 1) / 2))

    top, room = parties.agg(F.max(votes), F.sum(F.when(F.col(votes) > 0, F.col(limit)))).first()
    total = min(total, room or 0)
    if not total:
        return parties.withColumn("seats", F.lit(0).cast("long"))
    few, enough, least = top * 2.0 + 1, 0.0, 0
    steps = [few * 0.5**i for i in range(0, 60, 3)]
    for _ in range(60):
        sums = list(parties.agg(*(F.sum(given(F.lit(d))).alias(f"s{i}") for i, d in enumerate(steps))).first())
        for divisor, sum_ in zip(steps, sums, strict=True):
            if sum_ < total:
                few, least = divisor, sum_
            else:
                enough = divisor
                break
        # Two quotients of one party differ by more than this.
        if enough and few / enough - 1 < min(1e-3, 0.5 * enough / top) or few == enough:
            break
        lowest = enough or few * 0.5**60
        steps = [few * (lowest / few) ** (i / (_WAYS + 1)) for i in range(1, _WAYS + 1)]
        steps = [d for d in steps if lowest < d < few] or [lowest]
    held = parties.withColumn("seats", given(F.lit(few)).cast("long"))
    missing = total - least
    if not missing:
        return held
    next_up = held.where((F.col("seats") < F.col(limit)) & (F.col(votes) > 0))
    next_up = next_up.select(F.col(order).alias("_party"), (F.col(votes) / (2 * F.col("seats") + 1)).alias("_quotient"))
    more = next_up.orderBy(F.desc("_quotient"), F.asc_nulls_last("_party")).limit(missing).select("_party", F.lit(1).alias("_more"))
    joined = held.join(more, held[order].eqNullSafe(more["_party"]), "left")
    return joined.withColumn("seats", F.col("seats") + F.coalesce("_more", F.lit(0))).drop("_party", "_more")


def shard_seats(cells: Column, total: Column) -> Column:
    """Seats of a source's shards, an array of (shard, words, limit) structs.

    The array holds the shards of one source, so its length is bounded by their
    number. Halving the divisor's range leaves the last seats, which go to the
    highest quotients, equal ones to the lower shard.
    """

    def given(cell: Column, divisor: Column) -> Column:
        return F.least(cell["limit"], F.floor((cell["words"] / divisor + 1) / 2)).cast("long")

    def summed(divisor: Column) -> Column:
        return F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + given(c, divisor))

    top = F.array_max(F.transform(cells, lambda c: c["words"])).cast("double")
    start = F.struct((top * 2 + 1).alias("few"), (top * 1e-9).alias("enough"))

    def halve(range_: Column, _: Column) -> Column:
        middle = F.sqrt(range_["few"] * range_["enough"])
        short = summed(middle) < total
        return F.struct(F.when(short, middle).otherwise(range_["few"]).alias("few"), F.when(short, range_["enough"]).otherwise(middle).alias("enough"))

    def last_seats(few: Column) -> Column:
        return _let(F.transform(cells, lambda c: F.struct(c["shard"].alias("shard"), c["words"].alias("words"), c["limit"].alias("limit"), given(c, few).alias("seats"))), by_quotient)

    def by_quotient(held: Column) -> Column:
        ranked = F.array_sort(
            F.transform(
                held,
                lambda c: F.struct(
                    F.when(c["seats"] < c["limit"], -c["words"] / (2 * c["seats"] + 1)).otherwise(F.lit(0.0)).alias("rank"),
                    c["shard"].alias("shard"),
                    c["limit"].alias("limit"),
                    c["seats"].alias("seats"),
                ),
            )
        )
        return _let(total - F.aggregate(held, F.lit(0).cast("long"), lambda s, c: s + c["seats"]), lambda missing: F.transform(ranked, lambda c, i: one_more(c, i, missing)))

    def one_more(cell: Column, place: Column, missing: Column) -> Column:
        more = F.when((place < missing) & (cell["seats"] < cell["limit"]), 1).otherwise(0)
        return F.struct(cell["shard"].alias("shard"), (cell["seats"] + more).alias("seats"))

    return _let(F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, halve)["few"], last_seats)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def quotas(cells: DataFrame, weights=WEIGHTS, most: int = MOST, block: int = BLOCK_WORDS) -> DataFrame:
    """``(source, shard, words)`` with ``source_size``, ``target`` and ``seats`` of each shard."""
    sources = stored(cells.groupBy("source").agg(F.sum("words").alias("source_size")), "sources")
    aimed = targets(sources, weights, most)
    # The last block of a shard's last pass may be short.
    limits = cells.withColumn("limit", F.ceil(F.lit(most) * F.col("words") / F.lit(block)).cast("long"))
    grouped = limits.groupBy(F.col("source").alias("_s")).agg(F.array_sort(F.collect_list(F.struct("shard", "words", "limit"))).alias("cells"), F.sum("limit").alias("limit"))
    joined = stored(aimed.join(grouped, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "rooms")
    # A capped source gives every block as often as it may.
    whole = joined.where("capped").select("source", "source_size", "target", F.explode("cells").alias("c"))
    whole = whole.select("source", "source_size", "target", "c.shard", F.col("c.limit").alias("seats"))
    free = joined.where("not capped")
    total = free.agg(F.sum("target")).first()[0] or 0.0
    given = seats(free, "target", "limit", round(total / block), "source")
    by_shard = given.select("source", "source_size", "target", F.explode(shard_seats(F.col("cells"), F.col("seats"))).alias("c"))
    return whole.unionByName(by_shard.select("source", "source_size", "target", "c.shard", "c.seats"))


def _sized(documents: DataFrame, shards: int, seed: str) -> DataFrame:
    """Documents with ``_size``, ``_order``, their place in the seeded order, and ``_shard``."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    rows = documents.withColumn("_size", word_count(F.col("text"))).withColumn("_order", order)
    return rows.withColumn("_shard", F.conv(F.substring("_order", 1, 4), 16, 10).cast("int") % shards)


def _planned(rows: DataFrame, weights: tuple[int, ...], most: int, block: int) -> DataFrame:
    """What each shard of each source takes; ``rows`` are stored sizes."""
    cells = stored(rows.groupBy("source", F.col("_shard").alias("shard")).agg(F.sum("_size").alias("words")), "cells")
    own = cells.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "words")
    plan = quotas(cells, weights, most, block).join(own, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h"))).drop("_s", "_h")
    return stored(plan, "plan").select(
        F.col("source").alias("_s"), F.col("shard").alias("_h"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("words").alias("_words"), F.least(F.col("seats") * block, most * F.col("words")).alias("_take")
    )


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``_taken``: full passes over the shard, and the start of one more."""
    stream = Window.partitionBy("source", "_shard").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("_size").over(stream), F.lit(0)))
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
    passes = F.when(F.col("_words") > 0, F.floor(F.col("_take") / F.col("_words"))).otherwise(0)
    rest = F.col("_take") - passes * F.col("_words")
    partly = F.greatest(F.lit(0), F.least(F.col("_before") + F.col("_size"), rest) - F.col("_before"))
    return joined.withColumn("_taken", (passes * F.col("_size") + partly).cast("long"))


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, shard``.

    Null text has size 0; null source is a source of its own, the last. Rows with
    equal ids, sources and texts are told apart by nothing but their place in the
    seeded order, so each is taken in its turn. Empty input gives no rows. Extra
    columns are ignored. A source without words has target 0.
    """
    rows = stored(_sized(documents.select("doc_id", "source", "text"), shards, seed).drop("text"), "sizes")
    taken = _taken(rows, _planned(rows, weights, most, block))
    names = {"_size": "size", "_source_size": "source_size", "_target": "target", "_taken": "taken", "_shard": "shard"}
    return taken.select("doc_id", "source", *(F.col(c).alias(name) for c, name in names.items()))


def first_words(text: Column, number: Column) -> Column:
    """A text up to the end of its word of that number, white space as it was."""
    gaps, found = F.split(text, WORD, -1), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def together(parts: Column) -> Column:
        return F.aggregate(F.slice(parts, F.lit(1), number.cast("int")), F.lit(0), lambda n, p: n + F.length(p))

    return F.substring(text, F.lit(1), together(gaps) + together(found))


def mixed(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """The documents that the mix is made of, with the columns of ``documents``.

    A document is a row for each time it is taken whole, and one that holds its
    first words if it is taken partly; ``n_chars`` follows the text if it is there.
    Documents of which nothing is taken, those without words among them, go.
    """
    sizes = stored(_sized(documents.select("doc_id", "source", "text"), shards, seed).select("source", "_shard", "_size"), "sizes")
    # The row as one value: no name of it can clash with one of these columns.
    rows = documents.select(F.struct("*").alias("_row"))
    rows = _sized(rows.select("_row", F.col("_row.doc_id"), F.col("_row.source"), F.col("_row.text")), shards, seed).drop("text")
    taken = _taken(rows, _planned(sizes, weights, most, block)).where("_taken > 0")
    copies = F.ceil(F.col("_taken") / F.col("_size")).cast("int")
    each = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    words = F.least(F.col("_size"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_size"))
    text = F.when(words < F.col("_size"), first_words(F.col("_row.text"), words)).otherwise(F.col("_row.text"))
    return with_text(each, text, documents).select("_row.*")


def with_text(rows: DataFrame, text: Column, documents: DataFrame) -> DataFrame:
    """``_row`` with another text, and ``n_chars`` of it if ``documents`` has that."""
    changed = rows.withColumn("_row", F.col("_row").withField("text", text))
    if "n_chars" not in documents.columns:
        return changed
    length = F.length("_row.text").cast(documents.schema["n_chars"].dataType)
    return changed.withColumn("_row", F.col("_row").withField("n_chars", F.when(F.col("_row.text").isNotNull(), length).otherwise(F.col("_row.n_chars"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op3_mixing``: words that the mix takes of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
with recursive sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5('{SEED}:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as ord
  from documents
), docs as (
  select *, cast('0x' || substr(ord, 1, 4) as bigint) % {SHARDS} as shard from sized
), cells as (
  select source, shard, sum(size)::bigint as words, ceil({MOST} * sum(size) / {BLOCK_WORDS})::bigint as room from docs group by all
), sources as (
  select source, sum(words)::bigint as source_size, sum(room)::bigint as room,
    [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
  from cells group by source
), rounds as (
  select 0 as n, -1::bigint as capped, (select sum(source_size) from sources)::bigint as left_over, (select sum(weight) from sources)::bigint as share
  union all
  select n + 1,
    (select count(*) from sources s where {MOST} * source_size * share < left_over * weight),
    ((select sum(source_size) from sources) - coalesce((select sum({MOST} * source_size) from sources s where {MOST} * source_size * share < left_over * weight), 0))::bigint,
    (select sum(weight) from sources s where not {MOST} * source_size * share < left_over * weight)::bigint
  from rounds where n < 30
), settled as (
  select left_over, share from rounds where n = 30
), aimed as (
  select s.*, {MOST} * source_size * share < left_over * weight as capped,
    case when {MOST} * source_size * share < left_over * weight then ({MOST} * source_size)::double
                   else (left_over * weight)::double / share::double end as target
  from sources s, settled
), quotients as (
  select source, target / (2 * k + 1) as quotient
  from (select source, target, unnest(range(room)) as k from aimed where not capped)
), won as (
  select source, count(*) as seats from (
    select source, row_number() over (order by quotient desc, source nulls last) as place from quotients
  ) where place <= round((select sum(target) from aimed where not capped) / {BLOCK_WORDS}) group by source
  union all select source, room from aimed where capped
), shard_quotients as (
  select c.source, c.shard, w.seats, words::double / (2 * k + 1) as quotient
  from (select source, shard, words, unnest(range(room)) as k from cells) c
  join won w on c.source is not distinct from w.source
), shard_won as (
  select source, shard, count(*) as seats from (
    select source, shard, seats, row_number() over (partition by source order by quotient desc, shard) as place from shard_quotients
  ) where place <= seats group by source, shard
), placed as (
  select doc_id, source, shard, size,
    coalesce(sum(size) over (partition by source, shard order by ord rows between unbounded preceding and 1 preceding), 0)::bigint as earlier
  from docs
), taking as (
  select p.*, a.source_size, a.target, c.words, least(coalesce(w.seats, 0) * {BLOCK_WORDS}, {MOST} * c.words) as take
  from placed p join aimed a on p.source is not distinct from a.source
  join cells c on p.source is not distinct from c.source and p.shard = c.shard
  left join shard_won w on p.source is not distinct from w.source and p.shard = w.shard
), split as (
  select *, case when words > 0 then take // words else 0 end as passes from taking
)
select doc_id, size::bigint as size, source_size, target,
  (passes * size + greatest(0, least(earlier + size, take - passes * words) - earlier))::bigint as taken
from split
"""
