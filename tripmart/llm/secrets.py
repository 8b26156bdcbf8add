"""Secret scans with linking of the parts of one credential, in SQL functions only.

Strong finds stand alone: an assignment of a long value to a telling name, an
access identifier, a long hexadecimal run. Weak ones do not: a user or account
name, a mixed token, an endpoint. A weak find is reported only if a complementary
part lies within ``scope`` characters of it in the same text: names and endpoints
need a secret near them, tokens need a name, an access identifier or an endpoint.
The parts of a credential lie apart: a weak find inside another find is part of that
one and does not count, and finds that overlap are not complementary.

A pattern's places come from what lies between its matches: the text is split by
the pattern, and the lengths of pieces and matches add up in a window over the
text's own finds. The link is an interval join on sorted ends: at a find's start the
last end of a complementary part, and at its end the next start of one, tell whether
the gap between the two is within the scope.
Only finds are shuffled, never texts; a text is one window group, so a frequent
source, or copies of a text, are many groups.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.mixing import with_text


class Kind(NamedTuple):
    """A pattern, the group whose length counts, the least length, and its part."""

    name: str
    pattern: str
    group: int
    least: int
    part: str
    weak: bool
    #: What a text must contain for the pattern to be tried; a pattern or empty.
    needs: str
    #: What a match must contain besides.
    also: tuple[str, ...] = ()


#: Fixed patterns of the query contract, in its order; then the method's weak ones.
KINDS = [
    Kind(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        "secret",
        False,
        r"[:=]",
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, "name", False, "AKIA"),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, "secret", False, r"[0-9a-f]{16}"),
    Kind("user", r"([Uu]ser|[Ll]ogin|[Aa]ccount|[Cc]lient)(_?[Nn]ame|_?[Ii][Dd])?[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)", 3, 3, "name", True, r"[:=]"),
    Kind("mixed", r"[A-Za-z0-9+/_-]{20,}", 0, 20, "secret", True, r"[A-Za-z0-9+/_-]{20}", ("[a-z]", "[A-Z]", "[0-9]")),
    Kind("endpoint", r"[Hh][Tt][Tt][Pp][Ss]?://[^\x20\x09-\x0D\"'<>]+", 0, 10, "endpoint", True, "://"),
]
SCOPE = 200
#: What replaces a find.
MARK = "[SECRET]"


def _tried(text: Column, kind: Kind) -> Column:
    """Whether a text can match; cheap where the pattern is dear."""
    literal = not set(kind.needs) & set(r"\[](){}?*+|.^$")
    return text.contains(kind.needs) if literal else text.rlike(kind.needs)


def _pieces(text: Column, order: int, kind: Kind) -> Column:
    """An array of (kind, place, gap, length, good): each match and what precedes it."""
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda p: F.length(p))
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole

    def find(match: Column, i: Column) -> Column:
        good = F.length(F.get(counted, i)) >= kind.least
        for needed in kind.also:
            good = good & match.rlike(needed)
        return F.struct(F.lit(order).alias("kind"), i.alias("place"), F.get(gaps, i).alias("gap"), F.length(match).alias("length"), good.alias("good"))

    return F.when(_tried(text, kind), F.transform(whole, find))


def finds(documents: DataFrame, kinds: list[Kind] = KINDS, scope: int = SCOPE) -> DataFrame:
    """A row per find of each text: ``_row, doc_id, kind, start, end, weak, linked``.

    A text without any find gives one row whose ``kind`` is null. ``_row`` tells the
    rows of the input apart, ids may repeat or be null. Starts count code points
    from 0, ends are exclusive. Null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.expr("array()").cast("array<struct<kind:int,place:int,gap:int,length:int,good:boolean>>")
    found = F.concat(*(F.coalesce(_pieces(text, order, kind), none) for order, kind in enumerate(kinds)))
    rows = documents.select(F.monotonically_increasing_id().alias("_row"), "doc_id", found.alias("found"))
    rows = rows.select("_row", "doc_id", F.explode_outer("found").alias("f")).select("_row", "doc_id", "f.*").repartition("_row")
    so_far = Window.partitionBy("_row", "kind").orderBy("place")
    # Spark orders a null kind, of a text without finds, like any other.
    end = F.sum(F.col("gap") + F.col("length")).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    weak = F.col("kind").isin([i for i, k in enumerate(kinds) if k.weak])
    placed = placed.withColumn("weak", weak).where(F.col("kind").isNull() | F.col("good") | (F.col("place") == 0))
    # Of finds that begin no later, the longer first, one that ends no earlier holds the find.
    in_text = Window.partitionBy("_row")
    holders = in_text.orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.max(F.when(F.col("good"), F.col("end"))).over(holders) >= F.col("end"), F.lit(False))
    placed = placed.withColumn("good", F.col("good") & ~(F.col("weak") & held))
    sides = F.array(F.struct(F.lit(True).alias("opens"), F.col("start").alias("at")), F.struct(F.lit(False).alias("opens"), F.col("end").alias("at")))
    events = placed.withColumn("side", F.explode(sides)).select("*", "side.*").drop("side")

    def near(*parts: str) -> Column:
        """Whether such a part ends shortly before a start, or starts shortly behind an end."""
        other = F.col("kind").isin([i for i, k in enumerate(kinds) if k.part in parts]) & F.col("good")
        # Both windows run from their start to the row, which takes one pass each.
        before = F.max(F.when(other & ~F.col("opens"), F.col("at"))).over(in_text.orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
        behind = F.min(F.when(other & F.col("opens"), F.col("at"))).over(in_text.orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0))
        return F.when(F.col("opens"), F.col("at") - before).otherwise(behind - F.col("at")) <= scope

    secret = F.col("kind").isin([i for i, k in enumerate(kinds) if k.part == "secret"])
    linked = F.coalesce(F.when(secret, near("name", "endpoint")).otherwise(near("secret")), F.lit(False))
    found = ["_row", "doc_id", "kind", "start", "end", "good", "weak"]
    # Rows lie by text already, so this shuffles nothing.
    return events.withColumn("linked", linked).groupBy(*found).agg(F.max("linked").alias("linked"))


def _joined(rows: Column, kinds: list[Kind]) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(F.transform(F.array_sort(rows), lambda r: F.concat_ws(":", F.get(names, r["kind"]), r["start"], r["end"])), ",")


def scan(documents: DataFrame, kinds: list[Kind] = KINDS, scope: int = SCOPE) -> DataFrame:
    """A row per document: ``doc_id, n_assign, n_access, n_hex, base, base_sha256, spans, n_weak``.

    ``base`` lists the strong finds as kind:start:end by start, then kind, ``spans``
    these and the linked weak ones. Repeated rows and rows with a null id keep rows
    of their own; other columns are ignored; empty input gives no rows.
    """
    rows = finds(documents, kinds, scope)
    base = F.col("good") & ~F.col("weak")
    reported = F.col("good") & (~F.col("weak") | F.col("linked"))
    at = F.struct("start", "kind", "end")
    grouped = rows.groupBy("_row", "doc_id").agg(
        *(F.count_if(base & (F.col("kind") == i)).alias(f"n_{k.name}") for i, k in enumerate(kinds) if not k.weak),
        F.collect_list(F.when(base, at)).alias("_base"),
        F.collect_list(F.when(reported, at)).alias("_spans"),
    )
    names = [f"n_{k.name}" for k in kinds if not k.weak]
    listed = grouped.select("doc_id", *names, _joined(F.col("_base"), kinds).alias("base"), _joined(F.col("_spans"), kinds).alias("spans"), (F.size("_spans") - F.size("_base")).cast("long").alias("n_weak"))
    return listed.select("doc_id", *names, "base", F.sha2("base", 256).alias("base_sha256"), "spans", "n_weak")


def redacted(documents: DataFrame, kinds: list[Kind] = KINDS, scope: int = SCOPE, mark: str = MARK) -> DataFrame:
    """``documents`` with every reported find, weak ones too, replaced by ``mark``.

    All rows and columns stay; ``n_chars`` follows the text if it is there. Finds
    that overlap are replaced together. Only texts with finds change; they are
    known by their hash, so copies of a text are scanned into one group each and
    joined by one row. Texts without finds need no row on that side.
    """
    key = F.md5(F.col("text"))
    rows = finds(documents.select(key.alias("doc_id"), "text"), kinds, scope)
    reported = rows.where(F.col("good") & (~F.col("weak") | F.col("linked")))
    spans = reported.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("_spans")).withColumnRenamed("doc_id", "_of")
    whole = documents.select(F.struct("*").alias("_row")).withColumn("_key", F.md5("_row.text"))
    joined = whole.join(spans, F.col("_key") == F.col("_of"), "left")

    def merged(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] > span["start"]), longer).otherwise(F.concat(done, F.array(span)))

    none = F.expr("array()").cast(spans.schema["_spans"].dataType)
    places = F.aggregate("_spans", none, lambda done, span: F.when(F.size(done) == 0, F.array(span)).otherwise(merged(done, span)))
    changed = joined.withColumn("_places", F.when(F.col("_spans").isNotNull(), places))
    text = F.col("_row.text")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("_places", lambda s: s["end"].cast("long")))
    starts = F.concat(F.transform("_places", lambda s: s["start"].cast("long")), F.array(F.length(text).cast("long")))
    kept = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda z: F.substring(text, (z["a"] + 1).cast("int"), (z["b"] - z["a"]).cast("int")))
    masked = F.when(F.col("_places").isNull(), text).otherwise(F.array_join(kept, mark))
    return with_text(changed, masked, documents).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op1_secret_scans``: the finds of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(documents).drop("base")


def _sql() -> str:
    """The same by DuckDB's lists: places from the pieces between matches."""
    parts = []
    for order, kind in enumerate(KINDS):
        pattern = kind.pattern.replace("'", "''")
        also = "".join(f" and regexp_matches(m, '{p}')" for p in kind.also)
        parts.append(f"""
  select rid, {order} as kind, '{kind.name}' as name, {str(kind.weak).lower()} as weak, '{kind.part}' as part, start, start + length(m) as stop
  from (select rid, unnest(ms) as m, unnest(gs) as g,
          unnest(list_transform(range(len(ms)), lambda i: list_sum(list_transform(ps[1:i + 1], lambda p: length(p)))
            + coalesce(list_sum(list_transform(ms[1:i], lambda p: length(p))), 0))) as start
        from (select rid, regexp_extract_all(t, '{pattern}') as ms, regexp_extract_all(t, '{pattern}', {kind.group}) as gs,
                regexp_split_to_array(t, '{pattern}') as ps from docs where regexp_matches(t, '{pattern}')))
  where length(g) >= {kind.least}{also}""")
    union = "\n  union all".join(parts)
    return f"""
with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
found as ({union}
), parts as (
  select * from found f where not (weak and exists (select 1 from found o where o.rid = f.rid and o.start <= f.start
    and o.stop >= f.stop and (o.start < f.start or o.stop > f.stop or o.kind < f.kind)))
), linked as (
  select f.*, exists (select 1 from parts o where o.rid = f.rid
    and (o.start - f.stop between 0 and {SCOPE} or f.start - o.stop between 0 and {SCOPE})
    and case when f.part = 'secret' then o.part <> 'secret' else o.part = 'secret' end) as near from parts f
), listed as (
  select rid, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
    string_agg(name || ':' || start::bigint || ':' || stop::bigint, ',' order by start, kind) filter (not weak) as base,
    string_agg(name || ':' || start::bigint || ':' || stop::bigint, ',' order by start, kind) filter (not weak or near) as spans,
    count(*) filter (weak and near) as n_weak
  from linked group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_weak, 0) as n_weak
from docs left join listed using (rid)
"""


SQL = _sql()
