"""Chat formatting by quotation linking, in SQL functions only.

Lines that begin with ``>`` marks are quoted, as deep as there are marks. Lines of
one level that follow one another are a passage. Its words are normalised, and
hashed as a whole, line by line, and in every run of ``WINDOW`` words across its
lines; the hashes are joined to the messages of the same conversation whose own
words hash alike. So a passage links although it was wrapped anew or holds a part
of a message or of a line, as long as it keeps ``WINDOW`` words in a row. A message
replies to the message that it quotes most of at the outermost level of which any
passage links; deeper levels count only where no level outside them does. Own words
and replies make threads, ordered by their first message and by depth, without quotes.

The original of words is the first message of the conversation that says them.
So a passage that very many messages share has one original: originals come from an
aggregation with a partial step, and the join has one row on their side. Only
conversations in which someone quotes give a row for each of their words. Replies
point backwards, so threads end; roots are found by doubling the pointers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.mixing import stored

#: One quote mark, which spaces may surround.
_MARKS = r"^(?:\x20*>)+"
_ROUNDS = 64
#: Words in a row by which a part of a message is known.
WINDOW = 5


def lines(text: Column) -> Column:
    """An array of (level, body) of a text's lines; level 0 is the author's own."""

    def one(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        level = F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))
        return F.struct(level.alias("level"), F.substring(line, F.length(marks) + 1, F.length(line)).alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n", -1), one)


def normalised(text: Column) -> Column:
    """Lower-cased words of letters and digits with one space between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def own_words(parsed: Column) -> Column:
    """The lines of level 0 as one text."""
    return F.trim(F.array_join(F.transform(F.filter(parsed, lambda x: x["level"] == 0), lambda x: x["body"]), "\n"))


def _starts(items: str, of: str) -> Column:
    """Where a new value of the field ``of`` begins in the array column ``items``."""
    whole = F.col(items)
    begins = F.transform(whole, lambda x, i: F.struct(i.alias("at"), x[of].alias("of"), ((i == 0) | (F.get(whole, i - 1)[of] != x[of])).alias("new")))
    return F.filter(begins, lambda x: x["new"])


def _run(items: str, starts: str, x: Column, k: Column) -> Column:
    """The elements of ``items`` from start ``x``, the ``k``-th, to the next one."""
    until = F.coalesce(F.get(F.col(starts), k + 1)["at"], F.size(items))
    return F.slice(F.col(items), x["at"] + 1, until - x["at"])


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _windows(words: str) -> Column:
    """Every run of WINDOW words of an array column, as an array of texts."""
    last = F.size(words) - WINDOW + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(F.col(words), i, WINDOW), " "))).otherwise(F.array().cast("array<string>"))


def quoted_parts(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, level, passage, start, words, whole, hash)`` of quoted passages.

    ``start`` and ``words`` tell where a part lies in its passage; ``passage`` is the
    hash of its words, so equal passages of a message count once.
    """
    begun = rows.select("conv_id", "turn", "parsed", _starts("parsed", "level").alias("starts"))
    runs = F.transform(
        "starts",
        lambda x, k: F.struct(x["of"].alias("level"), F.filter(F.transform(_run("parsed", "starts", x, k), lambda y: normalised(y["body"])), lambda y: y != "").alias("lines")),
    )
    quoted = F.filter(runs, lambda x: (x["level"] > 0) & (F.size(x["lines"]) > 0))
    found = begun.select("conv_id", "turn", F.explode(quoted).alias("p")).select("conv_id", "turn", "p.level", "p.lines")
    split = F.flatten(F.transform("lines", lambda line, i: F.transform(F.split(line, " "), lambda w: F.struct(w.alias("word"), i.alias("line")))))
    placed = found.select("conv_id", "turn", "level", split.alias("placed"))
    placed = placed.select("*", F.transform("placed", lambda x: x["word"]).alias("said"), _starts("placed", "line").alias("starts"))

    def part(start: Column, words: Column, whole: int, text: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), words.cast("int").alias("words"), F.lit(whole).alias("whole"), _hash(text).alias("hash"))

    whole = F.array(part(F.lit(0), F.size("said"), 1, F.array_join("said", " ")))
    by_line = F.transform("starts", lambda x, k: part(x["at"], F.size(_run("placed", "starts", x, k)), 0, F.array_join(F.transform(_run("placed", "starts", x, k), lambda y: y["word"]), " ")))
    by_window = F.transform(_windows("said"), lambda t, i: part(i, F.lit(WINDOW), 0, t))
    parts = placed.select("conv_id", "turn", "level", _hash(F.array_join("said", " ")).alias("passage"), F.explode(F.concat(whole, by_line, by_window)).alias("p"))
    return parts.select("conv_id", "turn", "level", "passage", "p.*").distinct()


def replies(messages: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to, quoted)`` of messages that quote an earlier one.

    ``quoted`` counts the words of passages that link to ``reply_to`` at the level
    that is taken, the outermost one with a link; words in several linked parts count
    once. Of messages with as many words that are quoted as a whole passage, the
    latest is taken. Messages are known by conversation and turn; rows that share
    both are taken together. Those with a null in either link to nothing.
    """
    rows = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn", lines(F.col("text")).alias("parsed"))
    quoting = rows.where(F.exists("parsed", lambda x: x["level"] > 0))
    asked = stored(quoted_parts(quoting), "quoted")
    # Only conversations in which someone quotes need their messages' own words.
    quoted_in = asked.select("conv_id").distinct()
    own = rows.join(quoted_in, "conv_id", "left_semi").select("conv_id", "turn", own_words(F.col("parsed")).alias("own"))
    own = own.select("conv_id", "turn", "own", F.split(normalised(F.col("own")), " ").alias("words"))
    by_line = F.transform(F.split("own", "\r?\n"), normalised)
    spoken = F.array_distinct(F.concat(F.array(F.array_join("words", " ")), by_line, _windows("words")))
    said = own.select("conv_id", "turn", F.explode(spoken).alias("t")).where(F.col("t") != "")
    originals = said.groupBy("conv_id", _hash(F.col("t")).alias("hash")).agg(F.min("turn").alias("original"))
    found = asked.join(originals, ["conv_id", "hash"]).where(F.col("original") < F.col("turn"))
    # A passage's linked parts in their order: each adds the words behind those before.
    before = Window.partitionBy("conv_id", "turn", "level", "passage", "original").orderBy("start", "words", "whole").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("words")
    added = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))))
    each = found.withColumn("added", added).groupBy("conv_id", "turn", "level", "original")
    # A whole passage counts twice: once more than its parts alone.
    each = each.agg(F.sum("added").alias("quoted"), F.sum(F.col("words") * F.col("whole")).alias("as_whole"))
    weight = (F.col("quoted") + F.col("as_whole")).alias("weight")
    best = each.groupBy("conv_id", "turn").agg(F.max(F.struct((-F.col("level")).alias("outer"), weight, F.col("original").alias("reply_to"), "quoted")).alias("b"))
    return best.select("conv_id", "turn", "b.reply_to", F.col("b.quoted").cast("long").alias("quoted"))


def threads(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, root, depth)`` of messages with a reply: the start of their
    thread and the number of replies between. Each round halves what is left."""
    at = stored(links.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth")), "threads")
    for _ in range(_ROUNDS):
        up = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("root").alias("r"), F.col("depth").alias("d"))
        joined = at.join(up, (at["conv_id"] == up["c"]) & (at["root"] == up["t"]), "left")
        if joined.where("t is not null").isEmpty():
            return at
        at = stored(joined.select("conv_id", "turn", F.coalesce("r", "root").alias("root"), (F.col("depth") + F.coalesce("d", F.lit(0))).alias("depth")), "threads")
    raise RuntimeError("replies do not end")


def conversations(messages: DataFrame) -> DataFrame:
    """A row per message: ``conv_id, turn, role, text, quote_level, reply_to, quoted, root, depth``.

    ``text`` is the message's own words; ``quote_level`` is its deepest quote;
    ``reply_to`` is null and ``depth`` 0 where nothing earlier is quoted, and
    ``root`` is then the message itself. Sorted by conversation, ``root``,
    ``depth`` and ``turn``, messages stand in reply order. Null text is empty; rows
    are neither dropped nor merged; other columns are ignored.
    """
    links = stored(replies(messages), "replies")
    placed = links.join(threads(links), ["conv_id", "turn"])
    placed = placed.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "reply_to", "quoted", "root", "depth")
    parsed = messages.select("conv_id", "turn", "role", lines(F.col("text")).alias("parsed"))
    own = parsed.select("conv_id", "turn", "role", own_words(F.col("parsed")).alias("text"), F.array_max(F.transform("parsed", lambda x: x["level"])).cast("long").alias("quote_level"))
    joined = own.join(placed, (own["conv_id"] == placed["c"]) & (own["turn"] == placed["t"]), "left")
    return joined.select(
        "conv_id", "turn", "role", "text", "quote_level", "reply_to",
        F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"),
        F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op10_quotation_linking``: every message in its place, without quotes."""
    return conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text"))


SQL = r"""
with recursive split as (
  select conv_id, turn, role, text, unnest(regexp_split_to_array(coalesce(text, ''), '\r?\n')) as line,
    unnest(range(len(regexp_split_to_array(coalesce(text, ''), '\r?\n')))) as i, rid
  from (select *, row_number() over () as rid from conversations)
), parsed as (
  select *, length(regexp_extract(line, '^(?:\x20*>)+')) - length(replace(regexp_extract(line, '^(?:\x20*>)+'), '>', '')) as level,
    substr(line, length(regexp_extract(line, '^(?:\x20*>)+')) + 1) as body from split
), own as (
  select rid, any_value(conv_id) as conv_id, any_value(turn) as turn, any_value(role) as role, max(level)::bigint as quote_level,
    trim(coalesce(string_agg(body, chr(10) order by i) filter (level = 0), ''), ' ') as text
  from parsed group by rid
), runs as (
  select rid, conv_id, turn, level, body, i, i - row_number() over (partition by rid, level order by i) as run from parsed
), plain as (
  select rid, conv_id, turn, level, run, i, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') as t
  from runs where level > 0 and conv_id is not null and turn is not null
), worded as (
  select *, row_number() over (partition by rid, level, run order by i, j) - 1 as p
  from (select *, unnest(string_split(t, ' ')) as w, unnest(range(len(string_split(t, ' ')))) as j from plain where t <> '')
), passage as (
  select rid, conv_id, turn, level, run, list(w order by p) as ws, string_agg(w, ' ' order by p) as passage from worded group by all
), parts as (
  select conv_id, turn, level, passage, 0 as start, len(ws) as words, 1 as whole, passage as t from passage
  union select w.conv_id, w.turn, w.level, passage, min(p), count(*), 0, w.t
    from worded w join passage using (rid, level, run) group by w.rid, w.conv_id, w.turn, w.level, run, i, passage, w.t
  union select conv_id, turn, level, passage, s, 5, 0, array_to_string(ws[s + 1:s + 5], ' ')
    from (select *, unnest(range(len(ws) - 4)) as s from passage)
), spoken as (
  select conv_id, turn, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), ' ') as ws, text
  from own where turn is not null and conv_id in (select conv_id from parts)
), said as (
  select conv_id, turn, array_to_string(ws, ' ') as t from spoken
  union select conv_id, turn, trim(regexp_replace(lower(unnest(regexp_split_to_array(text, '\r?\n'))), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') from spoken
  union select conv_id, turn, array_to_string(ws[s + 1:s + 5], ' ') from (select *, unnest(range(len(ws) - 4)) as s from spoken)
), originals as (
  select conv_id, t, min(turn) as original from said where t <> '' group by all
), found as (
  select a.*, original, start + words as until from parts a join originals o on a.conv_id = o.conv_id and a.t = o.t where original < a.turn
), behind as (
  select *, max(until) over (partition by conv_id, turn, level, passage, original order by start, words, whole rows between unbounded preceding and 1 preceding) as earlier
  from found
), matched as (
  select conv_id, turn, level, original, sum(greatest(0, until - greatest(start, coalesce(earlier, 0)))) as quoted, sum(words * whole) as as_whole
  from behind group by conv_id, turn, level, original
), links as (
  select conv_id, turn, original as reply_to, quoted from matched
  qualify row_number() over (partition by conv_id, turn order by level, quoted + as_whole desc, original desc) = 1
), walk as (
  select conv_id, turn, reply_to as root, 1 as depth from links
  union all select w.conv_id, w.turn, l.reply_to, w.depth + 1 from walk w join links l on w.conv_id = l.conv_id and w.root = l.turn
), placed as (
  select conv_id, turn, max(depth) as depth, min(root) as root from walk group by all
)
select o.conv_id, o.turn, o.role, o.text, quote_level, l.reply_to, coalesce(l.quoted, 0)::bigint as quoted,
  coalesce(p.root, o.turn) as root, coalesce(p.depth, 0)::bigint as depth
from own o left join links l on o.conv_id = l.conv_id and o.turn = l.turn left join placed p on o.conv_id = p.conv_id and o.turn = p.turn
"""
