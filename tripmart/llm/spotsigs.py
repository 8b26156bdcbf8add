"""Document fingerprints by spot signatures, in SQL functions only.

A spot is where a common word, an anchor, is followed by content words; its
signature is the hash of the chain of the next content words. The fingerprint is
the sorted set of a text's signatures. Likeness is the Jaccard index of two sets.
Whether sets are alike enough is decided by length first: they are partitioned by their
length, and sets that are more than one partition apart cannot reach the threshold, so
they are not compared.

Where anchors are rare for the length of a text, each word counts as following one.
So the signatures of every text grow with its content, whatever its language, and a
few stray anchors do not stand for a long text.

The next document in id order is found without sorting texts: ids are ranked over
many tasks. Texts are shuffled once by their id; what the document before needs of a
text, its start and its signatures, is shuffled to that document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.mixing import numbered

#: Frequent function words of four languages.
ANCHORS = """the of and to a in is was it for on with as be at by that this are from or an he not
de la le les et un une que qui en du des pour dans sur au pas est
der die das und zu den von mit ist ein eine nicht auf
el y los las del se por con para una su al es lo""".split()
CHAIN = 2
#: Content words for each anchor beyond which anchors are rare.
RARE = 20
#: Likeness of near-duplicates.
ALIKE = 0.8
#: A quarter of a text is replaced in its edited form.
EDITED = 4


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signatures(text: Column) -> Column:
    """The sorted set of signatures of a text, as hexadecimal strings.

    Words are lower-cased runs of letters and digits. A chain at a text's end may
    be shorter. In a text with more than ``RARE`` content words for each anchor every
    word counts as following one; a text without content words has the hash of itself
    as its only signature.
    """
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # An anchor and its space become a mark on the word that follows; marks at the
    # end have no such word.
    marked = F.regexp_replace(plain, f"(?<= )(?:{'|'.join(ANCHORS)}) ", "^")

    def of_marked(line: Column) -> Column:
        anchors = F.length(line) - F.length(F.replace(line, F.lit("^"), F.lit("")))
        content = F.filter(F.split(F.rtrim(line, F.lit(" ^")), " "), lambda w: w != "")
        # Counted once for a text, not for each word.
        return _let(F.struct(content.alias("words"), anchors.alias("anchors")), with_rule)

    def with_rule(found: Column) -> Column:
        rare = found["anchors"] * RARE < F.size(found["words"])
        return _let(F.struct(found["words"].alias("words"), rare.alias("rare")), lambda f: of_words(f["words"], f["rare"]))

    def of_words(words: Column, everywhere: Column) -> Column:
        def chain(word: Column, i: Column) -> Column:
            following = [F.ltrim(F.get(words, i + k), F.lit("^")) for k in range(1, CHAIN)]
            return F.when(everywhere | word.startswith("^"), F.substring(F.md5(F.concat_ws(" ", F.ltrim(word, F.lit("^")), *following)), 1, 8))

        found = F.array_compact(F.transform(words, chain))
        return F.array_sort(F.array_distinct(F.when(F.size(found) > 0, found).otherwise(F.array(F.substring(F.md5(text), 1, 8)))))

    return _let(marked, of_marked)


def fingerprint(found: Column) -> Column:
    return F.array_join(found, "")


def partition(found: Column, least: float = ALIKE) -> Column:
    """Number of the set's length partition; each is 1 / ``least`` times the last."""
    return F.floor(F.log(F.size(found).cast("double")) / F.log(F.lit(1 / least)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets of signatures."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def alike(a: Column, b: Column, index: Column, least: float = ALIKE) -> Column:
    """Whether two sets reach a likeness; ``index`` is only computed where their lengths allow it."""
    return F.when(F.abs(partition(a, least) - partition(b, least)) > 1, F.lit(False)).otherwise(index >= least)


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter of code points replaced by the start of another."""
    size = F.floor(F.length(text) / EDITED).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - size), F.substring(following, F.lit(1), size))


def compare(documents: DataFrame) -> DataFrame:
    """A row per document with its fingerprint, its edited text's, likenesses and near-duplicates.

    Null text counts as empty. The next document of a row is that of the next
    greater id, null ids last, and the first id's after the last; of documents that
    share an id, the one with the least start. Other columns are ignored, repeated
    rows stay, empty input gives no rows.
    """
    # One key without nulls for both joins and the aggregation between them, so that
    # texts are dealt out once and starts once.
    kind = documents.schema["doc_id"].dataType
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("null"))
    rows = documents.select(key.alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    lengths = documents.groupBy("doc_id").agg(F.max(F.length(F.coalesce(F.col("text"), F.lit("")))).alias("most"))
    ids = numbered(lengths, "doc_id")
    last = ids.agg(F.max("number")).first()[0]
    own = ids.select(key.alias("next_key"), "number")
    before = ids.select(key.alias("for_key"), "most", F.when(F.col("number") == F.lit(last), 0).otherwise(F.col("number") + 1).alias("number"))
    pairs = own.join(before, "number").drop("number")
    starts = rows.join(pairs, F.col("key") == F.col("next_key")).select(
        "for_key", F.substring("text", F.lit(1), F.floor(F.col("most") / EDITED).cast("int")).alias("start"), signatures(F.col("text")).alias("next_found")
    )
    starts = starts.groupBy("for_key").agg(F.min(F.struct("start", "next_found")).alias("next"))
    joined = rows.join(starts, F.col("key") == F.col("for_key"))
    doc_id = F.when(F.col("key") != "null", F.substring("key", F.lit(2), F.length("key"))).cast(kind)
    changed = joined.select(doc_id.alias("doc_id"), "text", "next", edited(F.col("text"), F.col("next.start")).alias("changed"))
    found = changed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("changed", 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("_own"),
        signatures(F.col("changed")).alias("_edited"),
        F.col("next.next_found").alias("_next"),
    )
    near = found.withColumns({"near_edited": likeness(F.col("_own"), F.col("_edited")), "near_next": likeness(F.col("_own"), F.col("_next"))})
    return near.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("_own")).alias("fingerprint"),
        fingerprint(F.col("_edited")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        alike(F.col("_own"), F.col("_edited"), F.col("near_edited")).alias("alike_edited"),
        alike(F.col("_own"), F.col("_next"), F.col("near_next")).alias("alike_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op8_document_fingerprints``: the fingerprints of every document."""
    return compare(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_ANCHOR_LIST = ", ".join(f"'{a}'" for a in ANCHORS)


def _found(table: str, text: str) -> str:
    """Signatures of a text column of a table, by its row number."""
    return f"""
  select rid, list_sort(list_distinct(case when len(chains) > 0 then chains else [substr(md5(t), 1, 8)] end)) as found
  from (
    select rid, t, list_filter(list_transform(range(1, len(content) + 1), lambda i: case
        when content[i].spot or none then substr(md5(content[i].word || case when i < len(content) then ' ' || content[i + 1].word else '' end), 1, 8) end),
        lambda c: c is not null) as chains
    from (
      select rid, t, {RARE} * len(list_filter(words, lambda w: w in ({_ANCHOR_LIST}))) < len(list_filter(words, lambda w: w not in ({_ANCHOR_LIST}))) as none,
        list_filter(list_transform(range(1, len(words) + 1), lambda i: {{'word': words[i], 'spot': i > 1 and words[greatest(i - 1, 1)] in ({_ANCHOR_LIST})}}),
          lambda c: c.word not in ({_ANCHOR_LIST})) as content
      from (select rid, {text} as t, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') as words from {table})
    )
  )"""


SQL = f"""
with docs as (select row_number() over (order by doc_id nulls last) as rid, doc_id, coalesce(text, '') as text from documents),
pairs as (
  select *, length(text) // {EDITED} as cut,
    coalesce(lead(text) over (order by rid), first_value(text) over (order by rid)) as following from docs
), changed as (
  select rid, doc_id, text, substr(text, 1, length(text) - cut) || substr(following, 1, cut) as altered from pairs
), own as ({_found("docs", "text")}
), other as ({_found("changed", "altered")}
), jaccard as (
  select c.rid, doc_id, text, altered, own.found as a, other.found as b,
    coalesce(lead(own.found) over (order by c.rid), first_value(own.found) over (order by c.rid)) as n
  from changed c join own on own.rid = c.rid join other on other.rid = c.rid
)
, sets as (
  select *, len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b)))::double as near_edited,
    len(list_intersect(a, n)) / (len(a) + len(n) - len(list_intersect(a, n)))::double as near_next
  from jaccard
)
select doc_id, length(text) as n_chars, sha256(altered) as edited_sha256, array_to_string(a, '') as fingerprint, array_to_string(b, '') as edited_fingerprint,
  near_edited, near_next, near_edited >= {ALIKE} as alike_edited, near_next >= {ALIKE} as alike_next
from sets
"""
