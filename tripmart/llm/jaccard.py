"""Similarity join of texts by the Jaccard index of their word n-grams.

A MinHash LSH forest finds candidates: each tree labels a text with a sequence of
MinHash values, and texts that share a prefix of the label lie in one subtree of
the sorted trie. All trees are sorted, and all neighbours with a
common prefix are verified exactly. From the similarities of those that are linked
follows, for each length of the prefix, the recall of pairs like them: the prefix is
shortened from its full depth, level by level, until pairs of every band of similarity
that occurs reach the target. Then each subtree is a bucket. Of
buckets with the same members one is kept. In each bucket the exact index of each
pair is computed, each pair in the first tree that joins it only, so links are
counted once. Large buckets are dealt out as pairs of blocks of bounded size; a
task emits a row per text, not per pair: its number of links and the least text it
is linked to. Linked texts form classes.

Exact copies are one text from the start: a text is known by its hash and stands
for any number of documents.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.components import components
from tripmart.llm.mixing import stored
from tripmart.llm.text import Block, Hasher, blocks, in_batches, mixed, words


#: Parts that the documents of one text are dealt out in.
SALTS = 16
#: Bits of a level of a label; a label is two numbers of four levels.
LEVEL_BITS = 16
HALF = 4
#: Width of a band of similarities.
BAND = 0.05
#: Levels of a common prefix from which neighbours are verified.
SEEN = 2
#: Bytes of text hashed at once; the hasher's arrays and tables take some 40 times as much.
HASHED_BYTES = 1 << 20


class Forest(NamedTuple):
    """n-gram words, similarity, target recall, trees and their depth (8 at most)."""

    words: int = 5
    similarity: float = 0.8
    recall: float = 0.9995
    trees: int = 16
    depth: int = 8
    block: int = 256

    def chance(self, similarity: np.ndarray, length: int) -> np.ndarray:
        """How likely a pair shares a prefix of that length in a tree or more."""
        return 1 - (1 - similarity**length) ** self.trees

    def prefix(self, similar: np.ndarray, seen: int = 1) -> int:
        """The longest prefix that finds pairs like the verified ones with the target recall.

        ``similar`` are similarities of linked pairs that share a prefix of ``seen``
        levels; a pair counts for all those of its kind that do not. Every band of
        similarity with such a pair has to reach the recall, 1 level is left at least.
        Without any, pairs at the threshold stand for them.
        """
        similar = similar if len(similar) else np.array([self.similarity])
        weight = 1 / self.chance(similar, seen)
        band = ((similar - self.similarity) / BAND + 1e-9).astype(int)
        found = [np.bincount(band, weight * self.chance(similar, length)) for length in range(1, self.depth + 1)]
        return self.longest(np.bincount(band, weight), np.stack(found, axis=1))

    def longest(self, wanted: np.ndarray, found: np.ndarray) -> int:
        """The longest prefix that reaches the recall in each band, from the sums of weights
        of its pairs and of those that each length from 1 on finds: (bands, depth)."""
        length = self.depth
        while length > 1 and not (found[:, length - 1] >= self.recall * wanted).all():
            length -= 1
        return length


def shingles(block: Block, hasher: Hasher, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words, and their text's number, ascending.

    A text of fewer than n words has one n-gram, of all its words; that of a text
    without words is the same for all such texts.
    """
    starts, ends, owner = words(block)
    word = hasher.ranges(block.data, starts, ends)
    number = np.bincount(owner, minlength=block.n)
    first = np.cumsum(number) - number
    place = np.arange(len(owner)) - first[owner] if len(owner) else owner
    full = np.flatnonzero(owner[: max(len(owner) - n + 1, 0)] == owner[n - 1 :]) if len(owner) >= n else np.zeros(0, np.int64)
    gram = np.zeros(len(full), np.uint64)
    for j in range(n):
        gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + word[full + j])
    short = np.flatnonzero(number < n)
    rest = np.zeros(block.n, np.uint64)
    inside = number[owner] < n
    np.add.at(rest, owner[inside], mixed(word[inside] + mixed(place[inside].astype(np.uint64) + np.uint64(1))))
    grams = np.concatenate([gram, mixed(rest[short] + np.uint64(n))])
    owners = np.concatenate([owner[full], short])
    order = np.argsort(owners, kind="stable")
    return grams[order], owners[order]


def gram_sets(column: pa.Array, hasher: Hasher, n: int) -> list[np.ndarray]:
    """The sorted set of hashes of n-grams of each text."""
    sets: list[np.ndarray] = []
    for block in blocks(column, HASHED_BYTES):
        grams, owners = shingles(block, hasher, n)
        sets.extend(np.unique(s) for s in np.split(grams, np.searchsorted(owners, np.arange(1, block.n))))
    return sets


def labels(block: Block, hasher: Hasher, forest: Forest) -> np.ndarray:
    """Each text's label in each tree, as two numbers of four levels: (texts, trees * 2)."""
    grams, owners = shingles(block, hasher, forest.words)
    edges = np.flatnonzero(np.diff(owners, prepend=-1))
    multipliers = mixed(np.arange(1, forest.trees * forest.depth + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((block.n, forest.trees * 2), np.uint64)
    for tree in range(forest.trees):
        for level in range(forest.depth):
            values = (grams * multipliers[tree * forest.depth + level]) >> np.uint64(32)
            least = np.minimum.reduceat(values, edges) if len(edges) else values
            bits = mixed(least + np.uint64(level + 1)) >> np.uint64(64 - LEVEL_BITS)
            out[:, tree * 2 + level // HALF] |= bits << np.uint64(LEVEL_BITS * (HALF - 1 - level % HALF))
    return out


def _labelled(rows: DataFrame, forest: Forest) -> DataFrame:
    """``(key, labels)`` of rows ``(key, text)``."""

    def work(batches):
        hasher = Hasher()
        for batch in batches:
            found = [labels(b, hasher, forest) for b in blocks(batch.column(1), HASHED_BYTES)]
            if not found:
                continue
            values = np.concatenate(found).view(np.int64)
            offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "labels"])

    return in_batches(rows, work, "key binary, labels array<long>")


def prefix_of(high: Column, low: Column, length: int) -> Column:
    """A number for the first levels of a label."""
    if length <= HALF:
        return F.xxhash64(F.shiftrightunsigned(high, LEVEL_BITS * (HALF - length)))
    return F.xxhash64(high, F.shiftrightunsigned(low, LEVEL_BITS * (2 * HALF - length)))


def common_levels(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Levels that each sorted label has in common with the one before it."""
    out = np.zeros(len(high), np.int64)
    going = np.ones(max(len(high) - 1, 0), bool)
    for half in (high, low):
        differing = (half[1:] ^ half[:-1]).view(np.uint64)
        for level in range(HALF):
            going &= (differing >> np.uint64(LEVEL_BITS * (HALF - 1 - level))) & np.uint64((1 << LEVEL_BITS) - 1) == 0
            out[1:] += going
    return out


def _neighbours(labelled: DataFrame, seen: int) -> DataFrame:
    """``(a, b)``: texts that follow one another in a sorted tree and share ``seen`` levels.

    The first and last text of a range of the sorted labels are paired with themselves:
    what follows or precedes them lies in another range, so no pair may show what they share.
    """

    def work(batches):
        last = None
        for batch in batches:
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            tree, high, low = (batch.column(c).to_numpy() for c in ("tree", "high", "low"))
            near = common_levels(high, low) >= seen
            near[1:] &= tree[1:] == tree[:-1]
            at = np.flatnonzero(near)
            keys = batch.column("key")
            if last is None:
                yield pa.RecordBatch.from_arrays([keys.slice(0, 1)] * 2, names=["a", "b"])
            last = batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at - 1)), keys.take(pa.array(at))], names=["a", "b"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([last.column("key")] * 2, names=["a", "b"])

    ordered = labelled.repartitionByRange("tree", "high", "low").sortWithinPartitions("tree", "high", "low")
    pairs = in_batches(ordered, work, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _similarities(pairs: DataFrame, words: int) -> DataFrame:
    """The exact index of rows ``(x, y)`` of texts."""

    def work(batches):
        hasher = Hasher()
        for batch in batches:
            sides = [gram_sets(column, hasher, words) for column in batch.columns]
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides, strict=True)]
            index = [c / (len(x) + len(y) - c) for c, x, y in zip(common, *sides, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(index, pa.float64())], names=["similarity"])

    return in_batches(pairs, work, "similarity double")


def _compared(rows: DataFrame, texts: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """Neighbours ``(a, b)`` and the texts ``(key, text)`` that may share ``SEEN`` levels with another.

    Of ``(key, text)`` and ``(key, labels)``. No text that shares them is missing, so the
    members of buckets are among them if these are made of as many levels.
    """
    seen = min(SEEN, forest.depth)
    trees = F.array(*(F.struct(F.lit(t).alias("tree"), F.col("labels")[2 * t].alias("high"), F.col("labels")[2 * t + 1].alias("low")) for t in range(forest.trees)))
    pairs = stored(_neighbours(texts.select("key", F.explode(trees).alias("l")).select("key", "l.*"), seen), "neighbours")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    # One document of a text will do; copies of a text are dealt out, as there may be very many.
    salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    # Merged: the planner sees the size before the salts and would broadcast a multiple of it.
    wanted = wanted.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    found = salted.join(wanted, (F.col("key") == F.col("k")) & (F.col("_salt") == F.col("_s")), "left_semi").dropDuplicates(["key"])
    return pairs.where("a <> b"), stored(found.select("key", "text"), "neighbour-texts")


def prefix_length(rows: DataFrame, texts: DataFrame, forest: Forest) -> int:
    """How many levels of the labels make a bucket, from ``(key, text)`` and ``(key, labels)``."""
    return _recalled(*_compared(rows, texts, forest), forest)


def _recalled(pairs: DataFrame, found: DataFrame, forest: Forest) -> int:
    """The longest prefix with the target recall, from neighbours and their texts.

    All labels of all trees were sorted and all neighbours with a common prefix are verified;
    the sums of each band of similarity, a few numbers, alone reach the driver.
    """
    seen = min(SEEN, forest.depth)
    x, y = found.select(F.col("key").alias("a"), F.col("text").alias("x")), found.select(F.col("key").alias("b"), F.col("text").alias("y"))
    verified = _similarities(pairs.join(x, "a").join(y, "b").select("x", "y"), forest.words)
    similar = F.col("similarity")

    def chance(length: int) -> Column:
        return 1 - F.pow(1 - F.pow(similar, F.lit(length)), F.lit(forest.trees))

    band = ((similar - forest.similarity) / BAND + 1e-9).cast("int")
    sums = verified.where(similar >= forest.similarity - 1e-9).groupBy(band.alias("band")).agg(
        F.sum(1 / chance(seen)).alias("wanted"),
        F.array(*(F.sum(chance(length) / chance(seen)) for length in range(1, forest.depth + 1))).alias("found"),
    ).collect()
    if not sums:
        return forest.prefix(np.array([]))
    return forest.longest(np.array([r["wanted"] for r in sums]), np.array([r["found"] for r in sums]))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common part of all pairs of sets of hashes."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((n, n))
    # Columns ascend, so a slice of them is a slice of the arrays.
    width = max(64, (1 << 22) // n)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def links(sets: list[np.ndarray], label: np.ndarray, tree: int, side: np.ndarray, across: bool, similarity: float) -> np.ndarray:
    """Which pairs of a bucket are linked and found first in this tree."""
    common = overlaps(sets)
    sizes = np.array([len(s) for s in sets])
    union = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * union - 1e-9
    for earlier in range(tree):
        linked &= label[:, earlier][:, None] != label[:, earlier][None, :]
    if across:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    return linked


def least_linked(linked: np.ndarray) -> np.ndarray:
    """The lowest number that each one is linked to, directly or not."""
    least = np.arange(len(linked))
    while True:
        reached = np.where(linked, least[None, :], len(linked)).min(axis=1)
        lower = np.minimum(least, reached)
        lower = lower[lower]
        if (lower == least).all():
            return least
        least = lower


def _verified(rows: DataFrame, forest: Forest) -> DataFrame:
    """Of rows sorted by bucket and block pair, each linked text's links there."""

    def of_group(group: list[tuple]) -> list[tuple]:
        if len(group) < 2:
            return []
        group.sort(key=lambda r: r[0])
        _, i, j = group[0][5]
        label = np.array([r[3] for r in group])
        linked = links([r[1] for r in group], label, group[0][4], np.array([r[2] for r in group]), i != j, forest.similarity)
        if not linked.any():
            return []
        least = least_linked(linked)
        number = linked @ np.array([r[6] for r in group])
        return [(group[k][0], group[least[k]][0], int(number[k])) for k in np.flatnonzero(linked.any(axis=1))]

    def work(batches):
        hasher, group = Hasher(), []
        for batch in batches:
            out, sets = [], gram_sets(batch.column("text"), hasher, forest.words)
            columns = [batch.column(c).to_pylist() for c in ("key", "side", "labels", "tree", "bucket", "i", "j", "copies")]
            for s, key, side, label, tree, bucket, i, j, copies in zip(sets, *columns, strict=True):
                at = (bucket, i, j)
                if group and group[0][5] != at:
                    out += of_group(group)
                    group = []
                group.append((key, s, side, label, tree, at, copies))
            if out:
                yield _links_batch(out)
        out = of_group(group)
        if out:
            yield _links_batch(out)

    return in_batches(rows, work, "key binary, least binary, links long")


def _links_batch(rows: list[tuple]) -> pa.RecordBatch:
    keys, least, number = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(least, pa.binary()), pa.array(number, pa.int64())], names=["key", "least", "links"])


def text_key(text: Column) -> Column:
    """What texts are known by; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes_of(documents: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """Of each text that has a copy or a similar text: ``(key, own_id, class_id, n_links, first)``.

    ``own_id`` is the least id of its documents; ``first`` marks the text of each
    class whose document has the least id.
    """
    rows = documents.select("doc_id", "text", text_key(F.col("text")).alias("key"))
    found = _labelled(rows.select("key", "text"), forest)
    # A text's labels are equal in all its copies; any of them will do.
    copies = rows.groupBy("key").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies"))
    numbers = range(forest.trees * 2)
    once = found.select("key", *(F.col("labels")[t].alias(f"t{t}") for t in numbers)).groupBy("key").agg(*(F.max(f"t{t}").alias(f"t{t}") for t in numbers))
    full = stored(once.join(copies, "key").select("key", "id", "copies", F.array(*(f"t{t}" for t in numbers)).alias("labels")), "texts")
    pairs, shared = _compared(rows.select("key", "text"), full, forest)
    length = _recalled(pairs, shared, forest)
    prefixes = F.array(*(prefix_of(F.col("labels")[2 * t], F.col("labels")[2 * t + 1], length) for t in range(forest.trees)))
    texts = full.withColumn("labels", prefixes)

    in_trees = texts.select("key", F.posexplode("labels").alias("tree", "label"))
    sizes = in_trees.groupBy("tree", "label").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum((F.xxhash64(F.col("key"), F.lit(1)) % (1 << 31)).cast("decimal(20,0)")).cast("decimal(38,0)").alias("s"),
    )
    kept = sizes.where("n > 1").groupBy("n", "x", "s").agg(F.min(F.struct("tree", "label")).alias("b")).select("n", "b.tree", "b.label")
    members = stored(in_trees.join(kept, ["tree", "label"]).select("key", "tree", F.xxhash64("tree", "label").alias("bucket"), "n"), "members")

    carried = shared
    if length < min(SEEN, forest.depth):
        # One document of each text: of equal rows, any.
        chosen = members.select(F.col("key").alias("k")).distinct().join(texts, F.col("k") == F.col("key")).select("k", "id")
        carried = rows.join(chosen, (rows["key"] == chosen["k"]) & rows["doc_id"].eqNullSafe(chosen["id"])).select("key", "text").dropDuplicates(["key"])
    # One block for each ``block`` texts of a bucket, and one row for each pair of blocks.
    number = F.ceil(F.col("n") / forest.block).cast("int")
    side = F.pmod(F.xxhash64(F.col("key"), F.lit(2)), number.cast("long")).cast("int")
    dealt = members.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    dealt = dealt.select("key", "tree", "bucket", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    grouped = dealt.join(carried, "key").join(texts.select("key", "labels", "copies"), "key")
    ordered = grouped.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    found_links = stored(_verified(ordered, forest), "links")

    number_of = found_links.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found_links.select(F.col("key").alias("a"), F.col("least").alias("b")))
    ids = roots.join(texts.select("key", "id"), roots["node"] == texts["key"])
    # Stored, so that a class with very many texts can be split in the join.
    firsts = stored(ids.groupBy("root").agg(F.min("id").alias("class_id"), F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("first")), "firsts")
    classes = roots.join(firsts, "root").select(F.col("node").alias("key"), "class_id", "first")
    similar = classes.join(number_of, "key", "left")
    many = texts.where("copies > 1").select("key", "id", "copies")
    joined = many.join(similar, "key", "full").join(texts.select("key", F.col("id").alias("own_id"), F.col("copies").alias("own_copies")), "key")
    return stored(
        joined.select(
            "key",
            "own_id",
            F.coalesce("class_id", "own_id").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("own_copies") - 1).cast("long").alias("n_links"),
            F.coalesce(F.col("first") == F.col("key"), F.lit(True)).alias("first"),
        ),
        "classes",
    )


def join(documents: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """A row per document: ``doc_id, class_id, n_links``.

    ``class_id`` is the least id of the documents that links connect, ``n_links``
    the number of other documents whose n-grams are similar enough, copies of the
    same text included. Null texts count as empty; texts without words are similar
    to one another. Null ids stay null and are no class's id unless all are.
    Repeated rows are copies. Other columns are ignored; empty input gives no rows.
    """
    rows = documents.select("doc_id", text_key(F.col("text")).alias("key"))
    result = rows.join(classes_of(documents, forest).withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    class_id = F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return result.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def deduplicated(documents: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """One document of each class, that of the least id; all columns. Of equal rows one stays."""
    rows = documents.select(F.struct("*").alias("_row")).withColumn("_key", text_key(F.col("_row.text")))
    # Copies of one text may be a third of all rows: they are dealt out by their ids too.
    # Rows that are equal in both share a salt, so one of them is left at the end.
    salt = F.pmod(F.xxhash64("_row.doc_id"), F.lit(SALTS)).cast("int")
    found = classes_of(documents, forest).select(F.col("key").alias("_k"), F.col("own_id").alias("_id"), F.col("first").alias("_first"))
    # Merged: the planner sees the size before the salts and would broadcast a multiple of it.
    found = found.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    rows = rows.withColumn("_salt", salt)
    joined = rows.join(found, (F.col("_key") == F.col("_k")) & (F.col("_salt") == F.col("_s")), "left")
    kept = joined.where(F.col("_k").isNull() | (F.col("_first") & F.col("_row.doc_id").eqNullSafe(F.col("_id"))))
    return kept.dropDuplicates(["_key", "_salt"]).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op5_ngram_jaccard_join``: class and links of every document."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
