"""Near-duplicate vectors by a subspace pigeonhole join.

Two unit vectors have a cosine of ``t`` or more if their squared distance is at most
``2 - 2 t``. Vectors are rotated at random, so that no coordinate stands out, and split
into blocks. If every block of a pair were farther apart than the block's share of that
budget, by its number of coordinates, the pair would be too: so each linked pair lies
within the budget of at least one block. Each block is range-joined by itself, and the
union of what the blocks find is verified exactly, so no link is lost.

The range join of a block puts each vector into a cell by the signs of its first
coordinates, around the mean of a sample. A vector also visits the cells, of lower number
than its own, that its budget reaches: those that differ in coordinates whose squares sum
up to the budget at most. So a pair within the budget shares a cell in which one of them
is at home. The number of cells follows the number of vectors. A cell that is still larger
than a task should hold is dealt out as pairs of parts of bounded size, so a hot group of
vectors is spread over many tasks.

A task compares the block's coordinates of its vectors in float32 with some slack, and
only rows and columns of the matrix with a hit in double precision, with all coordinates.
A pair counts in the first block within whose budget it lies, which both of its vectors'
tasks decide alike. Tasks emit a row per linked vector, never pairs: its number of links
and the least vector that it is connected to there.

Equal vectors are one vector from the start and stand for any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.components import components
from tripmart.llm.mixing import stored
from tripmart.llm.text import in_batches

SEED = 20
#: Vectors whose mean is the middle of the cells; any middle gives right results.
SAMPLE = 1024
#: Rounding that a budget forgives in double precision, and in the first comparison.
SLACK = 1e-9
COARSE_SLACK = 1e-4
#: Rows of a matrix at a time.
ROWS = 256


class Subspaces(NamedTuple):
    """Least cosine, blocks, vectors that a part of a cell may hold, and the most signs of a cell."""

    cosine: float = 0.95
    blocks: int = 4
    part: int = 32768
    most_bits: int = 8

    @property
    def budget(self) -> float:
        return 2 - 2 * self.cosine

    def ranges(self, size: int) -> list[tuple[int, int]]:
        """First and last + 1 coordinate of each block."""
        n = min(self.blocks, size)
        edges = [size * b // n for b in range(n + 1)]
        return list(zip(edges[:-1], edges[1:], strict=True))

    def bits(self, vectors: int, size: int) -> int:
        """Signs of a cell: enough that a cell is half a part, two at least."""
        wanted = max(2, ceil(log2(max(vectors, 1) / self.part)) + 1)
        return min(wanted, self.most_bits, min(b - a for a, b in self.ranges(size)))


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same for each size."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Whether a vector can have a cosine: not null, not zero, all components finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_key(vector: Column) -> Column:
    """What vectors are known by: equal components, equal key."""
    return F.unhex(F.md5(vector.cast("string")))


def places(vectors: np.ndarray, middle: np.ndarray, space: Subspaces, bits: int) -> list[np.ndarray]:
    """Of each vector, its cells in all blocks: (block * 2^bits + cell) * 2 + 1 where it is at home, even where it visits."""
    size = vectors.shape[1]
    rotated = (units(vectors) - middle) @ rotation(size).T
    cells = np.arange(1 << bits)
    flipped = (cells[:, None] >> np.arange(bits)) & 1
    found, owner = [], []
    for block, (low, high) in enumerate(space.ranges(size)):
        part = rotated[:, low : low + bits]
        home = ((part >= 0) << np.arange(bits)).sum(axis=1)
        reached = (part * part) @ flipped.T.astype(float) <= space.budget * (high - low) / size + COARSE_SLACK
        # Column c of ``reached`` says whether the cell home ^ c is in reach.
        row, flip = np.nonzero(reached)
        cell = home[row] ^ flip
        keep = (cell < home[row]) | (flip == 0)
        found.append((((block << bits) + cell) * 2 + (flip == 0))[keep])
        owner.append(row[keep])
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.split(found[order].astype(np.int32), np.searchsorted(owner[order], np.arange(1, len(vectors))))


def _placed(vectors: DataFrame, size: int, middle: np.ndarray, space: Subspaces, bits: int) -> DataFrame:
    """``(key, copies, vector, place)`` of vectors of one size: a row for each cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = pa.array([p.tolist() for p in places(_matrix(batch.column(2)), middle, space, bits)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["key", "copies", "vector", "places"])

    element = vectors.schema["vector"].dataType.simpleString()
    rows = in_batches(vectors.where(F.size("vector") == size).select("key", "copies", "vector"), work, f"key binary, copies long, vector {element}, places array<int>")
    return rows.select("key", "copies", "vector", F.explode("places").alias("place"))


class Group:
    """Vectors that one task compares: a part of a cell, or two parts of it."""

    def __init__(self, vectors: np.ndarray, home: np.ndarray, side: np.ndarray, copies: np.ndarray, block: int, space: Subspaces):
        self.units, self.home, self.side, self.copies = units(vectors), home, side, copies
        self.block, self.space = block, space
        self.turn = rotation(vectors.shape[1])
        self.rotated = self.units @ self.turn.T
        self.ranges = space.ranges(vectors.shape[1])
        self.links = np.zeros(len(vectors), np.int64)
        self.label = np.arange(len(vectors))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def _within(self, block: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of ``a`` and ``b`` lie within a block's budget."""
        low, high = self.ranges[block]
        budget = self.space.budget * (high - low) / self.units.shape[1] + SLACK
        x, y = self.rotated[a, low:high], self.rotated[b, low:high]
        apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
        out = apart <= budget
        # Where rounding could decide, the same sum in the same order for both vectors.
        i, j = np.nonzero(np.abs(apart - budget) < 1e-12)
        if len(i):
            difference = self.units[a[i]] - self.units[b[j]]
            turned = (difference[:, None, :] * self.turn[None, low:high, :]).sum(axis=2)
            out[i, j] = (turned * turned).sum(axis=1) <= budget
        return out

    def compare(self, a: np.ndarray, b: np.ndarray, ordered: bool) -> None:
        """Links between ``a`` and ``b``; of pairs inside one set only those with a < b if ``ordered``."""
        low, high = self.ranges[self.block]
        budget = self.space.budget * (high - low) / self.units.shape[1] + COARSE_SLACK
        part = self.rotated[:, low:high].astype(np.float32)
        half = (part * part).sum(axis=1) / 2
        right = np.column_stack([part[b], -half[b], np.ones(len(b), np.float32)]).T
        for first in range(0, len(a), ROWS):
            rows = a[first : first + ROWS]
            left = np.column_stack([part[rows], np.ones(len(rows), np.float32), -half[rows]])
            hits = left @ right >= np.float32(-budget / 2)
            if ordered:
                hits &= (rows[:, None] < b[None, :]) | ~self.home[b][None, :]
            i, j = np.flatnonzero(hits.any(axis=1)), np.flatnonzero(hits.any(axis=0))
            if len(i):
                self._verify(rows[i], b[j], hits[np.ix_(i, j)])

    def _verify(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        cosine = self.units[a] @ self.units[b].T
        linked = linked & (cosine >= self.space.cosine - SLACK)
        i, j = np.nonzero(linked & (np.abs(cosine - self.space.cosine) <= SLACK))
        if len(i):
            linked[i, j] = (self.units[a[i]] * self.units[b[j]]).sum(axis=1) >= self.space.cosine
        if linked.any():
            linked &= self._within(self.block, a, b)
            for earlier in range(self.block):
                linked &= ~self._within(earlier, a, b)
        i, j = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if not len(i):
            return
        a, b, linked = a[i], b[j], linked[np.ix_(i, j)]
        self.links[a] += linked @ self.copies[b]
        self.links[b] += linked.T @ self.copies[a]
        most = len(self.label)
        before = None
        while before is None or (before != (self.label[a].sum(), self.label[b].sum())):
            before = (self.label[a].sum(), self.label[b].sum())
            self.label[a] = np.minimum(self.label[a], np.where(linked, self.label[b][None, :], most).min(axis=1))
            self.label[b] = np.minimum(self.label[b], np.where(linked, self.label[a][:, None], most).min(axis=0))
        self.edges += [(a, self.label[a].copy()), (b, self.label[b].copy())]

    def run(self) -> list[tuple[int, int, int]]:
        """(place, least place that it is connected to, links) of each linked vector."""
        at = np.arange(len(self.label))
        if (self.side == self.side[0]).all():
            self.compare(at[self.home], at, True)
        else:
            one = self.side == 0
            self.compare(at[one & self.home], at[~one], False)
            self.compare(at[~one & self.home], at[one & ~self.home], False)
        if not self.edges:
            return []
        a, b = (np.concatenate(e) for e in zip(*self.edges, strict=True))
        least = np.arange(len(self.label))
        while True:
            lower = least.copy()
            np.minimum.at(lower, a, least[b])
            np.minimum.at(lower, b, least[a])
            lower = lower[lower]
            if (lower == least).all():
                break
            least = lower
        return [(k, int(least[k]), int(self.links[k])) for k in np.flatnonzero(self.links)]


def _linked(rows: DataFrame, space: Subspaces, bits: int) -> DataFrame:
    """``(key, least, links)`` from rows sorted by cell and pair of parts."""

    def of_group(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(group).combine_chunks()
        if len(table) < 2:
            return
        place = table["place"].to_numpy()
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        side = (table["side"].to_numpy() != i).astype(int) if i != j else np.zeros(len(table), int)
        if i != j and side.min() == side.max():
            return
        vectors = _matrix(table["vector"].combine_chunks())
        found = Group(vectors, place % 2 == 1, side, table["copies"].to_numpy(), int(place[0]) >> (bits + 1), space).run()
        if found:
            at, least, links = (np.array(c) for c in zip(*found, strict=True))
            keys = table["key"].combine_chunks()
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(at)), keys.take(pa.array(least)), pa.array(links)], names=["key", "least", "links"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.column_stack([batch.column("place").to_numpy() >> 1, batch.column("i").to_numpy(), batch.column("j").to_numpy()])
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                if at is not None and (marks[first] != at).any():
                    yield from of_group(group)
                    group = []
                at = marks[first]
                group.append(batch.slice(first, last - first))
        if group:
            yield from of_group(group)

    return in_batches(rows, work, "key binary, least binary, links long")


def linked(vectors: DataFrame, space: Subspaces = Subspaces()) -> DataFrame:
    """``(key, least, links)`` of distinct vectors ``(key, copies, vector)``; a key may come from several tasks.

    Vectors of unlike sizes are never linked; each size is joined by itself.
    """
    out = None
    for size, number in sorted((r["size"], r["n"]) for r in vectors.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()):
        sample = vectors.where(F.size("vector") == size).select("vector").limit(SAMPLE).collect()
        middle = units(np.array([r["vector"] for r in sample])).mean(axis=0)
        bits = space.bits(number, size)
        rows = stored(_placed(vectors, size, middle, space, bits), "places")
        cell = F.shiftright("place", 1)
        # At most blocks * 2^most_bits rows, so they are broadcast.
        sizes = rows.groupBy(cell.alias("cell")).agg(F.ceil(F.count("*") / space.part).cast("int").alias("parts"))
        dealt = rows.join(F.broadcast(sizes), cell == F.col("cell"))
        dealt = dealt.withColumn("side", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = dealt.select("key", "copies", "vector", "place", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
        ordered = dealt.repartition(F.shiftright("place", 1), "i", "j").sortWithinPartitions(F.shiftright("place", 1), "i", "j")
        found = _linked(ordered, space, bits)
        out = found if out is None else out.unionByName(found)
    return vectors.sparkSession.createDataFrame([], "key binary, least binary, links long") if out is None else out


def near_duplicates(rows: DataFrame, space: Subspaces = Subspaces(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per row: ``vec_id, n_links, component_id, kept``.

    Vectors that are null, empty or zero or hold null or non-finite components link
    with nothing. Repeated rows are different vectors that link with each other; equal
    ids with unlike vectors stay apart. ``component_id`` is the least id that links
    reach, null ids last; ``kept`` marks the rows that bear it. Other columns are
    ignored; an empty table gives no rows.
    """
    named = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))
    key = F.when(usable(F.col("vector")), vector_key(F.col("vector")))
    keyed = named.select("vec_id", key.alias("key"), "vector")
    distinct = keyed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    distinct = stored(distinct, "vectors")
    found = stored(linked(distinct.select("key", "copies", "vector"), space), "links")
    number = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = stored(components(found.select(F.col("key").alias("a"), F.col("least").alias("b"))), "roots")
    ids = roots.join(distinct.select("key", "id"), roots["node"] == distinct["key"]).select("node", "root", "id")
    # Stored, so that a class with very many vectors can be split in the join.
    least = stored(ids.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    classes = roots.join(least, "root").select(F.col("node").alias("key"), "component_id")
    whole = distinct.select("key", "id", "copies").join(classes, "key", "left").join(number, "key", "left")
    whole = stored(
        whole.select(
            F.col("key").alias("k"),
            F.coalesce("component_id", "id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        ),
        "classes",
    )
    joined = keyed.select("vec_id", "key").join(whole, F.col("key") == F.col("k"), "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op11_embedding_dedup``: links and class of every vector."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


SQL = """
with recursive v as (
    select vec_id, embedding::double[] as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
l as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.95
),
r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
n as (select a, count(*) as n_links from l group by a),
c as (select a, least(a, min(b)) as component_id from r group by a)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, vec_id)::bigint as component_id,
    vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join n on vec_id = n.a left join c on vec_id = c.a
"""
