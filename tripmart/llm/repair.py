"""Conversation structure repair by a parallel Viterbi search with rank convergence.

A conversation should read ``(s?(ua)+)?``: an optional system message, then users and
assistants in turn. Four states accept that; edits of the messages have costs, and the
cheapest edits are a shortest path over (message, state). The search runs backwards:
a cost vector holds, for each state, the cheapest way to the end.

Messages are ordered over the cluster by range, so a long conversation lies in many
partitions, and is cut into chunks of bounded size. All chunks run at once from a
speculative vector, the one of the conversation's end. A chunk's true vector is the
one at the start of the chunk behind it; fix-up passes rerun the chunks whose vector
differs from the one they used by more than a constant, until none does. After few
messages the vectors hardly depend on where they started, so few passes do.

Tracing goes forward: of the edits that keep to a cheapest path, each step takes the one
with the least letter. A chunk is traced from each of the states that it may be entered
in; a stream over a conversation's chunks picks the true ones. Vectors, kinds of messages
and states are few, so steps are looked up in tables that fill as they are met.

Only the digest of a repaired conversation is one stream over its messages, in bounded
memory: that is what a digest of the whole text asks for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tripmart.llm.mixing import stored
from tripmart.llm.text import in_batches

#: Messages of a chunk, as a power of two.
CHUNK_BITS = 12
_PASSES = 10_000

SPACE = r"[\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: States: nothing yet, after a system message, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after each state's only speaker, and that speaker.
TALK = (USER, USER, ASSISTANT, USER)
SPEAKER = ("user", "user", "assistant", "user")
#: The state after keeping a message by the place of its role's initial in ``INITIALS``, or None.
INITIALS = "sua"
KEPT = ((SYSTEM, None, None, None), (USER, USER, None, USER), (None, None, ASSISTANT, None), (None,) * 4)
#: Cheapest way to the end after the last message, by state.
END = (0, 2 * INSERT_COST, INSERT_COST, 0)
#: Kinds of messages: initial + 4 if truncated, or this one, which has to go.
MUST_GO = 8


def as_long(vector: tuple[int, ...]) -> int:
    return sum(v << (8 * i) for i, v in enumerate(vector))


def as_vector(value: int) -> tuple[int, ...]:
    return tuple((value >> (8 * i)) & 255 for i in range(4))


class Search:
    """Steps of the search by vector, kind and state, worked out once each.

    Vectors are numbers of ``as_long`` less their least entry, so two that differ by
    a constant are one number.
    """

    def __init__(self):
        self.before: dict[tuple[int, int], int] = {}
        self.moves: dict[tuple[int, int, int], tuple[str, int, int]] = {}

    @staticmethod
    def _options(after: tuple[int, ...], kind: int, state: int) -> list[tuple[int, str, int]]:
        """(cost to the end, letter, next state) of the edits that use the message up."""
        options = [(DELETE_COST + after[state], DELETE, state)]
        if kind != MUST_GO:
            extra, kept = TRUNCATED_COST * (kind >= 4), KEPT[kind & 3][state]
            if kept is not None:
                options.append((extra + after[kept], KEEP, kept))
            options.append((REROLE_COST + extra + after[TALK[state]], REROLE, TALK[state]))
        return options

    def _vector(self, after: tuple[int, ...], kind: int) -> list[int]:
        """Costs in front of a message from those behind it, inserts included."""
        least = [min(self._options(after, kind, state))[0] for state in range(4)]
        # An insert leads to user or assistant, from where one more leads to the other.
        user, assistant = least[USER], least[ASSISTANT]
        least[USER] = min(user, INSERT_COST + assistant)
        least[ASSISTANT] = min(assistant, INSERT_COST + user)
        for state in (START, SYSTEM):
            least[state] = min(least[state], INSERT_COST + least[USER])
        return least

    def back(self, vector: int, kind: int) -> int:
        """The vector in front of a message."""
        found = self.before.get((vector, kind))
        if found is None:
            least = self._vector(as_vector(vector), kind)
            found = self.before[(vector, kind)] = as_long(tuple(v - min(least) for v in least))
        return found

    def move(self, vector: int, kind: int, state: int) -> tuple[str, int, int]:
        """Letters up to and with the message's edit, their cost and the next state."""
        found = self.moves.get((vector, kind, state))
        if found is None:
            after, letters, cost, at = as_vector(vector), "", 0, state
            least = self._vector(after, kind)
            while True:
                options = [o for o in self._options(after, kind, at) if o[0] == least[at]]
                if INSERT_COST + least[TALK[at]] == least[at]:
                    options.append((least[at], INSERT, TALK[at]))
                total, letter, following = min(options, key=lambda o: o[1])
                letters += letter
                if letter == INSERT:
                    cost, at = cost + INSERT_COST, following
                    continue
                cost += total - after[following]
                found = self.moves[(vector, kind, state)] = (letters, cost, following)
                break
        return found

    def vectors(self, vector: int, kinds: list[int]) -> list[int]:
        """The vector behind each message, and in front of the first one, backwards."""
        out = [vector]
        for kind in reversed(kinds):
            vector = self.back(vector, kind)
            out.append(vector)
        return out


def _segments(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[list]]:
    """Runs of rows with equal first two columns, as a list for each column."""
    at, held = None, None
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True)
        for row in rows:
            if row[:2] != at:
                if held is not None:
                    yield held
                at, held = row[:2], [[] for _ in range(columns)]
            for values, value in zip(held, row, strict=True):
                values.append(value)
    if held is not None:
        yield held


def _by_segment(rows: DataFrame, work: Callable[[list[list]], list[tuple]], schema: str) -> DataFrame:
    """``work`` over the chunks of conversations, each sorted by position, as a stream.

    ``rows`` begin with ``conv`` and ``chunk`` and hold ``pos``.
    """
    ordered = rows.repartition("chunk").sortWithinPartitions("chunk", "conv", "pos")
    names, n = [field.split(" ")[0] for field in schema.split(", ")], len(rows.columns)
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    types = [kinds[field.split(" ")[1]] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for segment in _segments(batches, n):
            out.extend(work(segment))
            if len(out) >= 10_000:
                yield flushed()
                out.clear()
        if out:
            yield flushed()

    return in_batches(ordered, run, schema)


def placed(messages: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Messages in their order over all tasks, stored: ``conv, pos, chunk`` and their faults' parts.

    ``conv`` is the conversation's id as text, so that null is one of the ids. Order
    is by turn, nulls first, then role and digest of the text; the row's number breaks
    ties, so that equal messages can be dealt out too.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    conv = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    rows = messages.select(conv.alias("conv"), "turn", role.alias("role"), text.alias("text"), F.unhex(F.md5(text)).alias("hash"), F.monotonically_increasing_id().alias("tie"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "hash", "tie")]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return stored(spread.withColumn("pos", F.monotonically_increasing_id()).withColumn("chunk", F.shiftright("pos", chunk_bits)), "messages")


def marked(messages: DataFrame) -> DataFrame:
    """Of placed messages, stored without texts: ``conv, chunk, pos, kind, fault``.

    ``fault`` is the first of blank, duplicate and truncated, or null. Only the first
    places of repeated messages are joined, so a message repeated without end is
    counted before its shuffle.
    """
    rows = messages.select(
        "conv", "chunk", "pos", "role", "hash",
        F.least(F.instr(F.lit(INITIALS), F.substring("role", 1, 1)), F.length("role") * 4).alias("initial"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?]{SPACE}*+\z")).alias("open"),
    )
    firsts = rows.groupBy("conv", "role", "hash").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(stored(firsts, "first-places"), ["conv", "role", "hash"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("open"), "truncated")
    initial = F.when(F.col("initial") == 0, 3).otherwise(F.col("initial") - 1)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).otherwise(initial + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    return stored(joined.withColumn("fault", fault).select("conv", "chunk", "pos", kind.cast("int").alias("kind"), "fault"), "marked")


def _started(rows: DataFrame) -> DataFrame:
    """``(conv, chunk, used, start)``: the vector in front of each chunk from ``used`` behind it."""

    def work(segment: list[list]) -> list[tuple]:
        conv, chunk, _, kinds, used = segment
        return [(conv[0], chunk[0], used[0], search.vectors(used[0], kinds)[-1])]

    search = Search()
    return _by_segment(rows.select("conv", "chunk", "pos", "kind", "used"), work, "conv string, chunk long, used long, start long")


def converged(marks: DataFrame) -> tuple[DataFrame, int]:
    """``(conv, chunk, used)`` with the true vector behind each chunk, and the passes that it took.

    A pass runs only the chunks whose vector behind is not the one they used. One
    number a pass reaches the driver.
    """
    end = F.lit(as_long(END)).cast("long")
    found = stored(_started(marks.withColumn("used", end)), "vectors")
    for passes in range(1, _PASSES):
        behind = F.lead("start").over(_in_order())
        checked = stored(found.withColumn("needed", F.coalesce(behind, end)), "vectors")
        wrong = checked.where("used <> needed")
        if not wrong.count():
            return checked.select("conv", "chunk", "used"), passes
        again = marks.join(wrong.select("conv", "chunk", F.col("needed").alias("used")), ["conv", "chunk"])
        found = stored(checked.where("used = needed").drop("needed").unionByName(_started(again)), "vectors")
    raise RuntimeError("the vectors did not settle")


def _in_order() -> WindowSpec:
    return Window.partitionBy("conv").orderBy("chunk")


def _trace(search: Search, kinds: list[int], used: int, state: int, last: bool) -> Iterator[tuple[str, int, int]]:
    """(letters, cost, state in front) of each message's edits; the last one's hold what closes."""
    vectors = search.vectors(used, kinds)
    for i, kind in enumerate(kinds):
        letters, cost, after = search.move(vectors[len(kinds) - 1 - i], kind, state)
        while last and i == len(kinds) - 1 and after in (SYSTEM, USER):
            letters, cost, after = letters + INSERT, cost + INSERT_COST, TALK[after]
        yield letters, cost, state
        state = after


def _entered(marks: DataFrame, chunks: DataFrame) -> DataFrame:
    """``(conv, chunk, used, entry, last)``: the state that each chunk is entered in."""
    sizes = chunks.withColumn("last", F.lead("chunk").over(_in_order()).isNull()).withColumn("first", F.lag("chunk").over(_in_order()).isNull())
    sizes = stored(sizes, "chunks")
    several = sizes.where(~(F.col("first") & F.col("last")))

    def work(segment: list[list]) -> list[tuple]:
        conv, chunk, _, kinds, used = segment
        vectors, exits = search.vectors(used[0], kinds), []
        for state in range(4):
            for i, kind in enumerate(kinds):
                state = search.move(vectors[len(kinds) - 1 - i], kind, state)[2]
            exits.append(str(state))
        return [(conv[0], chunk[0], "".join(exits))]

    search = Search()
    rows = marks.join(several.select("conv", "chunk", "used"), ["conv", "chunk"]).select("conv", "chunk", "pos", "kind", "used")
    exits = _by_segment(rows, work, "conv string, chunk long, exits string")

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, START
        for batch in batches:
            entries = []
            for conv, found in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if conv != at:
                    at, state = conv, START
                entries.append(state)
                state = int(found[state])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entries, pa.int32())], names=["conv", "chunk", "entry"])

    ordered = exits.repartition("conv").sortWithinPartitions("conv", "chunk")
    entries = in_batches(ordered, follow, "conv string, chunk long, entry int")
    joined = sizes.join(entries, ["conv", "chunk"], "left")
    return joined.select("conv", "chunk", "used", F.coalesce("entry", F.lit(START)).alias("entry"), F.col("last").cast("int").alias("last"))


def edits(marks: DataFrame) -> DataFrame:
    """``(conv, pos, letters, cost, state)``: the cheapest edits at each message.

    ``letters`` are inserts before the message and its own edit, and behind the last
    message the inserts that close the conversation; ``state`` is the one in front.
    """
    chunks = _entered(marks, converged(marks)[0])
    rows = marks.join(chunks, ["conv", "chunk"]).select("conv", "chunk", "pos", "kind", "used", "entry", "last")

    def work(segment: list[list]) -> list[tuple]:
        conv, _, places, kinds, used, entry, last = segment
        traced = _trace(search, kinds, used[0], entry[0], bool(last[0]))
        return [(conv[0], pos, *step) for pos, step in zip(places, traced, strict=True)]

    search = Search()
    return _by_segment(rows, work, "conv string, pos long, letters string, cost int, state int")


def _lines(letters: str, state: int, role: str, text: str) -> Iterator[tuple[str, str]]:
    """The repaired messages that stand for one message."""
    for letter in letters:
        if letter == INSERT:
            yield SPEAKER[state], ""
            state = TALK[state]
        elif letter == KEEP:
            state = KEPT[INITIALS.find(role[:1]) if role else 3][state]
            yield role, text
        elif letter == REROLE:
            yield SPEAKER[state], text
            state = TALK[state]


def _merged(messages: DataFrame, found: DataFrame) -> DataFrame:
    """Messages and their edits, a conversation's one after the other in one partition."""
    said = messages.select("conv", "pos", F.lit(0).alias("kind"), "role", "text", F.lit(None).cast("string").alias("letters"), F.lit(None).cast("int").alias("cost"), F.lit(None).cast("int").alias("state"))
    done = found.select("conv", "pos", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "letters", "cost", "state")
    return said.unionByName(done).repartition("conv").sortWithinPartitions("conv", "pos", "kind")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Of each batch: (conv, role, text, letters, cost, state) of messages met with their edits."""
    role = text = None
    for batch in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[2] == 0:
                role, text = row[3], row[4]
            else:
                out.append((row[0], role, text, *row[5:]))
        yield out


def repaired(messages: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """The repaired conversations: ``conv_id`` as text, ``place`` from 0, ``role``, ``text``."""
    rows = placed(messages, chunk_bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = None, 0
        for steps in _steps(batches):
            out = []
            for conv, role, text, letters, _, state in steps:
                if conv != at:
                    at, place = conv, 0
                for line in _lines(letters, state, role, text):
                    out.append((conv, place, *line))
                    place += 1
            if out:
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["conv", "place", "role", "text"])

    lines = in_batches(_merged(rows, edits(marked(rows))), work, "conv string, place long, role string, text string")
    return lines.select(F.when(F.col("conv") != "n", F.substring("conv", 2, 1 << 30)).alias("conv_id"), "place", "role", "text")


def _digests(rows: DataFrame) -> DataFrame:
    """``(conv, cost, audit, repaired_sha256, illegal)`` from merged messages and edits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for steps in _steps(batches):
            done = []
            for conv, role, text, letters, cost, state in steps:
                if conv != at:
                    if at is not None:
                        done.append((at, total, "".join(audit), digest.hexdigest(), illegal))
                    at, total, audit, digest, empty, illegal, before = conv, 0, [], hashlib.sha256(), True, 0, None
                initial = role[:1]
                illegal += before is not None and before + initial not in ("su", "ua", "au")
                before = initial
                total += cost
                audit.append(letters)
                for line_role, line_text in _lines(letters, state, role, text):
                    digest.update(f"{'' if empty else chr(10)}{line_role}:{line_text}".encode())
                    empty = False
            if done:
                yield _digest_batch(done)
        if at is not None:
            yield _digest_batch([(at, total, "".join(audit), digest.hexdigest(), illegal)])

    return in_batches(rows, work, "conv string, cost long, audit string, repaired_sha256 string, illegal long")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["conv", "cost", "audit", "repaired_sha256", "illegal"])


def report(messages: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """A row per conversation that has a message: its faults, cheapest edits and repaired digest.

    Null roles and texts count as one space, a null id as an id of its own. Messages
    of one turn are ordered by role and digest; equal ones repeat one another. Other
    columns are ignored. ``conv`` is the id as text behind a ``v``, or ``n`` for null.
    """
    rows = placed(messages, chunk_bits)
    marks = marked(rows)
    turns = rows.select("conv", "turn").distinct().groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns"))
    gaps = turns.select("conv", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"))
    faults = marks.groupBy("conv").agg(*(F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")))
    digests = _digests(_merged(rows, edits(marks)))
    return digests.join(gaps, "conv").join(faults, "conv")


def damaged(messages: DataFrame) -> DataFrame:
    """Messages with the faults that the query plants, by the hash of their id and turn."""

    def text_of(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(" "))

    rows = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.pmod(F.crc32(F.concat(text_of(F.col("conv_id")), F.lit(":"), text_of(F.col("turn")))), F.lit(20)).alias("_way"),
    ).where("_way <> 0")
    text = F.when(F.col("_way") == 1, "").when(F.col("_way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_way") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op13_conversation_repair``: faults, cheapest edits and digest of every damaged conversation."""
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = report(damaged(messages))
    conv = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    ids = messages.select("conv_id", conv.alias("conv")).distinct()
    joined = ids.join(found, "conv", "left")
    numbers = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
