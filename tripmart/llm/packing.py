"""Packing documents into training sequences by vector bin packing.

A piece of a document needs tokens, one segment and loss-bearing tokens; a sequence
has a limit on each. Whole sequences are cut from long documents first. What is
left waits in a pool of bounded size; an open sequence takes the waiting piece whose
needs have the greatest dot product with the room it still has, both as shares of
the limits. When none fits, the piece with the greatest product is cut to fill the
room. A sequence that a limit closes early is cut back to a power of two, and what
is cut off goes back to the pool. So no sequence needs padding.

Work is one narrow pass: each partition of the input packs its own documents, holds
one pool, and numbers its sequences in a range of its own. Sequences do not cross
partitions; the last ones of each are cut into powers of two.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.text import SPACES, Block, Hasher, blocks, in_batches, runs

END_ID = 1
TOKENS = 2048
SEGMENTS = 64
#: Waiting pieces of a partition; more are packed before more are read.
POOL = 512
#: Units whose ids a worker remembers, besides those of the texts at hand.
UNITS = 1_000_000
#: Bytes of text whose units are found at once; smaller blocks stay in the processor's cache.
UNIT_BYTES = 1 << 20
#: Room for the sequence numbers of one partition.
PER_PARTITION = 1 << 40
OUT_ROWS = 20_000


class Limits(NamedTuple):
    """Of one sequence. The ids of a prompt bear no loss, nor does a document's first
    id: nothing predicts it."""

    tokens: int = TOKENS
    segments: int = SEGMENTS
    loss: int = TOKENS


class Piece(NamedTuple):
    key: object
    total: int  # ids of the whole document
    start: int
    ids: np.ndarray
    free: int = 1  # leading ids of the document that bear no loss

    @property
    def still_free(self) -> int:
        """Leading ids of this piece that bear no loss."""
        return min(len(self.ids), max(0, self.free - self.start))

    @property
    def loss(self) -> int:
        return len(self.ids) - self.still_free

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


class Packer:
    """Packs pieces as they come; ``emit`` gets the pieces of each closed sequence."""

    def __init__(self, limits: Limits, pool: int, emit: Callable[[list[Piece]], None]):
        if min(limits) < 1:
            raise ValueError("limits are positive")
        self.limits, self.most, self.emit = limits, pool, emit
        self.waiting: list[Piece] = []
        #: Needs of the waiting pieces, as shares of the limits.
        self.needs = np.zeros((2 * pool + 2 * limits.segments + 4, 3))

    def _share(self, piece: Piece) -> tuple[float, float, float]:
        return len(piece.ids) / self.limits.tokens, 1 / self.limits.segments, piece.loss / self.limits.loss

    def _wait(self, piece: Piece) -> None:
        if len(self.waiting) == len(self.needs):
            self.needs = np.concatenate([self.needs, np.zeros_like(self.needs)])
        self.needs[len(self.waiting)] = self._share(piece)
        self.waiting.append(piece)

    def _take(self, at: int) -> Piece:
        piece, last = self.waiting[at], self.waiting.pop()
        if at < len(self.waiting):
            self.waiting[at] = last
            self.needs[at] = self.needs[len(self.waiting)]
        return piece

    def _most(self, piece: Piece, tokens: int, loss: int) -> int:
        """Ids of a piece that fit into so much room."""
        return min(len(piece.ids), tokens, loss + piece.still_free)

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.limits.tokens:
            full = self._most(piece, self.limits.tokens, self.limits.loss)
            head, piece = piece.cut(1 << (full.bit_length() - 1) if full < self.limits.tokens else full)
            self.emit([head])
        if len(piece.ids):
            self._wait(piece)
        while len(self.waiting) >= self.most:
            self._sequence()

    def finish(self) -> None:
        while self.waiting:
            self._sequence()

    def _sequence(self) -> None:
        """Packs one sequence from the pool and closes it."""
        limits = self.limits
        tokens, segments, loss = limits
        held: list[Piece] = []
        while tokens and segments and self.waiting:
            needs = self.needs[: len(self.waiting)]
            room = np.array([tokens / limits.tokens, segments / limits.segments, loss / limits.loss])
            product = needs @ room
            fits = (needs <= room + 1e-12).all(axis=1)
            if fits.any():
                piece = self._take(int(np.where(fits, product, -1.0).argmax()))
            else:
                at = int(product.argmax())
                most = self._most(self.waiting[at], tokens, loss)
                if most < 1:
                    break
                piece, rest = self._take(at).cut(most)
                self._wait(rest)
            held.append(piece)
            tokens, segments, loss = tokens - len(piece.ids), segments - 1, loss - piece.loss
        size = limits.tokens - tokens
        if tokens and size & (size - 1):
            extra = size - (1 << (size.bit_length() - 1))
            while extra:
                piece = held.pop()
                if len(piece.ids) > extra:
                    piece, rest = piece.cut(len(piece.ids) - extra)
                    held.append(piece)
                    extra = 0
                else:
                    rest, extra = piece, extra - len(piece.ids)
                self._wait(rest)
        self.emit(held)


_SPACE, _LETTER, _DIGIT, _MARK, _ODD = range(5)


def _kinds() -> np.ndarray:
    """Kinds of bytes. Apostrophes join words and ``<`` may begin a special token;
    bytes beyond ASCII are odd unless they are letters that ``_latin`` knows."""
    out = np.full(256, _MARK, np.uint8)
    for byte in range(128):
        if chr(byte).isalpha():
            out[byte] = _LETTER
        elif chr(byte).isdigit():
            out[byte] = _DIGIT
    out[SPACES] = _SPACE
    out[[ord("'"), ord("<")]] = _ODD
    out[128:] = _ODD
    return out


_KIND = _kinds()


def _latin(data: np.ndarray) -> np.ndarray:
    """Marks both bytes of the letters U+00C0 to U+00FF."""
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    out = np.zeros(len(data), bool)
    out[lead] = out[lead + 1] = True
    return out


def units(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, lower-cased where that is safe, and start, end and text of the units.

    The tokenizer cuts at white space, around digits and between letters and other
    marks, and its normaliser works on single characters of Latin letters; so ids
    of a text are those of its units. A run between spaces that holds anything
    less plain is one unit, and is left to the tokenizer as it is.
    """
    data = block.data
    kind = _KIND[data]
    latin = _latin(data) if len(data) else np.zeros(0, bool)
    kind[latin] = _LETTER
    starts, ends, owner = runs(block, kind != _SPACE)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind == _ODD, out=sums[1:])
    odd = sums[ends] > sums[starts]
    plain = np.zeros(len(data) + 1, np.int8)
    plain[starts[~odd]] += 1  # no place occurs twice among the starts, nor among the ends
    plain[ends[~odd]] -= 1
    plain = np.cumsum(plain[:-1], dtype=np.int8).astype(bool)
    opens = plain.copy()
    opens[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    opens[starts] = True
    first = np.flatnonzero(opens)
    run = np.searchsorted(starts, first, "right") - 1
    last = np.append(first[1:], 0)[: len(first)]
    new_run = np.append(run[1:] != run[:-1], True)[: len(first)]
    last[new_run] = ends[run[new_run]]
    upper = plain & ((data >= 65) & (data <= 90) | latin & (data >= 0x80) & (data <= 0x9E))
    return data + upper.astype(np.uint8) * np.uint8(32), first, last, owner[run]


class Ids:
    """Token ids of texts; a unit is encoded once, while it is remembered."""

    def __init__(self, path: str, most: int = UNITS):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.hasher = Tokenizer.from_file(path), most, Hasher()
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, hashes: list[int], texts: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        total = int(size.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.slots.update(zip(hashes, range(len(self.size), len(self.size) + len(found)), strict=True))
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += total

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers, with END_ID at the end."""
        for block in blocks(column, UNIT_BYTES):
            data, starts, ends, owner = units(block)
            hashes = self.hasher.ranges(data, starts, ends)
            distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.slots) > self.most:
                self._forget()
            known = distinct.tolist()
            new = [i for i, h in enumerate(known) if h not in self.slots]
            if new:
                raw = data.tobytes()
                at = first[new]
                self._learn([known[i] for i in new], [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            slot = np.fromiter(map(self.slots.__getitem__, known), np.int64, len(known))[place]
            size = self.size[slot]
            until = np.cumsum(size)
            ids = self.ids[np.repeat(self.begin[slot] - until + size, size) + np.arange(int(size.sum()))]
            cuts = np.concatenate([[0], until])[np.searchsorted(owner, np.arange(block.n + 1))]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                out = np.empty(b - a + 1, "<u4")
                out[:-1], out[-1] = ids[a:b], END_ID
                yield out


def remembered(path: str) -> Ids:
    """The worker's own Ids of a vocabulary: a worker runs many tasks, and the
    tokenizer's module is what outlives each of them."""
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if not hasattr(tokenizers, "remembered_ids"):
        tokenizers.remembered_ids = {}
    if path not in tokenizers.remembered_ids:
        tokenizers.remembered_ids[path] = Ids(path)
    return tokenizers.remembered_ids[path]


def pack(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limits: Limits = Limits(), pool: int = POOL, prompt: str | None = None
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens``.

    ``prompt`` names a column of texts that stand before ``text``: their ids come
    first and bear no loss, and the limit on loss counts the ids behind them. Without
    it, all ids of a document but the first bear loss.
    Null text or prompt counts as empty; a document still has its end id. Rows with equal or null ids
    are documents of their own. Every id of every row lies in exactly one piece.
    Empty input gives no rows; other columns are ignored. Sequence numbers are
    unique and depend on how the input is split, not on when a task is run again.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    texts = [documents[f"`{text}`"].alias("text")] + ([] if prompt is None else [documents[f"`{prompt}`"].alias("prompt")])
    rows = documents.select(documents[f"`{key}`"].alias("doc_id"), *texts)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:])

    def work(batches):
        out: list[tuple] = []
        number = [TaskContext.get().partitionId() * PER_PARTITION]

        def emit(pieces: list[Piece]) -> None:
            offset = 0
            for p in pieces:
                out.append((p.key, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.total, number[0], offset, p.loss))
                offset += len(p.ids)
            number[0] += 1

        key_type = None
        packer, ids = Packer(limits, pool, emit), remembered(tokenizer)

        def drained() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * len(names)
            arrays = [pa.array(columns[0], key_type)] + [pa.array(c, pa.int64()) for c in columns[1:]]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def pieces_of(batch: pa.RecordBatch) -> Iterator[Piece]:
            keys = batch.column(0).to_pylist()
            if prompt is None:
                for k, found in zip(keys, ids.of(batch.column(1)), strict=True):
                    yield Piece(k, len(found), 0, found)
                return
            for k, answer, asked in zip(keys, ids.of(batch.column(1)), ids.of(batch.column(2)), strict=True):
                joined = np.concatenate([asked[:-1], answer])  # without the prompt's end id
                yield Piece(k, len(joined), 0, joined, max(1, len(asked) - 1))

        # Millions of small values live on and none refer to one another.
        gc.disable()
        try:
            for batch in batches:
                key_type = batch.column(0).type
                for piece in pieces_of(batch):
                    packer.add(piece)
                    if len(out) >= OUT_ROWS:
                        yield drained()
            packer.finish()
        finally:
            gc.enable()
        if out:
            yield drained()

    return in_batches(rows, work, schema)


def tokenizer_path() -> str:
    """The public vocabulary of the query contract."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op2_packing``: the pieces of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(documents, tokenizer_path())
