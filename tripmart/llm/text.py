"""Texts as byte arrays: words, lines and their hashes for many texts at once.

An Arrow column is cut into blocks of a few megabytes; one text is never cut, so a
block is as large as its longest text at worst. All positions are bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BLOCK_BYTES = 4 << 20
#: Rows that a Python worker gets at once, unless the session says otherwise.
BATCH_ROWS = 1000
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = 10
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)


class Block(NamedTuple):
    """Texts ``first`` to ``first + n - 1`` of a column."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def in_batches(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches whose memory stays bounded."""
    conf = rows.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return rows.mapInArrow(function, schema)


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a text column; null counts as an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


class Hasher:
    """Polynomial hashes of byte ranges; keeps its tables between blocks."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.powers):
            self.powers, self.inverse = _powers(_BASE, len(data)), _powers(_INVERSE, len(data))
        # In place: these arrays are eight times as large as the texts.
        sums = np.zeros(len(data) + 1, np.uint64)
        sums[1:] = data
        sums[1:] += np.uint64(1)
        sums[1:] *= self.powers[: len(data)]
        np.cumsum(sums[1:], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverse[starts])


def runs(block: Block, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the runs of marked bytes; texts end runs."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = block.offsets[:-1]
    edges = edges[edges < len(inside)]
    opens[edges] |= inside[edges]
    edges = block.offsets[1:]
    edges = edges[edges > 0] - 1
    closes[edges] |= inside[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(block.offsets, starts, "right") - 1


def words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words are maximal runs of anything but space, tab, \\n, \\v, \\f and \\r."""
    return runs(block, ~SPACES[block.data])


def counts(block: Block, marked: np.ndarray) -> np.ndarray:
    """Marked bytes of each text."""
    sums = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=sums[1:])
    return sums[block.offsets[1:]] - sums[block.offsets[:-1]]


def characters(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of each code point."""
    return (data & 0xC0) != 0x80


def lines(block: Block, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and hash of each line that has a non-space byte."""
    breaks = np.flatnonzero(block.data == NEWLINE)
    edges = np.unique(np.concatenate([block.offsets, breaks + 1]))
    starts, ends = edges[:-1], edges[1:]
    ends = ends - (block.data[ends - 1] == NEWLINE) if len(ends) else ends
    solid = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(~SPACES[block.data], out=solid[1:])
    keep = solid[ends] > solid[starts]
    starts, ends = starts[keep], ends[keep]
    owner = np.searchsorted(block.offsets, starts, "right") - 1
    return starts, ends, owner, hasher.ranges(block.data, starts, ends)


def repeats(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Of each text, the values that equal an earlier value of the same text."""
    pairs = mixed(hashes + mixed(owner.astype(np.uint64)))
    _, first = np.unique(pairs, return_index=True)
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)
