"""Repetition inside a text by its suffix array.

The suffixes of a text's words are sorted by prefix doubling; neighbours in that
order give the longest common prefixes, whose intervals are the maximal repeated
substrings. The union of their places, as a share of the words, and the longest of
them decide. Only suffixes whose first ``WINDOW`` words occur twice can begin a
repeat that counts, so only those are sorted: clean texts cost one pass. Many texts
are handled at once, with a text's number as the first sort key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.text import SPACES, Block, Hasher, blocks, characters, counts, in_batches, lines, mixed, repeats, words

#: Words of the shortest repeat that counts.
WINDOW = 8
#: Fixed limits of the query contract.
LEAST_WORDS = 20
MOST_BASE_PERCENT = 30
#: The method's own limits.
MOST_SHARE = 0.25
MOST_LONGEST = 100
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _dense(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of rows by the columns, first column first; and the sorted order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        values = column[order]
        new[1:] |= values[1:] != values[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, order


def longest_repeats(owner: np.ndarray, hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Words that begin a repeat of ``window`` words or more, and the longest such repeat.

    ``owner`` is the ascending text number of each word and ``hashes`` tells words
    apart. Repeats stay inside one text and may overlap themselves.
    """
    n = len(owner)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < window + 1:
        return none
    keys, length = hashes, 1
    wide = mixed(owner.astype(np.uint64) + np.uint64(1))
    keys = mixed(keys + wide)
    while length < window:
        step = min(length, window - length)
        keys = mixed(keys[: n - length - step + 1] * np.uint64(3) + mixed(keys[step : n - length + 1]))
        length += step
    full = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    own = keys[full]
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begins = full[twice]
    if not len(begins):
        return none

    # Places that order the suffixes: those above and what follows their window.
    after = begins + window
    after = after[(after < n)]
    places = np.unique(np.concatenate([begins, after]))
    where = np.full(n + 1, -1, np.int64)
    where[places] = np.arange(len(places))
    touched = np.unique((places[:, None] + np.arange(window)[None, :]).ravel())
    touched = touched[touched < n]
    _, ids = np.unique(hashes[touched], return_inverse=True)
    word = np.full(n + window, -1, np.int64)
    word[touched] = ids
    text = np.full(n + window, -1, np.int64)
    text[:n] = owner
    columns = [text[places]]
    for j in range(window):
        columns.append(np.where(text[places + j] == text[places], word[places + j], -1))
    ranks, _ = _dense(columns)
    levels, size = [ranks], window
    while True:
        ties = np.bincount(ranks)[ranks] > 1
        if not ties.any():
            break
        follow = places + size
        inside = ties & (follow < n)
        inside[inside] = owner[follow[inside]] == owner[places[inside]]
        second = np.full(len(places), -1, np.int64)
        second[inside] = ranks[where[follow[inside]]]
        ranks, _ = _dense([ranks, second])
        levels.append(ranks)
        size *= 2
    # Common prefixes of neighbours in suffix order, by levels from the longest.
    is_begin = np.zeros(n + 1, bool)
    is_begin[begins] = True
    sorted_places = places[np.argsort(ranks)]
    sorted_places = sorted_places[is_begin[sorted_places]]
    left, right = sorted_places[:-1], sorted_places[1:]
    common = np.zeros(len(left), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        ok = (a < n) & (b < n)
        ok[ok] = is_begin[a[ok]] & is_begin[b[ok]]
        ok[ok] = levels[level][where[a[ok]]] == levels[level][where[b[ok]]]
        common += ok * (window << level)
    going = common > 0
    for _ in range(window - 1):
        a, b = left + common, right + common
        going &= (a < n) & (b < n)
        ok = going.copy()
        ok[ok] = (owner[a[ok]] == owner[left[ok]]) & (owner[b[ok]] == owner[right[ok]]) & (hashes[a[ok]] == hashes[b[ok]])
        going = ok
        common += going
    best = np.zeros(len(sorted_places), np.int64)
    best[:-1] = common
    best[1:] = np.maximum(best[1:], common)
    return sorted_places, best


def block_measures(block: Block, hasher: Hasher) -> dict[str, np.ndarray]:
    """The measures of each text of a block."""
    data = block.data
    starts, ends, owner = words(block)
    hashes = hasher.ranges(data, starts, ends)
    n_words = np.bincount(owner, minlength=block.n)
    _, _, line_owner, line_hashes = lines(block, hasher)
    places, longest = longest_repeats(owner, hashes)
    edges = np.zeros(len(owner) + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + longest, -1)
    covered = np.cumsum(edges[:-1]) > 0
    top = np.zeros(block.n, np.int64)
    np.maximum.at(top, owner[places], longest)
    return {
        "n_words": n_words,
        "word_chars": counts(block, characters(data) & ~SPACES[data]),
        "n_symbols": counts(block, SYMBOLS[data]),
        "n_dup_lines": repeats(line_owner, line_hashes, block.n),
        "n_repeat_words": np.bincount(owner, covered, block.n).astype(np.int64),
        "longest_repeat": top,
    }


def verdicts(found: dict[str, np.ndarray], most_share: float, most_longest: int) -> dict[str, np.ndarray]:
    n, repeated = found["n_words"], found["n_repeat_words"]
    failed = (n < LEAST_WORDS) | (100 * repeated > MOST_BASE_PERCENT * n)
    kept = ~failed & (repeated <= most_share * n) & (found["longest_repeat"] <= most_longest)
    return {"base_failed": failed, "kept": kept}


def judge(documents: DataFrame, text: str = "text", most_share: float = MOST_SHARE, most_longest: int = MOST_LONGEST) -> DataFrame:
    """``documents`` without the text, with its measures, ``base_failed`` and ``kept``.

    ``n_repeat_words`` is the size of the union of all repeats, ``longest_repeat``
    the words of the longest. Null and empty texts have no words and fail. Rows are
    neither dropped nor merged; columns with a result's name are replaced. One
    narrow pass; a worker holds a few megabytes of text, or one text if longer.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat", "base_failed", "kept"]
    kept = [c for c in documents.columns if c != text and c.lower() not in names]
    rows = documents.select(*(documents[f"`{c}`"] for c in kept), documents[f"`{text}`"])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    schema = ", ".join(fields + [f"{c} long" for c in names[:6]] + [f"{c} boolean" for c in names[6:]])

    def work(batches):
        hasher = Hasher()
        for batch in batches:
            parts = [block_measures(b, hasher) for b in blocks(batch.column(len(kept)))]
            if not parts:
                continue
            found = {c: np.concatenate([p[c] for p in parts]) for c in names[:6]}
            found |= verdicts(found, most_share, most_longest)
            arrays = [batch.column(i) for i in range(len(kept))] + [pa.array(found[c]) for c in names]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    return in_batches(rows, work, schema)


def spans(text: str | None, window: int = WINDOW) -> list[tuple[int, int]]:
    """The union of all repeats of one text as word ranges, end exclusive."""
    out: list[tuple[int, int]] = []
    for block in blocks(pa.array([text], pa.string())):
        starts, ends, owner = words(block)
        places, longest = longest_repeats(owner, Hasher().ranges(block.data, starts, ends), window)
        for begin, size in sorted(zip(places.tolist(), longest.tolist(), strict=True)):
            if out and begin <= out[-1][1]:
                out[-1] = (out[-1][0], max(out[-1][1], begin + size))
            else:
                out.append((begin, begin + size))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op6_quality_rules``: the measures and the verdict of every document."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
