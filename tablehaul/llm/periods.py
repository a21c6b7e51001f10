"""Runs of repeated word sequences: branching tandem repeats of an enhanced suffix array, without tree nodes.

A batch of texts is one array of word numbers, with numbers of their own for each text, so nothing matches across
texts. Suffixes are sorted by doubling; the kept ranks of each doubling give common prefixes to the right and to the left.
Every common-prefix interval is split where its depth stands: suffixes of the smaller side look up whether the suffix
one depth further, or one depth before, lies on the other side. If so the two are neighbours in a square that no word to
the right continues. Rotated to the left as far as it goes, such a square is a run; each run has one.

NULL and empty texts have no words and no runs; equal rows give equal rows; a text of any length is handled whole, in one
task, with some 150 bytes a word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tablehaul.llm import texts

# Words of a run at least, and how often its period must fit.
MIN_WORDS = 12
MIN_REPEATS = 2
# Suffixes looked up at once.
LOOK_UPS = 1 << 20

SCHEMA = """doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint,
            runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"""


class SuffixArray:
    """Sorted suffixes of ``keys``, their places, and the ranks of strings of 1, 2, 4, ... keys."""

    def __init__(self, keys: np.ndarray):
        n = len(keys)
        self.ranks: list[np.ndarray] = []
        rank = np.zeros(n, np.int64)
        at, second, width = np.arange(n), keys, 0
        while len(at):
            order = np.lexsort((second, rank[at]))
            at, second = at[order], second[order]
            group = rank[at]
            first = np.ones(len(at), bool)
            first[1:] = group[1:] != group[:-1]
            begin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            first[1:] |= second[1:] != second[:-1]
            rank = rank.copy()
            place = np.arange(len(at))
            rank[at] = group + np.maximum.accumulate(np.where(first, place, 0)) - begin
            alone = first.copy()
            alone[:-1] &= first[1:]
            at = at[~alone]
            self.ranks.append(rank.astype(np.int32))
            width = max(2 * width, 1)
            ahead = at + width
            second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1) if n else at
        self.place = rank
        self.order = np.empty(n, np.int64)
        self.order[rank] = np.arange(n)

    def common_right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        n, out = len(self.place), np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.ranks))):
            rank = self.ranks[j]
            x, y = a + out, b + out
            same = (x < n) & (y < n) & (x != y)
            same[same] = rank[x[same]] == rank[y[same]]
            out[same] += 1 << j
        return out

    def common_left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest string that ends just before both ``a`` and ``b``."""
        out = np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.ranks))):
            rank = self.ranks[j]
            x, y = a - out - (1 << j), b - out - (1 << j)
            same = (x >= 0) & (y >= 0)
            same[same] = rank[x[same]] == rank[y[same]]
            out[same] += 1 << j
        return out


def _reach(values: np.ndarray, at: np.ndarray, depth: np.ndarray, strict: bool) -> np.ndarray:
    """How many values from ``at`` on are larger than ``depth`` (or as large, where not ``strict``) without a gap."""
    least, out, tables = values, np.zeros(len(at), np.int64), []
    floor = depth if strict else depth - 1
    going = least[np.minimum(at, len(values) - 1)] > floor
    width = 1
    while going.any():
        tables.append(least)
        nxt = np.full(len(least), -1, least.dtype)
        nxt[: len(least) - width] = np.minimum(least[: len(least) - width], least[width:])
        least, width = nxt, 2 * width
        going = going & (least[np.minimum(at, len(values) - 1)] > floor)
    for j in reversed(range(len(tables))):
        x = at + out
        more = x < len(values)
        more[more] = tables[j][x[more]] > floor[more]
        out[more] += 1 << j
    return out


def squares(array: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and periods of all squares that the word behind them does not continue."""
    n = len(array.order)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none
    depth = np.zeros(n, np.int64)
    depth[1:] = array.common_right(array.order[:-1], array.order[1:])
    split = np.flatnonzero(depth > 0)
    if not len(split):
        return none, none
    at = depth[split]
    right = split + 1 + _reach(depth, split + 1, at, strict=False)
    left = split - 1 - _reach(depth[::-1], n - split, at, strict=True)
    small_left = split - left <= right - split
    begin = np.where(small_left, left, split)
    size = np.where(small_left, split - left, right - split)
    other_lo, other_hi = np.where(small_left, split, left), np.where(small_left, right, split)
    ends = np.cumsum(size)
    starts, periods = [], []
    lo = 0
    while lo < len(split):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + LOOK_UPS, "right")))
        part = slice(lo, hi)
        which = np.repeat(np.arange(lo, hi), size[part])
        inside = np.arange(len(which)) - np.repeat(ends[part] - size[part] - done, size[part])
        here, step = array.order[begin[which] + inside], at[which]
        for there in (here + step, here - step):
            hit = np.flatnonzero((there >= 0) & (there < n))
            rank = array.place[there[hit]]
            hit = hit[(rank >= other_lo[which[hit]]) & (rank < other_hi[which[hit]])]
            starts.append(np.minimum(here[hit], there[hit]))
            periods.append(step[hit])
        lo = hi
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(keys: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all runs, by start and period."""
    array = SuffixArray(keys)
    begin, period = squares(array)
    back = array.common_left(begin, begin + period)
    start, length = begin - back, 2 * period + back
    long = (length >= min_words) & (length >= min_repeats * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _run_batch(batch: pa.RecordBatch, min_words: int, min_repeats: int) -> pa.RecordBatch:
    data, offsets = texts.flat(batch.column(1))
    n = batch.num_rows
    starts, ends = texts.spans(data, offsets, texts.white_space())
    rows = texts.rows_of(starts, offsets)
    words = texts.pieces(data, starts, ends)
    code, distinct = texts.codes(words)
    start, length, period = runs_of(rows * max(len(distinct), 1) + code, min_words, min_repeats)
    row = rows[start]
    first_word = np.searchsorted(rows, np.arange(n + 1))
    first_run = np.searchsorted(row, np.arange(n + 1))
    dropped = np.zeros(len(rows) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    start = start - first_word[row]
    longest = np.lexsort((period, start, -length, row))
    top = longest[np.minimum(first_run[:-1], max(len(longest) - 1, 0))] if len(longest) else np.zeros(n, np.int64)
    none = first_run[1:] == first_run[:-1]

    def of_longest(values: np.ndarray) -> pa.Array:
        return pa.array(values[top] if len(values) else np.zeros(n, np.int64), pa.int64(), mask=none)

    struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], ["start", "length", "period"])
    word_rows = np.searchsorted(rows[kept], np.arange(n + 1))
    lists = pa.ListArray.from_arrays(pa.array(word_rows, pa.int32()), words.take(pa.array(kept)).cast(pa.binary()))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0), pa.array(np.diff(first_word)), pa.array(np.diff(first_run)),
            of_longest(start), of_longest(length), of_longest(period),
            pa.ListArray.from_arrays(pa.array(first_run, pa.int32()), struct),
            pc.binary_join(lists, b" ").cast(pa.string()),
        ],
        ["doc_id", "n_words", "n_runs", "start", "length", "period", "runs", "collapsed"],
    )


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS
) -> DataFrame:
    """All runs of each text, the longest of them, and the text with each run cut to its first period.

    Words are what stands between white space. A run is a stretch of words with smallest period ``period``, at least ``min_words``
    and ``min_repeats`` periods long, that no neighbouring word extends. ``start`` counts words from 0; the longest run is the
    first of the longest (NULL where there is none). ``collapsed`` joins the kept words by one space. One pass, no shuffle.
    """
    if min_repeats < 2 or min_words < 2:
        raise ValueError("a run repeats its period twice at least")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.whole_text(text).alias("text"))
    return texts.map_arrow(rows, lambda batch: _run_batch(batch, min_words, min_repeats), SCHEMA)
