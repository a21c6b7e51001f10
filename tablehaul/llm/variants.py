"""Spelling variants of words: neighbours at one edit, from a dictionary of trie-node pairs.

The vocabulary is sorted twice, forward and reversed, over all tasks. A sorted word opens the trie nodes behind its
common prefix with the word before it, so every distinct prefix has one number, and every distinct suffix another. A word of L
letters is then L pairs (node of the letters before a skipped position, node of those behind it) and L + 1 pairs for an
inserted one (nodes on both sides of a gap). Two words differ by one replaced letter if they share a skipped pair, by one
deleted letter if a skipped pair of the longer is a gap pair of the shorter: exact, and linear in the letters. All words
of a pair have the same letters but one, so its group is no larger than the alphabet and a gap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablehaul.sources.files import staged

# Maximal runs of these are words before edits.
LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 5
MIN_COUNT = 3
# A form occurs this many times as often as its variant, at least.
FORM_FACTOR = 2
# Words of a sorted part.
PART_WORDS = 100_000

_BATCH_ROWS = 10_000
_PLAIN, _FIRST_OF_RUN, _GAP = 0, 1, 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def word_counts(words: DataFrame, word: str = "word", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough. Counted in part before the shuffle, so common words do no harm."""
    long = words.select(F.col(word).cast("string").alias("word")).filter(F.length("word") >= min_letters)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def _number_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, id, word) in order to (id, part, word, nodes, first, letters): node numbers from 1 within the part.

    A part opens a node at each letter that the word before does not share; the first word opens all of its own.
    """
    before, path, opened, first = "", [], 0, True
    for batch in batches:
        nodes, offsets, firsts, letters = [], [0], [], []
        for word in batch.column(2).to_pylist():
            same = _common(before, word)
            del path[same:]
            path.extend(range(opened + same + 1, opened + len(word) + 1))
            opened += len(word)
            nodes.extend(path)
            offsets.append(len(nodes))
            firsts.append(first)
            letters.append(opened)
            before, first = word, False
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1), batch.column(0), batch.column(2),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(nodes, pa.int64())),
                pa.array(firsts), pa.array(letters, pa.int64()),
            ],
            ["id", "part", "word", "nodes", "first", "letters"],
        )


class Numbering:
    """Turns the node numbers of a part into those of the whole trie."""

    def __init__(self, parts: dict[int, tuple[int, np.ndarray]]):
        self.parts = parts

    @classmethod
    def of(cls, numbered: DataFrame) -> Numbering:
        """From the first and the last word of each part, which is all that reaches the driver.

        A part's first word shares its first letters with the last word of the part before; those nodes have numbers already.
        """
        last = numbered.groupBy("part").agg(F.max_by("id", "letters").alias("id")).select("id")
        ends = numbered.filter("first").select("id").union(last).distinct()
        rows = numbered.join(F.broadcast(ends), "id").select("part", "id", "word", "nodes", "letters").orderBy("part", "letters").collect()
        of_part: dict[int, list] = {}
        for row in rows:
            of_part.setdefault(row.part, []).append(row)
        parts, base, before, path = {}, 0, "", np.zeros(0, np.int64)
        for part, (first, *rest) in sorted(of_part.items()):
            final = rest[-1] if rest else first
            known = path[: _common(before, first.word)]
            parts[part] = (base, known)
            path = cls._whole(np.array(final.nodes, np.int64), base, known)
            before, base = final.word, base + final.letters
        return cls(parts)

    @staticmethod
    def _whole(nodes: np.ndarray, base: int, known: np.ndarray) -> np.ndarray:
        out = nodes + base
        if len(known):
            old = nodes <= len(known)
            out[old] = known[nodes[old] - 1]
        return out

    def flat(self, part: np.ndarray, nodes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whole-trie numbers of the nodes of all rows in one array, and the row bounds in it."""
        offsets = nodes.offsets.to_numpy().astype(np.int64)
        values = nodes.values.to_numpy()[offsets[0] : offsets[-1]].copy()
        offsets = offsets - offsets[0]
        each = np.repeat(part, np.diff(offsets))
        for p in np.unique(part).tolist():
            mine = each == p
            values[mine] = self._whole(values[mine], *self.parts[p])
        return values, offsets


def _sorted_nodes(words: DataFrame, parts: int, label: str) -> DataFrame:
    """(id, word) by word, in code-point order, with the nodes of each word numbered within its part."""
    rows = words.repartitionByRange(parts, "word").sortWithinPartitions("word")
    rows = rows.select(F.spark_partition_id().cast("bigint").alias("part"), *(["id"] if "id" in words.columns else [F.monotonically_increasing_id().alias("id")]), "word")
    schema = "id bigint, part bigint, word string, nodes array<bigint>, first boolean, letters bigint"
    return staged(rows.mapInArrow(_number_nodes, schema), label)


def _pairs(batch: pa.RecordBatch, forward: Numbering, reverse: Numbering) -> Iterator[pa.RecordBatch]:
    """(id, n, word, part, nodes, back_part, back_nodes) to (before, after, n, id, kind), one row per skipped or gap position."""
    ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    letters = np.frombuffer("".join(batch.column(2).to_pylist()).encode("utf-32-le"), np.uint32)
    prefix, offsets = forward.flat(batch.column(3).to_numpy(), batch.column(4))
    back, _ = reverse.flat(batch.column(5).to_numpy(), batch.column(6))
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(ids)), size)
    at = np.arange(len(prefix)) - offsets[row]
    suffix = back[offsets[row] + size[row] - 1 - at]
    behind = np.zeros(len(prefix), np.int64)
    behind[:-1] = suffix[1:]
    behind[offsets[1:] - 1] = 0
    before = np.zeros(len(prefix), np.int64)
    before[1:] = prefix[:-1]
    before[offsets[:-1]] = 0
    new = np.ones(len(prefix), bool)
    new[1:] = letters[1:] != letters[:-1]
    new[offsets[:-1]] = True
    kind = np.where(new, _FIRST_OF_RUN, _PLAIN)
    end = offsets[1:] - 1
    zeros = np.zeros(len(ids), np.int64)
    columns = (
        np.concatenate((before, before, prefix[end])),
        np.concatenate((behind, suffix, zeros)),
        np.concatenate((n[row], n[row], n)),
        np.concatenate((ids[row], ids[row], ids)),
        np.concatenate((kind, np.full(len(row) + len(ids), _GAP))).astype(np.int8),
    )
    for lo in range(0, len(columns[0]), _BATCH_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + _BATCH_ROWS]) for c in columns], ["before", "after", "n", "id", "kind"])


def _near_of_groups(before, after, n, ids, kind) -> list[np.ndarray]:
    """Neighbours of each row in its whole group: how many, and the most frequent one (the rows are sorted so)."""
    new = np.ones(len(ids), bool)
    new[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1])
    group = np.cumsum(new) - 1
    total = group[-1] + 1 if len(group) else 0
    missing = len(ids)

    def first_of(chosen: np.ndarray) -> np.ndarray:
        out = np.full(total, missing)
        np.minimum.at(out, group[chosen], chosen)
        return out

    skip = kind != _GAP
    skips, canon, gaps = np.flatnonzero(skip), np.flatnonzero(kind == _FIRST_OF_RUN), np.flatnonzero(~skip)
    best = first_of(skips)
    second = first_of(skips[best[group[skips]] != skips])
    best_canon, gap = first_of(canon), first_of(gaps)
    here = np.arange(len(ids))
    at_first = kind == _FIRST_OF_RUN
    other = np.where(best[group] == here, second[group], best[group])
    choice = np.where(skip, np.where(at_first, np.minimum(other, gap[group]), other), best_canon[group])
    count = np.where(
        skip,
        np.bincount(group[skips], minlength=total)[group] - 1 + (at_first & (gap[group] < missing)),
        np.bincount(group[canon], minlength=total)[group],
    )
    found = np.flatnonzero(count > 0)
    return [ids[found], count[found], n[choice[found]], ids[choice[found]]]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair, then by falling count and id. Groups are small; one may reach into the next batch."""
    rest = None
    names = ["id", "n_near", "near_n", "near_id"]

    def out(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in _near_of_groups(*columns)], names)

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            columns = [np.concatenate(c) for c in zip(rest, columns, strict=True)]
        if not len(columns[0]):
            continue
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        cut = int(np.argmax(same))
        rest = [c[cut:] for c in columns]
        if cut:
            yield out([c[:cut] for c in columns])
    if rest is not None:
        yield out(rest)


def neighbours(words: DataFrame, parts: int | None = None) -> DataFrame:
    """(id, word, n, n_near, near_id, near_n) of distinct words with counts ``(word, n)``; ids ascend in code-point order.

    ``n_near`` counts the words at exactly one inserted, deleted or replaced letter; ``near_id`` is the one with the largest
    count (the smallest word of those), NULL where there is none. ``parts``: sorted parts, by the number of words if not given.
    """
    words = staged(words.select("word", "n"), "words")
    parts = parts or max(1, math.ceil(words.count() / PART_WORDS))
    ahead = _sorted_nodes(words.select("word"), parts, "prefixes")
    back = _sorted_nodes(ahead.select("id", F.reverse("word").alias("word")), parts, "suffixes")
    forward, reverse = Numbering.of(ahead), Numbering.of(back)
    vocabulary = staged(
        ahead.select("id", "word", "part", "nodes")
        .join(words, "word")
        .join(back.select("id", F.col("part").alias("back_part"), F.col("nodes").alias("back_nodes")), "id"),
        "vocabulary",
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH_ROWS):
                yield from _pairs(batch.slice(lo, _BATCH_ROWS), forward, reverse)

    entries = vocabulary.select("id", "n", "word", "part", "nodes", "back_part", "back_nodes").mapInArrow(
        pairs, "before bigint, after bigint, n bigint, id bigint, kind tinyint"
    )
    dealt = entries.repartition("before", "after").sortWithinPartitions("before", "after", F.desc("n"), "id")
    near = dealt.mapInArrow(_near, "id bigint, n_near bigint, near_n bigint, near_id bigint")
    near = near.groupBy("id").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near_id").alias("id"))).alias("best")
    )
    return vocabulary.select("id", "word", "n").join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.col("best.id").alias("near_id"), (-F.col("best.n")).alias("near_n"),
    )


def _roots(links: DataFrame, most: int) -> DataFrame:
    """(id, root) from (id, form): each round follows twice as many forms. Counts double along them, which bounds the rounds."""
    roots = links.select("id", F.col("form").alias("root"))
    longest = max(1, math.ceil(math.log(max(most, 2), FORM_FACTOR)))
    for _ in range(max(1, math.ceil(math.log2(longest)))):
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        after = staged(roots.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = after.select("id", "root")
        if after.filter("moved").isEmpty():
            break
    return roots


def spelling_variants(words: DataFrame, parts: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words with counts ``(word, n)``.

    ``form``: the most frequent neighbour if it is ``FORM_FACTOR`` times as frequent as the word at least; ``root``: the last word
    on the way along the forms, the word itself if it has none. An empty table gives an empty one.
    """
    near = staged(neighbours(words, parts), "neighbours")
    most = near.agg(F.max("n")).first()[0] or 0
    links = staged(near.filter(F.col("near_n") >= FORM_FACTOR * F.col("n")).select("id", F.col("near_id").alias("form"), "near_n"), "forms")
    ends = links.join(_roots(links, most), "id")
    names = near.select(F.col("id").alias("name_id"), F.col("word").alias("name"))
    named = (
        ends.join(names.withColumnRenamed("name", "form_word"), ends.form == F.col("name_id")).drop("name_id")
        .join(names.withColumnRenamed("name", "root_word"), F.col("root") == F.col("name_id"))
        .select("id", "form_word", "root_word", F.col("near_n").alias("form_n"))
    )
    return near.join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
