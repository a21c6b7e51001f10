"""SimHash near-duplicates through a hierarchical index in Gray order.

A document's fingerprint is the bitwise majority of its shingle hashes. Fingerprints
that differ in at most ``max_distance`` bits are linked.

The index is a tree of masked bit patterns. Its upper nodes are shared out over the
cluster: a node fixes some bits, and as linked fingerprints agree in at least one of
``max_distance + 1`` parts of the free bits, each node over ``leaf_size`` is replaced by
the nodes of those parts, until it is small (no link is lost, whatever the sizes, and
the number of fixed bits bounds a node at the end). In a task the fingerprints of a node are
sorted by Gray rank, neighbours are factored level by level into the bits they share, and
searches descend from the top, adding up the differences of the bits each level adds; a
subtree is pruned as soon as the sum is over the limit.

NULL text counts as empty and has fingerprint zero, as any text without words. Equal
rows share a fingerprint. A NULL id is kept, but never names a component: a component of
rows without ids has the id NULL. Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablehaul.llm import texts
from tablehaul.llm.components import components
from tablehaul.sources.files import staged

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
LEAF_SIZE = 4096
FAN_OUT = 8
# Rows of small nodes searched together, and the most (search, node) pairs held at once.
BATCH_ROWS = 65_536
FRONTIER = 1_000_000


# fingerprints


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each run of ``k`` lower-case words joined by spaces, and its row.

    A row with fewer words, but not none, has one shingle of all its words.
    """
    data = texts.lower_ascii(data)
    starts, ends = texts.spans(data, offsets, texts.white_space())
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = texts.rows_of(starts, offsets)
    lengths = ends - starts
    joined = np.full(int(lengths.sum()) + n, 0x20, np.uint8)
    word = np.repeat(np.arange(n), lengths)
    within = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    to = np.cumsum(lengths + 1)
    joined[np.repeat(to - lengths - 1, lengths) + within] = data[np.repeat(starts, lengths) + within]
    last = np.searchsorted(rows, rows, "right") - 1
    first = np.searchsorted(rows, rows, "left")
    index = np.arange(n)
    whole = (last - first + 1 < k) & (index == first)
    at = np.flatnonzero((index + k - 1 <= last) | whole)
    until = np.where(whole[at], last[at], at + k - 1)
    body = memoryview(joined)
    begin, end = (to - lengths - 1)[at].tolist(), (to - 1)[until].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(body[i:j], SEED) for i, j in zip(begin, end, strict=True)], np.uint64), rows[at]


def majority(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Of each row the bits set in over half its hashes; zero without hashes."""
    out = np.zeros(n, np.uint64)
    if not len(hashes):
        return out
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    sizes = np.diff(np.append(starts, len(rows)))
    for bit in range(64):
        ones = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32)
        over = 2 * np.add.reduceat(ones, starts) > sizes
        out[rows[starts]] |= over.astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(doc_id, text_hash, fingerprint), one row per input row; no shuffle. ``text_hash`` tells rows of one id apart."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, rows = shingle_hashes(*texts.flat(batch.column(2)), shingle)
        found = majority(hashes, rows, batch.num_rows).view(np.int64)
        return texts.batch_of(("doc_id", "text_hash", "fingerprint"), batch.column(0), batch.column(1), found)

    whole = texts.whole_text(text)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(whole).alias("text_hash"), whole.alias("text"))
    return texts.map_arrow(rows, run, "doc_id bigint, text_hash bigint, fingerprint bigint")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def gray_rank(fingerprint: Column) -> Column:
    """Place of a bit string in Gray order."""
    rank = fingerprint
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank


# upper nodes


def parts_of(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` about equal runs of its free bits added, for each run."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False) if j > i]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _children(spark: SparkSession, masks: list[int], parts: int) -> tuple[DataFrame, list[int]]:
    """(mask, child) rows; their number depends on the level alone."""
    below = {m: parts_of(m, parts) for m in masks}
    rows = [(_signed(m), _signed(c)) for m, own in below.items() for c in own]
    return spark.createDataFrame(rows, "mask bigint, child bigint"), sorted({c for own in below.values() for c in own})


def nodes(prints: DataFrame, max_distance: int, leaf_size: int) -> DataFrame:
    """(mask, pattern, fingerprint): nodes of at most ``leaf_size`` fingerprints that hold every close pair.

    A node whose free bits allow no more than ``leaf_size`` fingerprints is not split further.
    """
    spark = prints.sparkSession
    parts = max_distance + 1
    masks = parts_of(0, parts)
    roots = F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask")
    rows = prints.select("fingerprint", roots)
    leaves = None
    while True:
        rows = rows.withColumn("pattern", F.col("fingerprint").bitwiseAND(F.col("mask")))
        final = all(1 << (64 - m.bit_count()) <= leaf_size for m in masks)
        large = rows.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > leaf_size)
        large = None if final else staged(large.select("mask", "pattern"), "large-nodes")
        if large is None or large.isEmpty():
            small, split = rows, None
        else:
            small = rows.join(large, ["mask", "pattern"], "left_anti")
            children, masks = _children(spark, masks, parts)
            split = rows.join(large, ["mask", "pattern"], "left_semi").join(F.broadcast(children), "mask")
        small = small.select("mask", "pattern", "fingerprint")
        leaves = small if leaves is None else leaves.union(small)
        if split is None:
            return leaves
        rows = staged(split.select("fingerprint", F.col("child").alias("mask")).distinct(), "split-nodes")


# lower nodes, inside a task


class GrayTree:
    """Levels over sorted fingerprints of several groups; a node knows the bits its fingerprints share."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray, fan_out: int = FAN_OUT):
        begin = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
        place = np.arange(len(prints)) - np.repeat(begin, np.diff(np.append(begin, len(prints))))
        self.masks, self.patterns, self.first = [np.full(len(prints), ~np.uint64(0))], [prints], []
        owner = groups
        while len(owner) > len(np.unique(owner)):
            place = place // fan_out
            starts = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1]))))
            sizes = np.diff(np.append(starts, len(owner)))
            same = ~(self.patterns[-1] ^ np.repeat(self.patterns[-1][starts], sizes))
            mask = np.bitwise_and.reduceat(same & self.masks[-1], starts)
            self.masks.append(mask)
            self.patterns.append(self.patterns[-1][starts] & mask)
            self.first.append(np.append(starts, len(owner)))
            owner, place = owner[starts], place[starts]
        self.top = np.searchsorted(owner, groups)

    def close_pairs(self, prints: np.ndarray, search: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(searcher, found) with at most ``limit`` differing bits, found before the searcher in the order."""
        node = self.top[search]
        level = len(self.masks) - 1
        known = self.masks[level][node]
        sums = np.bitwise_count((prints[search] ^ self.patterns[level][node]) & known)
        while level:
            keep = sums <= limit
            search, node, sums = search[keep], node[keep], sums[keep]
            first = self.first[level - 1]
            counts = first[node + 1] - first[node]
            above = np.repeat(self.masks[level][node], counts)
            within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            search, sums, node = np.repeat(search, counts), np.repeat(sums, counts), np.repeat(first[node], counts) + within
            level -= 1
            added = self.masks[level][node] & ~above
            sums = sums + np.bitwise_count((prints[search] ^ self.patterns[level][node]) & added)
        keep = (sums <= limit) & (node < search)
        return search[keep], node[keep]


def _join_roots(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        left, right = roots[a], roots[b]
        apart = left != right
        if not apart.any():
            return roots
        np.minimum.at(roots, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while not np.array_equal(upper := roots[roots], roots):
            roots = upper


def spanning_links(prints: np.ndarray, groups: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same fingerprints as all close pairs of each group do, at most one per fingerprint."""
    tree = GrayTree(prints, groups)
    roots = np.arange(len(prints))
    largest = int(np.bincount(groups - groups[0]).max())
    step = max(1, FRONTIER // largest)
    for at in range(0, len(prints), step):
        roots = _join_roots(roots, *tree.close_pairs(prints, np.arange(at, min(at + step, len(prints))), limit))
    tied = np.flatnonzero(roots != np.arange(len(prints)))
    return prints[tied], prints[roots[tied]]


def _search_nodes(limit: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            held.clear()
            change = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
            end = len(rows) if last else (int(change[-1]) if len(change) else 0)
            if end < len(rows):
                held.append(rows[end:])
            if end:
                groups = np.zeros(end, np.int64)
                groups[change[change < end]] = 1
                a, b = spanning_links(rows[:end, 2].astype(np.uint64), np.cumsum(groups), limit)
                yield texts.batch_of(("a", "b"), a.view(np.int64), b.view(np.int64))

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.int64))
            if sum(map(len, held)) >= BATCH_ROWS:
                yield from flush(False)
        if held:
            yield from flush(True)

    return task


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, leaf_size: int = LEAF_SIZE) -> DataFrame:
    """(a, b) links among distinct fingerprints with the same connected components as all close pairs."""
    rank = gray_rank(F.col("fingerprint"))
    return (
        nodes(prints, max_distance, leaf_size)
        .repartition("mask", "pattern")
        .sortWithinPartitions("mask", "pattern", rank)
        .mapInArrow(_search_nodes(max_distance), "a bigint, b bigint")
        .distinct()
    )


# documents


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    leaf_size: int = LEAF_SIZE,
) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) per row; ``component_id`` is the smallest id reachable by links."""
    rows = staged(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    prints = staged(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(prints.select("fingerprint"), max_distance, leaf_size))
    rooted = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id", "root")
    return rows.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row, whole, of each component: the smallest id, ids before NULL, and by text among rows of one id."""
    found = near_duplicates(docs, doc_id, text, **options)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    winners = found.groupBy("root").agg(F.min(order).alias("w")).select(
        F.col("w.doc_id").alias("winner_id"), F.col("w.text_hash").alias("winner_hash")
    )
    names = texts.free_names(docs, "key_id", "key_hash")
    keyed = docs.withColumns({names[0]: F.col(doc_id).cast("bigint"), names[1]: F.xxhash64(texts.whole_text(text))})
    matches = keyed[names[0]].eqNullSafe(winners.winner_id) & (keyed[names[1]] == winners.winner_hash)
    return keyed.join(winners, matches, "left_semi").dropDuplicates(names).select(*docs.columns)
