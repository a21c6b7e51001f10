"""Benchmark decontamination: winnowed word-gram fingerprints, joined and extended to whole windows.

A benchmark window is a run of consecutive item words; an item with fewer words is one
window. Every stretch of ``window`` words is represented by the smallest hash among its
k-grams. Equal stretches have equal representatives, so a join of the representatives
of documents with those of the benchmark misses no shared stretch. Hits are then extended: the
stretches they stand for are compared word by word, as text.

Items shorter than a window are looked up by all word runs of their length; only lengths that occur
in the benchmark are looked at, and there are at most ``window - 1`` of them.

Up to ``broadcast_prints`` different benchmark fingerprints are sent to every task, which then looks its own up and
extends hits while it holds the text; nothing but hits is shuffled. Beyond that number both sides are joined
by a shuffle and texts are joined to their hits. Both ways give the same rows. NULL texts have no words and no windows. Rows of documents are told apart by
id and text, equal rows get equal answers, and a NULL id is kept. An item row without id marks words, but is
in no list of items; items are counted by id. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablehaul.llm import texts
from tablehaul.sources.files import staged

WINDOW = 10
GRAM = 5
# Benchmark fingerprints, of 8 bytes, that may be sent to every task.
BROADCAST_PRINTS = 1_000_000


class Words:
    """Words of a batch of texts, and hashes of runs of them."""

    def __init__(self, column: pa.Array):
        data, offsets = texts.flat(column)
        self.data = texts.lower_ascii(data)
        self.starts, self.ends = texts.spans(self.data, offsets, texts.no_alphanumerics())
        self.rows = texts.rows_of(self.starts, offsets)
        self.n_rows = len(column)
        self.bounds = np.searchsorted(self.rows, np.arange(self.n_rows + 1))

    def fits(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words from each word on stays in its row."""
        n = max(len(self.rows) - width + 1, 0)
        return self.rows[:n] == self.rows[width - 1 :][:n]

    def gram_hashes(self, k: int) -> np.ndarray:
        return texts.window_hashes(texts.span_hashes(self.data, self.starts, self.ends), k)

    def joined(self, first: int, width: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(first, first + width))


def representatives(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first word in the row, number of windows, hash): runs of windows with the same smallest gram hash."""
    fits = words.fits(window)
    least = texts.sliding_minimum(words.gram_hashes(gram), window - gram + 1)[: len(fits)]
    change = np.ones(len(fits), bool)
    change[1:] = (least[1:] != least[:-1]) | (words.rows[1 : len(fits)] != words.rows[: len(fits) - 1]) | (fits[1:] != fits[:-1])
    first = np.flatnonzero(change)
    sizes = np.diff(np.append(first, len(fits)))
    first, sizes = first[fits[first]], sizes[fits[first]]
    rows = words.rows[first]
    return rows, first - words.bounds[rows], sizes, least[first]


def _widths(items: DataFrame, window: int) -> list[int]:
    """Window lengths in use: the full one and those of shorter items; at most ``window`` values."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.diff(Words(batch.column(0)).bounds)
        return texts.batch_of(("width",), np.unique(np.minimum(counts[counts > 0], window)).astype(np.int32))

    return sorted(r.width for r in texts.map_arrow(items.select("text"), run, "width int").distinct().collect())


def _prints(rows: DataFrame, widths: list[int], window: int, gram: int) -> DataFrame:
    """(doc_id, tag, width, start, n, hash) representatives of each window length."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = Words(batch.column(2))
        for width in widths:
            row, start, n, h = representatives(words, width, gram if width == window else width)
            take = pa.array(row)
            yield texts.batch_of(
                ("doc_id", "tag", "width", "start", "n", "hash"),
                batch.column(0).take(take), batch.column(1).take(take), np.full(len(row), width, np.int32),
                start.astype(np.int32), n.astype(np.int32), h.view(np.int64),
            )

    return texts.map_arrow(rows, run, "doc_id bigint, tag bigint, width int, start int, n int, hash bigint")


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, width, words): the distinct windows of each item."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column(1))
        out = []
        for row, (i, j) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)):
            width = min(j - i, window)
            if width:
                out += [(row, width, words.joined(at, width)) for at in range(i, j - width + 1)]
        row, width, body = zip(*out, strict=True) if out else ((), (), ())
        return texts.batch_of(
            ("item_id", "width", "words"),
            batch.column(0).take(pa.array(row, pa.int64())), pa.array(width, pa.int32()), pa.array(body, pa.binary()),
        )

    return texts.map_arrow(items, run, "item_id bigint, width int, words binary").distinct()


EXTENDED = "doc_id bigint, tag bigint, start int, width int, words binary"


def _extended_batch(batch: pa.RecordBatch, words: Words, hits: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    """All windows of (row, start, n, width) hits."""
    out = [
        (row, start, width, words.joined(int(words.bounds[row]) + start, width))
        for row, first, n, width in hits
        for start in range(first, first + n)
    ]
    row, start, width, body = zip(*out, strict=True) if out else ((), (), (), ())
    take = pa.array(row, pa.int64())
    return texts.batch_of(
        ("doc_id", "tag", "start", "width", "words"), batch.column(0).take(take), batch.column(1).take(take),
        pa.array(start, pa.int32()), pa.array(width, pa.int32()), pa.array(body, pa.binary()),
    )


def _looked_up(rows: DataFrame, known: dict[int, np.ndarray], window: int, gram: int) -> DataFrame:
    """(doc_id, tag, start, width, words): windows whose representative is among the ``known`` hashes of their width."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, hits = Words(batch.column(2)), []
        for width, hashes in known.items():
            row, start, n, h = representatives(words, width, gram if width == window else width)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            hits += [(*r, width) for r in zip(row[hit].tolist(), start[hit].tolist(), n[hit].tolist(), strict=True)]
        return _extended_batch(batch, words, hits)

    return texts.map_arrow(rows, run, EXTENDED)


def _extended(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """(doc_id, tag, start, width, words): the windows that hit representatives stand for."""
    listed = hits.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "n", "width")).alias("hits"))
    same = rows.doc_id.eqNullSafe(listed.doc_id) & (rows.tag == listed.tag)
    joined = rows.join(listed.hint("merge"), same).select(rows.doc_id, rows.tag, rows.text, "hits")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        listed = [
            (row, hit["start"], hit["n"], hit["width"]) for row, own in enumerate(batch.column(3).to_pylist()) for hit in own
        ]
        return _extended_batch(batch, Words(batch.column(2)), listed)

    return texts.map_arrow(joined, run, EXTENDED)


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.tag_of(text).alias("tag"), texts.whole_text(text).alias("text"))


def find_windows(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_prints: int = BROADCAST_PRINTS,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tag, start, width, words) of every benchmark window in a document, and (item_id, width, words).

    ``start`` counts words; ``tag`` is a hash of the text.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram lies inside a window")
    rows = _keyed(docs, doc_id, text)
    tests = items.select(F.col(item_id).cast("bigint").alias("item_id"), texts.whole_text(item_text).alias("text"))
    widths = _widths(tests, window)
    item_windows = staged(_item_windows(tests, window), "item-windows")
    as_rows = tests.select(F.col("item_id").alias("doc_id"), F.lit(0).cast("bigint").alias("tag"), "text")
    item_prints = staged(_prints(as_rows, widths, window, gram).select("width", "hash").distinct(), "item-prints")
    if item_prints.count() <= broadcast_prints:
        listed = item_prints.groupBy("width").agg(F.collect_list("hash").alias("hashes")).collect()
        known = {r.width: np.sort(np.array(r.hashes, np.int64).view(np.uint64)) for r in listed}
        candidates = _looked_up(rows, known, window, gram)
    else:
        hits = _prints(rows, widths, window, gram).join(item_prints, ["width", "hash"], "left_semi")
        candidates = _extended(rows, staged(hits, "hits"))
    distinct = staged(item_windows.select("width", "words").distinct(), "distinct-windows")
    found = candidates.distinct().join(distinct, ["width", "words"], "left_semi")
    return staged(found, "found-windows"), item_windows


def _covered(found: DataFrame) -> DataFrame:
    """(doc_id, tag, n_hit): words inside any found window."""
    listed = found.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "width")).alias("at"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for at in batch.column(2):
            start, width = at.values.field(0).to_numpy(), at.values.field(1).to_numpy()
            edge = np.zeros(int((start + width).max()) + 1, np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + width, -1)
            out.append(int(np.count_nonzero(np.cumsum(edge))))
        return texts.batch_of(("doc_id", "tag", "n_hit"), batch.column(0), batch.column(1), pa.array(out, pa.int64()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(run, batches)

    return listed.mapInArrow(task, "doc_id bigint, tag bigint, n_hit bigint")


def _word_counts(rows: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return texts.batch_of(("doc_id", "tag", "n_words"), batch.column(0), batch.column(1), np.diff(Words(batch.column(2)).bounds))

    return texts.map_arrow(rows, run, "doc_id bigint, tag bigint, n_words bigint")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row of ``docs``: its words, those inside benchmark windows, and the items found (``items``, sorted as text)."""
    found, item_windows = find_windows(docs, items, doc_id, text, **options)
    ids = (
        found.select("doc_id", "tag", "width", "words").distinct()
        .join(item_windows.where("item_id IS NOT NULL"), ["width", "words"])
        .groupBy("doc_id", "tag")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    hit = _covered(found).alias("h")
    named = hit.join(
        ids.alias("i"), F.col("h.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("h.tag") == F.col("i.tag")), "left"
    ).select(F.col("h.doc_id").alias("hit_id"), F.col("h.tag").alias("hit_tag"), "n_hit", "items")
    counts = _word_counts(_keyed(docs, doc_id, text))
    same = counts.doc_id.eqNullSafe(named.hit_id) & (counts.tag == named.hit_tag)
    none = F.array().cast("array<string>")
    return counts.join(named, same, "left").select(
        "doc_id", "tag", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows, with all columns, that hold no benchmark window."""
    found, _ = find_windows(docs, items, doc_id, text, **options)
    hit = found.select(F.col("doc_id").alias("hit_id"), F.col("tag").alias("hit_tag")).distinct()
    names = texts.free_names(docs, "row_id", "row_tag")
    keyed = docs.withColumns({names[0]: F.col(doc_id).cast("bigint"), names[1]: texts.tag_of(text)})
    same = keyed[names[0]].eqNullSafe(hit.hit_id) & (keyed[names[1]] == hit.hit_tag)
    return keyed.join(hit, same, "left_anti").select(*docs.columns)
