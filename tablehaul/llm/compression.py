"""Quality rules: word and line counts, and zstandard compression bands.

``measure`` gives one row per document, ``keep`` the documents that pass. NULL text
counts as empty, an empty text has no words and is rejected; a NULL id is passed on. Rows
are judged one by one, so repeated rows get equal verdicts and an empty table gives none.
Other columns of the input play no part in ``measure`` and are all returned by ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tablehaul.llm import texts

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"

LEVEL = 3
CHUNK_BYTES = 2048
# (bytes from, lowest, highest) compressed bytes per byte. Short texts carry the frame header, hence the loose start.
WHOLE_BANDS = (
    (0, 0.0, 100.0),
    (64, 0.35, 1.30),
    (128, 0.35, 1.10),
    (256, 0.35, 0.95),
    (512, 0.30, 0.85),
    (1024, 0.28, 0.75),
    (2048, 0.25, 0.70),
    (8192, 0.22, 0.68),
    (32768, 0.18, 0.66),
)
CHUNK_BAND = (0.22, 0.75)
# A text fails if over this share of its chunks lies outside the chunk band.
MAX_BAD_CHUNKS = 0.3

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_bytes bigint, ratio double, n_chunks bigint, n_bad_chunks bigint, "
    "base_failed boolean, band_failed boolean, kept boolean"
)


def repeated_words(words: pa.Array, rows: np.ndarray, n: int, window: int) -> np.ndarray:
    """Words of each row that lie in a window of words found twice or more in the row."""
    code, _ = texts.codes(words)
    if len(code) < window:
        return np.zeros(n, np.int64)
    hashes = texts.window_hashes(texts.mix(code.astype(np.uint64) + np.uint64(1)), window)
    at = np.flatnonzero(rows[: len(hashes)] == rows[window - 1 :])
    with np.errstate(over="ignore"):
        keyed = texts.mix(hashes[at] + texts.mix(rows[at].astype(np.uint64) + np.uint64(1)))
    group, _ = texts.codes(pa.array(keyed))
    at = at[np.bincount(group)[group] > 1]
    edge = np.zeros(len(code) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return texts.counts_of(rows, n, np.cumsum(edge[:-1]) > 0)


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray, n: int) -> np.ndarray:
    """Lines of each row that hold a word and equal an earlier line of the row."""
    breaks = np.zeros(256, bool)
    breaks[0x0A] = True
    starts, ends = texts.spans(data, offsets, breaks)
    if not len(starts):
        return np.zeros(n, np.int64)
    words = np.searchsorted(word_starts, ends) - np.searchsorted(word_starts, starts)
    starts, ends = starts[words > 0], ends[words > 0]
    code, distinct = texts.codes(texts.pieces(data, starts, ends))
    rows = texts.rows_of(starts, offsets)
    each = np.unique(rows * max(len(distinct), 1) + code) // max(len(distinct), 1)
    return texts.counts_of(rows, n) - texts.counts_of(each, n)


def chunk_ratios(compress: zstandard.ZstdCompressor, body: memoryview, size: int) -> list[float]:
    """Ratios of the whole chunks of a text; a rest is judged by one more chunk that ends with the text."""
    starts = list(range(0, len(body) - size + 1, size))
    if starts and len(body) % size:
        starts.append(len(body) - size)
    return [len(compress.compress(body[i : i + size])) / size for i in starts]


def _measures(batch: pa.RecordBatch, text: str, options: dict) -> dict[str, np.ndarray]:
    data, offsets = texts.flat(batch.column(batch.schema.get_field_index(text)))
    n = batch.num_rows
    starts, ends = texts.spans(data, offsets, texts.white_space())
    rows = texts.rows_of(starts, offsets)
    words = texts.pieces(data, starts, ends)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True
    leading = ((data & 0xC0) != 0x80) & ~texts.white_space()[data]
    out = {
        "n_words": texts.counts_of(rows, n),
        "word_chars": texts.sums_between(leading, offsets),
        "n_symbols": texts.sums_between(symbols[data], offsets),
        "n_dup_lines": duplicate_lines(data, offsets, starts, n),
        "n_repeat_words": repeated_words(words, rows, n, REPEAT_WINDOW),
        "n_bytes": np.diff(offsets),
    }
    compress = zstandard.ZstdCompressor(level=options["level"])
    low, high = options["chunk_band"]
    ratio, chunks, bad = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.flatnonzero(out["n_bytes"]):
        body = memoryview(data[offsets[i] : offsets[i + 1]])
        ratio[i] = len(compress.compress(body)) / len(body)
        each = chunk_ratios(compress, body, options["chunk_bytes"])
        chunks[i], bad[i] = len(each), sum(not low <= r <= high for r in each)
    bands = np.array(options["whole_bands"], float)
    band = bands[np.searchsorted(bands[:, 0], out["n_bytes"], "right") - 1]
    out |= {"ratio": ratio, "n_chunks": chunks, "n_bad_chunks": bad}
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
        100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"]
    )
    out["band_failed"] = (ratio < band[:, 1]) | (ratio > band[:, 2]) | (bad > options["max_bad_chunks"] * chunks)
    out["kept"] = ~out["base_failed"] & ~out["band_failed"]
    return out


def _options(level, chunk_bytes, whole_bands, chunk_band, max_bad_chunks) -> dict:
    if whole_bands[0][0] != 0 or list(whole_bands) != sorted(whole_bands):
        raise ValueError("bands must ascend from 0 bytes")
    return {
        "level": level,
        "chunk_bytes": chunk_bytes,
        "whole_bands": tuple(whole_bands),
        "chunk_band": chunk_band,
        "max_bad_chunks": max_bad_chunks,
    }


def measure(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    level: int = LEVEL,
    chunk_bytes: int = CHUNK_BYTES,
    whole_bands: Sequence[tuple[float, float, float]] = WHOLE_BANDS,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
) -> DataFrame:
    """Counts, compression ratios and the verdict of each row, in one pass without a shuffle.

    ``base_failed``: too few words, or too many in repeated windows. ``band_failed``: the
    ratio of the whole text is outside the band of its length, or too many of its chunks are
    outside theirs (below: repetitive, above: incompressible).
    """
    options = _options(level, chunk_bytes, whole_bands, chunk_band, max_bad_chunks)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _measures(batch, "text", options)
        return texts.batch_of(("doc_id", *found), batch.column(0), *found.values())

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.whole_text(text).alias("text"))
    return texts.map_arrow(rows, run, SCHEMA)


def keep(
    docs: DataFrame,
    text: str = "text",
    level: int = LEVEL,
    chunk_bytes: int = CHUNK_BYTES,
    whole_bands: Sequence[tuple[float, float, float]] = WHOLE_BANDS,
    chunk_band: tuple[float, float] = CHUNK_BAND,
    max_bad_chunks: float = MAX_BAD_CHUNKS,
) -> DataFrame:
    """The rows, with all their columns, whose verdict in ``measure`` is ``kept``."""
    options = _options(level, chunk_bytes, whole_bands, chunk_band, max_bad_chunks)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_measures(batch, text, options)["kept"]))

    return texts.map_arrow(docs, run, docs.schema, text)
