"""Arrow batches of texts as flat byte arrays: words, lines and hashes without a loop per row."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Text bytes handled at once; a longer text is a batch of its own.
BATCH_BYTES = 2 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x9E3779B97F4A7C15 | 1


def whole_text(name: str) -> Column:
    """A text column as a string; NULL counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def tag_of(name: str) -> Column:
    """64 bits by which different texts under one id are told apart: hash of the text and of its length."""
    whole = whole_text(name)
    return F.xxhash64(whole, F.octet_length(whole))


def release() -> None:
    """Give what a task has freed back to the system, as its worker lives on and other work needs the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: str, text: str = "text", done: Callable | None = None, limit: int = BATCH_BYTES) -> DataFrame:
    """``mapInArrow`` with batches of at most ``limit`` text bytes. ``run`` gets and returns a ``RecordBatch`` or yields some.

    ``done`` is called at the end of a task, whose worker may go on with other work.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in bounded(batch, text, limit):
                out = run(part)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
        if done:
            done()
        release()

    return df.mapInArrow(task, schema)


def bounded(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` text bytes each, but one row at least."""
    _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows in one array, and the row bounds in it. NULL is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def white_space() -> np.ndarray:
    """Bytes that are a space or 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def no_alphanumerics() -> np.ndarray:
    """ASCII bytes other than digits and letters; bytes of other characters count as letters."""
    table = np.ones(256, bool)
    table[0x80:] = False
    for lo, hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
        table[lo : hi + 1] = False
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data).astype(np.uint8)


def spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without a byte of ``breaks``; none crosses a row."""
    inside = ~breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    return starts, ends


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each place in the flat array. Empty rows own none."""
    return np.searchsorted(offsets, starts, "right") - 1


def counts_of(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    out = np.bincount(rows, weights, n)
    return out.astype(np.int64)


def sums_between(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each row."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The given spans as binary values. They must not overlap and must ascend."""
    kept = np.zeros(len(data) + 1, np.int8)
    np.add.at(kept, starts, 1)
    np.add.at(kept, ends, -1)
    body = data[np.cumsum(kept[:-1], dtype=np.int8) > 0] if len(data) else data
    bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each value, equal for equal values, and the distinct values."""
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive 64-bit values; values of one row are the caller's care."""
    with np.errstate(over="ignore"):
        n = max(len(values) - k + 1, 0)
        out = np.zeros(n, np.uint64)
        for i in range(k):
            out = mix(out * np.uint64(31) + values[i : i + n])
    return out


def batch_of(schema: Iterable[str], *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, list(schema))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class RollingHash:
    """Hashes of all strings of one length in a slab, from one running sum."""

    def __init__(self, size: int):
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = self.powers(_BASE, size + 1)
        self.down = self.powers(inverse, size + 1)

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        known = 1
        with np.errstate(over="ignore"):
            while known < n:
                step = np.uint64(pow(base, known, 1 << 64))
                out[known : 2 * known] = out[: min(known, n - known)] * step
                known *= 2
        return out

    def of(self, data: np.ndarray, k: int) -> np.ndarray:
        if len(data) < k:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[: len(data)], out=total[1:])
            sums = total[k:] - total[:-k]
            return mix(sums * self.up[: len(sums)])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, whatever its place. Spans must ascend and not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    longest = int(lengths.max())
    powers = RollingHash.powers(_BASE, longest + 1)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    with np.errstate(over="ignore"):
        terms = (data[np.repeat(starts, lengths) + inside].astype(np.uint64) + np.uint64(1)) * powers[inside]
        return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64) * _MIX)
