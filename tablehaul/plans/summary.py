"""Mergeable quantile summaries of composite integer keys, and cuts of about equal rows taken from them.

Each task reads its key columns once and keeps points of equal weight of its sorted keys. Summaries are merged
in a tree on the executors; only the cuts reach the driver. Keys travel as one value that sorts like the
key tuple: big-endian bytes with the sign bit flipped.

A summary of S points is off by at most half a point's weight at each of its cuts, and each merge adds as much again. With
``POINTS`` points a part and a tree of few levels, parts are within 5 % of even; plans of more than ``MOST_POINTS / POINTS``
parts get coarser, down to two points a part at a million parts. A task that merges holds ``MERGED_BYTES`` of summaries at most, whatever the
rows, and sorts them slice by slice.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

LOWEST, HIGHEST = -(2**63), 2**63 - 1

# Points of a summary: for each part, at least, and at most.
POINTS = 128
FEWEST_POINTS = 1 << 12
MOST_POINTS = 1 << 21
# Rows sorted at once in a task, summaries merged at once and their bytes, points of them sorted at once, and rows whose summaries meet in one
# task at first.
CHUNK_ROWS = 1 << 20
FAN_IN = 32
MERGED_BYTES = 300 << 20
SLICE_POINTS = 1 << 17
MERGED_ROWS = 1 << 22

_SCHEMA = "node bigint, keys binary, weights binary"


def points_for(parts: int) -> int:
    return min(max(FEWEST_POINTS, POINTS * parts), MOST_POINTS)


def encode(columns: list[np.ndarray]) -> np.ndarray:
    """Key tuples as values that sort alike."""
    shifted = [c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns]
    if len(shifted) == 1:
        return shifted[0]
    return np.ascontiguousarray(np.stack(shifted, axis=1).astype(">u8")).view(f"S{8 * len(shifted)}").ravel()


def decode(keys: np.ndarray, width: int) -> list[np.ndarray]:
    whole = keys if width == 1 else np.ascontiguousarray(keys).view(">u8").reshape(-1, width)
    columns = [whole] if width == 1 else [whole[:, i] for i in range(width)]
    return [(c.astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64) for c in columns]


def _dtype(width: int) -> str:
    return "u8" if width == 1 else f"S{8 * width}"


class Summary:
    """Sorted different keys, and how many rows each stands for."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        self.keys = keys[first]
        self.weights = np.add.reduceat(weights, first) if len(first) else weights

    @classmethod
    def of(cls, keys: np.ndarray) -> Summary:
        return cls(np.sort(keys), np.ones(len(keys), np.int64))

    @classmethod
    def merged(cls, parts: list[Summary]) -> Summary:
        keys, weights = np.concatenate([p.keys for p in parts]), np.concatenate([p.weights for p in parts])
        order = np.argsort(keys, kind="stable")
        return cls(keys[order], weights[order])

    def compressed(self, points: int) -> Summary:
        """At most ``points`` keys: those in the middle of stretches of equal rows."""
        if len(self.keys) <= points:
            return self
        weights, middle = _stretches(int(self.weights.sum()), points)
        at = np.searchsorted(np.cumsum(self.weights), middle, "right")
        return Summary(self.keys[at], weights)


def _stretches(total: int, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of each of ``points`` equal stretches, and the row in the middle of each."""
    ends = (np.arange(1, points + 1, dtype=np.float64) * (total / points)).astype(np.int64)
    ends[-1] = total
    weights = np.diff(ends, prepend=0)
    return weights, ends - (weights + 1) // 2


def _slices(parts: list[Summary]) -> Iterator[Summary]:
    """The merged summary in order, about ``SLICE_POINTS`` of the parts' points at a time."""
    step = max(SLICE_POINTS // len(parts), 1)
    pivots = np.unique(np.concatenate([p.keys[step::step] for p in parts]))
    bounds = [np.concatenate(([0], np.searchsorted(p.keys, pivots), [len(p.keys)])) for p in parts]
    for i in range(len(pivots) + 1):
        some = [(p.keys[b[i] : b[i + 1]], p.weights[b[i] : b[i + 1]]) for p, b in zip(parts, bounds, strict=True)]
        keys, weights = (np.concatenate(c) for c in zip(*some, strict=True))
        if len(keys):
            order = np.argsort(keys, kind="stable")
            yield Summary(keys[order], weights[order])


def merge(parts: list[Summary], points: int) -> Summary:
    """``Summary.merged(parts).compressed(points)``, holding one slice of it beside the parts and the result."""
    if len(parts) == 1 or sum(len(p.keys) for p in parts) <= points:
        return Summary.merged(parts).compressed(points) if len(parts) > 1 else parts[0].compressed(points)
    kept: list[Summary] = []
    for part in _slices(parts):
        kept.append(part)
        if sum(len(k.keys) for k in kept) > points:
            break
    else:
        return Summary.merged(kept)
    kind = kept[0].keys.dtype
    kept.clear()
    weights, middle = _stretches(sum(int(p.weights.sum()) for p in parts), points)
    keys, done, at = np.empty(points, kind), 0, 0
    for part in _slices(parts):
        ends = done + np.cumsum(part.weights)
        done = int(ends[-1])
        until = int(np.searchsorted(middle, done))
        keys[at:until] = part.keys[np.searchsorted(ends, middle[at:until], "right")]
        at = until
    return Summary(keys, weights)


def _bytes(values: np.ndarray) -> pa.Array:
    """An array as one binary value, not copied."""
    body = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, body.size], np.int32)), body])


def _row(node: int, summary: Summary) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), _bytes(summary.keys), _bytes(summary.weights)], ["node", "keys", "weights"])


def _point_bytes(width: int) -> int:
    return 8 * (width + 1)


def _summarise(points: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[Summary] = []
        held: list[np.ndarray] = []

        def close() -> None:
            if held:
                done.append(Summary.of(np.concatenate(held)).compressed(points))
                held.clear()
            if len(done) >= FAN_IN or len(done) > 2 and 2 * _point_bytes(width) * sum(len(d.keys) for d in done) > MERGED_BYTES:
                done[:] = [merge(done, points)]

        rows = 0
        for batch in batches:
            held.append(encode([c.to_numpy() for c in batch.columns[:width]]))
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                close()
                rows = 0
        close()
        if done:
            yield _row(TaskContext.get().partitionId(), merge(done, points))

    return run


class _Stored(Summary):
    """A summary as it was sent, not copied."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        self.keys, self.weights = keys, weights


def _read(table: pa.Table, width: int, points: int) -> Summary:
    keys = [np.frombuffer(k.as_buffer(), _dtype(width)) for k in table.column("keys")]
    weights = [np.frombuffer(w.as_buffer(), np.int64) for w in table.column("weights")]
    return merge([_Stored(k, w) for k, w in zip(keys, weights, strict=True)], points)


def cuts(summary: Summary, width: int, parts: int, lo: int, hi: int) -> list[tuple[list[int], int, int]]:
    """(prefix, lo, hi) of gap-free parts in key order; a value over two shares is cut by the next key column."""
    columns, share = decode(summary.keys, width), summary.weights.sum() / parts

    def below(rows: slice, prefix: list[int], lo: int, hi: int, parts: int) -> list[tuple[list[int], int, int]]:
        column, weights = columns[len(prefix)][rows], summary.weights[rows]
        first = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
        values, counts = column[first], np.add.reduceat(weights, first)
        done, total = np.cumsum(counts), int(counts.sum())
        alone = counts > total / parts
        # close where the rows so far reach the next whole share
        closes = np.floor(done * (parts / total) + 1e-9) > np.floor((done - counts) * (parts / total) + 1e-9)
        out, start = [], lo
        for i in np.flatnonzero(alone | closes).tolist():
            value, last = int(values[i]), i + 1 == len(values)
            if alone[i]:
                if start < value:
                    out.append((prefix, start, value - 1))
                if counts[i] > 2 * share and len(prefix) + 1 < width:
                    begin = rows.start + int(first[i])
                    end = rows.start + (len(column) if last else int(first[i + 1]))
                    out += below(slice(begin, end), [*prefix, value], LOWEST, HIGHEST, -int(-counts[i] // share))
                else:
                    out.append((prefix, value, value))
            else:
                value = hi if last else value
                out.append((prefix, start, value))
            start = value + 1
        if start <= hi:
            out.append((prefix, start, hi))
        return out

    return below(slice(0, len(summary.keys)), [], lo, hi, parts)


def plan_cuts(keys: DataFrame, parts: int, lo: int, hi: int, total: int) -> list[tuple[tuple[int, ...], int, int]]:
    """``cuts`` of a frame whose columns are the bigint key columns, from one pass over it. ``total``: about its rows."""
    width, points = len(keys.columns), points_for(parts)
    level = keys.mapInArrow(_summarise(points, width), _SCHEMA)
    groups = math.ceil(total / MERGED_ROWS)
    fan_in = max(2, min(FAN_IN, MERGED_BYTES // (points * _point_bytes(width))))
    while groups > 1:
        node = F.pmod("node", F.lit(groups)).alias("node")

        def merge(table: pa.Table) -> pa.Table:
            return pa.Table.from_batches([_row(table.column("node")[0].as_py(), _read(table, width, points))])

        level = level.select(node, "keys", "weights").groupBy("node").applyInArrow(merge, _SCHEMA)
        groups = math.ceil(groups / fan_in) if groups > fan_in else 1

    def plan(table: pa.Table) -> pa.Table:
        found = cuts(_read(table, width, 2 * points), width, parts, lo, hi)
        prefix, low, high = zip(*found, strict=True)
        return pa.table({"prefix": pa.array(prefix, pa.list_(pa.int64())), "lo": pa.array(low, pa.int64()), "hi": pa.array(high, pa.int64())})

    planned = level.select(F.lit(0).cast("bigint").alias("node"), "keys", "weights").groupBy("node")
    rows = planned.applyInArrow(plan, "prefix array<bigint>, lo bigint, hi bigint").collect()
    return [(tuple(r.prefix), r.lo, r.hi) for r in rows]
