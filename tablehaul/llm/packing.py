"""Packing of token pieces into sequences of bounded length by exact complements, then best fit.

Pieces of equal length are interchangeable, so the plan needs only how many there are of each
length: at most ``capacity`` numbers, whatever the size of the corpus. The plan is made from
them on the driver and says, for each length, which sequences and places its pieces fill. Pieces are
numbered within their length on the cluster and look their place up.

NULL text counts as empty; an empty text is one piece, its end id. Repeated rows are packed
each on its own, a NULL id is kept, an empty table gives none. Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tablehaul.llm import texts, tokens
from tablehaul.sources.files import staged

CAPACITY = 4096
END_ID = 1
# Pieces of one length that are numbered in one task.
NUMBERED_ROWS = 200_000


# pieces


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids): each text's ids and the end id, cut only if over ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers, left out without ``with_ids``.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = tokens.encoder(tokenizer).encode(*texts.flat(batch.column(1)))
        out: list[list] = [[] for _ in range(6)]
        for row, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            own = np.append(ids[i:j], end_id).astype("<u4")
            for piece, at in enumerate(range(0, len(own), capacity)):
                body = own[at : at + capacity].tobytes()
                for column, value in zip(out, (row, piece, at, len(body) // 4, zlib.crc32(body), body), strict=True):
                    column.append(value)
        row, piece, *rest = out
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(v, k) for v, k in zip(rest, kinds, strict=True)]
        return texts.batch_of(
            names, batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *columns[: len(names) - 2]
        )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.whole_text(text).alias("text"))
    return texts.map_arrow(rows, run, schema, done=lambda: tokens.end_task(tokenizer), limit=tokens.BATCH_BYTES)


# the plan


@dataclass
class Plan:
    """Where the pieces of each length go: runs of piece numbers, ``per`` of them to a sequence."""

    length: list[int] = field(default_factory=list)
    number: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    per: list[int] = field(default_factory=list)
    sequences: int = 0

    def add(self, pattern: Counter, times: int, used: np.ndarray) -> None:
        """``times`` sequences filled by the lengths of ``pattern``."""
        offset = 0
        for length, per in sorted(pattern.items(), reverse=True):
            for column, value in zip(
                (self.length, self.number, self.sequence, self.offset, self.per),
                (length, int(used[length]), self.sequences, offset, per),
                strict=True,
            ):
                column.append(value)
            used[length] += per * times
            offset += per * length
        self.sequences += times


class Complements:
    """Which lengths are left, and which sums of one, two or three of them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        self.lengths = np.flatnonzero(self.counts)
        # bit s of a number says whether s is a sum: single lengths, and pairs of them
        self.single = sum(1 << n for n in self.lengths.tolist())
        self.pair = 0
        for n in self.lengths.tolist():
            self.pair |= self.single << n

    def _pairs(self, gap: int, left: np.ndarray) -> tuple[int, int] | None:
        if not self.pair >> gap & 1:
            return None
        large = self.lengths[(self.lengths < gap) & (2 * self.lengths >= gap)]
        small = gap - large
        fits = (left[large] > 0) & (left[small] > (large == small))
        at = np.flatnonzero(fits)
        return (int(large[at[-1]]), int(small[at[-1]])) if len(at) else None

    def filling(self, gap: int, left: np.ndarray) -> tuple[int, ...] | None:
        """One to three lengths of ``left`` that sum up to ``gap``; large ones first."""
        if left[gap] > 0:
            return (gap,)
        if found := self._pairs(gap, left):
            return found
        for largest in self.lengths[(self.lengths < gap) & (3 * self.lengths >= gap)][::-1].tolist():
            if left[largest] > 0 and self.pair >> (gap - largest) & 1:
                left[largest] -= 1
                found = self._pairs(gap - largest, left)
                left[largest] += 1
                if found:
                    return (largest, *found)
        return None


def _exact_pattern(index: Complements, start: int, capacity: int) -> Counter | None:
    """Lengths from ``start`` down that fill a sequence exactly, the last one to three by complement."""
    pattern, gap, left = Counter({start: 1}), capacity - start, index.counts.copy()
    left[start] -= 1
    while gap:
        if found := index.filling(gap, left):
            pattern.update(found)
            return pattern
        fit = np.flatnonzero(left[: gap + 1])
        if not len(fit):
            return None
        longest = int(fit[-1])
        pattern[longest] += 1
        left[longest] -= 1
        gap -= longest
    return pattern


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Plan for ``counts`` pieces of each length.

    From the longest length down, a sequence is begun and closed by an exact complement; it is
    repeated as long as the pieces last, so each step uses up a length. Where no complement is left
    the length waits. What waits is placed by best fit, longest first, again for many
    sequences at once.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} does not fit")
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    plan, waiting = Plan(), np.zeros(capacity + 1, np.int64)
    index = Complements(left)
    for start in range(capacity, 0, -1):
        while left[start]:
            pattern = _exact_pattern(index, start, capacity)
            if pattern is None:
                waiting[start], left[start] = left[start], 0
            else:
                times = min(int(left[n]) // per for n, per in pattern.items())
                plan.add(pattern, times, used)
                for n, per in pattern.items():
                    left[n] -= per * times
            if not left[index.lengths].all():
                index.refresh()
    # best fit: open sequences by the room they have
    open_bins: dict[int, list[tuple[Counter, int]]] = {}
    for length in range(capacity, 0, -1):
        n = int(waiting[length])
        while n:
            room = min((r for r in open_bins if r >= length), default=None)
            if room is None:
                per = capacity // length
                full, rest = divmod(n, per)
                for times, size in ((full, per), (1, rest)):
                    if times and size:
                        open_bins.setdefault(capacity - size * length, []).append((Counter({length: size}), times))
                break
            pattern, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
            per = min(room // length, n)
            take = min(times, n // per)
            if times > take:
                open_bins.setdefault(room, []).append((pattern, times - take))
            open_bins.setdefault(room - per * length, []).append((pattern + Counter({length: per}), take))
            n -= take * per
    for bins in open_bins.values():
        for pattern, times in bins:
            plan.add(pattern, times, used)
    return plan


# on the cluster


def _numbered(pieces: DataFrame, largest: int) -> DataFrame:
    """``pieces`` plus ``number``, counted from 0 within each length; a common length is shared out over many tasks."""
    parts = max(1, -(-largest // NUMBERED_ROWS))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    # one row per length and part
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside) - F.lit(1))
    joined = ranked.join(before, ["length", "salt"])
    return joined.select(*[pieces[c] for c in pieces.columns], (F.col("before") + F.col("rank")).alias("number"))


def _placed(numbered: DataFrame, plan: Plan) -> DataFrame:
    """Sequence and offset of each numbered piece. The plan's size depends on the capacity, not on the rows.

    Only lengths and numbers go to Python; ids stay where they are.
    """
    order = np.lexsort((plan.number, plan.length))
    length, number, sequence, offset, per = (
        np.array(c, np.int64)[order] for c in (plan.length, plan.number, plan.sequence, plan.offset, plan.per)
    )
    stride = np.int64(1) << np.int64(48)
    begins = length * stride + number

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        size, which = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        run = np.searchsorted(begins, size * stride + which, "right") - 1
        within = which - number[run]
        return pd.DataFrame(
            {"sequence_id": sequence[run] + within // per[run], "offset": offset[run] + within % per[run] * size}
        )

    found = numbered.withColumn("place", place("length", "number"))
    return found.select(*[c for c in numbered.columns if c != "number"], "place.sequence_id", "place.offset")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces, with their columns, plus ``sequence_id`` and ``offset``.

    ``pieces`` has doc_id, piece, length and ids_crc32, and is read three times.
    """
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = make_plan(counts, capacity)
    return _placed(_numbered(pieces, max(counts.values(), default=0)), plan)


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Token pieces of all texts, each in its sequence; tokenized once."""
    capacity = options.get("capacity", CAPACITY)
    return pack(staged(token_pieces(docs, tokenizer, doc_id, text, **options), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the ids of each sequence, from packed pieces that carry ``ids``. At most ``capacity`` ids each."""
    own = F.array_sort(F.collect_list(F.struct("offset", "doc_id", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(own.alias("p")).select(
        "sequence_id", F.unhex(F.array_join("p.ids", "")).alias("ids"), F.col("p.doc_id").alias("doc_ids")
    )
