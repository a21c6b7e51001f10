"""Removal of byte strings that occur twice, decided by suffix arrays.

A window is a byte string of the given length that starts somewhere in a text. A byte
goes if it lies in a window that also starts anywhere else, in the same text or another.
Matches never cross texts and all are judged on the input.

1. Every window belongs to the smallest hash among its k-grams, so equal windows always
   meet under one hash. A piece is a run of windows with the same hash.
2. A piece whose gram occurs once in all texts cannot hold a repeated window and goes. Of equal pieces two
   stand for all, as two are enough to show that their windows repeat.
3. Pieces are dealt into buckets by hash. A bucket's suffixes are sorted in two stages:
   those smaller than their successors directly, the others by one scan over the buckets
   of first bytes that places each in front of the one it precedes. Neighbours with a
   common prefix of a whole window are repeats.
4. Repeated windows go back to every copy of their piece, are joined into spans per text,
   and are cut out.

A hash whose different pieces exceed a bucket (the edge of a passage that very many texts
share) is split: its windows are dealt by their own hash instead, again two for all equal ones. Only texts that hold
such pieces, and a few others, are shuffled for that.

NULL text counts as empty, texts shorter than a window stay whole. Equal rows repeat each
other. Rows are told apart by id and text, so a NULL or repeated id does no harm. Other
columns of the input play no part in ``find_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tablehaul.llm import texts
from tablehaul.sources.files import staged

WINDOW = 200
GRAM = 32
# Windows of one piece at most; only repetitive text has longer runs.
MAX_RUN = 1024
# Bytes looked at together when pieces are cut, and bytes sorted together.
SLAB_BYTES = 1 << 20
BUCKET_BYTES = 1 << 20
# Numbers by which texts that are looked at again are told from most others, all of them broadcast at most.
MARKS = 1 << 20


# pieces


def _rows_in(offsets: np.ndarray, at: int, n: int) -> np.ndarray:
    """Row of each of the ``n`` bytes from ``at``."""
    first = int(np.searchsorted(offsets, at, "right")) - 1
    inside = offsets[first + 1 : int(np.searchsorted(offsets, at + n, "left"))] - at
    edge = np.zeros(n, np.int64)
    np.add.at(edge, inside, 1)
    return first + np.cumsum(edge)


def _occurrences(grams: np.ndarray, keys: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """How often each key is among the grams of its own range of places.

    A place counts only where it is least among the half window on one side of it, as any
    window that it decides holds one of the two.
    """
    half = (width + 1) // 2
    least = texts.sliding_minimum(grams, half)
    near = np.ones(len(grams), bool)
    near[: len(least)] = grams[: len(least)] == least
    near[half - 1 :] |= grams[half - 1 :] == least
    place = np.flatnonzero(near)
    known, rank = np.unique(keys, return_inverse=True)
    of = np.minimum(np.searchsorted(known, grams[place]), len(known) - 1)
    hit = known[of] == grams[place]
    size = len(grams) + 1
    ordered = np.sort(of[hit] * size + place[hit])
    return np.searchsorted(ordered, rank * size + last, "right") - np.searchsorted(ordered, rank * size + first, "left")


def cut_pieces(
    data: np.ndarray, offsets: np.ndarray, window: int, gram: int, rolling: texts.RollingHash
) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, n_windows, hash, occurrences of the hash, content) of all pieces of a batch, slab by slab."""
    body = memoryview(data)
    digest = xxhash.xxh3_64_intdigest
    for at in range(0, max(len(data) - window + 1, 0), SLAB_BYTES):
        slab = data[at : at + SLAB_BYTES + window - 1]
        grams = rolling.of(slab, gram)
        least = texts.sliding_minimum(grams, window - gram + 1)
        rows = _rows_in(offsets, at, len(least))
        valid = np.arange(at, at + len(least)) + window <= offsets[rows + 1]
        change = np.ones(len(least), bool)
        change[1:] = (least[1:] != least[:-1]) | (rows[1:] != rows[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(change)
        sizes = np.diff(np.append(first, len(least)))
        extra = (sizes - 1) // MAX_RUN
        if extra.any():
            within = np.arange(int((extra + 1).sum())) - np.repeat(np.cumsum(extra + 1) - extra - 1, extra + 1)
            first = np.repeat(first, extra + 1) + within * MAX_RUN
            sizes = np.diff(np.append(first, len(least)))
        first, sizes = first[valid[first]], sizes[valid[first]]
        if not len(first):
            continue
        times = _occurrences(grams, least[first], first, first + sizes - 1 + window - gram, window - gram + 1)
        begin = at + first
        ends = (begin + sizes + window - 1).tolist()
        content = [digest(body[i:j]) for i, j in zip(begin.tolist(), ends, strict=True)]
        yield rows[first], begin - offsets[rows[first]], sizes, least[first], times, np.array(content, np.uint64)


PIECES = "doc_id bigint, tag bigint, start int, n int, key bigint, weight int, content bigint"


def pieces(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """All pieces of (doc_id, tag, text) rows, without a shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = texts.RollingHash(SLAB_BYTES + window)
        for batch in batches:
            for part in texts.bounded(batch, "text"):
                data, offsets = texts.flat(part.column(2))
                for row, start, n, key, times, content in cut_pieces(data, offsets, window, gram, rolling):
                    take = pa.array(row)
                    yield texts.batch_of(
                        ("doc_id", "tag", "start", "n", "key", "weight", "content"),
                        part.column(0).take(take), part.column(1).take(take),
                        start.astype(np.int32), n.astype(np.int32), key.view(np.int64),
                        np.minimum(times, 2).astype(np.int32), content.view(np.int64),
                    )
        texts.release()

    return rows.mapInArrow(task, PIECES)


def shared_pieces(found: DataFrame) -> DataFrame:
    """Pieces whose key occurs twice or more, ``weight`` being how often a piece holds it."""
    keys = found.groupBy("key").agg(F.sum("weight").alias("times")).where("times > 1").select("key")
    return staged(found.join(staged(keys, "shared-keys"), "key").drop("weight"), "shared-pieces")


# suffix arrays


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one is not."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    nxt = np.where(differs, np.arange(n), n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    smaller = np.append(t[:-1] < t[1:], False)
    return smaller[nxt]


def _words(body: bytes, depth: int, order: str) -> np.ndarray:
    """The eight bytes from each place on as one number; what lies behind the end is zero."""
    padded = np.frombuffer(body + bytes(depth + 8), np.uint8)
    return np.ndarray((len(padded) - 7,), f"{order}u8", padded, strides=(1,))


def sort_by_words(body: bytes, places: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the ``depth`` bytes from there on, eight bytes at a time; only ties are looked at again.

    Two that tie are compared where they first differ; larger groups are sorted by their next eight bytes.
    """
    words, symbols = _words(body, depth, ">"), np.frombuffer(body + bytes(depth + 8), np.uint8)
    out = places.copy()
    # places of ``out`` in question, and the first place of each one's group
    at, group = np.arange(len(out)), np.zeros(len(out), np.int64)
    for offset in range(0, depth, 8):
        if not len(at):
            break
        key = words[out[at] + offset].astype(np.uint64)
        order = np.lexsort((key, group)) if offset else np.argsort(key, kind="stable")
        out[at], key, group = out[at[order]], key[order], group[order]
        new = np.ones(len(at) + 2, bool)
        new[1 : len(at)] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        pair = np.flatnonzero(new[:-2] & ~new[1:-1] & new[2:])
        left, right = out[at[pair]], out[at[pair + 1]]
        same = common_prefixes(body, left, right, depth)
        swap = (same < depth) & (symbols[left + same] > symbols[right + same])
        out[at[pair[swap]]], out[at[pair[swap] + 1]] = right[swap], left[swap]
        more = ~(new[:-2] & new[1:-1])
        more[pair] = more[pair + 1] = False
        group = at[np.maximum.accumulate(np.where(new[:-2], np.arange(len(at)), 0))][more]
        at = at[more]
    return out


def two_stage_sort(t: np.ndarray, wanted: np.ndarray, body: bytes, depth: int) -> np.ndarray:
    """Places of the wanted suffixes, and of those needed to sort them, in order of their first ``depth`` bytes.

    ``t`` holds the symbols, ``body`` the same as bytes. Suffixes smaller than their
    successors are sorted directly; each other one follows from its successor's place.
    """
    small = _types(t)
    needed = wanted.copy()
    # a wanted suffix that is larger than its successor needs that one, up to the next that is smaller
    place = np.arange(len(t))
    last_wanted = np.maximum.accumulate(np.where(wanted, place, -1))
    last_small = np.maximum.accumulate(np.where(small, place, -1))
    before = np.append(-1, last_small[:-1])
    needed |= (last_wanted >= 0) & (before < last_wanted)
    direct = np.flatnonzero(needed & small)
    ends = direct[t[direct] == 0]  # separators come first, though the bytes know no symbol below zero
    direct = np.concatenate([ends, sort_by_words(body, direct[t[direct] > 0], depth)])
    heads = t[direct]
    symbols = int(t.max()) + 1
    cuts = np.searchsorted(heads, np.arange(symbols + 1))
    larger = needed & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    if larger[-1]:
        waiting[t[-1]].append(np.array([len(t) - 1]))
    out = []
    for c in range(symbols):
        induced, queue = [], waiting[c]
        queue = np.concatenate(queue) if queue else np.zeros(0, np.int64)
        while len(queue):
            induced.append(queue)
            queue = queue[queue > 0] - 1
            queue = queue[larger[queue] & (t[queue] == c)]
        bucket = np.concatenate([*induced, direct[cuts[c] : cuts[c + 1]]])
        waiting[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (t[before] > c)]
        if len(before):
            heads = t[before]
            order = np.argsort(heads, kind="stable")
            before, heads = before[order], heads[order]
            edges = np.flatnonzero(np.append(True, heads[1:] != heads[:-1]))
            for part, head in zip(np.split(before, edges[1:]), heads[edges], strict=True):
                waiting[head].append(part)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(body: bytes, left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, counted up to ``limit``."""
    step = 8
    words = _words(body, limit, "<")
    out = np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    while len(live):
        differs = words[left[live] + out[live]] ^ words[right[live] + out[live]]
        low = differs & (~differs + np.uint64(1))
        same = np.where(differs == 0, step, np.bitwise_count(low - np.uint64(1)) // step)
        out[live] += same
        live = live[(same == step) & (out[live] < limit)]
    return np.minimum(out, limit)


def repeated_windows(bodies: list[bytes], n_windows: np.ndarray, window: int) -> list[np.ndarray]:
    """For each text, which of its first ``n_windows`` windows also start elsewhere in the texts."""
    body = b"\0".join(bodies) + b"\0"
    lengths = np.array([len(b) for b in bodies], np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    t = np.frombuffer(body, np.uint8).astype(np.int16) + np.int16(1)
    t[begin + lengths] = 0
    edge = np.zeros(len(t) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + n_windows, -1)
    wanted = np.cumsum(edge[:-1]) > 0
    order = two_stage_sort(t, wanted, body, window)
    order = order[wanted[order]]
    same = common_prefixes(body, order[:-1], order[1:], window) >= window
    repeated = np.zeros(len(t), bool)
    repeated[order[:-1][same]] = True
    repeated[order[1:][same]] = True
    return [repeated[i : i + n] for i, n in zip(begin.tolist(), n_windows.tolist(), strict=True)]


RUNS = "owner bigint, content bigint, first int, until int"


def _sort_buckets(window: int):
    def run(rows: list[tuple]) -> pa.RecordBatch:
        bodies, sizes, copies = [], [], []
        for _, _, _, n, times, body in rows:
            bodies += [body] * times
            sizes += [n] * times
            copies.append(len(bodies) - times)
        marks = repeated_windows(bodies, np.array(sizes, np.int64), window)
        out = []
        for (owner, content, first, _, _, _), at in zip(rows, copies, strict=True):
            flags = np.concatenate(([False], marks[at], [False])).astype(np.int8)
            change = np.diff(flags)
            for i, j in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True):
                out.append((owner, content, first + i, first + j))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return texts.batch_of(("owner", "content", "first", "until"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            buckets = batch.column(0).to_pylist()
            for number, row in zip(buckets, zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True), strict=True):
                if number != bucket:
                    if rows:
                        yield run(rows)
                    bucket, rows = number, []
                if not rows or rows[-1][:3] != row[:3]:
                    rows.append(row)
        if rows:
            yield run(rows)
        texts.release()

    return task


# putting it together


def _marked(rows: DataFrame, places: DataFrame) -> DataFrame:
    """The rows that ``places`` name by their tag, and few others; texts are not shuffled for it. ``places`` is read once more."""
    marks = places.select(F.pmod("tag", F.lit(MARKS)).alias("mark")).distinct()
    return rows.join(F.broadcast(marks), F.pmod(rows.tag, F.lit(MARKS)) == marks.mark, "left_semi")


def _cut_bodies(
    rows: DataFrame, places: DataFrame, window: int, each: Callable | None = None, made: str | None = None
) -> DataFrame:
    """Text of each (doc_id, tag, start, n) place, with the place's other columns; more than once if its row is repeated.

    ``each`` turns a batch of them into others, of the schema ``made``, in the same worker.
    """
    others = [c for c in places.columns if c not in ("doc_id", "tag")]
    kinds = dict(places.dtypes)
    listed = places.groupBy("doc_id", "tag").agg(F.collect_list(F.struct(*others)).alias("places"))
    schema = ", ".join(f"{c} {kinds[c]}" for c in others) + ", body binary"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = texts.flat(batch.column(0))
        listed = batch.column(1)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
        flat = listed.flatten()
        columns = [flat.field(c) for c in others]
        begin = offsets[owner] + columns[others.index("start")].to_numpy()
        ends = begin + columns[others.index("n")].to_numpy() + window - 1
        body = memoryview(data)
        bodies = [bytes(body[i:j]) for i, j in zip(begin.tolist(), ends.tolist(), strict=True)]
        cut = texts.batch_of((*others, "body"), *columns, pa.array(bodies, pa.binary()))
        yield from each(cut) if each else [cut]

    same = rows.doc_id.eqNullSafe(listed.doc_id) & (rows.tag == listed.tag)
    return texts.map_arrow(rows.join(listed, same).select(rows.text, "places"), run, made or schema)


def _variants(shared: DataFrame) -> DataFrame:
    """Different pieces of each key: how often each occurs, and one place of it."""
    place = F.struct("doc_id", "tag", "start", "n")
    found = shared.groupBy("key", "content").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("at"))
    return found.select("key", "content", F.least("times", F.lit(2).cast("bigint")).cast("int").alias("times"), "at.*")


def _windows_of(rows: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """Each window of the given places as a piece of its own, keyed by its hash."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rolling = texts.RollingHash(MAX_RUN + window)
        for owner, content, times, doc_id, tag, start, n, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = np.frombuffer(body, np.uint8)
            keys = rolling.of(data, window).view(np.int64)
            inner = [xxhash.xxh3_64_intdigest(body[i : i + window]) for i in range(n)]
            same = [pa.array([v] * n, k) for v, k in ((owner, pa.int64()), (content, pa.int64()), (times, pa.int32()), (doc_id, pa.int64()), (tag, pa.int64()))]
            yield texts.batch_of(
                ("owner", "content", "times", "doc_id", "tag", "start", "first", "key", "inner"),
                *same, np.arange(start, start + n, dtype=np.int32), np.arange(n, dtype=np.int32),
                keys, np.array(inner, np.uint64).view(np.int64),
            )

    asked = places.select("doc_id", "tag", "owner", "content", "times", F.col("doc_id").alias("id"), F.col("tag").alias("own_tag"), "start", "n")
    schema = "owner bigint, content bigint, times int, doc_id bigint, tag bigint, start int, first int, key bigint, inner bigint"
    return _cut_bodies(_marked(rows, places), asked, window, run, schema)


def find_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tag, text) rows, and (doc_id, tag, first, until): byte spans in which every byte repeats.

    ``tag`` is a hash of the text. Spans of one row may touch or overlap.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram lies inside a window")
    whole = texts.whole_text(text)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), texts.tag_of(text).alias("tag"), whole.alias("text")
    )
    long = rows.where(F.octet_length("text") >= window)
    shared = shared_pieces(pieces(long, window, gram))
    variants = staged(_variants(shared), "variants")
    sized = (F.col("n") + F.lit(window)) * F.col("times")
    large = staged(
        variants.groupBy("key").agg(F.sum(sized).alias("size")).where(F.col("size") > bucket_bytes).select("key"), "large-keys"
    )
    named = variants.withColumns({"owner": F.col("key"), "first": F.lit(0)})
    whole_keys = named.join(large, "key", "left_anti").withColumn("deal", F.col("key"))
    # a large key: equal pieces among themselves, then each window under its own hash
    split = named.join(large, "key", "left_semi")
    alike = split.where("times > 1").withColumn("deal", F.xxhash64("key", "content"))
    places = whole_keys.unionByName(alike)
    if not large.isEmpty():
        windows = _windows_of(long, staged(split.drop("key"), "split"), window).dropDuplicates(["owner", "content", "first"])
        windows = staged(windows, "windows")
        found = shared_pieces(windows.withColumn("weight", F.lit(1)))
        two = found.groupBy("key", "inner").agg(F.sum("times").alias("sum"), F.min(F.struct("doc_id", "tag", "start")).alias("at"))
        witness = two.select(
            F.lit(1).alias("n"), F.least(F.col("sum"), F.lit(2)).cast("int").alias("times"), "at.*",
            F.col("key"), F.col("key").alias("owner"), F.col("inner").alias("content"), F.lit(-1).alias("first"),
            F.xxhash64("key").alias("deal"),
        )
        places = places.unionByName(witness)
    bodies = _cut_bodies(long, places.drop("key"), window)
    total = places.agg(F.sum(sized)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    runs = (
        bodies.select(F.pmod("deal", F.lit(buckets)).alias("bucket"), "owner", "content", "first", "n", "times", "body")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "owner", "content", "first")
        .mapInArrow(_sort_buckets(window), RUNS)
    )
    runs = staged(runs, "runs")
    spans = _back(shared, runs.where("first >= 0"), window)
    if not large.isEmpty():
        hit = runs.where("first < 0").select(F.col("owner").alias("key"), F.col("content").alias("inner")).distinct()
        single = found.join(hit, ["key", "inner"]).select("owner", "content", "first")
        spans = spans.union(_back(shared, _consecutive(single), window))
    return rows, spans


def _consecutive(windows: DataFrame) -> DataFrame:
    """Single windows of a piece, at most ``MAX_RUN``, as runs."""
    order = Window.partitionBy("owner", "content").orderBy("first")
    island = windows.withColumn("island", F.col("first") - F.row_number().over(order))
    runs = island.groupBy("owner", "content", "island").agg(F.min("first").alias("first"), (F.max("first") + 1).alias("until"))
    return runs.drop("island")


def _back(shared: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """Runs of windows of a piece as byte spans of every row that holds the piece."""
    return shared.join(runs.withColumnRenamed("owner", "key"), ["key", "content"]).select(
        "doc_id", "tag", (F.col("start") + F.col("first")).alias("first"),
        (F.col("start") + F.col("until") + F.lit(window - 1)).alias("until"),
    )


def _merged(first: np.ndarray, until: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` bytes lie in a span."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, until, -1)
    return np.cumsum(edge[:-1]) > 0


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with the list of their spans, NULL where there are none."""
    listed = spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("first", "until")).alias("spans"))
    listed = listed.select(F.col("doc_id").alias("span_id"), F.col("tag").alias("span_tag"), "spans")
    same = rows.doc_id.eqNullSafe(listed.span_id) & (rows.tag == listed.span_tag)
    return rows.join(listed, same, "left").drop("span_id", "span_tag")


def cut_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = None, **options
) -> DataFrame:
    """The rows, with all columns, without the repeated bytes of their text.

    A cut may fall inside a character; its remaining bytes go too. NULL stays NULL and a text
    may become empty. ``length`` names a column that counts the characters of the text.
    """
    _, spans = find_repeats(docs, doc_id, text, **options)
    names = texts.free_names(docs, "row_id", "row_tag", "spans")
    keyed = docs.withColumns({names[0]: F.col(doc_id).cast("bigint"), names[1]: texts.tag_of(text)})
    listed = spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("first", "until")).alias(names[2]))
    listed = listed.select(F.col("doc_id").alias("span_of_id"), F.col("tag").alias("span_of_tag"), names[2])
    same = keyed[names[0]].eqNullSafe(listed.span_of_id) & (keyed[names[1]] == listed.span_of_tag)
    joined = keyed.join(listed, same, "left").select(*[keyed[c] for c in docs.columns], listed[names[2]])
    kept_columns = docs.columns
    at = docs.columns.index(text)
    counted = None if length is None else docs.columns.index(length)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        given = batch.column(at)
        left = [
            body[~gone].tobytes().decode("utf-8", "ignore") if had else None
            for (body, gone), had in zip(_each_mask(given, batch.column(batch.num_columns - 1)), given.is_valid().to_pylist(), strict=True)
        ]
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(left, pa.string())
        if counted is not None:
            columns[counted] = pa.array([None if t is None else len(t) for t in left]).cast(columns[counted].type)
        return pa.RecordBatch.from_arrays(columns, kept_columns)

    return texts.map_arrow(joined, run, docs.schema, text, done=texts.release)


def _each_mask(text: pa.Array, spans: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, offsets = texts.flat(text)
    for i in range(len(text)):
        body = data[offsets[i] : offsets[i + 1]]
        own = spans[i]
        if own.is_valid:
            flat = own.values
            yield body, _merged(flat.field(0).to_numpy(), flat.field(1).to_numpy(), len(body))
        else:
            yield body, np.zeros(len(body), bool)


REPORT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: bytes, bytes and maximal runs removed, the rest and its SHA-256."""
    rows, spans = find_repeats(docs, doc_id, text, **options)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for body, gone in _each_mask(batch.column(1), batch.column(2)):
            kept = body[~gone].tobytes()
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
            out.append((len(body), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        n_bytes, n_removed, n_spans, digest, kept = zip(*out, strict=True)
        return texts.batch_of(
            ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"),
            batch.column(0), pa.array(n_bytes), pa.array(n_removed), pa.array(n_spans), pa.array(digest), pa.array(kept, pa.binary()),
        )

    return texts.map_arrow(_with_spans(rows, spans).select("doc_id", "text", "spans"), run, REPORT)
