"""Token ids in binary shards, with a minimal perfect hash index from document key to place.

A written folder holds

* ``shard-N.ids``: 16 bytes of head (``TOKIDS01``, bytes per id, 0; the numbers little-endian unsigned
  32-bit), then the ids of documents in ascending id order, little-endian unsigned, 2 bytes each if the vocabulary allows
  and else 4. Shards follow each other in id order too.
* ``index-P.npz``: for the keys of one hash part, the levels of a minimal perfect hash (bits, and set
  bits before each word) and one record per key in slot order: key fingerprint, shard, first id, number of ids.
* ``manifest``: Parquet, one row per shard: documents, ids, and ids in earlier shards.

A key is a document id and a copy number, so repeated ids keep all their rows: copies are
numbered from 0 in the order of their ids' bytes. A NULL id is a key too and sorts first. NULL text counts as
empty, and has the end id alone. An empty table writes an empty manifest. Other columns play no part.

Looking a key up takes the hash of one level or a few, one rank, and one record; a fingerprint that
differs says the key is not there. Files are written under a name of their own and then
renamed, with the same bytes on each attempt, so a task that runs again does no harm.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from tablehaul.llm import texts, tokens

END_ID = 2
MAGIC = b"TOKIDS01"
HEAD = 16
SHARD_BYTES = 32 << 20  # text bytes of a shard, about
PART_KEYS = 500_000  # keys of an index part, about
ROOM = 2.0  # bits of a level per key
MAX_LEVELS = 48


# minimal perfect hash


def _key_hash(ids: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        salted = texts.mix(ids.astype(np.uint64) + texts.mix(np.full(1, seed, np.uint64))[0])
        return texts.mix(salted ^ (copies.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed)))


def fingerprint(ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
    return _key_hash(ids, copies, 0xF1A6)


class PerfectHash:
    """Levels of bits: a key's bit is set on the first level where no other key left falls on the same.

    The number of set bits before it, over all levels, is the key's slot. Keys still left after ``MAX_LEVELS``
    come last, in order.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray, rest: np.ndarray):
        self.sizes, self.words, self.rest = sizes, words, rest
        self.begin = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.total = int(ones.sum())

    @classmethod
    def build(cls, ids: np.ndarray, copies: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [], np.arange(len(ids))
        for level in range(MAX_LEVELS):
            if not len(left):
                break
            size = max(64, -(-int(len(left) * ROOM) // 64) * 64)
            at = (_key_hash(ids[left], copies[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        rest = np.stack([ids[left], copies[left]], axis=1).astype(np.int64)
        words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        return cls(np.array(sizes, np.int64), words, rest)

    def slots(self, ids: np.ndarray, copies: np.ndarray) -> np.ndarray:
        """Slot of each key. A key that was not given to ``build`` gets any slot, or -1."""
        out = np.full(len(ids), -1, np.int64)
        left = np.arange(len(ids))
        for level, (size, begin) in enumerate(zip(self.sizes.tolist(), self.begin.tolist(), strict=True)):
            if not len(left):
                break
            at = begin + (_key_hash(ids[left], copies[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            lower = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(lower)
            out[left[hit]] = rank[hit]
            left = left[~hit]
        for i in left.tolist():
            same = np.flatnonzero((self.rest[:, 0] == ids[i]) & (self.rest[:, 1] == copies[i]))
            if len(same):
                out[i] = self.total + int(same[0])
        return out


# files


def _open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _commit(uri: str, body: bytes) -> None:
    """Whole file at once, or not at all."""
    store, path = _open_fs(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(body)
    store.move(own, path)


class ShardWriter:
    """One shard, written as rows come; nothing of it is held."""

    def __init__(self, uri: str, width: int):
        self.store, self.path = _open_fs(uri)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.own)
        self.out.write(MAGIC + np.array([width, 0], "<u4").tobytes())

    def commit(self) -> None:
        self.out.close()
        self.store.move(self.own, self.path)


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:07d}.ids"


def index_name(folder: str, part: int) -> str:
    return f"{folder}/index-{part:07d}.npz"


# writing


def _cuts(docs: DataFrame, doc_id: str, text: str, shard_bytes: int) -> tuple[list[int], int]:
    """Ids at which shards begin, and the number of documents. One row, and one id per shard, reach the driver."""
    facts = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(texts.whole_text(text)))).first()
    shards = max(1, -(-int(facts[1] or 0) // shard_bytes))
    if shards == 1:
        return [], facts[0]
    ids = docs.select(F.col(doc_id).cast("bigint").alias("id")).where("id IS NOT NULL")
    wanted = [i / shards for i in range(1, shards)]
    found = ids.agg(F.percentile_approx("id", wanted, 20 * shards)).first()[0]
    return sorted(set(found or [])), facts[0]


def _encoded(docs: DataFrame, tokenizer: str, doc_id: str, text: str, cuts: list[int], end_id: int, width: int) -> DataFrame:
    """(doc_id, shard, ids) without a shuffle."""
    bounds = np.array(cuts, np.int64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = tokens.encoder(tokenizer).encode(*texts.flat(batch.column(1)))
        if len(ids) and int(ids.max()) >> (8 * width):
            raise ValueError(f"ids do not fit {width} bytes")
        own = [np.append(ids[i:j], end_id).astype(f"<u{width}").tobytes() for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        keys = batch.column(0)
        shard = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(), "right").astype(np.int32)
        return texts.batch_of(("doc_id", "shard", "ids"), keys, shard, pa.array(own, pa.binary()))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), texts.whole_text(text).alias("text"))
    return texts.map_arrow(rows, run, "doc_id bigint, shard int, ids binary", done=lambda: tokens.end_task(tokenizer), limit=tokens.BATCH_BYTES)


RECORDS = "doc_id bigint, copy int, shard int, first bigint, n bigint"


def _write_shards(folder: str, width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = writer = None
        first, last, copy = 0, None, -1
        for batch in batches:
            out = []
            for doc_id, number, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != shard:
                    if writer:
                        writer.commit()
                    shard, writer = number, ShardWriter(shard_name(folder, number), width)
                    first, last, copy = 0, None, -1
                copy = copy + 1 if (doc_id,) == last else 0
                last = (doc_id,)
                writer.out.write(ids)
                out.append((doc_id, copy, shard, first, len(ids) // width))
                first += len(ids) // width
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            if columns:
                yield texts.batch_of(("doc_id", "copy", "shard", "first", "n"), *columns)
        if writer:
            writer.commit()

    return task


def _hash_ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers to hash; NULL has a number of its own, told apart by ``copy`` below zero."""
    return column.fill_null(0).to_numpy().astype(np.int64)


def _hash_copies(ids: pa.Array, copies: pa.Array) -> np.ndarray:
    copy = copies.to_numpy().astype(np.int64)
    return np.where(ids.is_null().to_numpy(zero_copy_only=False), -1 - copy, copy)


def _write_index(folder: str):
    def finish(part: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        ids, copies = _hash_ids(column["doc_id"]), _hash_copies(column["doc_id"], column["copy"])
        perfect = PerfectHash.build(ids, copies)
        slot = perfect.slots(ids, copies)
        order = np.empty(len(slot), np.int64)
        order[slot] = np.arange(len(slot))
        body = io.BytesIO()
        np.savez(
            body, sizes=perfect.sizes, words=perfect.words, rest=perfect.rest,
            fingerprint=fingerprint(ids, copies)[order], shard=column["shard"].to_numpy()[order].astype("<u4"),
            first=column["first"].to_numpy()[order].astype("<u8"), n=column["n"].to_numpy()[order].astype("<u4"),
        )
        _commit(index_name(folder, part), body.getvalue())
        return texts.batch_of(("part", "keys"), pa.array([part], pa.int32()), pa.array([len(slot)], pa.int64()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            parts = batch.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [len(parts)])).tolist()
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i < j:
                    if held and parts[i] != part:
                        yield finish(int(part), held)
                        held = []
                    part = parts[i]
                    held.append(batch.slice(i, j - i))
        if held:
            yield finish(int(part), held)

    return task


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    width: int = 2,
    shard_bytes: int = SHARD_BYTES,
    part_keys: int = PART_KEYS,
) -> int:
    """Write shards, index and manifest to a new shared ``folder``; returns the number of index parts.

    One shuffle, of ids. ``width`` is the bytes of an id.
    """
    spark = docs.sparkSession
    store, path = _open_fs(folder)
    store.create_dir(path)
    cuts, n_docs = _cuts(docs, doc_id, text, shard_bytes)
    records = f"{folder}/records"
    (
        _encoded(docs, tokenizer, doc_id, text, cuts, end_id, width)
        .repartitionById(len(cuts) + 1, F.col("shard"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
        .mapInArrow(_write_shards(folder, width), RECORDS)
        .write.parquet(records)
    )
    written = spark.read.schema(RECORDS).parquet(records)
    per_shard = written.groupBy("shard").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("ids"))
    # one row per shard
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard.withColumn("before", F.coalesce(F.sum("ids").over(earlier), F.lit(0))).write.parquet(f"{folder}/manifest")
    parts = max(1, -(-n_docs // part_keys))
    (
        written.select(_part(parts), "doc_id", "copy", "shard", "first", "n")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_write_index(folder), "part int, keys bigint")
        .write.parquet(f"{folder}/parts")
    )
    return parts


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")


# reading


class IndexPart:
    """One part of the index, in memory."""

    def __init__(self, folder: str, part: int):
        store, path = _open_fs(index_name(folder, part))
        with store.open_input_stream(path) as source:
            kept = np.load(io.BytesIO(source.read()))
        self.perfect = PerfectHash(kept["sizes"], kept["words"], kept["rest"])
        self.prints, self.shard, self.first, self.n = kept["fingerprint"], kept["shard"], kept["first"], kept["n"]

    def find(self, ids: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(record of each key, whether it is there)."""
        slot = self.perfect.slots(ids, copies)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprint(ids[known], copies[known])
        return slot, known


class ShardReader:
    """Random access to the ids of a folder's shards, one open at a time."""

    def __init__(self, folder: str):
        self.folder, self.shard, self.source, self.width = folder, None, None, 0

    def ids(self, shard: int, first: int, n: int) -> np.ndarray:
        if shard != self.shard:
            self.close()
            store, path = _open_fs(shard_name(self.folder, shard))
            self.source, self.shard = store.open_input_file(path), shard
            head = self.source.read(HEAD)
            if head[:8] != MAGIC:
                raise ValueError(f"{path} is not a shard of ids")
            self.width = int(np.frombuffer(head[8:12], "<u4")[0])
        self.source.seek(HEAD + first * self.width)
        return np.frombuffer(self.source.read(n * self.width), f"<u{self.width}").astype("<u4")

    def close(self) -> None:
        if self.source:
            self.source.close()


def read_tokens(spark: SparkSession, folder: str, keys: DataFrame, parts: int, with_ids: bool = False) -> DataFrame:
    """Of each (doc_id, copy) key that is there: place, ids read, their CRC-32 as 32-bit ids, and the ids if wanted.

    Keys go to the task of their index part, are looked up there, and are read in shard order.
    """
    names = ["doc_id", "copy", "shard", "first", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id bigint, copy int, shard int, first bigint, n_tokens bigint, ids_crc32 bigint" + (", ids binary" if with_ids else "")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, index, reader = None, None, ShardReader(folder)
        for batch in batches:
            column = batch.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [len(column)])).tolist()
            for i, j in zip(cuts, cuts[1:], strict=False):
                if i == j:
                    continue
                if column[i] != number:
                    number, index = column[i], IndexPart(folder, int(column[i]))
                ids, copies = batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i)
                slot, known = index.find(_hash_ids(ids), _hash_copies(ids, copies))
                at = np.flatnonzero(known)
                at = at[np.lexsort((index.first[slot[at]], index.shard[slot[at]]))]
                record = slot[at]
                shard, first, n = index.shard[record], index.first[record], index.n[record]
                read = (reader.ids(s, f, k) for s, f, k in zip(shard.tolist(), first.tolist(), n.tolist(), strict=True))
                bodies = []
                crc = []
                for own in read:
                    crc.append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        bodies.append(own.tobytes())
                columns = [
                    ids.take(pa.array(at)), copies.take(pa.array(at)), shard.astype(np.int32),
                    first.astype(np.int64), n.astype(np.int64), pa.array(crc, pa.int64()),
                ]
                yield texts.batch_of(names, *columns, *([pa.array(bodies, pa.binary())] if with_ids else []))
        reader.close()

    dealt = keys.select(_part(parts), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("copy").cast("int").alias("copy"))
    found = dealt.repartition("part").sortWithinPartitions("part").mapInArrow(task, schema)
    manifest = spark.read.parquet(f"{folder}/manifest").select("shard", "before")
    return found.join(manifest, "shard").withColumn("start", F.col("before") + F.col("first")).drop("before")


def keys_of(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, copy) of all rows: the ids that a table holds, numbered where they repeat."""
    counted = docs.groupBy(F.col(doc_id).cast("bigint").alias("doc_id")).agg(F.count(F.lit(1)).alias("rows"))
    copies = F.explode(F.sequence(F.lit(0), (F.col("rows") - 1).cast(T.IntegerType())))
    return counted.select("doc_id", copies.alias("copy"))
