"""WARC archives: one gzip member per record, revisits for repeated payloads, and a splittable reader.

Writing. Pages with equal payloads of at least ``min_bytes`` share one ``response`` record, that of the smallest page id;
the others become ``revisit`` records without payload. A payload is the page's text in UTF-8 behind a
short HTTP head. Page id, and for revisits the payload's length and the id they refer to,
are extension fields of the record head. Record ids and dates do not depend on the attempt, so a task that runs again
writes the same bytes; files are renamed into place when whole.

Reading. Files are cut into byte ranges. A task looks for the gzip magic in its range, tries each place by
decoding what follows, takes it for a record if that begins as a WARC head, and reads on
behind the record. It owns the records that start in its range, and reads past the end to finish the last.

NULL payloads count as empty. A NULL page id is kept; among equal payloads it comes after all ids. Of rows that repeat an id and a
payload the first by URL is the response. An empty table writes no file and reads as
no rows. Other columns play no part.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablehaul.llm import texts

MIN_BYTES = 100
SPLIT_BYTES = 8 << 20
BLOCK_BYTES = 64 << 10
LEVEL = 6

# fixed values of the WARC 1.1 format
VERSION = b"WARC/1.1"
HEAD = b"WARC/1."
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# records


def record_id(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{copy}')}>"


def _field(value: str) -> str:
    """A head field's value on one line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, copy: int, refers_to: tuple | None, date: str) -> bytes:
    """One record. ``refers_to`` is None for a response, else the response's page id in a tuple."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest, copy),
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _field(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Page-ID": page_id,
        "X-Payload-Length": len(payload),
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to[0], digest, 0), "X-Refers-To-Page-ID": refers_to[0]}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(body: bytes) -> tuple[dict[str, str], bytes]:
    """Head fields and block."""
    head, _, rest = body.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    fields = {name: value for name, _, value in (line.partition(": ") for line in lines)}
    return fields, rest[: int(fields["Content-Length"])]


# Left by ``write_warc`` beside the archives: what it wrote.
LIST = "written.json"

# writing


def _with_types(pages: DataFrame, page_id: str, url: str, payload: str, min_bytes: int) -> DataFrame:
    """(page, page_id, url, payload, digest, response_id, shared): pages next to the response of their payload.

    Only ids and digests are grouped; each page's text moves once, to the task of its own id.
    """
    whole = texts.whole_text(payload)
    rows = pages.select(
        F.coalesce(F.col(page_id).cast("string"), F.lit("")).alias("page"), F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"), whole.alias("payload"), F.sha2(whole, 256).alias("digest"),
    )
    large = rows.where(F.octet_length("payload") >= min_bytes).select("page", "page_id", "digest")
    groups = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("response_id")).where("n > 1")
    shared = large.distinct().join(groups, "digest").select("page", "digest", "response_id", F.lit(True).alias("shared"))
    return rows.repartition("page", "digest").join(shared, ["page", "digest"], "left")


def _write(folder: str, date: str, level: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        path = f"{base}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        own, out, written, last, copy = f"{path}.{uuid.uuid4().hex}", None, 0, None, 0
        for batch in batches:
            for page_id, url, payload, digest, response, shared in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                copy = copy + 1 if (page_id, digest) == last else 0
                last = (page_id, digest)
                first = not shared or (page_id == response and copy == 0)
                out = out or store.open_output_stream(own)
                body = record(page_id, url, payload.encode(), digest, copy, None if first else (response,), date)
                out.write(gzip.compress(body, level, mtime=0))
                written += 1
        if out:
            out.close()
            store.move(own, path)
            yield texts.batch_of(("path", "records"), pa.array([path]), pa.array([written], pa.int64()))

    return task


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = MIN_BYTES,
    date: str = "2000-01-01T00:00:00Z",
    level: int = LEVEL,
) -> int:
    """Write a new shared ``folder`` of archives; returns the number of records."""
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base)
    typed = _with_types(pages, page_id, url, payload, min_bytes)
    files = (
        typed.sortWithinPartitions("page", "digest", F.col("url").asc_nulls_last())
        .select("page_id", "url", "payload", "digest", "response_id", F.coalesce("shared", F.lit(False)).alias("shared"))
        .mapInArrow(_write(folder, date, level), "path string, records bigint")
    )
    done = files.collect()  # one row per file
    sizes = {f.base_name: f.size for f in store.get_file_info([row.path for row in done])} if done else {}
    with store.open_output_stream(f"{base}/{LIST}") as out:
        out.write(json.dumps([{"file": row.path.rpartition("/")[2], "records": row.records, "bytes": sizes[row.path.rpartition("/")[2]]} for row in done]).encode())
    return sum(row.records for row in done)


def _listed(store: pafs.FileSystem, path: str) -> dict[str, int] | None:
    """Files and sizes as ``write_warc`` left them."""
    if store.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    with store.open_input_file(path) as source:
        return {f["file"]: f["bytes"] for f in json.loads(source.read())}


# reading


class Damaged(ValueError):
    """An archive does not hold the records that were written."""


class RangeReader:
    """Records of one file that start in a byte range.

    With ``strict``, records lie one behind the other: where one ends the next begins, or the file ends. The reader of a record checks the
    place behind it, in its range or beyond, and the reader of a file's first byte checks that place, so whatever is broken is
    seen by one of them. Otherwise other bytes may lie between records.
    """

    def __init__(self, source: pa.NativeFile, start: int, end: int, file: str = "", strict: bool = False):
        self.source, self.at, self.end, self.file, self.strict = source, start, end, file, strict
        self.size = source.size()

    def _next_magic(self) -> int | None:
        """First place from here on, in the range, that looks like a gzip member."""
        at = self.at
        while at < self.end:
            self.source.seek(at)
            block = self.source.read(BLOCK_BYTES)
            found = block.find(MAGIC)
            if found >= 0:
                return at + found if at + found < self.end else None
            if len(block) < BLOCK_BYTES:
                return None
            at += len(block) - len(MAGIC) + 1
        return None

    def _member(self, at: int, whole: bool = True) -> tuple[bytes, int] | None:
        """Content and end of the member at a place, or None if none with a WARC head starts there; just its head if not ``whole``.

        What breaks off or does not decode behind such a head is damage.
        """
        self.source.seek(at)
        decoder, parts, begun, read = zlib.decompressobj(31), [], False, 0
        try:
            while not decoder.eof:
                block = self.source.read(BLOCK_BYTES)
                if not block:
                    if begun:
                        raise Damaged(f"{self.file} ends in the middle of the record at {at}")
                    return None
                read += len(block)
                parts.append(decoder.decompress(block))
                if not begun:
                    head = b"".join(parts)[: len(HEAD)]
                    if head != HEAD[: len(head)]:
                        return None
                    begun = len(head) == len(HEAD)
                    if begun and not whole:
                        return b"", at
        except zlib.error as broken:
            if begun:
                raise Damaged(f"{self.file} is damaged in the record at {at}: {broken}") from broken
            return None
        return (b"".join(parts), at + read - len(decoder.unused_data)) if begun else None

    def _must_begin(self, at: int) -> None:
        if self.strict and at < self.size and self._member(at, whole=False) is None:
            raise Damaged(f"{self.file} has no record at {at}, where one must begin")

    def records(self) -> Iterator[tuple[int, bytes]]:
        """(place, content) of each record."""
        if self.at == 0:
            self._must_begin(0)
        while (place := self._next_magic()) is not None:
            found = self._member(place)
            if found is None:
                self.at = place + 1
            else:
                body, self.at = found
                self._must_begin(self.at)
                yield place, body


RECORDS = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary, file string, place bigint"
)


def _row(body: bytes, file: str, place: int) -> tuple:
    fields, block = parse_record(body)

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    digest, payload, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), None, number("X-Payload-Length")
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise Damaged(f"{file} is damaged in the record at {place}: its payload has another digest")
    return (
        number("X-Page-ID"), fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest,
        number("X-Refers-To-Page-ID"), payload, file, place,
    )


def read_warc(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, strict: bool = True) -> DataFrame:
    """All records of a folder's archives, read by byte ranges. One row per range is made on the driver.

    Damage is an error: a record that breaks off or does not decode, a gap between records, a payload with another digest, and, where
    ``write_warc`` left its list, a file that is missing, unknown or of another size. Not ``strict``, other bytes may lie between records.
    """
    store, base = pafs.FileSystem.from_uri(folder)
    files = [f for f in store.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".warc.gz")]
    written = _listed(store, f"{base}/{LIST}")
    if written is not None and {f.base_name: f.size for f in files} != written:
        found = {f.base_name: f.size for f in files}
        wrong = sorted(n for n in found.keys() | written.keys() if found.get(n) != written.get(n))
        raise Damaged(f"{folder}: files are missing, unknown or of another size: {wrong[:5]}")
    ranges = [(f.path, at, min(at + split_bytes, f.size)) for f in files for at in range(0, f.size, split_bytes)]
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pafs.FileSystem.from_uri(folder)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return texts.batch_of(names, *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)))

        for given in batches:
            for _, path, start, end in zip(*(c.to_pylist() for c in given.columns), strict=True):
                with files.open_input_file(path) as source:
                    rows, held = [], 0
                    for place, body in RangeReader(source, start, end, path, strict).records():
                        rows.append(_row(body, path, place))
                        held += len(body)
                        if held > texts.BATCH_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield batch(rows)

    numbered = [(i, *r) for i, r in enumerate(ranges)]
    dealt = spark.createDataFrame(numbered, "id int, path string, start bigint, end bigint")
    return dealt.repartitionById(max(1, len(ranges)), F.col("id")).mapInArrow(task, RECORDS)
