import gzip
import hashlib
import io
import random
import zlib

import pyarrow as pa
import pytest
from llm_cases import prose, sql_connection, table
from pyarrow import fs as pafs

from tablehaul.llm import queries, warc
from tablehaul.sources.files import fresh_path

LONG = prose(1, 60)
ROWS = [
    (1, "http://a/1", LONG), (2, "http://a/2", LONG), (2, "http://a/0", LONG), (1, "http://b", LONG), (1, "http://c", "short"),
    (3, None, "short"), (4, "x\r\ny", None), (5, "u", ""), (None, "u", LONG), (None, "v", prose(2, 80)), (None, "w", prose(2, 80)),
    (6, "é漢", "é" * 49), (7, "é", "é" * 50), (8, "é", "é" * 50), (9, "big", prose(3, 60_000)),
    (10, "g", "\x1f\x08 WARC/1.1\r\n\r\nWARC-Type: response\r\n"), (0, "late", LONG),
]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))
    seen, out = {}, []
    for page, _, text in rows:
        body = (text or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and digest in seen
        seen.setdefault(digest, page)
        out.append((page, len(body), digest, "revisit" if again else "response", seen[digest] if again else None))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS digest", "1 AS page").repartition(3)


def read_back(spark, folder, split):
    return warc.read_warc(spark, folder, split).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()


def test_query_matches_sql(spark):
    df = queries.op8_splittable_warc(spark, "/root/testdata/sf0.001")
    sql = sql_connection().sql(queries.ORACLE_SQL["op8_splittable_warc"])
    assert sorted(df.columns) == sorted(sql.columns)
    assert sorted(map(tuple, df.select(*sql.columns).collect()), key=key) == sorted(sql.fetchall(), key=key)


def test_edge_rows_at_any_split(spark):
    folder = fresh_path(spark, "warc")
    assert warc.write_warc(frame(spark, ROWS), folder) == len(ROWS)
    for split in (37, 1000, 1 << 20):
        assert sorted(map(tuple, read_back(spark, folder, split)), key=key) == sorted(expected(ROWS), key=key)
    payloads = {(r.page_id, r.url): bytes(r.payload).decode() for r in warc.read_warc(spark, folder).where("payload IS NOT NULL").collect()}
    assert payloads[(9, "big")] == ROWS[14][2] and payloads[(4, "x%0D%0Ay")] == ""


def test_empty_table(spark):
    folder = fresh_path(spark, "warc")
    assert warc.write_warc(frame(spark, ROWS).limit(0), folder) == 0
    assert warc.read_warc(spark, folder).count() == 0


def test_archives_are_plain_gzip(spark):
    folder = fresh_path(spark, "warc")
    pages = table(spark, "pages")
    warc.write_warc(pages, folder)
    store, base = pafs.FileSystem.from_uri(folder)
    heads = 0
    for info in store.get_file_info(pafs.FileSelector(base)):
        if info.path.endswith(".warc.gz"):
            with store.open_input_file(info.path) as f:
                heads += gzip.GzipFile(fileobj=io.BytesIO(f.read())).read().count(b"WARC/1.1\r\nWARC-Type: ")
    assert heads == pages.count()


@pytest.mark.parametrize("seed", range(5))
def test_false_magic_is_passed_over(seed):
    """Magic bytes inside members, junk between them, and members that are no records."""
    pick = random.Random(seed)
    bodies, data, places = [], b"", []
    for i in range(30):
        junk = pick.choice([b"", b"\x1f\x8b", b"\x1f\x8b\x08", b"\x1f\x8b\x08\x00junk", gzip.compress(b"no record", mtime=0)])
        data += junk
        payload = pick.randbytes(pick.randint(0, 300)) + b"\x1f\x8b\x08" * pick.randint(0, 3)
        body = warc.record(i, "u", payload, hashlib.sha256(payload).hexdigest(), 0, None, "d")
        places.append(len(data))
        bodies.append(body)
        data += gzip.compress(body, pick.choice([0, 6]), mtime=0)
    for size in (1, 50, 997, len(data)):
        got = []
        for at in range(0, len(data), size):
            got += warc.RangeReader(pa.BufferReader(data), at, min(at + size, len(data))).records()
        assert got == list(zip(places, bodies, strict=True))


def damaged(spark, change, keep_list=False):
    """A folder of one archive of 250 records with its bytes changed."""
    folder = fresh_path(spark, "warc")
    rows = [(i, f"http://a/{i}", prose(i, 40)) for i in range(250)]
    assert warc.write_warc(spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1), folder) == 250
    store, base = pafs.FileSystem.from_uri(folder)
    paths = [f.path for f in store.get_file_info(pafs.FileSelector(base)) if f.path.endswith(".warc.gz")]
    path = max(paths, key=lambda p: store.get_file_info(p).size)
    with store.open_input_file(path) as source:
        body = change(source.read())
    if body is None:
        store.delete_file(path)
    else:
        with store.open_output_stream(path, compression=None) as out:
            out.write(body)
    if not keep_list:
        store.delete_file(f"{base}/{warc.LIST}")
    return folder


def member_starts(body):
    starts, at = [], 0
    while at < len(body):
        starts.append(at)
        decoder = zlib.decompressobj(31)
        decoder.decompress(body[at:])
        at = len(body) - len(decoder.unused_data)
    return starts


def flipped(at):
    return lambda body: body[:at] + bytes([body[at] ^ 0x55]) + body[at + 1 :]


@pytest.mark.parametrize("split", [700, 5000, 1 << 20])
@pytest.mark.parametrize(
    "change",
    [
        lambda b: b[:-200],
        lambda b: b[: member_starts(b)[-1] + 5],
        lambda b: flipped(len(b) // 2)(b),
        lambda b: flipped(member_starts(b)[7])(b),
        lambda b: flipped(member_starts(b)[0] + 2)(b),
        lambda b: flipped(member_starts(b)[9] + 14)(b),
        lambda b: b[: member_starts(b)[20]] + b[member_starts(b)[20] + 3 :],
        lambda b: b[: member_starts(b)[30]] + b"junk" + b[member_starts(b)[30] :],
        lambda b: b + b"tail",
        lambda b: flipped(len(b) - 6)(b),
    ],
)
def test_damage_is_an_error(spark, change, split):
    """Cut, flipped, missing and foreign bytes, whether or not the list of files is there."""
    with pytest.raises(Exception, match="damaged|no record|ends in the middle"):
        warc.read_warc(spark, damaged(spark, change), split).collect()


@pytest.mark.parametrize("change", [lambda b: None, lambda b: b[:-200], lambda b: b[: member_starts(b)[-1]]])
def test_files_are_those_that_were_written(spark, change):
    """Also a file that is gone, or ends where a record ends."""
    with pytest.raises(warc.Damaged, match="missing, unknown or of another size"):
        warc.read_warc(spark, damaged(spark, change, keep_list=True))


@pytest.mark.parametrize("split", [100, 3000, 1 << 20])
def test_as_many_records_as_were_written(spark, split):
    folder = damaged(spark, lambda b: b, keep_list=True)
    assert warc.read_warc(spark, folder, split).count() == 250
