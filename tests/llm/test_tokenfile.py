import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import EDGE_ROWS, documents, prose, table
from tokenizers import Tokenizer

from tablehaul.llm import queries, tokenfile
from tablehaul.sources.files import fresh_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    encoded = [(i, np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")) for i, text in rows]
    encoded.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].astype("<u2").tobytes()))
    out, start = [], 0
    for i, ids in encoded:
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = queries.op6_perfect_hash_index(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(expected(rows))


@pytest.mark.parametrize(("shard_bytes", "part_keys"), [(1 << 20, 1000), (3000, 3)])
def test_edge_rows(spark, shard_bytes, part_keys):
    docs = documents(spark, EDGE_ROWS, "shard string, copy string, part int")
    folder = fresh_path(spark, "tokens")
    parts = tokenfile.write_tokens(docs, folder, PATH, shard_bytes=shard_bytes, part_keys=part_keys)
    found = tokenfile.read_tokens(spark, folder, tokenfile.keys_of(docs), parts, with_ids=True)
    got = [tuple(r) for r in found.select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=key) == sorted(expected(EDGE_ROWS), key=key)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in found.collect())


def test_wide_ids_and_missing_keys(spark):
    docs = documents(spark, EDGE_ROWS)
    folder = fresh_path(spark, "tokens")
    parts = tokenfile.write_tokens(docs, folder, PATH, width=4)
    keys = spark.createDataFrame([(7, 0), (7, 1), (1, 1), (999, 0), (None, 1), (None, 2)], "doc_id bigint, copy int")
    found = tokenfile.read_tokens(spark, folder, keys, parts)
    assert sorted(((r.doc_id, r.copy) for r in found.collect()), key=key) == [(None, 1), (1, 1), (7, 0)]
    with pytest.raises(Exception, match="do not fit"):
        tokenfile.write_tokens(docs, fresh_path(spark, "tokens"), PATH, width=1)


def test_empty_table(spark):
    docs = documents(spark, EDGE_ROWS).limit(0)
    folder = fresh_path(spark, "tokens")
    parts = tokenfile.write_tokens(docs, folder, PATH)
    assert tokenfile.read_tokens(spark, folder, tokenfile.keys_of(docs), parts).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1000, 40_000])
def test_perfect_hash_is_minimal(n):
    ids = np.random.default_rng(n).permutation(10 * n + 1)[:n].astype(np.int64) - n
    copies = np.arange(n) % 3
    perfect = tokenfile.PerfectHash.build(ids, copies)
    assert sorted(perfect.slots(ids, copies).tolist()) == list(range(n))
    assert int(perfect.sizes.sum()) <= 64 * 40 + 6 * n


def test_keys_left_after_all_levels(monkeypatch):
    monkeypatch.setattr(tokenfile, "MAX_LEVELS", 1)
    ids, copies = np.arange(500), np.zeros(500, np.int64)
    perfect = tokenfile.PerfectHash.build(ids, copies)
    assert len(perfect.rest) and sorted(perfect.slots(ids, copies).tolist()) == list(range(500))


def test_long_text_spans_batches(spark):
    rows = [(i, prose(i, 9000)) for i in range(12)]
    docs = documents(spark, rows)
    folder = fresh_path(spark, "tokens")
    parts = tokenfile.write_tokens(docs, folder, PATH, shard_bytes=100_000)
    got = tokenfile.read_tokens(spark, folder, tokenfile.keys_of(docs), parts)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == sorted(expected(rows))
