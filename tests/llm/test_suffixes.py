import hashlib
import random

import numpy as np
import pytest
from llm_cases import EDGE_ROWS, documents, prose, table
from pyspark.sql import functions as F

from tablehaul.llm import queries, suffixes, texts


def expected(rows, window=200):
    bodies = [(t or "").encode() for _, t in rows]
    seen = {}
    for d, body in enumerate(bodies):
        for i in range(len(body) - window + 1):
            seen.setdefault(body[i : i + window], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in bodies]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + window] = True
    out = []
    for (doc_id, _), body, g in zip(rows, bodies, gone, strict=True):
        kept = np.frombuffer(body, np.uint8)[~g].tobytes()
        runs = int(np.sum(g & ~np.concatenate(([False], g[:-1])))) if len(g) else 0
        out.append((doc_id, len(body), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def same(df, want):
    got = [tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    same(queries.op9_two_stage_suffixes(spark, "/root/testdata/sf0.001"), expected(rows))


def test_edge_rows(spark):
    docs = documents(spark, EDGE_ROWS, "tag string, start int, kept string")
    same(suffixes.dedup_report(docs), expected(EDGE_ROWS))
    assert suffixes.dedup_report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 60])
def test_short_windows_and_split_keys(spark, bucket_bytes):
    """A tiny alphabet gives many repeats; tiny buckets force every key through the split by window."""
    pick = random.Random(11)
    passage = "".join(pick.choice("abcd") for _ in range(40))
    rows = [(i, "".join(pick.choice("abcdefgh") for _ in range(25)) + passage[: pick.randint(5, 40)] + "xyz" * pick.randint(0, 6)) for i in range(60)]
    rows += [(100, "\0" * 30), (101, "\0a" * 20), (102, rows[0][1]), (102, rows[0][1])]
    docs = documents(spark, rows)
    same(suffixes.dedup_report(docs, window=12, gram=4, bucket_bytes=bucket_bytes), expected(rows, 12))


def test_two_stage_order():
    pick = random.Random(2)
    body = bytes(pick.choice(b"abc") for _ in range(3000)) + b"c" * 300 + b"\0"
    t = np.frombuffer(body, np.uint8).astype(np.int16) + np.int16(1)
    t[-1] = 0
    order = suffixes.two_stage_sort(t, np.ones(len(t), bool), body, 4000)
    assert order.tolist() == sorted(range(len(body)), key=lambda i: body[i:])
    prefix = suffixes.common_prefixes(body, order[:-1], order[1:], 50)
    for i, j, n in zip(order[:-1].tolist(), order[1:].tolist(), prefix.tolist(), strict=True):
        a, b = body[i : i + 50], body[j : j + 50]
        common = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert min(n, common) == common


def test_cut_repeats_keeps_columns(spark):
    rows = [(1, prose(1, 100) + " é" * 200), (2, "é" + prose(1, 100)), (3, None), (4, "short"), (None, "é" * 500)]
    docs = documents(spark, rows, "spans int, row_id string")
    got = suffixes.cut_repeats(docs, length="n_chars")
    assert got.columns == docs.columns and got.schema == docs.schema
    report = {r.doc_id: r for r in suffixes.dedup_report(docs).collect()}
    for r in got.collect():
        if r.text is not None:
            assert r.text == bytes(report[r.doc_id].kept).decode("utf-8", "ignore") and r.n_chars == len(r.text)
    assert {r.doc_id for r in got.where("text IS NULL").collect()} == {3}


def test_batches_cut_alike(monkeypatch):
    """Slabs that end inside texts give the same windows as one slab."""
    body = prose(1, 3000).encode()
    data, offsets = np.frombuffer(body, np.uint8), np.array([0, 0, 700, 705, len(body)])
    cover = []
    for slab in (1 << 20, 1000):
        monkeypatch.setattr(suffixes, "SLAB_BYTES", slab)
        rolling = texts.RollingHash(slab + 200)
        windows = {}
        for part in suffixes.cut_pieces(data, offsets, 200, 32, rolling):
            for row, start, n, h, _, _ in zip(*(c.tolist() for c in part), strict=True):
                windows |= {(row, start + i): h for i in range(n)}
        cover.append(windows)
    assert cover[0] == cover[1]
    assert set(cover[0]) == {(r, i) for r in range(4) for i in range(offsets[r + 1] - offsets[r] - 199)}


def test_windows_need_one_worker_and_few_texts(spark):
    """Texts without a split piece are not shuffled, and cutting a piece and its windows takes one Python worker a task."""
    docs = documents(spark, [(i, prose(i, 60)) for i in range(500)] + [(None, prose(600, 60)), (3, prose(601, 60))])
    rows = docs.select("doc_id", texts.tag_of("text").alias("tag"), "text")
    places = rows.where("doc_id IN (3, 4) OR doc_id IS NULL").select(
        "doc_id", "tag", F.lit(0).alias("start"), F.lit(2).alias("n"), F.lit(7).cast("bigint").alias("owner"),
        F.lit(8).cast("bigint").alias("content"), F.lit(1).alias("times"),
    )
    few = [r.doc_id for r in suffixes._marked(rows, places).collect()]
    assert len(few) < 10 and sorted(i for i in few if i in (3, 4)) == [3, 3, 4] and None in few
    windows = suffixes._windows_of(rows, places, 20)
    assert sorted((r.doc_id or 0, r.first) for r in windows.collect()) == [(0, 0), (0, 1), (3, 0), (3, 0), (3, 1), (3, 1), (4, 0), (4, 1)]
    assert windows._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
