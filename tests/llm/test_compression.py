import random
import re

import pytest
import zstandard
from llm_cases import EDGE_ROWS, documents, prose, table

from tablehaul.llm import compression, queries

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(windows) < 3000 else None
    if covered is None:
        seen = {}
        for i, w in enumerate(windows):
            seen.setdefault(w, []).append(i)
        covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    body = text.encode()
    bad = False
    if body:
        compress = zstandard.ZstdCompressor(level=3)
        low, high = next(b[1:] for b in reversed(compression.WHOLE_BANDS) if b[0] <= len(body))
        chunks = [body[i : i + 2048] for i in range(0, len(body), 2048)]
        ratios = [len(compress.compress(c)) / 2048 for c in chunks if len(c) == 2048]
        outside = sum(not 0.22 <= r <= 0.75 for r in ratios)
        bad = not low <= len(compress.compress(body)) / len(body) <= high or outside > 0.3 * len(ratios)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered), failed, not failed and not bad,
    )


def key(row):
    return tuple((x is not None, x) for x in row)


def test_measures_edge_rows(spark):
    got = compression.measure(documents(spark, EDGE_ROWS, "n_words string, kept string")).select("doc_id", *BASE).collect()
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(t)) for i, t in EDGE_ROWS), key=key)


def test_query_matches_brute_force(spark):
    got = {r[0]: tuple(r[1:]) for r in queries.op4_compression_bands(spark, "/root/testdata/sf0.001").select("doc_id", *BASE).collect()}
    assert got == {r.doc_id: expected(r.text) for r in table(spark, "documents").collect()}


def test_keep_returns_whole_rows(spark):
    docs = documents(spark, EDGE_ROWS, "kept string, ratio int")
    kept = compression.keep(docs)
    assert kept.columns == docs.columns
    want = [(i, t) for i, t in EDGE_ROWS if expected(t)[-1]]
    assert sorted((tuple(r) for r in kept.select("doc_id", "text").collect()), key=key) == sorted(want, key=key)
    assert compression.keep(docs.limit(0)).count() == 0 == compression.measure(docs.limit(0)).count()


def test_bands_reject_both_ends(spark):
    pick = random.Random(7)
    noise = "".join(chr(pick.randrange(0x21, 0x7F)) if i % 9 != 8 else " " for i in range(4000))
    rows = [(1, prose(1, 400)), (2, noise), (3, "ab " + "0123456789" * 400 + " " + prose(9, 12))]
    got = {r.doc_id: r for r in compression.measure(documents(spark, rows)).collect()}
    assert got[1].kept and not got[2].kept and got[3].band_failed and got[2].ratio > got[1].ratio


def test_bands_must_ascend(spark):
    with pytest.raises(ValueError):
        compression.measure(documents(spark, EDGE_ROWS), whole_bands=((5, 0, 1),))


def test_junk_at_the_end_is_judged(spark):
    """Junk behind the last whole chunk fails like junk in front of it."""
    pick = random.Random(8)
    noise = "".join(chr(pick.randrange(0x21, 0x7F)) if i % 9 != 8 else " " for i in range(1950))
    good = prose(12, 400)[:2049] + " "
    got = {r.doc_id: r for r in compression.measure(documents(spark, [(1, good + noise), (2, noise + " " + good), (3, prose(12, 600)[:4000])])).collect()}
    assert got[1].band_failed and got[2].band_failed and got[3].kept
