import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import EDGE_ROWS, SF_DIR, documents, table

from tablehaul.llm import periods, queries


def runs(words, least=12):
    """(start, length, period) of all runs, period by period."""
    out, n = set(), len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p) and j > i:
                out.add((i, j + p - i, p))
            i = max(j, i + 1)
    smallest = {}
    for start, length, period in out:
        smallest[start, length] = min(period, smallest.get((start, length), period))
    return sorted(((s, n, p) for (s, n), p in smallest.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def longest(found):
    return min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def key(row):
    return tuple((x is not None, x) for x in row)


def test_runs_match_brute_force():
    pick = random.Random(5)
    for _ in range(600):
        words = [pick.randrange(pick.randint(1, 3)) for _ in range(pick.randint(0, 70))]
        if words and pick.random() < 0.4:
            a, p = pick.randrange(len(words)), pick.randint(1, 12)
            words = [w if i < a else words[a + (i - a) % min(p, len(words) - a)] for i, w in enumerate(words)]
        least = pick.choice([2, 5, 12])
        got = zip(*(x.tolist() for x in periods.runs_of(np.array(words, np.int64), least)), strict=True)
        assert list(got) == runs(words, least)


def test_many_look_ups_are_cut(monkeypatch):
    words = np.array([0, 1] * 300 + [0, 0, 1] * 200, np.int64)
    whole = [x.tolist() for x in periods.runs_of(words)]
    monkeypatch.setattr(periods, "LOOK_UPS", 7)
    assert [x.tolist() for x in periods.runs_of(words)] == whole


def test_edge_rows_and_clashing_columns(spark):
    rows = [*EDGE_ROWS, (20, "la " * 500), (21, "a b c " * 5 + "x"), (22, "a b\n" * 6 + "a  b\tq " * 7), (20, "la " * 500)]
    found = periods.periodic_runs(documents(spark, rows, "n_runs string, runs int, collapsed int")).collect()
    want = []
    for i, text in rows:
        words = words_of(text)
        all_runs = runs(words) if len(words) < 3000 else []
        want.append((i, len(words), len(all_runs), *longest(all_runs), collapsed(words, all_runs)))
    got = [(r.doc_id, r.n_words, r.n_runs, r.start, r.length, r.period, r.collapsed) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert periods.periodic_runs(documents(spark, EDGE_ROWS).limit(0)).count() == 0


def test_words_of_two_texts_are_no_run(spark):
    docs = spark.createDataFrame([(i, "a b c d e f") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    assert periods.periodic_runs(docs).filter("n_runs > 0").count() == 0


def test_query_matches_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_branching_tandems(spark, SF_DIR).collect()}
    want = {}
    for doc_id, text in table(spark, "documents").select("doc_id", "text").collect():
        words = words_of(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = runs(words)
        top = longest(found)
        digest = hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in found).encode()).hexdigest()
        want[doc_id] = (
            len(found), *top, None if top[0] is None else 1000 * top[1] // top[2], digest,
            hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
        )
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 10


def test_repeats_must_repeat(spark):
    with pytest.raises(ValueError):
        periods.periodic_runs(documents(spark, EDGE_ROWS), min_repeats=1)
