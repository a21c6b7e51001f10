import random
import re
import zlib
from collections import Counter

import pytest
from llm_cases import SF_DIR, documents, table

from tablehaul.llm import queries, variants


def deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def near_words(counts):
    """Neighbours by deletion: word with word less a letter, and words that differ at one place."""
    by_gap, out = {}, {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            by_gap.setdefault((w[:i], w[i + 1 :]), set()).add(w)
        for shorter in deletions(w):
            if shorter in counts:
                out[w].add(shorter)
                out[shorter].add(w)
    for group in by_gap.values():
        for w in group:
            out[w] |= group - {w}
    return out


def variants_of(counts):
    near, form, out = near_words(counts), {}, {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w)))
    return out


def collected(frame):
    return {r.word: tuple(r)[1:] for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_random_words_match_brute_force(spark, parts):
    pick = random.Random(parts)
    counts = {}
    for _ in range(250):
        counts["".join(pick.choice("abé") for _ in range(pick.randint(5, 8)))] = pick.randint(3, 60)
    counts |= {"a" * 3000: 5, "a" * 2999: 11, "a" * 1500 + "b" + "a" * 1499: 3, "ß漢😀xyz": 9, "ß漢😀xy": 4}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = collected(variants.spelling_variants(words, parts=parts))
    assert got == variants_of(counts)
    assert sum(v[0] is not None for v in got.values()) > 20


def test_long_way_to_the_root(spark):
    words = ["abcdefghij"[:i] + "z" * (12 - i) for i in range(11)]
    counts = {w: 3 * 2**i for i, w in enumerate(words)}
    got = collected(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")))
    assert got == variants_of(counts)
    assert got[words[0]][1] == words[-1]


def test_repeated_letters_are_one_neighbour(spark):
    words = spark.createDataFrame([("aaaaa", 3), ("aaaaaa", 7), ("aaaaaaa", 20)], "word string, n bigint")
    assert collected(variants.spelling_variants(words)) == {
        "aaaaa": ("aaaaaa", "aaaaaaa", 3, 1, 7), "aaaaaa": ("aaaaaaa", "aaaaaaa", 7, 2, 20), "aaaaaaa": (None, "aaaaaaa", 20, 1, None),
    }


def test_counts_leave_out_short_and_rare(spark):
    rows = [(w, None) for w in ["house"] * 4 + ["houses"] * 2 + ["hut"] * 9 + [None] * 5]
    words = spark.createDataFrame(rows, "word string, n string")
    assert [tuple(r) for r in variants.word_counts(words).collect()] == [("house", 4)]
    empty = variants.word_counts(words.limit(0))
    assert variants.spelling_variants(empty).count() == 0


def test_words_are_spread_over_parts(spark):
    """No task sorts more than its part, whatever the words begin with."""
    words = spark.createDataFrame([("common" + str(i), 3) for i in range(2000)], "word string, n bigint")
    assert variants._sorted_nodes(words.select("word"), 8, "t").groupBy("part").count().agg({"count": "max"}).first()[0] < 600


def occurrences(rows):
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            yield run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]


def test_query_matches_brute_force(spark, tmp_path):
    counts = {w: n for w, n in Counter(occurrences(table(spark, "documents").select("doc_id", "text").collect())).items() if n >= 3 and len(w) >= 5}
    got = collected(queries.op12_trie_pairs(spark, SF_DIR))
    assert got == variants_of(counts)
    assert sum(v[0] is not None for v in got.values()) > 5


def test_query_on_edge_rows(spark, tmp_path):
    rows = [(None, "Hello Hello hello"), (1, None), (2, ""), (3, "ÀÉÎõü " * 4 + "x" * 9000), (3, "hellO"), (4, "hellos " * 3 + "×÷×÷× " * 3)]
    documents(spark, rows, "word string, n string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = {w: n for w, n in Counter(occurrences(rows)).items() if n >= 3 and len(w) >= 5}
    assert collected(queries.op12_trie_pairs(spark, str(tmp_path))) == variants_of(counts)
