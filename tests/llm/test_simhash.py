import random
import re

import numpy as np
import xxhash
from llm_cases import EDGE_ROWS, documents, prose, table

from tablehaul.llm import queries, simhash
from tablehaul.llm.components import components


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(values, limit=3):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    array = np.array(values, np.uint64)
    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= limit):
            a, b = find(v), find(values[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    roots = roots_of(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    return [(i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints, strict=True)]


def key(row):
    return tuple((x is not None, x) for x in row)


def same(df, want):
    got = [tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    same(queries.op3_simhash_gray_index(spark, "/root/testdata/sf0.001"), expected(rows))


def test_edge_rows(spark):
    docs = documents(spark, EDGE_ROWS, "fingerprint string, component_id int, root string")
    found = simhash.near_duplicates(docs)
    same(found.withColumn("fingerprint", simhash.hex_digits(found.fingerprint)), expected(EDGE_ROWS))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_dense_nodes_are_split_without_losing_links(spark):
    """A ball around one fingerprint, far more than a node may hold, and scattered ones."""
    pick = random.Random(3)
    centre = pick.getrandbits(64)
    values = {centre}
    while len(values) < 900:
        flips = pick.sample(range(64), pick.randint(1, 9))
        values.add(centre ^ sum(1 << b for b in flips))
    values |= {pick.getrandbits(64) for _ in range(300)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    want = roots_of(values)
    for leaf in (16, 100_000):
        found = simhash.links(prints, 3, leaf)
        assert found.count() <= 4 * 3**3 * len(values)
        roots = {r.node: r.root for r in components(found).collect()}
        unsigned = {v % 2**64: r for v, r in roots.items()}
        groups = {}
        for v in values:
            groups.setdefault(unsigned.get(v, v if v < 2**63 else v - 2**64), set()).add(v)
        brute = {}
        for v, r in want.items():
            brute.setdefault(r, set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_pairs_in_a_group_match_brute_force():
    pick = np.random.default_rng(5)
    base = pick.integers(0, 2**63, 40, dtype=np.uint64)
    prints = np.unique(np.concatenate([base ^ (np.uint64(1) << pick.integers(0, 64, 40, dtype=np.uint64)) for _ in range(20)]))
    tree = simhash.GrayTree(prints, np.zeros(len(prints), np.int64))
    a, b = tree.close_pairs(prints, np.arange(len(prints)), 3)
    brute = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j) for i, j in np.argwhere(brute) if j < i}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_keep_one_row_of_each_component(spark):
    rows = [*EDGE_ROWS, (20, prose(40, 80)), (21, prose(40, 80)), (None, prose(40, 80))]
    docs = documents(spark, rows, "key_id int, root string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = expected(rows)
    roots = roots_of([int(p, 16) for _, p, _ in want])
    ids = {}
    for i, p, _ in want:
        root = roots[int(p, 16)]
        ids[root] = min((i is None, i or 0), ids.get(root, (True, 0)))
    got = [(r.doc_id is None, r.doc_id or 0) for r in kept.collect()]
    assert sorted(got) == sorted(ids.values())
