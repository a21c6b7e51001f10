import numpy as np
import pytest
from llm_cases import SF_DIR, table
from pyspark.sql import functions as F

from tablehaul.llm import neighbours, queries


def frame(spark, rows, extra=""):
    schema = "vec_id bigint, embedding array<float>" + (f", {extra}" if extra else "")
    more = [None] * len(extra.split(",")) if extra else []
    return spark.createDataFrame([(*r, *more) for r in rows], schema).repartition(3)


def brute(rows, answers=20, step=20):
    """Best rows for each query, every pair compared."""
    rows = sorted({(i, tuple(np.float32(x) for x in v)) for i, v in rows})
    ids = np.array([i for i, _ in rows])
    base = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in zip(ids.tolist(), base, strict=True):
        if i % step == 0:
            score = (base * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score.round(12))) if ids[j] != i][:answers]
            out[i] = [(int(ids[j]), score[j]) for j in order]
    return out


def answers_of(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def clustered(n, width=16, groups=40, seed=1):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((groups, width))
    return [(i, [float(x) for x in centres[i % groups] + 0.3 * pick.standard_normal(width)]) for i in range(n)]


def recall(got, want):
    hits = sum(len({v for _, v, _ in got.get(q, [])} & {v for v, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_query_matches_brute_force(spark):
    """One partition at this size, so the answer is exact."""
    rows = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()]
    got, want = answers_of(queries.op11_learned_partitions(spark, SF_DIR)), brute(rows)
    assert {q: [(r, v) for r, v, _ in a] for q, a in got.items()} == {q: [(r, v) for r, (v, _) in enumerate(a, 1)] for q, a in want.items()}
    assert all(abs(g[2] - w[1]) < 1e-12 for q in want for g, w in zip(got[q], want[q], strict=True))


def test_recall_over_learned_partitions(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VALUES", 16 * 600)
    rows = clustered(9000)
    seen = []
    fit = neighbours.fit
    monkeypatch.setattr(neighbours, "fit", lambda *a, **k: seen.append(fit(*a, **k)) or seen[-1])
    found = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)
    got = answers_of(found)
    assert len(seen[0].bias) == 8 and seen[0].probes < 8
    assert recall(got, brute(rows)) >= 0.9
    assert all([r for r, _, _ in a] == list(range(1, 21)) and q not in {v for _, v, _ in a} for q, a in got.items())


def test_a_third_of_equal_vectors(spark, monkeypatch):
    """Equal vectors are one entry; each query still gets 20 rows, the smallest ids first."""
    monkeypatch.setattr(neighbours, "PARTITION_ROWS", 64)
    rows = [(i, [3.0, 1.0, 0.0] if i % 3 == 0 else v[:3]) for i, v in clustered(1500, 3)]
    got, want = answers_of(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, coverage=1.0)), brute(rows)
    assert {q: len(a) for q, a in got.items()} == dict.fromkeys(want, 20)
    assert recall(got, want) >= 0.9
    same = [q for q in want if q % 3 == 0]
    equal = [i for i in range(0, 1500, 3)]
    for q in same:
        ties = [v for _, v, s in got[q] if s == 10.0]
        assert ties == [i for i in equal if i != q][: len(ties)]


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(8)]
    bad = [(None, [1.0, 1.0]), (0, None), (40, []), (60, [0.0, 0.0]), (80, [None, 1.0]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (140, [1.0, 2.0, 3.0])]
    found = neighbours.nearest(frame(spark, good + bad + good, "rank string, score string"), F.col("vec_id") % 20 == 0)
    assert [(r["rank"], r.vec_id, r.score) for r in found.orderBy("rank").collect()] == [(i, i, 1.0) for i in range(1, 8)]
    assert set(found.columns) == {"query_id", "rank", "vec_id", "score"}


def test_empty_and_lonely(spark):
    ask = F.col("vec_id") % 20 == 0
    assert neighbours.nearest(frame(spark, [(0, [1.0])]).limit(0), ask).count() == 0
    assert neighbours.nearest(frame(spark, [(0, [1.0])]), ask).count() == 0
    assert neighbours.nearest(frame(spark, [(1, [1.0]), (2, [2.0])]), ask).count() == 0
    two = neighbours.nearest(frame(spark, [(0, [1.0]), (0, [2.0]), (7, [3.0])]), ask)
    assert sorted((r.vec_id, r.score) for r in two.collect()) == [(7, 3.0), (7, 6.0)]


@pytest.mark.parametrize("parts", [2, 8])
def test_partitions_are_balanced_and_follow_the_graph(spark, parts):
    points = np.array([v for _, v in clustered(800, groups=8)], np.float32)
    near = neighbours.neighbour_graph(spark, points, 10)
    assert (near == neighbours.nearest_rows(points, np.arange(800), 10)).all()
    place = neighbours.balanced_partitions(near, parts)
    sizes = np.bincount(place, minlength=parts)
    assert sizes.max() - sizes.min() <= 1
    inside = (place[near] == place[:, None]).mean()
    assert inside > 0.8


def test_tiles_hold_near_partitions_or_cut_large_ones(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VALUES", 1000)
    layout = neighbours._layout({0: 30, 1: 40, 2: 900, 3: 5}, {0: 10, 1: 250, 2: 1, 3: 0}, 4, 255, 10)
    assert layout == {0: (0, 1, 3), 1: (0, 1, 3), 2: (1, 9, 1), 3: (2, 1, 1)}
