"""Approximate nearest neighbours by inner product, over learned partitions.

Fit, on a bounded sample of different vectors: exact neighbour graph of the sample, balanced partitions of the graph by
recursive bisection (halves by the graph's slowest-mixing vector, then swaps that cut fewer edges), and a softmax classifier that
learns how a vector's neighbours are spread over the partitions. Held-out sample rows tell how many partitions a
query must visit. All rows are then indexed under their most probable partition; each query goes to its most probable ones, where
every row is compared exactly.

Rows with equal vectors are one entry with its smallest ids, as many as an answer can hold, so that a vector that fills
a third of the table is compared once. Partitions and their queries are cut into blocks of bounded size.

Rows take part if the id and all components are there and finite, one component at least is not zero, and there are as many
components as most rows have (the shorter length on a tie). Rows equal in id and vector count once. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablehaul.sources.files import staged

# Bounded sample for the graph and the classifier: rows, and components in all.
SAMPLE_ROWS = 1 << 16
SAMPLE_VALUES = 1 << 23
# Sampled rows of a partition, and rows of the table that a partition should hold.
PARTITION_SAMPLE = 256
PARTITION_ROWS = 1024
GRAPH_NEIGHBOURS = 10
EPOCHS = 20
SEED = 42
# Share of a held-out row's sample neighbours that lie in the partitions it would visit.
COVERAGE = 0.97
# Components of the rows, and of the queries, of a tile.
BLOCK_VALUES = 1 << 20

_ENTRY = "entry bigint, ids array<bigint>, is_query boolean, vector array<float>"


def nearest_rows(rows: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` other rows of largest inner product for each wanted row."""
    out = [np.zeros((0, k), np.int64)]
    for lo in range(0, len(wanted), 256):
        own = wanted[lo : lo + 256]
        score = rows[own] @ rows.T
        score[np.arange(len(own)), own] = -np.inf
        out.append(np.argpartition(-score, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def neighbour_graph(spark: SparkSession, sample: np.ndarray, k: int) -> np.ndarray:
    """``nearest_rows`` of all sampled rows, shared out over tasks; the sample is bounded and goes to each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_numpy()
            near = nearest_rows(sample, wanted, k)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * k, pa.int32()), pa.array(near.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "near"])

    found = spark.range(0, len(sample), 1, math.ceil(len(sample) / 1024)).mapInArrow(run, "id bigint, near array<bigint>").toArrow()
    near = found.column("near").combine_chunks().flatten().to_numpy().reshape(-1, k)
    return near[np.argsort(found.column("id").to_numpy())]


def _bisect(n: int, a: np.ndarray, b: np.ndarray, pick: np.random.Generator) -> np.ndarray:
    """Two halves of a graph given by its edges ``a[i] - b[i]``: True for the second. Sizes differ by one at most."""
    degree = np.maximum(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), 1.0)
    scale = 1 / np.sqrt(degree)
    flat = np.sqrt(degree) / np.linalg.norm(np.sqrt(degree))
    x = pick.standard_normal(n)
    for _ in range(60):
        x -= flat * (flat @ x)
        y = x * scale
        x = x + scale * (np.bincount(a, y[b], n) + np.bincount(b, y[a], n))
        x /= np.linalg.norm(x) or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(x * scale, kind="stable")[n // 2 :]] = True
    for _ in range(12):
        sign = np.where(side, 1.0, -1.0)
        pull = np.bincount(a, sign[b], n) + np.bincount(b, sign[a], n)
        gain = np.where(side, -pull, pull)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        pairs = min(len(left), len(right))
        good = int(np.searchsorted(-(gain[left[:pairs]] + gain[right[:pairs]]), 0.0))
        swap = max(good // 2, 1) if good else 0
        if not swap:
            break
        cut = np.count_nonzero(side[a] != side[b])
        tried = side.copy()
        tried[left[:swap]], tried[right[:swap]] = True, False
        if np.count_nonzero(tried[a] != tried[b]) >= cut:
            break
        side = tried
    return side


def balanced_partitions(neighbours: np.ndarray, parts: int, seed: int = SEED) -> np.ndarray:
    """Partition of each node of a neighbour graph; ``parts`` is a power of two, sizes differ by one at most."""
    n = len(neighbours)
    pick = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), neighbours.shape[1]), neighbours.ravel()
    out = np.zeros(n, np.int64)
    for _ in range(int(math.log2(parts))):
        inner = out[a] == out[b]
        a, b = a[inner], b[inner]
        halved = np.zeros(n, np.int64)
        by = np.argsort(out[a], kind="stable")
        bounds = np.searchsorted(out[a][by], np.arange(out.max() + 2))
        for part in range(out.max() + 1):
            nodes = np.flatnonzero(out == part)
            edges = by[bounds[part] : bounds[part + 1]]
            place = np.searchsorted(nodes, a[edges]), np.searchsorted(nodes, b[edges])
            halved[nodes] = _bisect(len(nodes), *place, pick)
        out = 2 * out + halved
    return out


@dataclass(frozen=True)
class Router:
    """Softmax classifier of vectors into partitions, and how many of them a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return _unit(vectors) @ self.weights + self.bias

    def partitions(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` likeliest partitions of each vector, likeliest first, ties to the smaller number."""
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")[:, :most]


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _fit_classifier(unit: np.ndarray, target: np.ndarray, epochs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by Adam on the cross-entropy; ``target`` has a row of shares for each vector."""
    pick = np.random.default_rng(seed)
    w = np.zeros((unit.shape[1] + 1, target.shape[1]), np.float32)
    mean, square, step = np.zeros_like(w), np.zeros_like(w), 0
    x = np.hstack((unit, np.ones((len(unit), 1), np.float32)))
    for epoch in range(epochs):
        rate = 0.1 * (1 - epoch / epochs)
        order = pick.permutation(len(x))
        for lo in range(0, len(x), 512):
            rows = order[lo : lo + 512]
            z = x[rows] @ w
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            slope = x[rows].T @ (z - target[rows]) / len(rows)
            step += 1
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w[:-1], w[-1]


def partition_count(rows: int, width: int) -> int:
    """Partitions of a table: a power of two, by its rows, as far as the bounded sample goes."""
    most = max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // width) // PARTITION_SAMPLE)
    return 1 << max(min(rows // PARTITION_ROWS, most), 1).bit_length() - 1


def fit(spark: SparkSession, sample: np.ndarray, parts: int, coverage: float = COVERAGE, seed: int = SEED) -> Router:
    """A router over ``parts`` partitions from sampled vectors, all different."""
    sample = sample.astype(np.float32)
    n = len(sample)
    if parts < 2:
        return Router(np.zeros((sample.shape[1], 1), np.float32), np.zeros(1, np.float32), 1)
    near = neighbour_graph(spark, sample, GRAPH_NEIGHBOURS)
    # Partitions of all, classifier without the held-out tenth: its rows are routed as new queries are.
    place = balanced_partitions(near, parts, seed)
    held = np.random.default_rng(seed).random(n) < 0.1
    unit = _unit(sample)
    target = np.zeros((n, parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(n), near.shape[1]), place[near].ravel()), 1.0)
    target[np.arange(n), place] += near.shape[1]
    target /= target.sum(axis=1, keepdims=True)
    router = Router(*_fit_classifier(unit[~held], target[~held], EPOCHS, seed), 1)
    # Rows are indexed where the classifier puts them, so that is where a held-out row must look.
    indexed = router.logits(sample).argmax(axis=1)
    rank = np.empty((np.count_nonzero(held), parts), np.int64)
    np.put_along_axis(rank, router.partitions(sample[held], parts), np.arange(parts)[None, :], axis=1)
    visits = np.sort(np.take_along_axis(rank, indexed[near[held]], axis=1).ravel())
    probes = int(visits[min(math.ceil(coverage * len(visits)), len(visits)) - 1]) + 1 if len(visits) else parts
    return Router(router.weights, router.bias, probes)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part; see the module's text."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    return rows.filter(F.size("vector") == (common.length if common else 0))


def _entries(rows: DataFrame, is_query: Column, keep: int) -> DataFrame:
    """One row per different vector: its ``keep`` smallest ids, and whether a query has it."""
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= keep)
    asked = rows.filter(is_query).select("vector").distinct()
    both = few.select("vector", "vec_id", F.lit(False).alias("q")).unionByName(asked.select("vector", F.lit(None).cast("bigint").alias("vec_id"), F.lit(True).alias("q")))
    grouped = both.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.max("q").alias("is_query"))
    return grouped.select(F.monotonically_increasing_id().alias("entry"), "ids", "is_query", "vector")


def _matrix(column: pa.Array) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values.reshape(len(column), -1)


def _routed(entries: DataFrame, router: Router) -> DataFrame:
    """Entries with their most probable partitions; the first is where they are indexed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                found = router.partitions(_matrix(part.column(3)), router.probes).astype(np.int32)
                bounds = pa.array(np.arange(len(found) + 1) * router.probes, pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(bounds, pa.array(found.ravel()))], [*part.schema.names, "visits"])

    return entries.mapInArrow(run, f"{_ENTRY}, visits array<int>")


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up component by component, so that equal pairs have equal scores everywhere."""
    score = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        score += queries[:, j].astype(np.float64) * rows[:, j].astype(np.float64)
    return score


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, keep: int) -> list[np.ndarray]:
    """The ``keep`` best rows of each query, ties to the smaller id."""
    by = np.lexsort((vec, -score, query))
    query, vec, score = query[by], vec[by], score[by]
    best = np.arange(len(query)) - np.searchsorted(query, query) < keep
    return [query[best], vec[best], score[best]]


def _compare(asked: np.ndarray, base: np.ndarray, ids: pa.ListArray, keep: int) -> list[np.ndarray]:
    """Numbers of the queries, ids and scores of the ``keep`` best rows of a partition for each query."""
    sizes = np.diff(ids.offsets.to_numpy())
    flat, begin = ids.values.to_numpy(), ids.offsets.to_numpy()[:-1]
    out = []
    for lo in range(0, len(asked), 256):
        some = asked[lo : lo + 256]
        score = some @ base.T
        few = min(keep, len(base))
        # rounding differs between ways to add up: all that may belong to the best are kept, then added up again
        least = -np.partition(-score, few - 1, axis=1)[:, few - 1]
        q, r = np.nonzero(score >= (least - 1e-9 * (np.abs(some) @ np.abs(base).max(axis=0)))[:, None])
        exact, each = _exact(some[q], base[r]), sizes[r]
        at = np.repeat(begin[r] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        out.append(_best(lo + np.repeat(q, each), flat[at], np.repeat(exact, each), keep))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _search(keep: int):
    """Best ``keep`` ids of a tile for each query: the partitions of the tile that it visits are compared one by one."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]]
        names = queries.column("query").to_numpy()
        if rows.num_rows and queries.num_rows:
            rows = rows.sort_by([("part", "ascending"), ("entry", "ascending")]).combine_chunks()
            part = rows.column("part").to_numpy()
            visits = queries.column("visits").combine_chunks()
            visited, asking = visits.flatten().to_numpy(), np.repeat(np.arange(len(names)), np.diff(visits.offsets.to_numpy()))
            asked = _matrix(queries.column("asked").combine_chunks()).astype(np.float64)
            for p in np.unique(part).tolist():
                mine = asking[visited == p]
                if len(mine):
                    of = rows.slice(int(np.searchsorted(part, p)), int(np.count_nonzero(part == p)))
                    base = _matrix(of.column("vector").combine_chunks()).astype(np.float64)
                    lists = of.column("ids").combine_chunks().take(pa.array(np.arange(len(base))))
                    q, vec, score = _compare(asked[mine], base, lists, keep)
                    found.append([mine[q], vec, score])
        query, vec, score = _best(*(np.concatenate(c) for c in zip(*found, strict=True)), keep)
        return pa.table({"query": names[query] if len(query) else query, "vec_id": vec, "score": score})

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    answers: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    coverage: float = COVERAGE,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``answers`` nearest rows found for each row for which ``is_query`` holds.

    ``is_query`` is a condition on the id, under the name ``vec_id``. Every other row of the table is a candidate; rows of the query's own id are not.
    Nearest first, ties to the smaller id; ``score`` is the inner product of the vectors as they are. A query finds what lies in
    the partitions it visits, an expected share of ``coverage``; fewer than ``answers`` rows only if those hold fewer and there
    are no more partitions. A query id with several vectors is answered for each.
    """
    rows = usable(vectors, vec_id, vector)
    entries = staged(_entries(rows, is_query, answers + 1), "entries")
    total = entries.count()
    if not total:
        return entries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = entries.select(F.size("vector")).first()[0]
    parts = partition_count(total, width)
    sample = entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(parts * PARTITION_SAMPLE).toArrow()
    router = fit(entries.sparkSession, _matrix(sample.column(0).combine_chunks()), parts, coverage, seed)
    return _answers(rows, is_query, staged(_routed(entries, router), "routed"), answers, len(router.bias))


def _layout(entries: dict[int, int], visits: dict[int, int], parts: int, queries: int, width: int) -> dict[int, tuple[int, int, int]]:
    """Tile group of each partition, with the blocks of rows and of queries that it is cut into.

    Partitions with neighbouring numbers, which are near in the tree of halves, share a tile as far as it goes, so that a
    query's candidates are compared among themselves before they leave it. A larger partition is cut.
    """
    block = max(1, BLOCK_VALUES // width)
    groups, rows = [[]], 0
    for p in range(parts):
        if groups[-1] and rows + entries.get(p, 0) > block:
            groups.append([])
            rows = 0
        groups[-1].append(p)
        rows += entries.get(p, 0)
    out = {}
    for g, members in enumerate(groups):
        held, asked = sum(entries.get(p, 0) for p in members), min(queries, sum(visits.get(p, 0) for p in members))
        for p in members:
            out[p] = g, max(1, math.ceil(held / block)), max(1, math.ceil(asked / block))
    return out


def _tiled_queries(routed: DataFrame, layout: dict[int, tuple[int, int, int]]) -> DataFrame:
    """(q_group, q_row_block, q_block, query, visits, asked): each query once for each block of rows of the groups it visits."""
    of = np.array([layout[p] for p in sorted(layout)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                visits = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                visits = np.sort(visits, axis=1)
                group = of[visits, 0]
                new = np.ones(group.shape, bool)
                new[:, 1:] = group[:, 1:] != group[:, :-1]
                first = np.flatnonzero(new.ravel())
                query = first // visits.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, visits.size), pa.int32()), pa.array(visits.ravel()))
                blocks = of[visits.ravel()[first], 1]
                each = np.repeat(np.arange(len(first)), blocks)
                block = np.arange(len(each)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                place = part.column(2).to_numpy()[query[each]] % of[visits.ravel()[first], 2][each]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(group.ravel()[first][each]), pa.array(block), pa.array(place), part.column(0).take(pa.array(query[each])),
                        lists.take(pa.array(each)), part.column(3).take(pa.array(query[each])),
                    ],
                    ["q_group", "q_row_block", "q_block", "query", "visits", "asked"],
                )

    asked = routed.filter("is_query").select("entry", "visits", F.pmod(F.xxhash64("entry"), F.lit(1 << 40)).alias("place"), "vector")
    return asked.mapInArrow(run, "q_group bigint, q_row_block bigint, q_block bigint, query bigint, visits array<int>, asked array<float>")


def _answers(rows: DataFrame, is_query: Column, routed: DataFrame, answers: int, parts: int) -> DataFrame:
    entries = dict(map(tuple, routed.groupBy(F.element_at("visits", 1)).count().collect()))
    visits = dict(map(tuple, routed.filter("is_query").select(F.explode("visits").alias("part")).groupBy("part").count().collect()))
    first = routed.agg(F.count_if("is_query").alias("queries"), F.max(F.size("vector")).alias("width")).first()
    layout = _layout(entries, visits, parts, first.queries, first.width)
    # one row per partition
    table = F.broadcast(rows.sparkSession.createDataFrame([(p, *x) for p, x in layout.items()], "part int, group bigint, row_blocks bigint, query_blocks bigint"))
    indexed = (
        routed.select("entry", "ids", "vector", F.element_at("visits", 1).alias("part")).join(table, "part")
        .withColumn("row_block", F.pmod(F.xxhash64("entry"), F.col("row_blocks")))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("group", "row_block", "block", "part", "entry", "ids", "vector")
    )
    tiles = indexed.groupBy("group", "row_block", "block").cogroup(_tiled_queries(routed, layout).groupBy("q_group", "q_row_block", "q_block"))
    found = tiles.applyInArrow(_search(answers + 1), "query bigint, vec_id bigint, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= answers + 1)
    lists = found.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    lists = lists.join(routed.select(F.col("entry").alias("query"), "vector"), "query").select("vector", "found")
    asking = rows.filter(is_query).distinct().select(F.col("vec_id").alias("query_id"), "vector")
    own = asking.join(lists, "vector").select(
        "query_id", F.slice(F.filter("found", lambda x: x.vec_id != F.col("query_id")), 1, answers).alias("found")
    )
    return own.select("query_id", F.posexplode("found").alias("place", "one")).select(
        "query_id", (F.col("place") + 1).alias("rank"), "one.vec_id", "one.score"
    )
