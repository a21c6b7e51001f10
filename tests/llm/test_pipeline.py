"""The stages one after the other, against the brute-force versions of their operators."""

import numpy as np
import pyarrow as pa
import pytest
import test_compression
import test_packing
import test_simhash
import test_winnow
from llm_cases import EDGE_ROWS, SF_DIR, documents, table

import corpus_pipeline

WINDOW = 200


def without_repeats(rows):
    bodies = [(t or "").encode() for _, t in rows]
    seen = {}
    for d, body in enumerate(bodies):
        for i in range(len(body) - WINDOW + 1):
            seen.setdefault(body[i : i + WINDOW], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in bodies]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + WINDOW] = True
    return [
        (i, np.frombuffer(b, np.uint8)[~g].tobytes().decode("utf-8", "ignore")) for (i, _), b, g in zip(rows, bodies, gone, strict=True)
    ]


def brute(rows, items):
    kept = [(i, t) for i, t in rows if test_compression.expected(t)[-1]]
    single = {i for i, _, root in test_simhash.expected(kept) if i == root}
    cut = without_repeats([r for r in kept if r[0] in single])
    return [r for r, found in zip(cut, test_winnow.expected(cut, items), strict=True) if not found[2]]


def test_stages_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    want = brute(rows, items)
    assert 0 < len(want) < len(rows)
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    used, total = test_packing.check_packed(want, found)
    assert used <= -(-total // 4096) * 1.01 + 1


def test_all_but_the_last_return_documents(spark):
    docs = documents(spark, EDGE_ROWS, "row_id int, spans string, kept boolean")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} <= {i for i, _ in EDGE_ROWS}, name


@pytest.mark.parametrize("stage", range(5))
def test_empty_documents(spark, stage):
    docs = table(spark, "documents").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, SF_DIR).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "simhash near-dedup", "suffix-array dedup", "benchmark decontamination", "best-fit packing",
    ]


@pytest.mark.parametrize("stage", range(5))
def test_batches_are_bounded_by_bytes(spark, stage):
    """10,000 long texts in a batch would be held several times over by each task."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = documents(spark, [(i, "x" * 100_000) for i in range(200)])
    corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), SF_DIR)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint").collect()
    assert len(sizes) > 3 and max(r.n for r in sizes) <= 5 << 20
