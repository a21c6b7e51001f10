"""Different texts under one id that agree in 32 bits of hash keep their own spans, hits and passages."""

import pytest
from llm_cases import documents, prose
from pyspark.sql import functions as F

from tablehaul.llm import chaining, suffixes, winnow

PASSAGE = prose(71, 60)


@pytest.fixture(scope="module")
def colliding(spark):
    """A text with the passage, and a short one without it whose 32-bit hash is the same."""
    long = spark.range(150_000).select(F.concat(F.lit(PASSAGE + " "), F.col("id").cast("string")).alias("t")).withColumn("h", F.hash("t"))
    short = spark.range(150_000).select(F.concat(F.lit("short "), F.col("id").cast("string")).alias("s")).withColumn("h", F.hash("s"))
    found = long.join(short, "h").orderBy("t", "s").first()
    assert found is not None
    return found.t, found.s


def test_suffixes_cut_their_own_bytes(spark, colliding):
    long, short = colliding
    for doc in (5, None):
        docs = documents(spark, [(doc, long), (doc, short), (1, PASSAGE)])
        got = {(r.doc_id, r.n_bytes): r.n_removed for r in suffixes.dedup_report(docs).collect()}
        assert got[(doc, len(short))] == 0 and got[(doc, len(long))] >= len(PASSAGE)
        assert short in {r.text for r in suffixes.cut_repeats(docs).collect()}


@pytest.mark.parametrize("broadcast_prints", [0, 1_000_000])
def test_clean_rows_get_no_foreign_hits(spark, colliding, broadcast_prints):
    long, short = colliding
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    for doc in (5, None):
        docs = documents(spark, [(doc, long), (doc, short)])
        got = {r.n_words: r.n_hit for r in winnow.contamination(docs, items, broadcast_prints=broadcast_prints).collect()}
        assert got == {2: 0, 61: 60}
        assert [r.text for r in winnow.keep_clean(docs, items, broadcast_prints=broadcast_prints).collect()] == [short]


def test_passages_of_one_id(spark, colliding):
    long, short = colliding
    found = chaining.passages(documents(spark, [(5, long), (5, short), (1, PASSAGE)])).collect()
    assert [(r.doc_id, r.first_word, r.n_words, r.other_id, r.equal_words) for r in found] == [(5, 0, 60, 1, 60)]
