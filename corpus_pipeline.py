"""Documents to packed training sequences, one operator after the other."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import wraps
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tablehaul.llm import compression, packing, simhash, suffixes, winnow  # noqa: E402
from tablehaul.sources.files import fresh_path  # noqa: E402


# Bytes of an Arrow batch: a batch of long texts is held several times at once, by the executor and by its Python worker.
BATCH_BYTES = 4 << 20


def bounded_batches(stage: Callable) -> Callable:
    """The stage, in a session that hands batches of at most ``BATCH_BYTES``, or one row, to Python."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@bounded_batches
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and the compression bands."""
    return compression.keep(docs)


@bounded_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of close fingerprints."""
    return simhash.keep_one(docs)


@bounded_batches
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that occur twice; ``n_chars`` follows the text."""
    return suffixes.cut_repeats(docs, length="n_chars")


@bounded_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any run of ten words of the benchmark."""
    return winnow.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@bounded_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

# Compression, tokens and packing have no SQL counterpart; tests/llm/test_pipeline.py uses brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
