"""Does an extract hold each source row exactly once?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablehaul.names import columns

# Keys of one bucket of the screen, about; a bucket that differs is compared key by key.
BUCKET_KEYS = 10_000


def _tagged(source: DataFrame, extracted: DataFrame, keys: Sequence[str], content: bool) -> tuple[DataFrame, list[str]]:
    """Both sides under names of their own: the grouping columns, and ``s`` and ``e``, one of them 1."""
    by = [f"k{i}" for i in range(len(keys))]
    named = [c.alias(name) for c, name in zip(columns(keys), by, strict=True)]
    others = [c for c in source.columns if c not in keys]
    if content and sorted(source.columns) != sorted(extracted.columns):
        raise ValueError("contents can only be compared over the same columns")

    def side(df: DataFrame, s: int) -> DataFrame:
        body = [F.xxhash64(*columns(others)).alias("body")] if content else []
        return df.select(*named, *body, F.lit(s).alias("s"), F.lit(1 - s).alias("e"))

    return side(source, 1).union(side(extracted, 0)), [*by, *(["body"] if content else [])]


def _balance(tagged: DataFrame, by: Sequence[str]) -> DataFrame:
    return tagged.groupBy(*by).agg(F.sum("s").alias("in_source"), F.sum("e").alias("in_extract"))


def key_balance(source: DataFrame, extracted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: ``in_source`` and ``in_extract`` row counts, in one shuffle.

    Both sides are tagged and grouped together instead of joined; counts combine
    before the shuffle, so a hot key moves as one row per task. NULL keys group too.
    """
    tagged, by = _tagged(source, extracted, keys, False)
    return _balance(tagged, by).select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], "in_source", "in_extract")


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


def _report(balance: DataFrame) -> DataFrame:
    s, e, zero = F.col("in_source"), F.col("in_extract"), F.lit(0).cast("bigint")
    return balance.agg(
        _total(s).alias("source_rows"),
        _total(e).alias("extracted_rows"),
        _total(F.when(s > 0, F.greatest(e - s, zero)).otherwise(zero)).alias("duplicate_rows"),
        _total(F.greatest(s - e, zero)).alias("missing_rows"),
        _total(F.when(s == 0, e).otherwise(zero)).alias("extra_rows"),
    )


def reconcile(
    source: DataFrame,
    extracted: DataFrame,
    keys: Sequence[str],
    screen: bool = False,
    content: bool = False,
    bucket_keys: int = BUCKET_KEYS,
) -> DataFrame:
    """One row: ``source_rows, extracted_rows, duplicate_rows, missing_rows, extra_rows``.

    Duplicates are surplus rows of a key the source has, extras are rows of a key
    it does not have. Only keys are compared, unless ``content`` makes a hash of all other columns part of
    the key: then a row with changed values is one missing and one extra row. Both sides
    must then have the same columns and types.

    ``screen`` is for tables whose keys are too many to shuffle: it first compares
    row counts and sums of key hashes per hash bucket, which combine before the shuffle,
    and then groups only the keys of buckets that differ. Buckets grow in number with the table, so one bad key pulls in
    about ``bucket_keys`` others. A clean extract costs two scans of the key columns. Two buckets with
    different keys agree by chance in about one of 2^64 cases; without ``screen`` every key is compared.
    """
    tagged, by = _tagged(source, extracted, keys, content)
    if not screen:
        return _report(_balance(tagged, by))
    buckets = max(1, -(-source.count() // bucket_keys))
    hashed = tagged.withColumn("hash", F.xxhash64(*by))
    bucketed = hashed.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    # the hash in three pieces, whose sums fit a bigint for 2^41 rows of one bucket
    pieces = [F.shiftrightunsigned("hash", shift).bitwiseAND(F.lit((1 << 22) - 1)) for shift in (0, 22, 44)]
    sign = F.col("s") - F.col("e")
    sums = bucketed.groupBy("bucket").agg(
        F.sum("s").alias("in_source"),
        F.sum("e").alias("in_extract"),
        *[F.sum(p * sign).alias(f"difference_{i}") for i, p in enumerate(pieces)],
    )
    differs = F.col("in_source") != F.col("in_extract")
    for i in range(len(pieces)):
        differs = differs | (F.col(f"difference_{i}") != 0)
    suspects = sums.where(differs).select("bucket")
    found = _report(_balance(bucketed.join(suspects, "bucket", "left_semi"), by))
    zero = F.lit(0).cast("bigint")
    counted = sums.agg(
        _total(F.col("in_source")).alias("source_rows"),
        _total(F.col("in_extract")).alias("extracted_rows"),
        *[zero.alias(c) for c in ("duplicate_rows", "missing_rows", "extra_rows")],
    )
    faults = found.select(
        zero.alias("source_rows"), zero.alias("extracted_rows"), "duplicate_rows", "missing_rows", "extra_rows"
    )
    return counted.union(faults).agg(*[F.sum(c).alias(c) for c in counted.columns])
