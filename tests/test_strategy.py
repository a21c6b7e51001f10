import pytest
from pyspark.sql import functions as F

from tablehaul.plans.strategy import (
    batch_rows_column,
    choose_strategy,
    partitions_for,
    rows_per_file,
    strategy_of,
)

SIZES = {
    199_999: (250_000, 166_666),
    200_000: (500_000, 333_333),
    9_999_999: (500_000, 333_333),
    10_000_000: (750_000, 500_000),
    49_999_999: (750_000, 500_000),
    50_000_000: (1_000_000, 666_666),
}
CHOICES = [
    (0, 1, "empty"),
    (0, 0, "empty"),
    (10, 1, "single_key"),
    (20_000_000, 1, "single_key"),
    (10_000_001, 2, "leading_key"),
    (10_000_000, 2, "key_order"),
    (5, 0, "unkeyed"),
]


@pytest.mark.parametrize("rows", SIZES)
def test_batch_rule(rows):
    assert (rows_per_file(rows), rows_per_file(rows, True)) == SIZES[rows]


@pytest.mark.parametrize("rows,size,want", CHOICES)
def test_strategy(rows, size, want):
    assert strategy_of(rows, size) == want


def test_column_forms_agree(spark):
    rows = [(n, k, b) for n in [*SIZES, 0, 10_000_001] for k in (0, 1, 2) for b in (True, False)]
    got = choose_strategy(spark.createDataFrame(rows, "n bigint, key_size int, has_text_blob boolean")).collect()
    for r in got:
        assert r["strategy"] == strategy_of(r["n"], r["key_size"])
        assert r["batch_rows"] == rows_per_file(r["n"], r["has_text_blob"])


def test_missing_key_size_is_unkeyed(spark):
    df = spark.createDataFrame([(5, None, False)], "n bigint, key_size int, has_text_blob boolean")
    assert choose_strategy(df).first()["strategy"] == "unkeyed"


def test_override():
    assert strategy_of(100, 2, "leading_key") == "leading_key"
    assert strategy_of(0, 2, "leading_key") == "empty"
    for other in ("fastest", "empty"):
        with pytest.raises(ValueError):
            strategy_of(1, 1, other)


def test_partitions_follow_rows_and_bytes():
    huge = 10**12
    assert rows_per_file(huge) == 1_000_000
    # no partition grows with the table
    assert huge / partitions_for(huge, 100 * 2**40, False, 1000) <= 1_000_000
    assert 100 * 2**40 / partitions_for(huge, 100 * 2**40, False, 1000) <= 256 * 2**20
    # few rows, but long ones
    assert partitions_for(1_000_000, 2**40, True, 8) > 1000
    # small tables neither idle the cores nor fall into tiny files
    assert partitions_for(600_000, 10**7, False, 8) == 8
    assert partitions_for(25, 100, False, 4000) == 1
    assert partitions_for(0, None, False, 8) == 1


def test_batch_floor(spark):
    assert spark.range(1).select(batch_rows_column(F.lit(1), F.lit(True)).alias("b")).first()["b"] >= 100_000
