"""Every registered query against its SQL on the smallest tables."""

import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SF_DIR


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return str(value)


def test_every_query_has_sql():
    assert set(driver.library_queries()) == set(driver.library_sql())


@pytest.mark.parametrize("name", driver.library_queries())
def test_query_matches_sql(spark, sql, name):
    df = driver.library_queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(map(comparable, r)) for r in df.select(*columns).collect())
    answer = sql.sql(driver.library_sql()[name])
    assert sorted(answer.columns) == columns
    order = [answer.columns.index(c) for c in columns]
    want = sorted(tuple(comparable(r[i]) for i in order) for r in answer.fetchall())
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 1500


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tablehaul.llm", "zstandard"])
def test_entry_without_the_training_data_operators(missing):
    """The other queries are there when that subpackage, its pipeline, or a package that only it needs is not."""
    code = (
        f"import sys; sys.modules['{missing}'] = None; import __spark_entry__ as e; "
        "assert set(e.queries()) == set(e.oracle_sql()) == set(e.library_queries())"
    )
    root = os.path.dirname(os.path.abspath(driver.__file__))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
