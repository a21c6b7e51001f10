"""Tasks that fail once must neither drop nor double rows, in files or in counts."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import json, sys
sys.path.insert(0, {root!r})
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
import tablehaul as th
from tablehaul.operators import extract

spark = (
    SparkSession.builder.master("local[3,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


@F.pandas_udf("bigint")
def fails_once(v: pd.Series) -> pd.Series:
    context = TaskContext.get()
    if context.attemptNumber() == 0 and context.partitionId() % 2 == 1:
        raise ValueError("lost")
    return v


plain = extract.coerce_table
extract.coerce_table = lambda df, *a: plain(df, *a).withColumn("v", fails_once("v"))
hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
df = spark.range(0, 9000, 1, 9).select(hot.alias("a"), F.col("id").alias("b"), F.col("id").alias("v"))
if {early!r}:
    df = df.withColumn("v", fails_once("v"))
out = {{}}
for name, floor in (("planned", 10**6), ("sampled", 0)):
    read = extract.read_by_key_range
    extract.read_by_key_range = lambda d, k, n, p: th.read_by_key_range(d, k, n, p, floor)
    stats = th.run_extract(df, name, {out!r}, ["a", "b"], 6, check_keys=True)
    back = spark.read.parquet(stats.path)
    out[name] = [stats.rows, back.count(), back.select("b").distinct().count()]
print("RESULT " + json.dumps(out))
"""


@pytest.mark.parametrize("early", [False, True])
def test_failed_tasks_are_repeated_exactly(tmp_path, early):
    code = SCRIPT.format(root=ROOT, out=str(tmp_path), early=early)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    lines = [line for line in done.stdout.splitlines() if line.startswith("RESULT ")]
    assert lines, done.stderr[-2000:]
    assert json.loads(lines[0][7:]) == {"planned": [9000] * 3, "sampled": [9000] * 3}
