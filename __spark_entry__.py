
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce
from itertools import combinations

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402
from pyspark.sql.window import Window  # noqa: E402

import tablehaul as th  # noqa: E402
from tablehaul.functions.coerce import (  # noqa: E402
    WHITE_SPACE,
    bytes_to_text,
    float_to_int64,
    float_to_text,
    text_to_bytes,
    trim_text,
)
from tablehaul.plans.balance import with_leaf_number  # noqa: E402
from tablehaul.plans.discovery import MAX_COLUMNS  # noqa: E402
from tablehaul.plans.sketches import DISTINCT_ERROR, LONG_TEXT, as_item  # noqa: E402
from tablehaul.sources.files import fresh_path  # noqa: E402
from tablehaul.sources.tables import default_partitions  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from tablehaul.llm import queries as llm  # noqa: E402
except ImportError:  # that part, or something that only it needs, is not there
    llm = None

RANGES = 8
PAGE = 100
CHUNK = 500
FILE_ROWS = 4_000
MANY_PARTS = 10_000
HEAVY_SHARE = 0.02

KEYS: dict[str, list[str]] = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": [],
    "conversations": ["conv_id", "turn"],
}
TEXT_BLOBS = {("documents", "text"), ("pages", "html"), ("conversations", "text")}

# Columns of the given tables with their catalog code, sub-type and portable type.
COLUMNS: dict[str, list[tuple[str, int, str]]] = {
    "region": [("r_regionkey", 8, "int64"), ("r_name", 37, "utf8")],
    "nation": [("n_nationkey", 8, "int64"), ("n_name", 37, "utf8"), ("n_regionkey", 8, "int64")],
    "customer": [
        ("c_custkey", 16, "int64"), ("c_name", 37, "utf8"), ("c_nationkey", 8, "int64"),
        ("c_acctbal", 27, "float64"), ("c_mktsegment", 37, "utf8"),
    ],
    "supplier": [
        ("s_suppkey", 16, "int64"), ("s_name", 37, "utf8"), ("s_nationkey", 8, "int64"),
        ("s_acctbal", 27, "float64"),
    ],
    "part": [
        ("p_partkey", 16, "int64"), ("p_name", 37, "utf8"), ("p_brand", 37, "utf8"),
        ("p_type", 37, "utf8"), ("p_size", 8, "int64"), ("p_retailprice", 27, "float64"),
    ],
    "orders": [
        ("o_orderkey", 16, "int64"), ("o_custkey", 16, "int64"), ("o_orderstatus", 37, "utf8"),
        ("o_totalprice", 27, "float64"), ("o_orderdate", 0, "native"), ("o_orderpriority", 37, "utf8"),
    ],
    "lineitem": [
        ("l_orderkey", 16, "int64"), ("l_partkey", 16, "int64"), ("l_suppkey", 16, "int64"),
        ("l_linenumber", 8, "int64"), ("l_quantity", 27, "float64"), ("l_extendedprice", 27, "float64"),
        ("l_discount", 27, "float64"), ("l_tax", 27, "float64"), ("l_returnflag", 37, "utf8"),
        ("l_linestatus", 37, "utf8"), ("l_shipdate", 0, "native"),
    ],
    "events": [
        ("event_id", 16, "int64"), ("ts", 0, "native"), ("user_id", 16, "int64"),
        ("event_type", 37, "utf8"), ("value", 27, "float64"), ("props", 37, "utf8"),
    ],
    "documents": [
        ("doc_id", 16, "int64"), ("text", 12, "utf8"), ("lang", 37, "utf8"),
        ("source", 37, "utf8"), ("n_chars", 16, "int64"),
    ],
    "embeddings": [("vec_id", 16, "int64"), ("embedding", 0, "native"), ("label", 8, "int64")],
    "pages": [("page_id", 16, "int64"), ("url", 37, "utf8"), ("html", 12, "utf8")],
    "benchmark": [("item_id", 16, "int64"), ("text", 37, "utf8")],
    "labels": [("doc_id", 16, "int64"), ("quality", 8, "int64"), ("toxic", 8, "int64")],
    "conversations": [
        ("conv_id", 16, "int64"), ("turn", 16, "int64"), ("role", 37, "utf8"), ("text", 12, "utf8"),
    ],
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents():
    """Makes the key of ``lineitem`` unique in the smallest tables as well."""
    return F.round(F.col("l_extendedprice") * 100).cast("bigint")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: _table(spark, sf_dir, name) for name in KEYS}


def _catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> th.Catalog:
    """``labels`` declares no key, and region one that is of no use, as its second column is text."""
    declared = {t: k for t, k in KEYS.items() if k and t in tables} | ({"region": ["r_regionkey", "r_name"]} if "region" in tables else {})
    return th.describe_tables(spark, tables, declared, TEXT_BLOBS)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.union, frames)


def _extract(
    spark: SparkSession, df: DataFrame, table: str, keys: list[str], **options
) -> DataFrame:
    stats = th.run_extract(df, table, fresh_path(spark, "extract"), keys, **options)
    return spark.read.parquet(stats.path) if stats.path else th.coerce_table(df)


def _profiles(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        th.profile_frame(df, KEYS[name]).select(F.lit(name).alias("table_name"), "n", "lo", "hi", "null_keys")
        for name, df in tables.items()
    )


# extraction


def extract_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, _table(spark, sf_dir, "orders"), "ORDERS", KEYS["orders"])


def extract_leading_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    return _extract(spark, lineitem, "LINEITEM", KEYS["lineitem"], strategy="leading_key")


def extract_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extract(
        spark, _table(spark, sf_dir, "conversations"), "CONVERSATIONS", KEYS["conversations"], has_text_blob=True
    )
    return th.read_in_key_order(rows, KEYS["conversations"], page_rows=PAGE)


def extract_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extract(spark, _table(spark, sf_dir, "labels"), "LABELS", [])


def extract_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table where key order is not wanted: no shuffle."""
    return _extract(spark, _table(spark, sf_dir, "lineitem"), "LINEITEM", KEYS["lineitem"], strategy="unkeyed")


def extract_text_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return _extract(
        spark, documents, "DOCUMENTS", KEYS["documents"], has_text_blob=True, compress=True, check_keys=True
    )


def extract_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extract(spark, _table(spark, sf_dir, "embeddings"), "EMBEDDINGS", KEYS["embeddings"])
    return rows.select("vec_id", F.posexplode("embedding").alias("dim", "x"), "label")


def extract_uneven_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared keys crowd the first ranges, so the split is taken from the data."""
    orders = _table(spark, sf_dir, "orders").withColumn("sq_key", F.col("o_orderkey") * F.col("o_orderkey"))
    path = fresh_path(spark, "uneven")
    th.write_extract(th.read_by_key_range(orders, ["sq_key"], even_floor=0), path)
    return spark.read.parquet(path)


def extract_by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and column types come from the catalog, not from the caller."""
    tables = _tables(spark, sf_dir)
    catalog = _catalog(spark, tables)
    columns = th.resolve_columns(catalog)
    return _extract(
        spark,
        tables["customer"],
        "CUSTOMER",
        th.keys_of(catalog, columns, "CUSTOMER"),
        declared_schema=th.declared_schema_of(columns, "CUSTOMER", tables["customer"]),
    )


def extract_by_catalog_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog whose codes would lose dates, booleans and decimals: what the connector delivers stays."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("o_day"),
        (F.col("o_custkey") % 2 == 0).alias("o_even"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_price"),
    )
    described = _catalog(spark, {"orders": orders})
    codes = [("orders.o_orderkey", 16, 0), ("orders.o_day", 12, 0), ("orders.o_even", 23, 0), ("orders.o_price", 8, 0)]
    fields = spark.createDataFrame(codes, "field_name string, field_type int, field_sub_type int")
    catalog = described._replace(fields=fields)
    columns = th.resolve_columns(catalog)
    keys = th.keys_of(catalog, columns, "ORDERS")
    return _extract(spark, orders, "ORDERS", keys, declared_schema=th.declared_schema_of(columns, "ORDERS", orders), check_keys=True)


def extract_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all files of an extract: rows, rows that do not follow the one before them in their file, and files that overlap."""
    lineitem = _table(spark, sf_dir, "lineitem")
    keys = KEYS["lineitem"]
    rows = _extract(spark, lineitem, "LINEITEM", keys, n=RANGES, strategy="leading_key")
    key = F.struct(*keys)
    in_file = Window.partitionBy("file").orderBy("place")
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"))
    checked = placed.select("file", key.alias("key"), (F.lag(key).over(in_file) > key).alias("falls"))
    files = checked.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if("falls").alias("falls"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    # one row per file
    earlier = F.max("hi").over(Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("n", "falls", (F.col("lo") <= earlier).alias("overlaps")).agg(
        F.sum("n").alias("n_rows"), F.sum("falls").alias("out_of_order"), F.count_if("overlaps").alias("overlapping_files"),
        (F.count(F.lit(1)) > 1).alias("many_files"),
    )


def extract_own_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that have the library's own working names, under a hot key: all come back."""
    orders = _table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    rows = orders.select(
        F.when(status == "F", F.lit(-1)).otherwise(F.col("o_custkey")).alias("s"), F.col("o_orderkey").alias("e"),
        status.alias("_part"), F.col("o_orderpriority").alias("_input_partition"), F.col("o_custkey").alias("leaf"),
        F.col("o_totalprice").alias("hash"),
    )
    path = fresh_path(spark, "names")
    th.write_extract(th.read_by_key_range(rows, ["s", "e"], RANGES, even_floor=0), path)
    back = spark.read.parquet(path)
    numbered = th.with_row_number(back, ["s", "e"], RANGES, even_floor=0)
    report = th.reconcile(rows, back, ["s", "e"], screen=True, content=True)
    return numbered.crossJoin(F.broadcast(report.select("missing_rows", "extra_rows", "duplicate_rows")))


def extract_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables, and one without rows."""
    out = fresh_path(spark, "all")

    def job(name: str, df: DataFrame, keys: list[str]):
        return lambda: th.run_extract(df, name, out, keys)

    tables = _tables(spark, sf_dir)
    jobs = [job(name, df, KEYS[name]) for name, df in tables.items()]
    stats = th.run_extracts([*jobs, job("no_orders", tables["orders"].where("o_orderkey < 0"), KEYS["orders"])])
    return th.extract_stats(spark, stats).select("table_name", "strategy", "rows", (F.col("megabytes") > 0).alias("wrote"))


def source_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    th.register_source(spark, "orders_source", f"{sf_dir}/orders.parquet")
    return spark.sql(
        """SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key,
                  max(o_orderkey) AS last_key
           FROM orders_source GROUP BY o_orderstatus, o_orderpriority"""
    )


def extract_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract that dies in one of its ranges, and the call that goes on with it."""
    orders = _table(spark, sf_dir, "orders")
    out, lost = fresh_path(spark, "resumed"), orders.agg(F.floor(F.avg("o_orderkey"))).first()[0]
    dies = F.when(F.col("o_orderkey") >= lost, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("o_custkey"))
    try:
        th.run_extract_resumable(orders.withColumn("o_custkey", dies), "ORDERS", out, KEYS["orders"], RANGES, waves=4)
    except Exception as error:  # the run that dies is meant to
        if "lost" not in str(error):
            raise
    stats = th.run_extract_resumable(orders, "ORDERS", out, KEYS["orders"], RANGES)
    return th.read_version(spark, stats.path)


def extract_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract of an older state of a table, brought up to date: rows changed, deleted, filled in and added at the end."""
    lineitem = _table(spark, sf_dir, "lineitem").withColumn("cents", _cents())
    keys = [*KEYS["lineitem"], "cents"]
    top = lineitem.agg(F.max("l_orderkey")).first()[0]
    key = F.col("l_orderkey")
    older = lineitem.filter((key < top * 9 // 10) & ~key.between(top // 2, top // 2 + 9))
    older = older.withColumn("l_quantity", F.when(key.between(top // 4, top // 4 + 9), F.lit(0.0)).otherwise(F.col("l_quantity")))
    older = older.union(older.filter(key.between(top // 3, top // 3 + 9)).withColumn("cents", -F.col("cents")))
    stats = th.run_extract_resumable(older, "LINEITEM", fresh_path(spark, "delta"), keys, 4 * RANGES)
    before = {f for r in th.ledger(spark, stats.path).collect() for f in r.files}
    report = th.extract_delta(lineitem, stats.path, keys)
    after = {f for r in th.ledger(spark, stats.path).collect() for f in r.files}
    few = report["replaced"] <= 8 and report["kept"] >= 2 * RANGES and len(before & after) >= report["kept"]
    return th.read_version(spark, stats.path).withColumn("few_files_written", F.lit(few))


def source_datasource_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract as a SQL data source: some of its key ranges, and the whole of it with and without a condition."""
    keys = KEYS["lineitem"]
    stats = th.run_extract(_table(spark, sf_dir, "lineitem"), "LINEITEM", fresh_path(spark, "extract"), keys, RANGES, strategy="leading_key")
    th.register_key_ranges(spark)
    for name, bounds in (("lineitem_ranges", ""), ("lineitem_some", ", lower '200', upper '900'")):
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY VIEW {name} USING key_ranges
                OPTIONS (path '{stats.path}', key '{keys[0]}', ranges '{RANGES}'{bounds})"""
        )
    measures = "l_returnflag, count(*) AS n, sum(l_linenumber) AS line_numbers, min(l_shipdate) AS first_day"
    return spark.sql(
        f"""SELECT 'some' AS part, {measures} FROM lineitem_some GROUP BY l_returnflag
            UNION ALL SELECT 'few', {measures} FROM lineitem_ranges WHERE l_orderkey < 200 AND l_linestatus = 'F' GROUP BY l_returnflag
            UNION ALL SELECT 'all', {measures} FROM lineitem_ranges GROUP BY l_returnflag"""
    )


# order and pages


def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return th.page(_table(spark, sf_dir, "orders"), KEYS["orders"], 101, 150)


def page_slice_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last rows of the table: only the key ranges that hold them are read."""
    lineitem = _table(spark, sf_dir, "lineitem")
    rows = lineitem.count()
    return th.page(lineitem, KEYS["lineitem"], rows - 49, rows)


def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows, one of whose columns has the name of the row number."""
    lineitem = _table(spark, sf_dir, "lineitem").withColumns({"row_no": F.col("l_suppkey"), "cents": _cents()})
    return th.with_page_number(lineitem, [*KEYS["lineitem"], "cents"], PAGE)


def _hot_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = F.when(F.col("l_returnflag") == "A", F.lit(-1)).otherwise(F.col("l_orderkey"))
    return _table(spark, sf_dir, "lineitem").withColumns({"hot_key": hot, "cents": _cents()})


def row_numbers_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows share the leading key; later key columns split them."""
    return th.with_row_number(_hot_lineitem(spark, sf_dir), ["hot_key", *KEYS["lineitem"], "cents"], even_floor=0)


# profiles and plans


def profile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(_tables(spark, sf_dir))


def plan_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = th.profile_key(_table(spark, sf_dir, "orders"), KEYS["orders"])
    return th.ranges_frame(spark, th.plan_ranges(profile.lo, profile.hi, RANGES))


def plan_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = th.profile_key(_table(spark, sf_dir, "orders"), KEYS["orders"])
    return th.plan_chunks(spark, th.plan_ranges(profile.lo, profile.hi, RANGES), CHUNK)


def range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return th.range_counts(_table(spark, sf_dir, "labels"), "doc_id", RANGES)


def range_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each pushed-down predicate selects, all predicates in one pass."""
    lineitem = _table(spark, sf_dir, "lineitem")
    profile = th.profile_key(lineitem, ["l_orderkey"])
    predicates = th.range_predicates("`l_orderkey`", th.plan_ranges(profile.lo, profile.hi, RANGES), open_ended=True)
    counts = [F.count_if(F.expr(p)) for p in predicates]
    return lineitem.agg(F.array(*counts).alias("counts")).select(
        F.posexplode("counts").alias("range_id", "n_rows")
    )


def balanced_range_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squared keys again: a balanced plan covers every row and stays within 5 % of even."""
    orders = _table(spark, sf_dir, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("sq_key"))
    ranges = th.plan_balanced_ranges(orders, "sq_key", RANGES)
    counted = orders.groupBy(th.assign_range(F.col("sq_key"), ranges).alias("range_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("sq_key").alias("lo"), F.max("sq_key").alias("hi")
    )
    share = F.sum("n_rows") / F.lit(RANGES)
    return counted.agg(
        F.count(F.lit(1)).alias("n_ranges"),
        F.sum("n_rows").alias("rows_covered"),
        F.min("lo").alias("first_key"),
        F.max("hi").alias("last_key"),
        ((F.max("n_rows") <= share * 1.05) & (F.min("n_rows") >= share * 0.95)).alias("even"),
    )


def predicates_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows share the leading key: every row meets one predicate, shares stay even."""
    rows = _hot_lineitem(spark, sf_dir)
    keys = ["hot_key", *KEYS["lineitem"]]
    predicates = th.plan_key_predicates(rows, keys, RANGES)
    hits = [F.expr(p).cast("int") for p in predicates]
    counted = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(reduce(lambda a, b: a + b, hits)).alias("hits"),
        F.greatest(*[F.sum(h) for h in hits]).alias("heaviest"),
    )
    return counted.select("n", "hits", (F.col("heaviest") * RANGES < F.col("n") * 2).alias("even"))


def many_balanced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hot key cut into ten thousand parts of rows: rows in parts, parts that reach into the next, and the largest one."""
    rows = _hot_lineitem(spark, sf_dir)
    keys = ["hot_key", *KEYS["lineitem"], "cents"]
    profile = th.profile_key(rows, keys)
    leaves = th.plan_leaves(rows, keys, MANY_PARTS, profile.lo, profile.hi, profile.rows)
    key = F.struct(*keys)
    parts = with_leaf_number(rows, leaves, keys, "part").groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    # one row per part
    earlier = F.max("hi").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return parts.select("n", (F.col("lo") <= earlier).alias("overlaps")).agg(
        F.sum("n").alias("n_rows"), F.count_if("overlaps").alias("overlapping_parts"),
        (F.max("n") <= F.greatest(F.lit(2), F.ceil(1.05 * F.sum("n") / MANY_PARTS) + 1)).alias("even"),
    )


# catalogs and strategies


def resolve_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog columns of all tables with what the data itself shows of each."""
    tables = _tables(spark, sf_dir)
    measured = _union(
        th.column_stats(df).select(F.lit(name).alias("relation_name"), "column_name", "n", "null_ratio")
        for name, df in tables.items()
    )
    return th.resolve_columns(_catalog(spark, tables)).join(measured, ["relation_name", "column_name"])


def _detected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    tables = _tables(spark, sf_dir)
    catalog = _catalog(spark, tables)
    columns = th.resolve_columns(catalog)
    return th.detect_keys(catalog, columns), columns, _profiles(tables)


def detect_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, _, profiles = _detected(spark, sf_dir)
    return keys.join(profiles, keys.relation_name == profiles.table_name).select(
        "table_name", F.array_join("key_columns", ",").alias("key_columns"), "usable", "n", "lo", "hi"
    )


def choose_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, columns, profiles = _detected(spark, sf_dir)
    blobs = th.text_blob_tables(columns)
    sized = keys.where("usable").select("relation_name", F.size("key_columns").alias("key_size"))
    joined = (
        profiles.withColumnRenamed("table_name", "relation_name")
        .join(sized, "relation_name", "left")
        .join(blobs, "relation_name")
    )
    return th.choose_strategy(joined).select("relation_name", "n", "has_text_blob", "strategy", "batch_rows")


# coercion


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    not_a_number = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(price)
    return _table(spark, sf_dir, "lineitem").select(
        *KEYS["lineitem"][:1],
        F.col("l_linenumber").cast("bigint").alias("line_long"),
        F.col("l_linenumber").cast("double").alias("line_double"),
        float_to_int64(price).alias("price_int"),
        float_to_int64(-price).alias("minus_price_int"),
        float_to_int64(price * F.lit(1e16)).alias("huge_int"),
        float_to_int64(price * F.lit(-1e16)).alias("minus_huge_int"),
        float_to_int64(not_a_number).alias("nan_int"),
    )


def coerce_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t　 "), F.col("text"), F.lit(" \r\n "))
    return _table(spark, sf_dir, "documents").select(
        "doc_id",
        trim_text(padded).alias("text"),
        th.coerce_column(F.col("n_chars"), T.LongType(), "utf8").alias("n_chars_text"),
        (F.col("n_chars") > F.col("doc_id")).cast("string").alias("flag_text"),
    )


def coerce_float_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        float_to_text(price).alias("price_text"),
        float_to_text(price / F.lit(7.0)).alias("seventh_text"),
        float_to_text(F.rint(price)).alias("whole_text"),
    )


def coerce_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select(
        "page_id", F.hex(text_to_bytes(F.col("url"))).alias("url_hex"), F.hex(text_to_bytes(F.col("html"))).alias("html_hex")
    )


def coerce_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UTF-8 bytes read as Latin-1, every byte one character."""
    return _table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", bytes_to_text(text_to_bytes(F.col("text"))).alias("latin1")
    )


def null_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("O")).alias("status"),
        F.nullif("o_custkey", F.col("o_orderkey")).alias("cust"),
        F.nullif(F.rint("o_totalprice"), F.col("o_totalprice")).alias("price"),
    )
    return th.coerce_table(orders.withColumn("cust_text", F.col("cust")).withColumn("price_text", F.col("price")),
                           {"cust_text": "utf8", "price_text": "utf8"})


def coerce_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = {"event_id": "utf8", "ts": "int64", "user_id": "float64", "event_type": "float64", "value": "int64", "props": "binary"}
    return th.coerce_table(_table(spark, sf_dir, "events"), declared).withColumn("props", F.hex("props"))


# statistics, compaction, reconciliation


def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        th.column_stats(df).select(F.lit(name).alias("table_name"), "position", "column_name", "n", "null_ratio", "avg_length")
        for name, df in _tables(spark, sf_dir).items()
    )


def _scalar_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Integer and text columns of all tables, whose text form is the same everywhere."""
    return {
        name: _table(spark, sf_dir, name).select(*(c for c, _, target in COLUMNS[name] if target in ("int64", "utf8"))) for name in KEYS
    }


def column_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all columns: NULLs, and whether distinct counts and the counts of all listed values are within their bounds."""
    out = []
    for name, df in _scalar_tables(spark, sf_dir).items():
        sketched = th.column_sketches(df)
        items = F.array(*(F.struct(F.lit(i).alias("position"), as_item(f).alias("value")) for i, f in enumerate(df.schema.fields)))
        counts = df.select(F.inline(items)).where("value IS NOT NULL").groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
        listed = sketched.select("position", "count_error", F.explode("heavy").alias("h"))
        listed = listed.select("position", "count_error", F.col("h.value").alias("value"), F.col("h.n").alias("listed"))
        # an unlisted value may have up to twice the bound
        off = counts.join(listed, ["position", "value"], "left").join(sketched.select("position", F.col("count_error").alias("bound")), "position")
        wrong = F.coalesce(F.abs(F.col("listed") - F.col("n")) > F.col("bound"), F.col("n") > 2 * F.col("bound"))
        checked = off.groupBy("position").agg(F.count(F.lit(1)).alias("exact"), F.count_if(wrong).alias("n_wrong"))
        within = F.abs(F.col("n_distinct") - F.coalesce("exact", F.lit(0))) <= 1 + DISTINCT_ERROR * F.coalesce("exact", F.lit(0))
        out.append(
            sketched.join(checked, "position", "left").select(
                F.lit(name).alias("table_name"), "column_name", "n", "n_null", within.alias("distinct_within"), F.coalesce("n_wrong", F.lit(0)).alias("n_wrong")
            )
        )
    return _union(out)


def heavy_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of at least 2 % of the rows of any column, found by sketches and counted exactly."""
    return _union(
        th.heavy_values(df, HEAVY_SHARE).select(F.lit(name).alias("table_name"), "column_name", "value", "n")
        for name, df in _scalar_tables(spark, sf_dir).items()
    )


def discover_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least unique sets of integer columns of all tables, and of one whose key is spoilt by a repeated row."""
    tables = _tables(spark, sf_dir)
    tables["suppliers_and_one"] = tables["supplier"].union(tables["supplier"].where("s_suppkey = 1"))
    found = [(name, ",".join(key)) for name, df in tables.items() for key in th.discover_keys(df) or [[]]]
    return spark.createDataFrame(found, "table_name string, key_columns string")


def profile_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct keys of all tables that have a key, and of the leading columns of composite ones."""
    tables = _tables(spark, sf_dir)
    return _union(
        th.key_uniqueness(tables[name], keys[:size]).select(F.lit(name).alias("table_name"), F.lit(",".join(keys[:size])).alias("key_columns"), "*")
        for name, keys in KEYS.items() for size in range(1, len(keys) + 1)
    )


def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in many small files, then in even ones of at most ``FILE_ROWS`` rows: content of each, and what the files hold."""
    small, usual = fresh_path(spark, "small"), fresh_path(spark, "usual")
    th.write_extract(_table(spark, sf_dir, "orders"), small, rows_per_file=FILE_ROWS // 8 + 1)
    th.compact(spark, small, usual, FILE_ROWS)
    rows = spark.read.parquet(usual)
    per_file = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("n_files"), F.min("n").alias("smallest"), F.max("n").alias("largest"),
        F.sum("n").alias("n_rows"), F.sum("keys").alias("keys"), F.sum("cents").alias("cents"),
    )


def compact_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that fit among small and oversized ones: content of each stays, and those that fit are not written again."""
    orders, path = _table(spark, sf_dir, "orders"), fresh_path(spark, "mixed")
    rows = orders.count()
    size = rows // 10
    parts = ((0, 4 * size, size), (4 * size, 5 * size, size // 20 + 1), (5 * size, rows, rows))
    for lo, hi, per_file in parts:
        part = orders.filter(F.col("o_orderkey").between(lo, hi - 1)) if hi < rows else orders.filter(F.col("o_orderkey") >= lo)
        th.write_extract(part.coalesce(1), path, rows_per_file=per_file, mode="append")
    before = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).count()
    fitting = {r.file for r in before.filter(F.col("count").between(size // 2, size)).collect()}
    done = th.compact_in_place(spark, path, size)
    back = spark.read.parquet(path)
    per_file = back.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    )
    kept = F.count_if(F.col("file").isin(*fitting)) if fitting else F.lit(0)
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.sum("keys").alias("keys"), F.sum("cents").alias("cents"), (F.max("n") <= size).alias("none_too_large"),
        ((kept == len(fitting)) & F.lit(done.files_kept == len(fitting) and done.rows_rewritten <= 7 * rows // 10)).alias("fitting_files_kept"),
    )


def page_from_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the middle of an extract, from its directory."""
    lineitem = _table(spark, sf_dir, "lineitem").withColumn("cents", _cents())
    keys = [*KEYS["lineitem"], "cents"]
    stats = th.run_extract(lineitem, "LINEITEM", fresh_path(spark, "paged"), keys, RANGES)
    rows = th.write_directory(spark, stats.path, keys, every=PAGE)
    return th.page_from_directory(spark, stats.path, keys, rows // 2 + 1, rows // 2 + 250)


def reconcile_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of a whole extract is wrong: the tree leads to its leaf, and no other key is read."""
    orders = _table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    stats = th.run_extract(orders, "ORDERS", fresh_path(spark, "tree"), KEYS["orders"], RANGES)
    leaves = th.write_digests(spark, stats.path, KEYS["orders"], leaf_rows=50)
    price = F.when(F.col("o_orderkey") == top // 2, -F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))
    found = th.reconcile_tree(orders.withColumn("o_totalprice", price), stats.path, KEYS["orders"])
    return found.withColumn("few_keys_read", (F.col("leaves_read") == 1) & (F.col("keys_read") <= 2 * 55) & F.lit(leaves > 16)).drop("leaves_read", "keys_read")


def reconcile_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return th.reconcile(
        _table(spark, sf_dir, "lineitem"), extract_leading_key(spark, sf_dir), KEYS["lineitem"]
    )


def reconcile_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders twice, pending ones lost, low-priority ones again under unknown keys."""
    orders = _table(spark, sf_dir, "orders")
    faulty = _union(
        [
            orders.where(F.col("o_orderstatus") != "P"),
            orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "P")),
            orders.where(F.col("o_orderpriority") == "5-LOW").withColumn("o_orderkey", -F.col("o_orderkey") - 1),
        ]
    )
    return th.reconcile(orders, faulty, KEYS["orders"])


def reconcile_screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few faults in a whole table: one customer's orders lost, another's doubled."""
    orders = _table(spark, sf_dir, "orders")
    customer = F.col("o_custkey")
    faulty = orders.where(customer != 7).union(orders.where(customer == 11))
    return th.reconcile(orders, faulty, KEYS["orders"], screen=True)


def reconcile_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key is there once, but some values are lost or changed."""
    orders = _table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice"))
    return th.reconcile(orders, orders.withColumn("o_totalprice", price), KEYS["orders"], content=True)


def partition_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions for a joined view follow the rows it has, not the planner's guess."""
    joined = _table(spark, sf_dir, "lineitem").join(_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = joined.count()
    parts = default_partitions(joined, rows)
    return joined.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("few", F.lit(parts) <= 8 + F.col("n_rows") / 10_000)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: orders in disjoint key ranges to Parquet and back."""
    return extract_single_key(spark, "/root/testdata/sf0.001")


_QUERIES = (
    extract_single_key, extract_leading_key, extract_key_order, extract_unkeyed, extract_unordered,
    extract_text_blobs, extract_nested, extract_uneven_key, extract_by_catalog, extract_by_catalog_types, extract_file_order, extract_own_names, extract_stats, extract_resumed, extract_delta, source_view_sql, source_datasource_sql, page_slice, page_slice_far, page_numbers,
    row_numbers_hot_key, profile_keys, plan_ranges, plan_chunks, range_counts, range_predicates,
    balanced_range_counts, predicates_hot_key, many_balanced_parts, resolve_columns, detect_keys, choose_strategy, coerce_numeric, coerce_text,
    coerce_float_text, coerce_binary, coerce_charset, null_coercion, coerce_declared, column_stats, column_sketches,
    heavy_values, discover_keys, profile_distinct_keys,
    compact_files, compact_mixed, page_from_directory, reconcile_tree, reconcile_clean, reconcile_faulty, reconcile_screened, reconcile_content, partition_sizes,
)


def library_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return library_queries()
    return library_queries() | llm.QUERIES | {"pipeline": corpus_pipeline.run}


# SQL counterparts


def _white_space_sql() -> str:
    return "(" + " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"


def _trimmed(column: str) -> str:
    return f"trim({column}, {_white_space_sql()})"


def _coerced(table: str) -> str:
    """Select list of a table as an extract holds it."""
    parts = []
    for name, code, target in COLUMNS[table]:
        if target == "int64":
            parts.append(f"CAST({name} AS BIGINT) AS {name}")
        elif target == "utf8":
            parts.append(f"{_trimmed(name)} AS {name}")
        else:
            parts.append(name)
    return ", ".join(parts)


def _bounds(table: str, key: str) -> str:
    return f"(SELECT min({key}) AS lo, max({key}) AS hi, max({key}) - min({key}) + 1 AS span FROM {table})"


def _planned(table: str, key: str) -> str:
    """Equal-width ranges; assumes at least RANGES key values."""
    return f"""
      SELECT i AS range_id, lo + span * i // {RANGES} AS lo, lo + span * (i + 1) // {RANGES} - 1 AS hi
      FROM {_bounds(table, key)}, range({RANGES}) AS r(i)"""


def _profile_rows() -> str:
    rows = []
    for name, keys in KEYS.items():
        bounds = f"CAST(min({keys[0]}) AS BIGINT) AS lo, CAST(max({keys[0]}) AS BIGINT) AS hi" if keys else (
            "CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi"
        )
        nulls = " OR ".join(f"{k} IS NULL" for k in keys) or "false"
        rows.append(
            f"SELECT '{name}' AS table_name, count(*) AS n, {bounds}, "
            f"count(*) FILTER (WHERE {nulls}) AS null_keys FROM {name}"
        )
    return " UNION ALL ".join(rows)


def _column_rows(with_length: bool) -> str:
    rows = []
    for name, columns in COLUMNS.items():
        for position, (column, code, target) in enumerate(columns):
            length = f"avg(length({column}))" if target == "utf8" else "CAST(NULL AS DOUBLE)"
            rows.append(
                f"SELECT '{name}' AS table_name, {position} AS position, '{column}' AS column_name, "
                f"count(*) AS n, avg(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) AS null_ratio"
                + (f", {length} AS avg_length" if with_length else "")
                + f" FROM {name}"
            )
    return " UNION ALL ".join(rows)


def _scalar_columns():
    return ((name, c, target) for name, columns in COLUMNS.items() for c, _, target in columns if target in ("int64", "utf8"))


def _heavy_rows() -> str:
    rows = []
    for name, c, target in _scalar_columns():
        value = f"CASE WHEN length({c}) <= {LONG_TEXT} THEN {c} ELSE 'sha256:' || sha256({c}) END" if target == "utf8" else f"CAST({c} AS VARCHAR)"
        rows.append(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, value, n "
            f"FROM (SELECT {value} AS value, count(*) AS n FROM {name} WHERE {c} IS NOT NULL GROUP BY 1) "
            f"WHERE n >= {HEAVY_SHARE} * (SELECT count(*) FROM {name})"
        )
    return " UNION ALL ".join(rows)


def _key_rows() -> str:
    """Every set of integer columns that is unique while none of its subsets is."""
    sources = {name: name for name in COLUMNS}
    sources["suppliers_and_one"] = "(SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey = 1)"
    rows = []
    for name, source in sources.items():
        integers = [c for c, _, target in COLUMNS.get(name, COLUMNS["supplier"]) if target == "int64"]
        sets = [s for size in range(1, MAX_COLUMNS + 1) for s in combinations(integers, size)]
        unique = {s: f"(count(DISTINCT ({', '.join(s)})) = count(*) AND " + " AND ".join(f"count({c}) = count(*)" for c in s) + ")" for s in sets}
        rows += [
            f"SELECT '{name}' AS table_name, '{','.join(s)}' AS key_columns FROM {source} HAVING count(*) > 1 AND {unique[s]}"
            + "".join(f" AND NOT {unique[t]}" for t in sets if set(t) < set(s))
            for s in sets
        ]
        rows.append(f"SELECT '{name}', '' FROM {source} HAVING count(*) < 2 OR NOT ({' OR '.join(unique.values())})")
    return " UNION ALL ".join(rows)


def _distinct_key_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{','.join(keys[:size])}' AS key_columns, CAST(coalesce(sum(copies), 0) AS BIGINT) AS n, "
        f"count(*) AS n_distinct, CAST(coalesce(sum(copies), 0) - count(*) AS BIGINT) AS n_repeated, coalesce(max(copies), 0) AS most "
        f"FROM (SELECT count(*) AS copies FROM {name} GROUP BY {', '.join(keys[:size])})"
        for name, keys in KEYS.items() for size in range(1, len(keys) + 1)
    )


def _strategy(keys: str) -> str:
    return (
        f"CASE WHEN n = 0 THEN 'empty' WHEN {keys} = 0 THEN 'unkeyed' WHEN {keys} = 1 THEN 'single_key' "
        "WHEN n > 10000000 THEN 'leading_key' ELSE 'key_order' END"
    )


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows) + ")"


def _truncated(x: str) -> str:
    return (
        f"CASE WHEN isnan({x}) THEN 0 WHEN {x} >= 9223372036854775807.0::DOUBLE THEN 9223372036854775807 "
        f"WHEN {x} <= -9223372036854775808.0::DOUBLE THEN -9223372036854775807 - 1 ELSE CAST(trunc({x}) AS BIGINT) END"
    )


def _plain_digits(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')"


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return library_sql()
    whole = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return library_sql() | llm.ORACLE_SQL | whole


def library_sql() -> dict[str, str]:
    lineitem_keys = ", ".join(KEYS["lineitem"])
    key_sizes = _values((f"'{t}'", len(k), str(any(b[0] == t for b in TEXT_BLOBS)).lower()) for t, k in KEYS.items())
    key_lists = _values((f"'{t}'", f"'{','.join(k)}'") for t, k in KEYS.items() if k)
    column_rows = _values(
        (
            f"'{t}'", i, f"'{c}'", 12 if (t, c) in TEXT_BLOBS else code, f"'{target}'",
            str((t, c) in TEXT_BLOBS).lower(),
        )
        for t, columns in COLUMNS.items()
        for i, (c, code, target) in enumerate(columns)
    )
    return {
        "extract_single_key": f"SELECT {_coerced('orders')} FROM orders",
        "extract_leading_key": f"SELECT {_coerced('lineitem')} FROM lineitem",
        "extract_key_order": f"""
            SELECT {_coerced('conversations')},
                   CAST((row_number() OVER (ORDER BY conv_id, turn) - 1) // {PAGE} AS BIGINT) AS page_no
            FROM conversations""",
        "extract_unkeyed": f"SELECT {_coerced('labels')} FROM labels",
        "extract_unordered": f"SELECT {_coerced('lineitem')} FROM lineitem",
        "extract_text_blobs": f"SELECT {_coerced('documents')} FROM documents",
        "extract_nested": """
            SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, embedding[i] AS x, CAST(label AS BIGINT) AS label
            FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
        "extract_uneven_key": "SELECT *, o_orderkey * o_orderkey AS sq_key FROM orders",
        "extract_by_catalog": f"SELECT {_coerced('customer')} FROM customer",
        "extract_by_catalog_types": """
            SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_day, o_custkey % 2 = 0 AS o_even,
                   CAST(o_totalprice AS DECIMAL(18,2)) AS o_price FROM orders""",
        "extract_file_order": """
            SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_order, CAST(0 AS BIGINT) AS overlapping_files,
                   true AS many_files FROM lineitem""",
        "extract_own_names": """
            SELECT *, row_number() OVER (ORDER BY s, e) AS row_no, CAST(0 AS BIGINT) AS missing_rows,
                   CAST(0 AS BIGINT) AS extra_rows, CAST(0 AS BIGINT) AS duplicate_rows
            FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN CAST(-1 AS BIGINT) ELSE o_custkey END AS s, o_orderkey AS e,
                         o_orderstatus AS _part, o_orderpriority AS _input_partition, o_custkey AS leaf,
                         o_totalprice AS hash FROM orders)""",
        "extract_resumed": f"SELECT {_coerced('orders')} FROM orders",
        "extract_delta": f"""
            SELECT {_coerced('lineitem')}, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, true AS few_files_written FROM lineitem""",
        "extract_stats": f"""
            SELECT p.table_name, {_strategy('k.key_size')} AS strategy, p.n AS rows, p.n > 0 AS wrote
            FROM ({_profile_rows()}) p JOIN {key_sizes} AS k(table_name, key_size, blob) USING (table_name)
            UNION ALL SELECT 'no_orders', 'empty', count(*), count(*) > 0 FROM orders WHERE o_orderkey < 0""",
        "reconcile_content": """
            SELECT count(*) AS source_rows, count(*) AS extracted_rows, CAST(0 AS BIGINT) AS duplicate_rows,
                   count(*) FILTER (WHERE o_orderstatus = 'P') AS missing_rows,
                   count(*) FILTER (WHERE o_orderstatus = 'P') AS extra_rows FROM orders""",
        "partition_sizes": "SELECT count(*) AS n_rows, true AS few FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
        "source_view_sql": """
            SELECT o_orderstatus, o_orderpriority, count(*) AS n, min(o_orderkey) AS first_key,
                   max(o_orderkey) AS last_key
            FROM orders GROUP BY o_orderstatus, o_orderpriority""",
        "source_datasource_sql": " UNION ALL ".join(
            f"""SELECT '{part}' AS part, l_returnflag, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers, min(l_shipdate) AS first_day
                FROM lineitem WHERE {condition} GROUP BY l_returnflag"""
            for part, condition in (("some", "l_orderkey BETWEEN 200 AND 900"), ("few", "l_orderkey < 200 AND l_linestatus = 'F'"), ("all", "true"))
        ),
        "page_slice": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100",
        "page_slice_far": f"SELECT * FROM lineitem ORDER BY {', '.join(k + ' DESC' for k in KEYS['lineitem'])} LIMIT 50",
        "page_numbers": f"""
            SELECT *, l_suppkey AS row_no, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
                   CAST((row_number() OVER (ORDER BY {lineitem_keys}, l_extendedprice) - 1) // {PAGE} AS BIGINT) AS page_no
            FROM lineitem""",
        "row_numbers_hot_key": f"""
            SELECT *, row_number() OVER (ORDER BY hot_key, {lineitem_keys}, cents) AS row_no
            FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CASE WHEN l_returnflag = 'A' THEN CAST(-1 AS BIGINT) ELSE l_orderkey END AS hot_key
                  FROM lineitem)""",
        "profile_keys": _profile_rows(),
        "plan_ranges": _planned("orders", "o_orderkey"),
        "plan_chunks": f"""
            SELECT range_id, c AS chunk_id, lo + c * {CHUNK} AS lo, least(lo + (c + 1) * {CHUNK} - 1, hi) AS hi
            FROM (SELECT *, unnest(range((hi - lo) // {CHUNK} + 1)) AS c FROM ({_planned('orders', 'o_orderkey')}))""",
        "range_counts": f"""
            SELECT p.range_id, p.lo, p.hi, count(l.doc_id) AS n_rows
            FROM ({_planned('labels', 'doc_id')}) p LEFT JOIN labels l ON l.doc_id BETWEEN p.lo AND p.hi
            GROUP BY p.range_id, p.lo, p.hi""",
        "range_predicates": f"""
            SELECT CAST(((l_orderkey - lo + 1) * {RANGES} - 1) // span AS INTEGER) AS range_id, count(*) AS n_rows
            FROM lineitem, {_bounds('lineitem', 'l_orderkey')} GROUP BY 1""",
        "balanced_range_counts": f"""
            SELECT CAST({RANGES} AS BIGINT) AS n_ranges, CAST(count(*) AS BIGINT) AS rows_covered,
                   min(o_orderkey * o_orderkey) AS first_key, max(o_orderkey * o_orderkey) AS last_key, true AS even
            FROM orders""",
        "many_balanced_parts": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS overlapping_parts, true AS even FROM lineitem",
        "predicates_hot_key": "SELECT count(*) AS n, count(*) AS hits, true AS even FROM lineitem",
        "resolve_columns": f"""
            SELECT c.relation_name, c.position, c.column_name, c.type_code, c.target_type, c.is_text_blob,
                   m.n, m.null_ratio
            FROM {column_rows} AS c(relation_name, position, column_name, type_code, target_type, is_text_blob)
            JOIN ({_column_rows(False)}) m ON m.table_name = c.relation_name AND m.column_name = c.column_name""",
        "detect_keys": f"""
            SELECT table_name, CASE WHEN table_name = 'region' THEN 'r_regionkey,r_name' ELSE key_columns END AS key_columns,
                   table_name <> 'region' AS usable, n, lo, hi
            FROM ({_profile_rows()}) p JOIN {key_lists} AS k(table_name, key_columns) USING (table_name)""",
        "choose_strategy": f"""
            SELECT table_name AS relation_name, n, has_text_blob,
                   {_strategy("(CASE WHEN table_name = 'region' THEN 0 ELSE key_size END)")} AS strategy,
                   CAST(CASE WHEN has_text_blob THEN batch * 2 // 3 ELSE batch END AS BIGINT) AS batch_rows
            FROM (SELECT *, CASE WHEN n < 200000 THEN 250000 WHEN n < 10000000 THEN 500000
                                 WHEN n < 50000000 THEN 750000 ELSE 1000000 END AS batch
                  FROM ({_profile_rows()}) JOIN {key_sizes} AS k(table_name, key_size, has_text_blob)
                  USING (table_name))""",
        "coerce_numeric": f"""
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS line_long, CAST(l_linenumber AS DOUBLE) AS line_double,
                   {_truncated('l_extendedprice')} AS price_int, {_truncated('(-l_extendedprice)')} AS minus_price_int,
                   {_truncated('(l_extendedprice * 1e16)')} AS huge_int,
                   {_truncated('(l_extendedprice * -1e16)')} AS minus_huge_int,
                   CASE WHEN l_discount = 0 THEN 0 ELSE {_truncated('l_extendedprice')} END AS nan_int
            FROM lineitem""",
        "coerce_text": f"""
            SELECT doc_id, {_trimmed('text')} AS text, CAST(n_chars AS VARCHAR) AS n_chars_text,
                   CASE WHEN n_chars > doc_id THEN 'true' ELSE 'false' END AS flag_text
            FROM documents""",
        "coerce_float_text": f"""
            SELECT o_orderkey, {_plain_digits('o_totalprice')} AS price_text,
                   {_plain_digits('o_totalprice / 7.0::DOUBLE')} AS seventh_text,
                   {_plain_digits('round_even(o_totalprice, 0)')} AS whole_text
            FROM orders""",
        "coerce_binary": "SELECT page_id, hex(encode(url)) AS url_hex, hex(encode(html)) AS html_hex FROM pages",
        "coerce_charset": """
            SELECT conv_id, turn,
                   array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'),
                                                  lambda h: chr(CAST('0x' || h AS INTEGER))), '') AS latin1
            FROM conversations""",
        "null_coercion": f"""
            SELECT *, CAST(cust AS VARCHAR) AS cust_text, {_plain_digits('price')} AS price_text
            FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, nullif(o_custkey, o_orderkey) AS cust,
                         nullif(round_even(o_totalprice, 0), o_totalprice) AS price FROM orders)""",
        "coerce_declared": f"""
            SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(NULL AS BIGINT) AS ts,
                   CAST(user_id AS DOUBLE) AS user_id, CAST(NULL AS DOUBLE) AS event_type,
                   {_truncated('value')} AS value, hex(encode(props)) AS props
            FROM events""",
        "column_stats": _column_rows(True),
        "column_sketches": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS n_null, "
            f"true AS distinct_within, CAST(0 AS BIGINT) AS n_wrong FROM {name}" for name, c, _ in _scalar_columns()
        ),
        "heavy_values": _heavy_rows(),
        "discover_keys": _key_rows(),
        "profile_distinct_keys": _distinct_key_rows(),
        "compact_files": f"""
            SELECT files AS n_files, n - (files - 1) * size AS smallest, size AS largest, n AS n_rows, keys, cents
            FROM (SELECT *, (n + files - 1) // files AS size
                  FROM (SELECT count(*) AS n, (count(*) + {FILE_ROWS} - 1) // {FILE_ROWS} AS files,
                               CAST(sum(o_orderkey) AS BIGINT) AS keys,
                               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders))""",
        "compact_mixed": """
            SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys,
                   CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, true AS none_too_large, true AS fitting_files_kept
            FROM orders""",
        "page_from_directory": f"""
            SELECT * FROM (SELECT {_coerced('lineitem')}, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)
            ORDER BY {lineitem_keys}, cents LIMIT 250 OFFSET (SELECT count(*) // 2 FROM lineitem)""",
        "reconcile_tree": """
            SELECT count(*) AS source_rows, count(*) AS extracted_rows, CAST(0 AS BIGINT) AS duplicate_rows,
                   CAST(1 AS BIGINT) AS missing_rows, CAST(1 AS BIGINT) AS extra_rows, true AS few_keys_read FROM orders""",
        "reconcile_clean": """
            SELECT count(*) AS source_rows, count(*) AS extracted_rows, CAST(0 AS BIGINT) AS duplicate_rows,
                   CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows FROM lineitem""",
        "reconcile_faulty": """
            SELECT count(*) AS source_rows,
                   count(*) FILTER (WHERE o_orderstatus <> 'P')
                     + count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')
                     + count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS extracted_rows,
                   count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P') AS duplicate_rows,
                   count(*) FILTER (WHERE o_orderstatus = 'P') AS missing_rows,
                   count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS extra_rows
            FROM orders""",
        "reconcile_screened": """
            SELECT count(*) AS source_rows,
                   count(*) FILTER (WHERE o_custkey <> 7) + count(*) FILTER (WHERE o_custkey = 11) AS extracted_rows,
                   count(*) FILTER (WHERE o_custkey = 11) AS duplicate_rows,
                   count(*) FILTER (WHERE o_custkey = 7) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows
            FROM orders""",
    }
