import random
import re

import pytest
from llm_cases import EDGE_ROWS, documents, prose, sql_connection

from tablehaul.llm import queries, winnow


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def expected(rows, items, window=10):
    sets = {}
    for item, text in items:
        w = words_of(text)
        width = min(len(w), window)
        for i in range(len(w) - width + 1) if width else ():
            sets.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in rows:
        w = words_of(text)
        hit, found = set(), set()
        for width in {len(s) for s in sets}:
            for i in range(len(w) - width + 1):
                if (run := tuple(w[i : i + width])) in sets:
                    hit |= set(range(i, i + width))
                    found |= sets[run]
        out.append((doc, len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def same(df, want):
    got = [tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "items").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def table_of_items(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", winnow.F.lit("x"))


def test_query_matches_sql(spark):
    df = queries.op10_winnowing(spark, "/root/testdata/sf0.001")
    sql = sql_connection().sql(queries.ORACLE_SQL["op10_winnowing"])
    assert sorted(df.columns) == sorted(sql.columns)
    assert sorted(map(tuple, df.select(*sql.columns).collect())) == sorted(sql.fetchall())


@pytest.mark.parametrize(("window", "gram", "prints"), [(10, 5, 1000), (10, 5, 0), (10, 10, 1000), (4, 1, 0)])
def test_edge_rows(spark, window, gram, prints):
    pick = random.Random(4)
    base = prose(77, 60).split()
    rows = [*EDGE_ROWS, (30, " ".join(base[5:14])), (31, " ".join(base[5:15]).upper()), (32, "a b c " + "-".join(base[40:58]) + " d")]
    rows += [(33 + i, " ".join(pick.choice("pqr") for _ in range(40))) for i in range(20)]
    items = [(1, " ".join(base)), (1, " ".join(base)), (2, None), (3, ""), (4, "one"), (None, " ".join(base[30:50])), (5, "p q r p q"),
             (6, " ".join(pick.choice("pqr") for _ in range(30))), (7, "漢字 Ünïcode")]
    docs = documents(spark, rows, "tag string, hits int, width int")
    found = winnow.contamination(docs, table_of_items(spark, items), window=window, gram=gram, broadcast_prints=prints)
    same(found, expected(rows, items, window))


def test_empty_sides(spark):
    docs = documents(spark, EDGE_ROWS)
    same(winnow.contamination(docs, table_of_items(spark, [])), expected(EDGE_ROWS, []))
    assert winnow.contamination(docs.limit(0), table_of_items(spark, [(1, prose(1, 30))])).count() == 0


def test_keep_clean(spark):
    rows = [*EDGE_ROWS, (40, prose(8, 30)), (None, prose(8, 12))]
    items = [(1, prose(8, 20))]
    docs = documents(spark, rows, "row_id int, hit_id int")
    kept = winnow.keep_clean(docs, table_of_items(spark, items))
    assert kept.columns == docs.columns
    want = [r for r, e in zip(rows, expected(rows, items), strict=True) if not e[2]]
    assert len(want) == len(rows) - 2
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=key) == sorted(want, key=key)
