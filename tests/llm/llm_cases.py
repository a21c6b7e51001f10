"""Small tables with the rows that break things, for all operators of the subpackage."""

import glob
import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words that look random but are the same in each run."""
    out, state = [], seed * 2654435761 + 12345
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(state >> 33) % len(WORDS)] + str((state >> 40) % 97))
    return " ".join(out)


def documents(spark, rows, extra: str = ""):
    """(doc_id, text) rows with the other columns of documents, and clashing ones if named: "name type, ..."."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    names = [c.split()[0] for c in extra.split(",")] if extra else []
    full = [(i, t, None if i is None else "en", "src0", None if t is None else len(t), *[None] * len(names)) for i, t in rows]
    return spark.createDataFrame(full, schema + (", " + extra if extra else "")).repartition(3)


EDGE_ROWS = [
    (1, prose(1, 300)),
    (1, prose(1, 300)),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, prose(2, 40)),
    (None, None),
    (5, "one"),
    (6, "Ünïcode ÄÖ ümlaut 漢字 " * 30),
    (7, prose(3, 20000)),
    (8, "a" * 5000),
    (9, prose(1, 300)),
    (10, prose(1, 299) + " other"),
    (11, "x\ny\nx\n\n \nx " + prose(5, 30)),
]


def sql_connection(sf_dir: str = SF_DIR):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def table(spark, name, sf_dir: str = SF_DIR):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
