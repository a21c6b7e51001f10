import hashlib
import itertools

import numpy as np
import pyarrow as pa
import public_tokenizers
from llm_cases import prose, sql_connection

from tablehaul.llm import chat, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")

ROWS = [
    (1, 0, "user", "hi <|im_end|> there"), (1, 1, "assistant", "<|im_start|>x<|im_sep|>"), (1, 1, "assistant", "<\\|im_end|> <\\\\|"),
    (1, 1, "assistant", "<\\|im_end|> <\\\\|"), (2, None, "assistant", None), (2, 3, None, ""), (2, 2, "<|im_end|>\nuser", "a\nb"),
    (None, 0, "assistant", "é漢😀 \x85 \x00"), (3, 0, "assistant", prose(3, 20000)), (3, 1, "assistant", "<|endoftext|>"),
    (4, 0, "user", "<<|>>"), (5, 0, "Assistant", " "),
]


def expected(rows):
    def escaped(t):
        out = ""
        for i, c in enumerate(t):
            if c == "|" and t[:i].rstrip("\\").endswith("<"):
                back = len(t[:i]) - len(t[:i].rstrip("\\"))
                out = out[: len(out) - back] + "\\" * (back + 1)
            out += c
        return out

    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3]))
    out = []
    for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
        own = list(own)
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        under = "".join(x for _, _, r, x in own if r == "assistant")
        formatted = sum(len(f"<|im_start|>{escaped(r)}<|im_sep|>{escaped(x) if len(x) < 1000 else x}<|im_end|>") for _, _, r, x in own)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (whole, under)]
        out.append((conv, len(own), sha[0], len(under), sha[1], formatted))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_query_matches_sql(spark):
    df = queries.op5_token_assembly(spark, "/root/testdata/sf0.001")
    sql = sql_connection().sql(queries.ORACLE_SQL["op5_token_assembly"])
    assert sorted(df.columns) == sorted(sql.columns)
    assert sorted(map(tuple, df.select(*sql.columns).collect())) == sorted(sql.fetchall())


def test_edge_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = spark.createDataFrame(ROWS, schema).repartition(4)
    turns = chat.format_turns(rows.selectExpr("*", "1 AS part", "2 AS start", "3 AS ids"), PATH)
    got = [tuple(r) for r in chat.conversation_report(turns, PATH).collect()]
    assert sorted(got, key=key) == sorted(expected(ROWS), key=key)
    assert chat.conversation_report(chat.format_turns(rows.limit(0), PATH), PATH).count() == 0


def test_turns_follow_each_other(spark):
    """A conversation that is spread over many tasks: starts are the running sum of lengths."""
    rows = [(7, i, "assistant" if i % 2 else "user", prose(i, i % 13)) for i in range(500)] + [(8, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.format_turns(frame, PATH).where("conv_id = 7").orderBy("turn").collect()
    start = 0
    for i, r in enumerate(found):
        assert (r.turn, r.start, len(r.loss)) == (i, start, len(r.ids))
        assert not any(r.loss) if i % 2 == 0 else sum(r.loss) == len(r.ids) - 3 - len(r.loss[: r.loss.index(True)]) + 2 if any(r.loss) else True
        start += len(r.ids)


def test_escape_is_reversible_and_hides_controls():
    parts = ["<", "|", "\\", "im_end", "<|im_end|>", "a"]
    for chosen in itertools.product(parts, repeat=4):
        text = "".join(chosen)
        hidden = chat.escape(pa.array([text]))[0].as_py()
        assert "<|" not in hidden and chat.unescape(hidden) == text


def test_masks_by_prefix_sums():
    ids, mask, bounds = chat.assemble(
        np.array([5, 6, 7]), np.array([0, 1, 3]), np.array([8, 9]), np.array([0, 2, 2]), np.array([True, True]), np.array([90, 91, 92])
    )
    assert ids.tolist() == [90, 5, 91, 8, 9, 92, 90, 6, 7, 91, 92]
    assert mask.tolist() == [False] * 3 + [True] * 2 + [False] * 6 and bounds.tolist() == [0, 6, 11]
