import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_cases import EDGE_ROWS, documents, prose, table
from tokenizers import Tokenizer

from tablehaul.llm import packing, queries, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "", " ", "\n\n", "a  b", "a   b  c", "x y 　z", "don't DON'T we'll", "tab\tnew\nline\r\n\r\n end ",
    "é́ é ́a", "漢字 かな カナ 한국어 text", "1234 ½ ² Ⅳ x2", "<|endoftext|> <|startoftext|>x", "\x1f\x1c a\x85b \x85c", "Σίσυφος ΣΑΣ Σ",
    "emoji 😀 👩‍👩‍👧 end", "a​ b c   d", "ß ẞ İ ı", "\u0000 a\u0000b", "\x01 \x01", " \x01a", "a \x01\x01 b",
]


def reference(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_ids_of_whole_texts(spark, name):
    whole = [r.text for r in table(spark, "documents").collect()] + ODD + [a + b + c for a in ODD for b in (" ", "\n ", "") for c in ODD]
    pick = random.Random(1)
    alphabet = [" ", " ", "\n", "\t", "a", "B", "é", "1", "'s", ".", " ", "　", "漢", "😀", "́", " ", "\x85", "\x01"]
    whole += ["".join(pick.choice(alphabet) for _ in range(30)) for _ in range(500)]
    encoder, ids_of = tokens.Encoder(public_tokenizers.path(name)), reference(name)
    bodies = [t.encode() for t in whole]
    offsets = np.concatenate(([0], np.cumsum([len(b) for b in bodies])))
    ids, bounds = encoder.encode(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    for i, text in enumerate(whole):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(text), repr(text)


def test_memory_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY_BYTES", 500)
    monkeypatch.setattr(tokens, "JOINED", 2)
    encoder, ids_of = tokens.Encoder(PATH), reference("word_bpe_49k.json")
    for seed in range(3):
        body = prose(seed, 50).encode()
        ids, _ = encoder.encode(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
        assert ids.tolist() == ids_of(body.decode())


def check_packed(rows, found, capacity=4096):
    """Pieces are right, sequences gapless and not over-full."""
    ids_of = reference("word_bpe_49k.json")
    want = Counter()
    for doc_id, text in rows:
        ids = [*ids_of(text), 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            body = np.array(ids[at : at + capacity], "<u4").tobytes()
            want[(doc_id, piece, at, len(body) // 4, zlib.crc32(body))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), sum(r.length for r in found)


def test_query_packs_documents(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    used, total = check_packed(rows, queries.op7_exact_complements(spark, "/root/testdata/sf0.001").collect())
    assert used <= -(-total // 4096) * 1.01 + 1


@pytest.mark.parametrize("capacity", [4096, 50])
def test_edge_rows(spark, capacity):
    docs = documents(spark, EDGE_ROWS, "piece string, length string, ids int, sequence_id int")
    found = packing.pack_documents(docs, PATH, capacity=capacity)
    check_packed(EDGE_ROWS, found.collect(), capacity)
    ids_of = reference("word_bpe_49k.json")
    for s in packing.sequences(found).collect():
        assert len(s.ids) <= 4 * capacity and len(s.doc_ids) >= 1
    total = sum(len(s.ids) for s in packing.sequences(found).collect())
    assert total == 4 * sum(len(ids_of(t)) + 1 for _, t in EDGE_ROWS)
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_common_lengths_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_ROWS", 7)
    rows = [(i, "same words here") for i in range(100)] + [(i, prose(i, i % 9)) for i in range(100, 150)]
    used, total = check_packed(rows, packing.pack_documents(documents(spark, rows), PATH, capacity=64).collect(), 64)
    assert used <= -(-total // 64) * 1.1 + 1


def lengths_of(plan, counts, capacity):
    """Every piece number of every length is placed once, and sequences are gapless."""
    bins = defaultdict(list)
    seen = Counter()
    runs = defaultdict(list)
    for column in zip(plan.length, plan.number, plan.sequence, plan.offset, plan.per, strict=True):
        runs[column[0]].append(column[1:])
    for length, own in runs.items():
        own.sort()
        for i, (number, sequence, offset, per) in enumerate(own):
            until = own[i + 1][0] if i + 1 < len(own) else counts[length]
            for k in range(number, until):
                bins[sequence + (k - number) // per].append((offset + (k - number) % per * length, length))
                seen[length] += 1
    assert dict(seen) == {n: c for n, c in counts.items() if c}
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(bins) == plan.sequences


@pytest.mark.parametrize("seed", range(12))
def test_plans(seed):
    pick = random.Random(seed)
    capacity = pick.choice([10, 64, 100])
    counts = {pick.randint(1, capacity): pick.randint(1, 60) for _ in range(pick.randint(1, 25))}
    plan = packing.make_plan(counts, capacity)
    lengths_of(plan, counts, capacity)


def test_exact_complements_beat_best_fit():
    assert packing.make_plan({60: 2, 40: 1, 25: 1, 15: 1}, 100).sequences == 2
    assert packing.make_plan({50: 3, 34: 1, 33: 2}, 100).sequences == 3
    assert packing.make_plan({40: 1, 30: 1, 20: 1, 10: 1}, 100).sequences == 1
    with pytest.raises(ValueError):
        packing.make_plan({101: 1}, 100)
