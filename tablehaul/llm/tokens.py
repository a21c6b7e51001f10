"""Token ids of whole texts, with each distinct chunk of a batch encoded once.

Public tokenizers split texts into words before they merge, so a text's ids are those of its chunks one
after the other, if cuts are made only where a word begins in any case. ``chunk_starts`` makes
such cuts between ASCII characters; everything else (say, around other spaces) stays in one chunk and is left to
the tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tablehaul.llm import texts

# Bytes that the chunks a task remembers may take, half of them those met last. Ids do not depend on it.
MEMORY_BYTES = 64 << 20
# What a remembered chunk takes beside its bytes and ids: two objects and a place in a table.
CHUNK_BYTES = 170
# Text bytes encoded at once: with more of them a chunk is looked up less often.
BATCH_BYTES = 4 << 20
# Chunks that are encoded as one text, with a mark behind each.
JOINED = 2_000
# U+0001 behind a space is a token of its own in any of the tokenizers, and no other text has its last id.
MARK = " \x01"


class Encoder:
    """Ids by the ``tokenizers`` library; strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0
        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.edges, self.at_begin = self._word_edges()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in one array, and the row bounds in it."""
        starts = chunk_starts(data, offsets)
        bounds = np.append(starts, len(data)).astype(np.int64)
        values = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
        )
        code, distinct = texts.codes(values)
        ids, sizes = self._ids(distinct.to_pylist())
        begin = np.cumsum(sizes) - sizes
        each = sizes[code]
        total = np.concatenate(([0], np.cumsum(each)))
        kind = np.int32 if total[-1] < 2**31 and len(ids) < 2**31 else np.int64
        place = np.repeat((begin[code] - total[:-1]).astype(kind), each)
        place += np.arange(len(place), dtype=kind)
        return ids[place], total[np.searchsorted(starts, offsets)]

    def forget(self) -> None:
        """Drop the remembered chunks."""
        self.known, self.older, self.held = {}, {}, 0

    def _ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks one after the other, and how many each has."""
        each = list(map(self.known.get, chunks))
        missed = [i for i, e in enumerate(each) if e is None]
        names = [chunks[i] for i in missed]
        found = list(map(self.older.get, names))
        new = [j for j, e in enumerate(found) if e is None]
        for j, ids in zip(new, self._encoded([names[j] for j in new]), strict=True):
            found[j] = ids
        for i, ids in zip(missed, found, strict=True):
            each[i] = ids
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        self.known.update(zip(names, found, strict=True))
        self.held += sum(map(len, names)) + sum(map(len, found)) + CHUNK_BYTES * len(names)
        if self.held > MEMORY_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        return np.frombuffer(b"".join(each), np.uint32), sizes // 4

    def _encoded(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk as bytes. Words behind a space share a text, as tokens tell where each begins; other chunks that
        can follow a mark share one with a mark behind each."""
        kinds = [_kind(c) for c in chunks]
        by_kind: tuple[list[bytes], ...] = ([], [], [])
        for c, k in zip(chunks, kinds, strict=True):
            by_kind[k].append(c)
        apart, together, words = by_kind
        found = [iter(self._alone(apart)), iter(self._marked(together)), iter(self._spaced(words))]
        return [next(found[k]) for k in kinds]

    def _alone(self, chunks: list[bytes]) -> list[bytes]:
        single = self.tokenizer.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in single]

    def _texts(self, chunks: list[bytes], between: bytes) -> Iterator[tuple[list[bytes], np.ndarray]]:
        """The chunks of each shared text, and its ids."""
        parts = [chunks[i : i + JOINED] for i in range(0, len(chunks), JOINED)]
        joined = [between.join([*part, b""]).decode() for part in parts]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            yield part, np.array(e.ids, np.uint32)

    def _marked(self, chunks: list[bytes]) -> list[bytes]:
        out, width = [], 4 * len(self.mark)
        for part, ids in self._texts(chunks, MARK.encode()):
            ends = 4 * (np.flatnonzero(ids == self.mark[-1]) + 1)
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not keep marks apart")
            body = ids.tobytes()
            out += [body[i : j - width] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        return out

    def _spaced(self, chunks: list[bytes]) -> list[bytes]:
        if self.edges is None:
            return self._marked(chunks)
        out = []
        for part, ids in self._texts(chunks, b""):
            # where words begin: at a token that begins one, or behind a token that ends one
            at = np.flatnonzero(self.edges[ids]) + (not self.at_begin)
            bounds = np.append(at, len(ids)) if self.at_begin else np.append(0, at)
            if len(at) != len(part) or bounds[0] or bounds[-1] != len(ids):
                out += self._marked(part)
                continue
            body, bounds = ids.tobytes(), (4 * bounds).tolist()
            out += [body[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]
        return out

    def _word_edges(self) -> tuple[np.ndarray | None, bool]:
        """Which tokens begin a word, or end one; none if the vocabulary has no sign for either."""
        tokens = self.tokenizer.encode(" a", add_special_tokens=False).tokens
        sign = tokens[0][:1]
        at_begin = bool(sign) and not sign.isascii()
        if not at_begin:
            sign = tokens[-1].removeprefix("a") if tokens[-1].startswith("a") else ""
        if not sign:
            return None, False
        edges = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            edges[number] = token.startswith(sign) if at_begin else token.endswith(sign)
        return edges, at_begin


def _kind(chunk: bytes) -> int:
    """2 for a space and ASCII letters, 1 for other chunks that can follow a mark and one them, 0 for the rest."""
    if chunk[0] == 0x20 and chunk[1:].isalpha():
        return 2
    return 1 if chunk[0] in _BEGIN and chunk[-1] in _SOLID and b"\x01" not in chunk else 0


_BEGIN = bytes([0x20, *range(0x09, 0x0E), *range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
_SOLID = bytes(range(0x21, 0x7F))


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row starts, and the places where any of the tokenizers begins a new word whatever stands around.

    Those are: ASCII white space behind a character that is none; what follows one ASCII white space, other than
    the space itself, behind such a character; ASCII marks behind an ASCII letter or digit.
    """
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        lead = np.zeros(256, np.int8)
        lead[0x21:0x7F] = 1
        lead[0xC3:0xE0] = 2
        lead[0xE4:0xEE] = 3
        space = texts.white_space()
        breaks = space.copy()
        breaks[0x20] = False
        alphanumeric = ~texts.no_alphanumerics()
        alphanumeric[0x80:] = False
        marks = (lead == 1) & ~alphanumeric
        kind = lead[data]
        solid = kind == 1
        solid[1:] |= kind[:-1] == 2
        solid[2:] |= kind[:-2] == 3
        cut[1:-1] = space[data[1:]] & solid[:-1]
        cut[2:-1] |= breaks[data[1:-1]] & (kind[2:] > 0) & solid[:-2]
        cut[1:-1] |= alphanumeric[data[:-1]] & marks[data[1:]]
    cut[offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker: that of the last file asked for."""
    return Encoder(path)


def end_task(path: str) -> None:
    """Workers live on after a task: what it remembered goes back to the system."""
    encoder(path).forget()
    texts.release()
