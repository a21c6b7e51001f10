"""Chat formatting by tokens: segments encoded on their own, control ids spliced in, loss masks from prefix sums.

A turn is ``START role SEP text END``. The three control ids lie beyond the tokenizer's vocabulary,
so no text can produce them. In the written form they are ``<|im_start|>``, ``<|im_sep|>`` and
``<|im_end|>``; to keep that form unambiguous, ``<``, any backslashes, ``|`` in a role or text
gets one more backslash, which ``unescape`` takes off again.

Turns are ordered by ``turn``, NULL first, then by role and text. NULL text or role counts as empty, a NULL
conversation is one of its own, repeated rows are turns each, and an empty table gives no
rows. Other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tablehaul.llm import texts, tokens
from tablehaul.sources.files import staged

CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LOSS_ROLE = "assistant"

_OPEN = r"<(\\*)\|"
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, _OPEN, r"<\\\1|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def assemble(
    role_ids: np.ndarray, role_bounds: np.ndarray, text_ids: np.ndarray, text_bounds: np.ndarray, loss: np.ndarray, controls: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all turns in one array, the loss mask over it, and the bounds of the turns.

    Segment lengths are summed up to the place of every segment; the mask is the running sum of
    +1 where a counted text starts and -1 where it ends.
    """
    roles, bodies = np.diff(role_bounds), np.diff(text_bounds)
    bounds = np.concatenate(([0], np.cumsum(roles + bodies + 3)))
    start = bounds[:-1]
    separator = start + 1 + roles
    end = bounds[1:] - 1
    ids = np.empty(int(bounds[-1]), np.int32)
    for at, control in zip((start, separator, end), controls, strict=True):
        ids[at] = control
    for at, sizes, own in ((start + 1, roles, role_ids), (separator + 1, bodies, text_ids)):
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids[np.repeat(at, sizes) + within] = own
    edge = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edge, (separator + 1)[loss], 1)
    np.add.at(edge, end[loss], -1)
    return ids, np.cumsum(edge[:-1]) > 0, bounds


TURNS = "conv_id bigint, turn bigint, part int, place bigint, ids array<int>, loss array<boolean>"


def _encode(tokenizer: str, loss_role: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conversation, place = TaskContext.get().partitionId(), None, 0
        encoder = tokens.encoder(tokenizer)
        size = encoder.tokenizer.get_vocab_size()
        controls = np.arange(size, size + len(CONTROLS))
        for whole in batches:
            for batch in texts.bounded(whole, "text"):
                role, text = batch.column(2), batch.column(3)
                loss = pc.equal(role, loss_role).to_numpy(zero_copy_only=False).astype(bool)
                ids, mask, bounds = assemble(
                    *encoder.encode(*texts.flat(escape(role))), *encoder.encode(*texts.flat(escape(text))), loss, controls
                )
                places = []
                for key, n in zip(batch.column(0).to_pylist(), np.diff(bounds).tolist(), strict=True):
                    if (key,) != conversation:
                        conversation, place = (key,), 0
                    places.append(place)
                    place += n
                offsets = pa.array(bounds, pa.int32())
                yield texts.batch_of(
                    ("conv_id", "turn", "part", "place", "ids", "loss"), batch.column(0), batch.column(1),
                    np.full(len(batch), part, np.int32), pa.array(places, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(mask)),
                )
        encoder.forget()

    return task


def format_turns(
    conversations: DataFrame,
    tokenizer: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = LOSS_ROLE,
) -> DataFrame:
    """(conv_id, turn, start, ids, loss): ids of each turn, their loss mask, and the turn's first place in its conversation.

    Rows are range-partitioned by conversation and turn, so a very long conversation is spread over
    tasks; each counts its own part, and the parts' lengths are added up afterwards.
    """
    rows = conversations.select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
        texts.whole_text(role).alias("role"), texts.whole_text(text).alias("text"),
    )
    dealt = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    turns = staged(dealt.mapInArrow(_encode(tokenizer, loss_role), TURNS), "turns")
    lengths = turns.groupBy("conv_id", "part").agg(F.sum(F.size("ids")).alias("n"))
    # one row per conversation and task that holds some of it
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = lengths.select(
        F.col("conv_id").alias("of"), F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    same = turns.conv_id.eqNullSafe(before["of"]) & (turns.part == before["of_part"])
    return turns.join(before, same).select("conv_id", "turn", (F.col("before") + F.col("place")).alias("start"), "ids", "loss")


REPORT = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _read_turns(batch: pa.RecordBatch, tokenizer) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the loss mask, formatted length) of each turn, from its ids alone."""
    start, separator, end = range(tokenizer.get_vocab_size(), tokenizer.get_vocab_size() + len(CONTROLS))
    segments = []
    for ids, loss in zip(batch.column(2), batch.column(3), strict=True):
        own, mask = ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False).astype(bool)
        middle = int(np.flatnonzero(own == separator)[0])
        if own[0] != start or own[-1] != end:
            raise ValueError("not a turn")
        segments += [own[1:middle].tolist(), own[middle + 1 : -1].tolist(), own[mask].tolist()]
    found = iter(tokenizer.decode_batch(segments, skip_special_tokens=False))
    fixed = sum(map(len, CONTROLS))
    for role, text, under in zip(found, found, found, strict=True):
        yield unescape(role), unescape(text), unescape(under), fixed + len(role) + len(text)


def conversation_report(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation, read back from formatted turns: turns, digests of all text and of the text under the mask, lengths.

    A digest of a whole conversation needs its turns one after the other, so they pass through one
    task, which holds a batch of them and the state of the digests.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = tokens.encoder(tokenizer).tokenizer
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = [c.split()[0] for c in REPORT.split(", ")]
        current = state = None
        done: list[tuple] = []

        def close() -> None:
            if state:
                n, whole, chars, under, formatted = state
                done.append((current[0], n, whole.hexdigest(), chars, under.hexdigest(), formatted))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True) if done else [()] * 6, kinds, strict=True)]
            done.clear()
            return texts.batch_of(names, *columns)

        for batch in batches:
            for key, (role, text, under, formatted) in zip(batch.column(0).to_pylist(), _read_turns(batch, decoder), strict=True):
                if (key,) != current:
                    close()
                    current, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(under)
                state[3].update(under.encode())
                state[4] += formatted
            yield flush()
        close()
        yield flush()

    ordered = turns.select("conv_id", "start", "ids", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "start")
    return ordered.mapInArrow(task, REPORT)
