"""Chat formatting at token level.

Roles and texts are encoded one by one, reserved ids that no text can produce are spliced between them, and the loss
mask comes from prefix sums over segment lengths. Control strings inside texts are escaped reversibly, so
the rendered string is as unambiguous as the ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Codec, public_codec

#: How the reserved ids are rendered, in the order of the ids after the vocabulary.
START, SEPARATOR, END = "<|im_start|>", "\n", "<|im_end|>\n"
RENDERED = (START, SEPARATOR, END)

TURN_SCHEMA = "conv_id bigint, turn_no bigint, first_token bigint, first_char bigint, n_chars bigint, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    """Every ``<|`` gets a backslash between its signs, one more where some stand there already."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles end at a newline when rendered, so theirs are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def _columns(batch: pa.RecordBatch) -> zip:
    return zip(*(column.to_pylist() for column in batch.columns))


def assemble(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",), make: Callable[[], Codec] = public_codec) -> DataFrame:
    """One row of token ids per turn of ``conv_id, turn, role, text``; more columns are ignored.

    ``first_token`` and ``first_char`` are the turn's places in the conversation (prefix sums over its turns), ``loss`` is
    true for the content tokens of ``loss_roles``. Order is by turn (nulls first), then role, then text; repeated rows are
    turns of their own; null roles and texts are empty; rows with a null ``conv_id`` form one conversation.
    A conversation is read as a sorted stream, so a huge one costs its task time, not memory.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        reserved = len(own.vocabulary)
        current, number, token_at, char_at = object(), 0, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in _columns(batch):
                if conv != current:
                    current, number, token_at, char_at = conv, 0, 0, 0
                head, body = escape_role(role), escape(text)
                segments = [np.frombuffer(p, "<u4") for p in own.encode_packed([head, body])]
                parts = [[reserved], segments[0], [reserved + 1], segments[1], [reserved + 2]]
                ends = np.cumsum([len(p) for p in parts])
                mask = np.zeros(ends[-1] + 1, np.int8)
                if role in loss_roles:  # +1 where a masked segment starts, -1 behind its end; the prefix sum is the mask
                    mask[ends[2]] += 1
                    mask[ends[3]] -= 1
                size = len(head) + len(body) + sum(map(len, RENDERED))
                ids = np.concatenate(parts).astype(np.int32)
                out.append((conv, number, token_at, char_at, size, ids, np.cumsum(mask)[:-1] > 0))
                number, token_at, char_at = number + 1, token_at + len(ids), char_at + size
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([row[i] for row in out], pa.int64()) for i in range(5)),
                     pa.array([row[5] for row in out], pa.list_(pa.int32())), pa.array([row[6] for row in out], pa.list_(pa.bool_()))],
                    ["conv_id", "turn_no", "first_token", "first_char", "n_chars", "ids", "loss"],
                )

    empty = F.lit("")
    picked = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    )
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(encode, TURN_SCHEMA)


def render(ids, own: Codec) -> str:
    """The formatted string of token ids."""
    reserved, out, run = len(own.vocabulary), [], []
    for i in [*ids, reserved]:
        if i >= reserved:
            out += [own.decode(run).decode(), RENDERED[i - reserved]]
            run = []
        else:
            run.append(i)
    return "".join(out[:-1])


def read_turn(ids: np.ndarray, own: Codec) -> tuple[str, str]:
    """Role and text of one turn's ids."""
    reserved = len(own.vocabulary)
    places = np.flatnonzero(ids >= reserved)
    if (ids[places] - reserved).tolist() != [0, 1, 2] or places[0] != 0 or places[2] != len(ids) - 1:
        raise ValueError("not a turn")
    role, text = ids[1 : places[1]], ids[places[1] + 1 : places[2]]
    return unescape_role(own.decode(role.tolist()).decode()), unescape(own.decode(text.tolist()).decode())


def conversation_digests(assembled: DataFrame, make: Callable[[], Codec] = public_codec) -> DataFrame:
    """Per conversation what the token rows of :func:`assemble` say when they are read back.

    Takes the frame as it comes from ``assemble``, whose partitions hold whole conversations in order; digests are
    updated turn by turn, so no conversation is held in memory.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        state = None

        def done() -> tuple:
            conv, turns, text_hash, chars, loss_hash, formatted, tokens = state
            return conv, turns, text_hash.hexdigest(), chars, loss_hash.hexdigest(), formatted, tokens

        def result(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            rows = []
            id_lists, loss_lists = batch.column("ids"), batch.column("loss")
            for i, (conv, chars) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("n_chars").to_pylist())):
                if state is None or conv != state[0]:
                    if state:
                        rows.append(done())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                ids, loss = np.array(id_lists[i].as_py(), np.int64), np.array(loss_lists[i].as_py(), bool)
                role, text = read_turn(ids, own)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                masked = unescape(own.decode(ids[loss].tolist()).decode())
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += chars
                state[6] += len(ids)
            if rows:
                yield result(rows)
        if state:
            yield result([done()])

    return assembled.mapInArrow(
        digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint"
    )
