"""SentencePiece BPE by vectorised merge rounds.

The words of a batch lie behind each other in one flat array of symbols. A round finds the best pair of every word by
a segmented minimum, merges its occurrences from the left, all words at once, and compacts the array; words without a
pair leave it. Rounds go on until no word is left.

A merge may create a pair that is better than (or as good as) itself, which comes before the next occurrence of the same
merge. Such merges are known from the vocabulary and take one occurrence a round; all others take every occurrence.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import text_chunks

#: Fixed value: the character that stands for a space inside pieces.
SPACE = "▁"
#: Kinds of pieces in the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Memo entries of a worker (word to packed ids), emptied when full, and the longest word it keeps.
MEMO, MEMO_CHARS = 500_000, 64
#: Characters that go through the rounds together; a longer word goes alone.
ROUND_CHARS = 500_000
_CODE_POINTS = 0x110000
_NO_RANK = np.iinfo(np.int64).max


def _messages(data: bytes) -> Iterator[tuple[int, object]]:
    """Number and value of each field of a protobuf message: integers, four raw bytes, or bytes by length."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 0x7F) << shift
            at, shift = at + 1, shift + 7
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError("no sentencepiece model")
        yield tag >> 3, value


def read_model(path: str) -> tuple[list[tuple[str, float, int]], str]:
    """The pieces (text, score, kind) of a model file by id, and the text that stands for the unknown piece.

    Fixed values: the field numbers of the public model format and their defaults. Only models whose encoding
    the rounds can give exactly are taken: BPE with byte fallback, identity normalisation, spaces escaped and kept, one
    space put in front.
    """
    with open(path, "rb") as file:
        fields = list(_messages(file.read()))
    pieces = []
    for number, value in fields:
        if number == 1:
            entry = dict(_messages(value))
            pieces.append((entry[1].decode(), struct.unpack("<f", entry.get(2, bytes(4)))[0], entry.get(3, NORMAL)))
    trainer = dict(_messages(next((v for n, v in fields if n == 2), b"")))
    normaliser = dict(_messages(next((v for n, v in fields if n == 3), b"")))
    plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or trainer.get(24, 0) or not plain:
        raise ValueError("only BPE models with byte fallback, identity normalisation and a space in front are supported")
    if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces) or sum(kind == BYTE for _, _, kind in pieces) != 256:
        raise ValueError("user-defined and unused pieces are not supported, and all 256 byte pieces are needed")
    return pieces, trainer.get(44, " ⁇ ".encode()).decode()


class MergeTable:
    """What two neighbouring symbols merge into, at which rank, and where words can be cut.

    A symbol is a piece id, or ``first_extra`` plus a code point for a character that is no piece.
    """

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.first_extra = len(pieces)
        ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        score = {text: s for text, s, kind in pieces if kind == NORMAL}
        by_score = {s: rank for rank, s in enumerate(sorted(set(score.values()), reverse=True))}
        tied = defaultdict(int)
        for s in score.values():
            tied[s] += 1

        def symbol(text: str) -> int | None:
            return ids.get(text, self.first_extra + ord(text) if len(text) == 1 else None)

        self.width = self.first_extra + _CODE_POINTS
        keys, into, ranks, beside = [], [], [], set()
        self.one_by_one = np.zeros(self.first_extra, bool)
        for text, own in ids.items():
            beside.update(ord(a) * _CODE_POINTS + ord(b) for a, b in zip(text, text[1:]))
            for cut in range(1, len(text)):
                left, right = symbol(text[:cut]), symbol(text[cut:])
                if left is None or right is None:
                    continue
                keys.append(left * self.width + right)
                into.append(own)
                ranks.append(by_score[score[text]])
                for half in (text[:cut], text[cut:]):
                    if len(half) > 1 and score[text] >= score[half]:
                        self.one_by_one[ids[half]] = True
            # Pieces of one score: which of them comes first depends on the place alone.
            if tied[score[text]] > 1:
                self.one_by_one[own] = True
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.into = np.array(into, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.beside = np.array(sorted(beside), np.int64)
        self.symbols = self.first_extra + np.arange(_CODE_POINTS, dtype=np.int64)
        for text, own in ids.items():
            if len(text) == 1:
                self.symbols[ord(text)] = own

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; ``_NO_RANK`` where nothing merges."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1) if len(self.keys) else np.zeros(len(key), int)
        found = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
        return np.where(found, self.ranks[at] if len(self.keys) else 0, _NO_RANK), np.where(found, self.into[at] if len(self.keys) else 0, -1)

    def cuts(self, points: np.ndarray) -> np.ndarray:
        """Whether no piece holds a character and its predecessor side by side, so that a word may begin there."""
        key = points[:-1] * _CODE_POINTS + points[1:]
        at = np.minimum(np.searchsorted(self.beside, key), max(len(self.beside) - 1, 0))
        return self.beside[at] != key if len(self.beside) else np.ones(len(key), bool)


def merge_rounds(table: MergeTable, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words behind each other, and the number of symbols of each word."""
    sizes = np.array([len(word) for word in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.zeros(len(points), bool)
    first[1:] = table.cuts(points)
    starts = np.cumsum(sizes) - sizes
    first[starts] = True
    owner = np.repeat(np.arange(len(words)), sizes)  # the given word of each symbol
    part = np.cumsum(first) - 1  # the independent part of it
    place = np.arange(len(points))
    symbol = table.symbols[points]
    rank = np.full(len(points), _NO_RANK)
    into = np.full(len(points), -1)
    inner = np.flatnonzero(~first) - 1
    rank[inner], into[inner] = table.pairs(symbol[inner], symbol[inner + 1])
    final = np.full(len(points), -1)  # symbols of finished parts at the place of their first character
    while len(symbol):
        heads = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        lengths = np.diff(np.append(heads, len(part)))
        best = np.repeat(np.minimum.reduceat(rank, heads), lengths)
        done = best == _NO_RANK
        if done.any():
            final[place[done]] = symbol[done]
            live = ~done
            symbol, part, place, rank, into, best = (a[live] for a in (symbol, part, place, rank, into, best))
            if not len(symbol):
                break
        at = np.flatnonzero(rank == best)
        # Overlapping occurrences: every second one of a row of neighbours, from the left.
        begins = np.concatenate(([True], at[1:] != at[:-1] + 1))
        row = np.flatnonzero(begins)
        offset = np.arange(len(at)) - np.repeat(row, np.diff(np.append(row, len(at))))
        leading = np.concatenate(([True], part[at[1:]] != part[at[:-1]]))
        at = at[leading | (offset % 2 == 0) & ~table.one_by_one[into[at]]]
        symbol[at] = into[at]
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        moved = np.cumsum(stay) - 1
        at = moved[at]
        symbol, part, place, rank, into = (a[stay] for a in (symbol, part, place, rank, into))
        touched = np.unique(np.concatenate((at, at[at > 0] - 1)))
        rank[touched], into[touched] = _NO_RANK, -1
        touched = touched[touched < len(symbol) - 1]
        touched = touched[part[touched] == part[touched + 1]]
        rank[touched], into[touched] = table.pairs(symbol[touched], symbol[touched + 1])
    kept = final >= 0
    return final[kept], np.bincount(owner[kept], minlength=len(words))


class PieceCodec:
    """Encoder and decoder of one model; built once in each worker."""

    def __init__(self, path: str):
        pieces, unknown = read_model(path)
        self.table = MergeTable(pieces)
        self.size = len(pieces)
        byte_ids = [i for i, (_, _, kind) in enumerate(pieces) if kind == BYTE]
        if [pieces[i][0] for i in byte_ids] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError("byte pieces must stand in order")
        self.byte_ids = byte_ids
        self.first_byte = byte_ids[0]
        self.is_byte = bytearray(kind == BYTE for _, _, kind in pieces)
        self.skipped = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.surface = [
            bytes([byte_ids.index(i)]) if kind == BYTE
            else b"\xff" if kind == CONTROL  # no UTF-8, so that such ids are decoded one by one
            else unknown.encode() if kind == UNKNOWN
            else text.replace(SPACE, " ").encode()
            for i, (text, _, kind) in enumerate(pieces)
        ]
        self.spaced = {i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL and text.startswith(SPACE)}
        self.shown = [str(i) for i in range(len(pieces))]
        normal = [(text, score) for text, score, kind in pieces if kind == NORMAL]
        self.space_ids = {len(t): i for i, (t, _, kind) in enumerate(pieces) if kind == NORMAL and not t.strip(SPACE)}
        spaces = {score for text, score in normal if len(text) > 1 and not text.strip(SPACE)}
        others = [score for text, score in normal if len(text) > 1 and text.strip(SPACE)]
        # Runs of spaces can be counted out if their pieces share one score below all others and no other piece
        # has a space inside.
        self.counted = (
            1 in self.space_ids
            and len(spaces) == 1
            and all(score > min(spaces) for score in others)
            and not any(SPACE in text[1:] for text, _ in normal if text.strip(SPACE))
        )
        joined = {c for text, _ in normal if len(text) > 1 for c in text}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joined and chr(c) != " ")
        if any(re.search(f"[^{SPACE}]{SPACE}", text) for text, _ in normal):  # pieces reach over words
            word = f"[^{alone}]+" if alone else r"[\s\S]+"
        else:
            word = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        self.split = re.compile(word + (f"|[{alone}]+" if alone else "")).findall
        self.memo: dict[str, bytes] = {}
        self.runs: dict[int, bytes] = {}

    def _space_run(self, n: int) -> bytes:
        """The ids of ``n`` spaces: with equal scores the leftmost pair merges first, so a stack is enough."""
        if n not in self.runs:
            stack: list[int] = []
            for _ in range(n):
                stack.append(1)
                while len(stack) > 1 and stack[-2] + stack[-1] in self.space_ids:
                    stack[-2:] = [stack[-2] + stack[-1]]
            if len(self.runs) > 1000:
                self.runs = {}
            self.runs[n] = array("I", [self.space_ids[k] for k in stack]).tobytes()
        return self.runs[n]

    def _merged(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word by merge rounds; a character that is no piece becomes its bytes."""
        out: list[bytes] = []
        start = size = 0
        for i in range(len(words) + 1):
            if i == len(words) or (i > start and size + len(words[i]) > ROUND_CHARS):
                if i > start:
                    symbols, counts = merge_rounds(self.table, words[start:i])
                    flat = symbols.tolist()
                    ends = np.cumsum(counts)
                    plain = np.logical_and.reduceat(symbols < self.size, ends - counts)
                    for end, count, known in zip(ends.tolist(), counts.tolist(), plain.tolist()):
                        ids = flat[end - count : end]
                        if not known:
                            ids = [b for s in ids for b in ([s] if s < self.size else [self.byte_ids[c] for c in chr(s - self.size).encode()])]
                        out.append(array("I", ids).tobytes())
                start, size = i, 0
            if i < len(words):
                size += len(words[i])
        return out

    def _packed(self, words: set[str]) -> dict[str, bytes]:
        known = {w: self.memo.get(w) for w in words}
        missing = [w for w, packed in known.items() if packed is None]
        if len(self.memo) + len(missing) > MEMO:
            self.memo = {}
        cores, leads = [], []
        for word in missing:
            core = word.lstrip(SPACE)
            lead = len(word) - len(core)
            if not self.counted:
                core, lead = word, 0
            elif lead and core:
                core = SPACE + core
            leads.append(lead)
            cores.append(core)
        merged = iter(self._merged([c for c in cores if c]))
        bare = array("I", [self.space_ids[1]]).tobytes() if self.counted else b""
        for word, core, lead in zip(missing, cores, leads):
            packed = next(merged) if core else self._space_run(lead)
            if core and lead > 1:
                # The last space belongs to the word if a piece took it, else to the run.
                packed = self._space_run(lead) + packed[4:] if packed[:4] == bare else self._space_run(lead - 1) + packed
            known[word] = packed
            if len(word) <= MEMO_CHARS:
                self.memo[word] = packed
        return known

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        parts = [self.split(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        get = self._packed(set().union(*parts)).__getitem__
        return [b"".join(map(get, words)) for words in parts]

    def decode(self, ids) -> str:
        """The text of ``ids``: spaces back, the one in front gone, a byte that is no UTF-8 as U+FFFD."""
        data = b"".join(map(self.surface.__getitem__, ids))
        lead = next((i for i in ids if i not in self.skipped), None)
        lead = 1 if lead in self.spaced else 0
        try:
            return data.decode()[lead:]
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surface[i]
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + size]).decode())
                        at += min(size, len(run) - at)
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()
            if i is not None and i not in self.skipped:
                out.append(self.surface[i].decode())
        return "".join(out)[lead:]


@lru_cache(maxsize=4)
def piece_codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def public_codec() -> PieceCodec:
    """The codec of the public model, read where the worker runs."""
    import public_tokenizers

    return piece_codec(public_tokenizers.path("piece_bpe_32k.model"))


def encode_texts(df: DataFrame, text: str = "text", make: Callable[[], PieceCodec] = public_codec) -> DataFrame:
    """``df`` plus ``piece_ids`` (array of int); null is an empty text and has no ids. No shuffle."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = make()
        for series in batches:
            texts = ["" if t is None else t for t in series.tolist()]
            out = []
            for start, stop in text_chunks(texts):
                out += [array("I", packed).tolist() for packed in own.encode_packed(texts[start:stop])]
            yield pd.Series(out, dtype=object)

    return df.withColumn("piece_ids", F.pandas_udf(encode, "array<int>")(F.col(f"`{text}`").cast("string")))


def decode_ids(df: DataFrame, ids: str = "piece_ids", make: Callable[[], PieceCodec] = public_codec) -> DataFrame:
    """``df`` plus ``decoded`` (string), the text behind ``ids``; null ids decode to an empty text."""

    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = make()
        for series in batches:
            yield pd.Series([own.decode([] if v is None else list(v)) for v in series], dtype=object)

    return df.withColumn("decoded", F.pandas_udf(decode, "string")(F.col(f"`{ids}`")))


def piece_digests(df: DataFrame, text: str = "text", key: str = "doc_id", make: Callable[[], PieceCodec] = public_codec) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row.

    Texts are encoded whole and their ids decoded again in one pass without a shuffle. Null is an empty text: no
    ids, digests of nothing. Repeated rows give repeated results, other columns are not looked at, an empty table gives
    an empty result.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            counts, ids_hex, decoded_hex = [], [], []
            for start, stop in text_chunks(texts):
                for packed in own.encode_packed(texts[start:stop]):
                    ids = array("I", packed)
                    counts.append(len(ids))
                    ids_hex.append(hashlib.sha256(",".join(map(own.shown.__getitem__, ids)).encode()).hexdigest())
                    decoded_hex.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = picked.mapInArrow(digest, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
