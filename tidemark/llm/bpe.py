"""Byte-level BPE through a sentencepiece model that is written straight from a rank file.

Every byte string of the vocabulary becomes a piece of printable characters, one per byte, scored by its negative
rank; normalisation is the identity. Pre-tokens are encoded one by one and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DROPS

#: Memo entries of a worker (pre-token to packed ids); it is emptied when full.
MEMO = 1_000_000
#: Characters tokenised at a time, so that token lists stay small; single texts may be longer.
CHUNK_CHARS = 300_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without gaps")
    return [piece for _, piece in ranked]


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes(out) + bytes([value])


def _field(number: int, value) -> bytes:
    """One protobuf field: bytes and text by length, floats in four bytes, integers as varints."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(vocabulary: list[bytes]) -> bytes:
    """A sentencepiece BPE model: piece 0 is the unknown piece, piece ``rank + 1`` the vocabulary.

    Fixed values: the field numbers of the public model format.
    """
    letters = byte_characters()
    pieces = [_field(1, "<unk>") + _field(2, 0.0) + _field(3, 2)]
    for rank, piece in enumerate(vocabulary):
        pieces.append(_field(1, "".join(letters[b] for b in piece)) + _field(2, -float(rank)) + _field(3, 1))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, 0) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normaliser = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, piece) for piece in pieces) + _field(2, trainer) + _field(3, normaliser)


#: Letters, numbers and white space of the code points below U+0250, as the pattern's classes have them.
_LATIN = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"\p{N}": "0-9²³¹¼-¾", r"\s": r"\t-\r \x85\xa0"}
_BEYOND_LATIN = re.compile("[^\x00-ɏ]").search


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text.

    Texts of Latin letters alone take an equal pattern of explicit ranges, which the standard library matches in
    half the time. It is used only if ``pattern`` consists of the three classes replaced here.
    """
    whole = regex.compile(pattern).findall
    plain = pattern.replace(r"(?!\S)", r"(?![^\s])")
    for kind, letters in _LATIN.items():
        plain = re.sub(r"\[(\^?)([^\]]*)\]", lambda m, k=kind, v=letters: f"[{m[1]}{m[2].replace(k, v)}]", plain)
        plain = re.sub(r"(?<!\[)" + re.escape(kind) + r"(?![^\[]*\])", lambda m, v=letters: f"[{v}]", plain)
    if re.search(r"\\[pPSdDwW]", plain):
        return whole
    fast = re.compile(plain).findall
    return lambda text: whole(text) if _BEYOND_LATIN(text) else fast(text)


class Codec:
    """Encoder and decoder of one vocabulary; built once in each worker."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.vocabulary))
        self.split = splitter(pattern)
        self.letters = dict(enumerate(byte_characters()))
        # A pre-token that is a vocabulary entry is that entry, whether or not merges lead to it.
        self.memo_start = {}
        for rank, piece in enumerate(self.vocabulary):
            try:
                self.memo_start[piece.decode()] = struct.pack("<I", rank)
            except UnicodeDecodeError:
                continue
        self.memo = dict(self.memo_start)

    def _packed(self, tokens: set[str]) -> dict[str, bytes]:
        """The packed ids of each pre-token, from the memo or from the model."""
        known = {t: self.memo.get(t) for t in tokens}
        missing = [t for t, packed in known.items() if packed is None]
        if len(self.memo) + len(missing) > MEMO + len(self.memo_start):
            self.memo = dict(self.memo_start)
        mapped = [t.encode().decode("latin-1").translate(self.letters) for t in missing]
        for token, ids in zip(missing, self.processor.encode(mapped, num_threads=1)):
            known[token] = self.memo[token] = array("I", [i - 1 for i in ids]).tobytes()
        return known

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        parts = [self.split(text) for text in texts]
        get = self._packed(set().union(*parts)).__getitem__
        return [b"".join(map(get, tokens)) for tokens in parts]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


DROPS.append(codec.cache_clear)


def public_codec() -> Codec:
    """The codec of the public multilingual vocabulary, read where the worker runs."""
    import public_tokenizers

    return codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def text_chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``limit`` characters together, never an empty one."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def encode_texts(df: DataFrame, text: str = "text", make: Callable[[], Codec] = public_codec) -> DataFrame:
    """``df`` plus ``token_ids`` (array of int); null is an empty text. Rows are neither lost nor shuffled."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = make()
        for series in batches:
            texts = ["" if t is None else t for t in series.tolist()]
            out = []
            for start, stop in text_chunks(texts):
                out += [array("I", packed).tolist() for packed in own.encode_packed(texts[start:stop])]
            yield pd.Series(out, dtype=object)

    return df.withColumn("token_ids", F.pandas_udf(encode, "array<int>")(F.col(f"`{text}`").cast("string")))


def decode_ids(df: DataFrame, ids: str = "token_ids", make: Callable[[], Codec] = public_codec) -> DataFrame:
    """``df`` plus ``decoded`` (binary), the bytes behind ``ids``; null ids decode to nothing."""
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = make()
        for series in batches:
            yield pd.Series([own.decode([] if v is None else v) for v in series], dtype=object)

    return df.withColumn("decoded", F.pandas_udf(decode, "binary")(F.col(f"`{ids}`")))


def token_digests(df: DataFrame, text: str = "text", key: str = "doc_id", make: Callable[[], Codec] = public_codec) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row.

    Each text is encoded whole, its ids are packed, and the packed ids are read again and decoded, all in one
    pass without a shuffle. Null is an empty text with no ids; repeated rows give repeated results.
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
                    ids_hex.append(hashlib.sha256(packed).hexdigest())
                    decoded_hex.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(decoded_hex, pa.string())],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = picked.mapInArrow(digest, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
