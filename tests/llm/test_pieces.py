"""Merge rounds against the sentencepiece library, on texts, on random strings and on random ids."""

from __future__ import annotations

import hashlib
import random
from array import array

import public_tokenizers
import pytest
import sentencepiece

from tidemark.llm import bpe, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "▁", "▁▁ a", " a", "a ", "  a  b   c", "\n\n", "\t x", " " * 15, " " * 31 + "the", " " * 100 + "中", " " * 5000, "<s>", "<0x41>", "日本語テキスト" * 50,
    "a" * 3000, "\x00x", "the" * 500, "👍🏽👨‍👩‍👧", "über étrange ñandú", "​　 mixed 中文 and Ünïcode", "ingionthe" * 77, "x" * 70 + " " + "y" * 70,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(codec, texts):
    return [list(array("I", packed)) for packed in codec.encode_packed(texts)]


def compare(codec, library, texts):
    want = library.encode(texts, num_threads=1)
    assert ids_of(codec, texts) == want
    assert [codec.decode(ids) for ids in want] == [library.decode(ids) for ids in want]


def test_ids_and_decoded_texts_are_those_of_the_library(library):
    compare(pieces.public_codec(), library, TEXTS)


def test_random_strings(library):
    pick = random.Random(11)
    alphabets = ["abcdeinthgo▁ ", "thein ▁", "a ", "  ab\n1", "é中日本ā😀 á"]
    compare(pieces.public_codec(), library, ["".join(pick.choice(pick.choice(alphabets)) for _ in range(pick.randint(1, 60))) for _ in range(4000)])
    known = [library.id_to_piece(i) for i in range(259, 32000)]
    joined = ["".join(pick.choice(known).replace("▁", pick.choice([" ", "▁", ""])) for _ in range(pick.randint(1, 30))) for _ in range(4000)]
    compare(pieces.public_codec(), library, joined)


def test_random_ids_decode_as_in_the_library(library):
    pick = random.Random(12)
    kinds = [lambda: pick.randrange(3), lambda: pick.randrange(3, 259), lambda: pick.randrange(32000), lambda: 28705]
    for _ in range(8000):
        ids = [pick.choice(kinds)() for _ in range(pick.randint(0, 8))]
        assert pieces.public_codec().decode(ids) == library.decode(ids)


def test_rounds_alone_give_the_runs_of_spaces_too(library):
    codec = pieces.PieceCodec(PATH)
    assert codec.counted
    codec.counted = False  # every run goes through the rounds, one merge at a time
    compare(codec, library, [" " * n + end for n in (1, 2, 14, 15, 16, 17, 30, 31, 32, 33, 63) for end in ("", "the", "中", "1")])


def test_a_full_memo_and_long_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 3)
    monkeypatch.setattr(pieces, "ROUND_CHARS", 10)
    compare(pieces.PieceCodec(PATH), library, TEXTS)
    compare(pieces.PieceCodec(PATH), library, [t * 2 for t in TEXTS])


def serialised(ranked: list[tuple[str, float]]) -> bytes:
    """A small model of the public format: byte fallback, identity normalisation, a space in front."""
    field = bpe._field
    entries = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *((p, s, 1) for p, s in ranked)]
    parts = [field(1, field(1, piece) + field(2, score) + field(3, kind)) for piece, score, kind in entries]
    trainer = field(3, 2) + field(4, len(entries)) + field(35, 1)
    return b"".join(parts) + field(2, trainer) + field(3, field(1, "identity") + field(3, 1) + field(4, 0) + field(5, 1))


def test_other_models_with_better_and_equal_later_merges(tmp_path):
    """Vocabularies in which merges make better pairs, with equal scores, and with spaces inside of pieces."""
    pick = random.Random(13)
    for case in range(25):
        chars = "ab▁c"
        texts = sorted({"".join(pick.choice(chars) for _ in range(pick.randint(2, 5))) for _ in range(40)})
        scored = [(c, -100.0) for c in "ab▁"] + [(t, -float(pick.randint(1, 25 if case % 2 else 1000))) for t in texts]
        path = tmp_path / f"{case}.model"
        path.write_bytes(serialised(scored))
        library = sentencepiece.SentencePieceProcessor(model_file=str(path))
        codec = pieces.PieceCodec(str(path))
        compare(codec, library, ["".join(pick.choice("ab cd") for _ in range(pick.randint(0, 40))) for _ in range(300)])


def test_models_of_another_kind_are_refused(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(bpe.serialise_model([bytes([b]) for b in range(256)]))
    with pytest.raises(ValueError):
        pieces.PieceCodec(str(path))


def test_documents_agree_with_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = pieces.piece_digests(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark):
    schema = "doc_id long, text string, piece_ids array<int>, `KEY` string"
    rows = [(1, None, [1], "a"), (2, "", None, "b"), (None, "a b", [], None), (2, "a b", [5], "b"), (2, "a b", [5], "b")]
    df = spark.createDataFrame(rows, schema)
    out = sorted(tuple(r) for r in pieces.piece_digests(df).select("n_tokens", "decoded_sha256").collect())
    empty, text = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"a b").hexdigest()
    assert out == [(0, empty), (0, empty), (2, text), (2, text), (2, text)]
    assert pieces.piece_digests(df.limit(0)).collect() == []
    both = pieces.decode_ids(pieces.encode_texts(df.drop("piece_ids"))).select("text", "decoded").collect()
    assert all((r["text"] or "") == r["decoded"] for r in both) and len(both) == 5
    assert [r["decoded"] for r in pieces.decode_ids(df.where("doc_id = 2 AND text = ''")).collect()] == [""]
