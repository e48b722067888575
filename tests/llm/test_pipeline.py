from __future__ import annotations

import hashlib
import struct

import pytest
import tiktoken

import corpus_pipeline
from tidemark.llm import stages
from tidemark.llm.bpe import public_codec

from . import test_decontaminate, test_jaccard, test_suffix, test_toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts):
    rows = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def test_toxicity_keeps_clean_documents(spark):
    docs, labels = test_toxicity.made(400)
    df = frame(spark, [(k, t) for k, t, _ in docs] + [(900, None), (901, "")])
    kept = stages.without_toxic(df, spark.createDataFrame(labels, test_toxicity.LABELS))
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    toxic = {k for k, _, y in labels if y}
    assert len(ids & toxic) <= 0.05 * len(toxic) and len(ids - toxic) >= 0.99 * (402 - len(toxic))


def test_one_document_of_each_group_stays(spark):
    texts = test_jaccard.near_copies(4, [6, 9, 20, 40, 80, 150] * 3)
    texts += ["", None, "", texts[0]]
    rows = list(enumerate(texts)) + [(0, texts[0]), (3, texts[3])]  # rows given twice
    df = frame(spark, rows)
    kept = stages.without_near_duplicates(df)
    assert kept.columns == df.columns
    want = {key for key, n, low in test_jaccard.brute(rows, 5, 80) if n == 0 or key == low}
    got = [r["doc_id"] for r in kept.collect()]
    assert set(got) == want
    assert sorted(got) == sorted(want)


def test_groups_are_told_apart_by_more_than_their_lowest_id(spark):
    base = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcdefg"]
    lone = [(None, base[0]), (None, base[1]), (1, base[2]), (1, base[3])]  # null ids, and one id with several texts
    groups = [(2, base[4]), (3, base[4] + " more"), (2, base[5]), (4, base[5] + " more"), (None, base[6]), (None, base[6])]
    rows = [(key, text, "en", "src", len(text)) for key, text in lone + groups]
    kept = stages.without_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = [*lone, groups[0], groups[2], groups[4]]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)


def test_repeats_are_cut_and_columns_kept(spark):
    passage = "Some passage that is said again. " * 8
    rows = [(1, "first " + passage + "end"), (2, passage + "second é"), (3, "third"), (4, None)]
    df = frame(spark, rows)
    out = {r["doc_id"]: r for r in stages.without_repeats(df).collect()}
    assert stages.without_repeats(df).columns == df.columns
    flags = test_suffix.brute([(t or "").encode() for _, t in rows], 200)
    for (key, text), marks in zip(rows, flags):
        kept = bytes(b for b, m in zip((text or "").encode(), marks) if not m).decode(errors="ignore")
        assert out[key]["text"] == kept and out[key]["n_chars"] == len(kept) and out[key]["source"] == f"src{key % 3}"


def test_contaminated_documents_go(spark):
    docs, items = test_decontaminate.made(6)
    kept = stages.without_contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    clean = [row[0] for row in test_decontaminate.brute(docs, items) if not row[-1]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(clean)


def test_the_stages_and_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "byte_bpe"]


@pytest.mark.parametrize("empty", [True, False])
def test_run(spark, sf_dir, empty, tmp_path):
    if empty:
        for name in ("documents", "labels", "benchmark"):
            spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
        return
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ranks = {piece: i for i, piece in enumerate(public_codec().vocabulary)}
    import public_tokenizers

    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = 0
    for row in rows:
        text = source[row["doc_id"]]
        if row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest():
            ids = encoding.encode_ordinary(text)
            assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            whole += 1
    assert len({r["doc_id"] for r in rows}) == len(rows) < len(source) and whole > 0.6 * len(rows)
