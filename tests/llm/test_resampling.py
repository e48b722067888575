"""Importance resampling against counters over every feature, without planes or sorting by ranges."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import resampling
from tidemark.llm.queries import op13_importance_resampling

DOC = "doc_id long, text string, score string, `KEY` int, rank int"


def buckets_of(text, buckets=10_000, longest=3):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded) if w]
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(run.encode()) % buckets for run in runs)


def brute(docs, target):
    """``(doc_id, n_features, weight, score, rank)`` of every ``(doc_id, text)``; equal rows are interchangeable."""
    own = [(doc_id, *buckets_of(text)) for doc_id, text in docs]
    source, aim = Counter(), Counter()
    for *_, counts in own:
        source.update(counts)
    for text in target:
        aim.update(buckets_of(text)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, n_words, counts in own:
        weight = sum(gain[b] * n for b, n in counts.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, sum(counts.values()), weight, score, None, n_words])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2]))
    for rank, row in enumerate(able[: 5 * len(able) // 100], 1):
        row[4] = rank
    return [tuple(r[:5]) for r in rows]


def agree(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_registered_query_against_counters(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    got = op13_importance_resampling(spark, sf_dir).collect()
    agree(got, brute(docs, target))
    assert max(r["rank"] or 0 for r in got) > 5


def test_odd_rows_repeats_and_hot_rows(spark):
    pick = random.Random(4)
    word = lambda: pick.choice(["The", "cat", "Ärger", "ÄRGER", "x1", "日本", "dog's", "ran"])
    texts = [(i, " ".join(word() for _ in range(pick.choice([0, 1, 19, 20, 21, 60, 400])))) for i in range(-5, 140)]
    texts += [(500, "one two three four five six seven eight nine ten " * 3)] * 120  # a third of all rows is one row
    texts += [(None, "cat " * 30), (None, "cat " * 30), (None, None), (7, None), (8, ""), (9, "... --"), (10, "x" * 50_000)]
    df = spark.createDataFrame([(d, t, "clash", 1, 2) for d, t in texts], DOC)
    target = ["the cat ran", None, "", "one two three four"]
    aims = spark.createDataFrame([(t, "a") for t in target], "text string, planes string")
    got = resampling.importance_resample(df, aims).collect()
    agree(got, brute(texts, target))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 1 + max(r["rank"] or 0 for r in got)))


def test_equal_scores_fall_to_smaller_keys(spark):
    rows = [(key, score, 0, able) for key, score, able in [(5, 10, True), (3, 10, True), (4, 10, True), (9, 99, False), (1, 11, True), (None, 10, True), (2, -5, True)]]
    scored = spark.createDataFrame(rows, "key long, score long, weight long, eligible boolean")
    for drawn in range(8):
        got = {r["key"]: r["rank"] for r in resampling.ranked(resampling.staged(scored, "test"), drawn).collect()}
        order = [1, 3, 4, 5, None, 2]
        assert got == {9: None} | {key: i + 1 if i < drawn else None for i, key in enumerate(order)}


def test_draws_of_every_size(spark):
    """Scores over all magnitudes, repeated and negative: bins of the histogram must never part equal scores."""
    pick = random.Random(9)
    values = [pick.choice([0, 1, -1, 7, pick.randint(-(10**9), 10**9), 2**62, -(2**62)]) for _ in range(300)]
    scored = spark.createDataFrame([(i, v, 0, True) for i, v in enumerate(values)], "key long, score long, weight long, eligible boolean")
    scored = resampling.staged(scored, "test")
    for drawn in (1, 17, 150, 300):
        want = sorted(range(300), key=lambda i: (-values[i], i))[:drawn]
        got = resampling.ranked(scored, drawn).where("rank IS NOT NULL").orderBy("rank").select("key").collect()
        assert [r["key"] for r in got] == want


def test_planes_hold_the_counts():
    words = [b"a"] * 700 + [b"b", b"c"] * 9
    n, data = resampling.feature_planes(words, 10_000, 3)
    text = " ".join(w.decode() for w in words)
    want = buckets_of(text)[1]
    size = resampling._plane_bytes(10_000)
    total = resampling.VerticalSum()
    for level in range(len(data) // size):
        plane = int.from_bytes(data[level * size : (level + 1) * size], "little")
        for _ in range(3):
            total.add(plane, level)
    assert n == sum(want.values()) and {b: c // 3 for b, c in enumerate(total.totals(10_000).tolist()) if c} == dict(want)
    gain = [random.Random(b).randint(-9000, 9000) for b in range(10_000)]
    got = resampling.weights_of([data, b"", data], resampling.gain_planes(gain), 10_000)
    value = sum(gain[b] * c for b, c in want.items())
    assert got.tolist() == [value, 0, value]


@pytest.mark.parametrize("buckets", [1, 7, 64, 1000])
def test_other_sizes(spark, buckets):
    df = spark.createDataFrame([(1, "a b c a b"), (2, "z")], "doc_id long, text string")
    got = resampling.importance_resample(df, df.where("doc_id = 2"), buckets=buckets, max_words=2, min_words=1, percent=50).collect()
    assert {r["doc_id"]: r["n_features"] for r in got} == {1: 9, 2: 1} and sum(r["rank"] is not None for r in got) == 1
    assert np.array_equal(resampling.bucket_totals(resampling.with_planes(df.limit(0), "doc_id", "text", buckets), buckets), np.zeros(buckets))


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resampling.importance_resample(df.limit(0), df).collect() == []
    got = resampling.importance_resample(df, df.limit(0)).collect()
    agree(got, brute([(1, "a b c")], []))
