from __future__ import annotations

import random

from tidemark.llm.common import connected_components, fresh, words_of
from pyspark.sql import functions as F


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in list(parent)}


def test_components_match_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), "test")
    want = {x: r for x, r in brute(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
    rows = got.collect()
    assert len(rows) == len(want) and {r["node"]: r["component"] for r in rows} == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "test").collect() == []


def test_words_fold_ascii_only(spark):
    rows = [(None,), ("",), (" ..! ",), ("The É-MIT 2.0",), ("\x00a\x7fb",)]
    got = spark.createDataFrame(rows, "text string").select(words_of(F.col("text")).alias("w")).collect()
    assert [r["w"] for r in got] == [[], [], [], ["the", "É", "mit", "2", "0"], ["a", "b"]]


def test_fresh_names_avoid_clashes_of_any_case():
    assert fresh(["Mark", "mark_"], "mark") == "mark__"
