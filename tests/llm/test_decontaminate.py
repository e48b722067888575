from __future__ import annotations

import hashlib
import random
import re

from tidemark.llm import decontaminate as d

DOCS = "doc_id bigint, text string, item string, rid string"
ITEMS = "item_id bigint, text string, n string"


def words(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded) if w]


def brute(docs, items):
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, test in items:
            terms = words(test)
            size = min(10, len(terms))
            windows = {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)} if terms else set()
            for i in range(len(own) - size + 1 if windows else 0):
                if tuple(own[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        marks = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(own), len(hit), len(found), marks, bool(hit)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(30)] + ["the"] * 30
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)] + [(12, None), (13, "...")]
    docs = []
    for key in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        if rng.random() < 0.5:
            at = rng.randrange(len(text) + 1)
            text[at:at] = words(rng.choice(items)[1])
        docs.append((key // 2, " ".join(text).replace("t1", "T1")))
    return docs + [(99, None), (98, ""), (97, "the")], items


def run(spark, docs, items):
    a = spark.createDataFrame([(k, t, "clash", "clash") for k, t in docs], DOCS)
    b = spark.createDataFrame([(k, t, "clash") for k, t in items], ITEMS)
    return sorted((tuple(r) for r in d.decontaminate(a, b).collect()), key=str)


def test_matches_brute_force(spark):
    for seed in (1, 2):
        docs, items = made(seed)
        assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_a_long_benchmark(spark, monkeypatch):
    docs, items = made(3)
    monkeypatch.setattr(d, "BLOCK_WORDS", 60)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_agree_on_rows_without_a_fixed_order(spark, monkeypatch):
    docs, items = made(6)
    monkeypatch.setattr(d, "BLOCK_WORDS", 60)
    a = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    a = a.mapInPandas(lambda frames: (f.sample(frac=1) for f in frames), a.schema)  # another order each time
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted((tuple(r) for r in d.decontaminate(a, b).collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = made(4)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 50 + "beta gamma"), (3, "alpha beta"), (4, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "gamma the alpha the beta")], "item_id bigint, text string")
    index = d.build_index(docs, ["gamma", "alpha", "beta", "the"])
    assert d.proximity_matches(index, items, slop=10).collect() == []  # its rarest term stands nowhere
    close = spark.createDataFrame([(7, "gamma alpha beta")], "item_id bigint, text string")
    assert [tuple(r) for r in d.proximity_matches(index, close, slop=10).collect()] == [(1, 7, 5)]


def test_native_plan(spark):
    docs, items = made(5)
    a = spark.createDataFrame([(k, t) for k, t in docs], "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    plan = d.decontaminate(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
