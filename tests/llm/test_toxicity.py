from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as t

DOCS = "doc_id bigint, text string, score string"
LABELS = "doc_id bigint, quality int, toxic int"


def made(n=400, seed=1):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randrange(3, 8))) for _ in range(400)]
    bad = ["vilword", "badmouth", "nastily"]
    docs, labels = [], []
    for key in range(n):
        toxic = key % 5 == 0
        words = [rng.choice(clean) for _ in range(rng.randrange(5, 60))]
        if toxic:
            words[:2] = [rng.choice(bad), "grolux" + rng.choice(clean)]
        rng.shuffle(words)
        docs.append((key, " ".join(words), "clash"))
        labels.append((key, 1, int(toxic)))
    return docs, labels


def fold(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made()
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), dict((k, y) for k, _, y in labels)


def test_held_out_rows_are_told_apart(tables):
    docs, labels, truth = tables
    rows = t.score_documents(docs, labels).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == fold(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_labels_of_the_held_out_fold_change_nothing(tables, spark):
    docs, labels, _ = tables
    turned = labels.withColumn("toxic", F.when(t.remainder(F.col("doc_id")) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r["doc_id"]: r["score"] for r in t.score_documents(docs, x).collect()} for x in (labels, turned))
    assert one == two


def test_scores_do_not_depend_on_the_layout(tables, spark):
    docs, labels, _ = tables
    copies = docs.unionByName(docs.where("doc_id < 200").selectExpr("doc_id + 1000 AS doc_id", "concat(text, ' more') AS text", "score"))
    marks = labels.unionByName(labels.where("doc_id < 200").selectExpr("doc_id + 1000 AS doc_id", "quality", "1 - toxic AS toxic"))
    spread = copies.repartition(7, F.xxhash64("text")).sortWithinPartitions(F.desc("doc_id"))
    one, two = ({r["doc_id"]: r["score"] for r in t.score_documents(x, y).collect()} for x, y in ((copies.coalesce(1), marks), (spread, marks.repartition(3))))
    assert one == two


def test_voters_and_label_model():
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.2
    votes = np.zeros((3000, 4))
    for j, accuracy in enumerate((0.95, 0.8, 0.6)):
        right = rng.random(3000) < accuracy
        votes[:, j] = np.where(right == y, 1, -1)
    votes[:, 3] = votes[:, 1]  # a copy must not count twice
    posterior, voters, correlation = t.label_model(votes, 0.2)
    assert ((posterior > 0.5) == y).mean() > 0.93
    assert abs(voters["accuracy"][0] - 0.95) < 0.08 and abs(voters["accuracy"][1] - 0.8) < 0.08
    assert correlation[1, 3] > 0.9 and voters["weight"][1] < 0.7 < voters["weight"][0]


def test_near_copies_do_not_teach_their_words(spark):
    docs, labels = made(300)
    copied = " ".join(f"peculiar{i}" for i in range(60))
    docs += [(1000 + i, copied + f" end{i}", "") for i in range(60)]
    labels += [(1000 + i, 1, 1) for i in range(60)]
    model = t.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert not any(item.startswith("peculiar") for item in model.weights.get("word", {}))


def test_an_id_of_many_rows_counts_once(spark):
    docs, labels = made(40)
    key = next(k for k, _, _ in labels if not fold(k))
    docs += [(key, f"other text {i}", "") for i in range(200)] + [(key, None, "")]
    rows = t.training_rows(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len({r["rid"] for r in rows}) == sum(not fold(k) for k, _, _ in labels)
    assert all(r["text"] is not None for r in rows)
    assert t.training_rows(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), max_rows=7).count() == 7


def test_odd_rows(spark, tables):
    _, labels, _ = tables
    rows = [(1, None, ""), (1, "", ""), (None, "x", ""), (2, "vilword " * 30_000, "")]
    got = t.score_documents(spark.createDataFrame(made()[0] + rows, DOCS), labels).collect()
    assert len(got) == 404 and sum(r["doc_id"] is None for r in got) == 1
    assert not spark.createDataFrame([], DOCS).where("1=0").collect()


@pytest.mark.parametrize("toxic", [None, 0, 1])
def test_nothing_to_learn_from(spark, toxic):
    docs, labels = made(20)
    labels = [(k, q, toxic) for k, q, _ in labels]
    rows = t.score_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == 20 and all(r["predicted"] == 0 for r in rows)
    assert t.score_documents(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).collect() == []
