from __future__ import annotations

from collections import defaultdict

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from tidemark.operators import retention
from tidemark.operators.retention import retain_latest


@pytest.fixture(scope="module")
def log(spark):
    """Stream ``hot`` holds most rows, timestamps tie, one stream is null."""
    stream = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 9, None).otherwise(
        F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(0, 5000, 1, 7).select("id", stream.alias("stream"), (F.col("id") * 37 % 101).alias("ts")).cache()


def brute(log, n):
    streams = defaultdict(list)
    for row in log.collect():
        streams[row.stream].append((row.ts, row.id))
    return sorted(i for entries in streams.values() for _, i in sorted(entries, reverse=True)[:n])


@pytest.mark.parametrize("n", [1, 3, 250, 10_000])
@pytest.mark.parametrize("limit", [retention.WINDOW_LIMIT, 0])
def test_exact_in_both_forms(log, monkeypatch, n, limit):
    monkeypatch.setattr(retention, "WINDOW_LIMIT", limit)
    got = retain_latest(log, "stream", ["ts", "id"], n)
    assert got.columns == log.columns
    assert [i for (i,) in rows(got, "id")] == brute(log, n)


@pytest.mark.parametrize("n", [1, 40, 250, 1800, 10_000])
@pytest.mark.parametrize("kind", ["bigint", "timestamp", "date", "string"])
def test_selection_agrees_for_every_type(spark, log, monkeypatch, n, kind):
    """Ties, nulls in the order column, one hot stream; strings have no cuts and are sorted."""
    monkeypatch.setattr(retention, "WINDOW_LIMIT", 0)
    typed = {
        "bigint": F.col("ts"),
        "timestamp": F.timestamp_seconds("ts"),
        "date": F.date_from_unix_date(F.col("ts").cast("int")),
        "string": F.lpad(F.col("ts").cast("string"), 4, "0"),
    }[kind]
    rows_ = log.withColumn("ts", F.when(F.col("id") % 11 != 0, typed))
    streams = defaultdict(list)
    for row in rows_.collect():
        streams[row.stream].append(((row.ts is not None, row.ts if row.ts is not None else 0), row.id))
    want = sorted(i for entries in streams.values() for _, i in sorted(entries, key=lambda e: (e[0][0], e[0][1] if e[0][0] else 0, e[1]), reverse=True)[:n])
    assert [i for (i,) in rows(retain_latest(rows_, "stream", ["ts", "id"], n), "id")] == want


def test_cuts_that_miss_are_not_used(log, monkeypatch):
    monkeypatch.setattr(retention, "WINDOW_LIMIT", 0)
    monkeypatch.setattr(retention, "_ACCURACY", 1)
    monkeypatch.setattr(retention, "_BROADCAST_STREAMS", 0)
    assert [i for (i,) in rows(retain_latest(log, "stream", ["ts", "id"], 700), "id")] == brute(log, 700)


def test_only_rows_around_the_cut_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(retention, "WINDOW_LIMIT", 0)
    sorted_rows = []
    by_position = retention._by_position
    monkeypatch.setattr(retention, "_by_position", lambda df, *more: sorted_rows.append(df.count()) or by_position(df, *more))
    df = spark.range(200_000).select("id", (F.col("id") % 3 != 0).alias("stream"), F.col("id").alias("ts"))
    assert retain_latest(df, "stream", ["ts"], 40_000).count() == 80_000
    assert 0 < sorted_rows[0] < 10_000


def test_null_is_unbounded_and_zero_keeps_nothing(log):
    assert retain_latest(log, "stream", ["ts", "id"], None).count() == 5000
    assert retain_latest(log, "stream", ["ts", "id"], 0).count() == 0


def test_rows_are_trimmed_before_the_shuffle(log):
    plan = plan_text(retain_latest(log, "stream", ["ts", "id"], 10))
    exchange = plan.rindex("Exchange hashpartitioning(stream")
    assert plan.find("WindowGroupLimit", exchange) > exchange


@pytest.mark.parametrize("n", [3, 1500])
def test_user_columns_named_like_helpers_survive(spark, n):
    names = ["_salt", "_rn", "_pos", "_part", "_stream", "_before"]
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 2).alias("g"), *(F.concat(F.lit(c), F.col("id")).alias(c) for c in names))
    got = retain_latest(df, "g", ["id"], n).collect()
    assert len(got) == 2 * min(n, 1000) and all(r[c] == f"{c}{r['id']}" for r in got for c in names)
