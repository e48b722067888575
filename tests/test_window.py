from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from helpers import plan_text, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.aggregates import high_water_text
from tidemark.operators.window import apply_filters, filter_conjunction, incremental_window
from tidemark.session import runtime_conf
from tidemark.sources.files import read_files


@pytest.fixture(scope="module")
def numbers(spark):
    values = [(i, None if i % 10 == 9 else i) for i in range(100)]
    return spark.createDataFrame(values, "id bigint, mark bigint").cache()


@pytest.mark.parametrize(("low", "high", "expected"), [(10, 20, 9), (0, 5, 5), (20, 20, 0), (30, 20, 0)])
def test_window_is_open_below_and_closed_above(numbers, low, high, expected):
    assert incremental_window(numbers, "mark", low, high).count() == expected


def test_degenerate_window_folds_to_an_empty_relation(numbers):
    plan = plan_text(incremental_window(numbers, "mark", 20, 20))
    assert "LocalTableScan" in plan and "Filter" not in plan


def test_first_run_is_bounded_above_and_keeps_nulls(numbers):
    got = incremental_window(numbers, "mark", None, 10)
    assert got.where("mark IS NULL").count() == 10
    assert got.where("mark > 10").count() == 0


def test_only_low_bound_and_zero_is_a_checkpoint(numbers):
    assert incremental_window(numbers, "mark", 0, None).count() == 89
    assert incremental_window(numbers, "mark", 90, None).count() == 8


def test_full_reads(numbers):
    assert incremental_window(numbers, None, 1, 2).count() == 100
    assert incremental_window(numbers, "mark", None, None).count() == 100
    assert incremental_window(numbers, "mark", 100, None, need_both=True).count() == 100


def test_boolean_column_is_refused(spark):
    with pytest.raises(TypeError):
        incremental_window(spark.createDataFrame([(True,)], "b boolean"), "b", 0, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-5, 105), min_size=3, max_size=3).map(sorted))
def test_adjacent_windows_are_gapless_and_disjoint(numbers, cuts):
    a, b, c = cuts
    left = rows(incremental_window(numbers, "mark", a, b), "id")
    right = rows(incremental_window(numbers, "mark", b, c), "id")
    whole = rows(incremental_window(numbers, "mark", a, c), "id")
    assert sorted(left + right) == whole
    assert not set(left) & set(right)


@pytest.mark.parametrize(
    ("ddl", "values", "low", "high", "kept"),
    [
        ("c string", ["0009", "0010", "0011"], "0009", "0010", ["0010"]),
        ("c decimal(10,2)", [Decimal("1.10"), Decimal("1.20")], Decimal("1.10"), "1.20", [Decimal("1.20")]),
        ("c double", [0.1, 0.2, 0.3], 0.1, 0.2, [0.2]),
        ("c date", ["2024-01-01", "2024-01-02"], "2024-01-01", "2024-01-02", ["2024-01-02"]),
        ("c string", ["2024-01-01 00:00:00", "2024-01-02 00:00:00"], datetime(2024, 1, 1),
         datetime(2024, 1, 3), ["2024-01-02 00:00:00"]),
    ],
)
def test_bounds_take_the_type_of_the_column(spark, ddl, values, low, high, kept):
    df = spark.createDataFrame([(str(v),) for v in values], "c string").select(F.col("c").cast(ddl.split()[1]))
    got = [r[0] for r in incremental_window(df, "c", low, high).collect()]
    assert [str(v) for v in got] == [str(v) for v in kept]


def test_window_reaches_the_parquet_scan(spark, sf_dir):
    events = read_files(spark, f"{sf_dir}/events.parquet").select("event_id", "ts")
    plan = plan_text(incremental_window(events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20)))
    assert "GreaterThan(ts,2024-01-10T00:00)" in plan
    assert "LessThanOrEqual(ts,2024-01-20T00:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_first_run_window_reaches_the_parquet_scan(spark, sf_dir):
    events = read_files(spark, f"{sf_dir}/events.parquet")
    plan = plan_text(incremental_window(events, "ts", None, datetime(2024, 1, 10)))
    assert "Or(LessThanOrEqual(ts,2024-01-10T00:00),IsNull(ts))" in plan


def test_not_a_number_is_treated_like_null(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "d double")
    assert high_water_text(df, "d") == "2.0"
    assert incremental_window(df, "d", None, "2.0").count() == 4
    assert incremental_window(df, "d", "1.0", "2.0").count() == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bound_that_does_not_fit_is_an_error(spark, numbers, ansi):
    with runtime_conf(spark, {"spark.sql.ansi.enabled": ansi}), pytest.raises(Exception, match="abc"):
        incremental_window(numbers, "mark", "abc", "def").count()


def test_nested_column(spark):
    df = spark.range(10).select(F.struct(F.col("id").alias("v")).alias("s"))
    assert incremental_window(df, "s.v", 3, 5).count() == 2


def test_filters_are_conjunctive(spark):
    df = spark.createDataFrame([("active", 20), ("active", 10), ("gone", 30)], "status string, age int")
    assert apply_filters(df, {"status": "= 'active'", "age": "> 18"}).count() == 1
    assert apply_filters(df, {}).count() == 3
    assert df.where(filter_conjunction({"age": "IN (10, 30)"})).count() == 2


def test_filters_reach_the_parquet_scan(spark, sf_dir):
    events = read_files(spark, f"{sf_dir}/events.parquet")
    plan = plan_text(apply_filters(events, {"event_type": "= 'purchase'", "value": "> 50"}))
    assert "EqualTo(event_type,purchase)" in plan and "GreaterThan(value,50.0)" in plan


def test_high_water_text_is_lossless(spark):
    df = spark.createDataFrame([("1.10", "007", "2024-01-01 10:00:00.000001")], "d string, s string, t string")
    df = df.select(F.col("d").cast("decimal(10,2)"), "s", F.col("t").cast("timestamp"),
                   F.col("t").cast("timestamp_ntz").alias("n"))
    assert high_water_text(df, "d") == "1.10"
    assert high_water_text(df, "s") == "007"
    assert high_water_text(df, "t") == "2024-01-01 10:00:00.000001+00:00"
    assert high_water_text(df, "n") == "2024-01-01 10:00:00.000001"
    assert high_water_text(df.where("false"), "d") is None


def test_timestamp_checkpoint_survives_an_ambiguous_hour(spark):
    micros = [1730593800_000000, 1730597400_000000]  # 01:30 twice in New York, 3 November 2024
    df = spark.createDataFrame([(m,) for m in micros], "m bigint").select(F.timestamp_micros("m").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        first = high_water_text(df.where(F.unix_micros("t") == micros[0]), "t")
        assert incremental_window(df, "t", first, high_water_text(df, "t")).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
