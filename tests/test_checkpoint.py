from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.checkpoint import (
    checkpoint_text,
    decode_checkpoint,
    encode_checkpoint,
    field_type,
    format_checkpoint,
    parse_checkpoint,
)


def parse(spark, value, ddl="string"):
    df = spark.createDataFrame([(value,)], f"c {ddl}")
    return parse_checkpoint(df, "c").first().checkpoint


@pytest.mark.parametrize(
    ("text", "tag", "value"),
    [
        ("999", "int", 999),
        ("  -7 ", "int", -7),
        ("+3", "int", 3),
        ("2024-03-31T23:59:59", "ts", datetime(2024, 3, 31, 23, 59, 59)),
        ("2024-03-31 23:59:59.5", "ts", datetime(2024, 3, 31, 23, 59, 59, 500000)),
        ("2024-03-31", "ts", datetime(2024, 3, 31)),
        ("2024-03-31T23:59:59+00:00", "ts", datetime(2024, 3, 31, 23, 59, 59)),
        ("2024-13-31", "str", "2024-13-31"),
        ("12:00", "str", "12:00"),
        ("2024-01", "str", "2024-01"),
        ("1.5", "str", "1.5"),
        ('{"t": {"0": 5}}', "str", '{"t": {"0": 5}}'),
        ("", "str", ""),
    ],
)
def test_text_is_read_as_integer_then_timestamp_then_text(spark, text, tag, value):
    got = parse(spark, text)
    assert got.t == tag
    assert {"int": got.as_int, "ts": got.as_ts, "str": got.as_str}[tag] == value
    assert sum(v is not None for v in (got.as_int, got.as_ts, got.as_str)) == 1


def test_typed_inputs(spark):
    assert parse(spark, None) is None
    assert parse(spark, 42, "int").as_int == 42
    assert parse(spark, 1.9, "double").as_int == 1
    assert parse(spark, -1.9, "double").as_int == -1
    assert parse(spark, Decimal("7.99"), "decimal(5,2)").as_int == 7
    assert parse(spark, datetime(2024, 1, 1), "timestamp").as_ts == datetime(2024, 1, 1)
    with pytest.raises(TypeError):
        parse(spark, True, "boolean")


def test_other_columns_are_kept(spark):
    df = spark.createDataFrame([(1, "5")], "id int, c string")
    assert parse_checkpoint(df, "c").columns == ["id", "c", "checkpoint"]


@pytest.mark.parametrize("text", ["500", "2024-01-10T08:00:00", "2024-01-10T08:00:00.000123", 'a "quoted" text', None])
def test_serde_round_trip(spark, text):
    df = parse_checkpoint(spark.createDataFrame([(text,)], "c string"), "c")
    coded = df.withColumn("j", encode_checkpoint(F.col("checkpoint")))
    row = decode_checkpoint(coded, "j", "back").first()
    assert row.back == row.checkpoint


def test_serde_form(spark):
    df = parse_checkpoint(spark.createDataFrame([("500",), ("2024-01-10T08:00:00",)], "c string"), "c")
    coded = [r[0] for r in df.select(encode_checkpoint(F.col("checkpoint"))).collect()]
    assert coded == ['{"t":"int","v":500}', '{"t":"ts","v":"2024-01-10T08:00:00"}']


@pytest.mark.parametrize("raw", ['{"t":"bool","v":"x"}', "[1]", "plain", None])
def test_unknown_tags_decode_to_null(spark, raw):
    assert decode_checkpoint(spark.createDataFrame([(raw,)], "j string"), "j").first().checkpoint is None


@pytest.mark.parametrize(
    ("value", "ddl", "expected"),
    [
        (42, "int", "42"),
        (0, "int", "0"),
        (datetime(2024, 6, 15, 9, 30), "timestamp", "'2024-06-15 09:30:00'"),
        (datetime(2024, 6, 15, 9, 30, 0, 5), "timestamp_ntz", "'2024-06-15 09:30:00.000005'"),
        ("abc", "string", "abc"),
        (None, "timestamp", None),
    ],
)
def test_literal(spark, value, ddl, expected):
    df = spark.createDataFrame([(value,)], f"c {ddl}")
    assert df.select(format_checkpoint(F.col("c"), field_type(df, "c"))).first()[0] == expected


def test_driver_text():
    assert checkpoint_text(None) is None
    assert checkpoint_text(0) == "0"
    assert checkpoint_text(datetime(2024, 1, 1, 2, 3, 4)) == "2024-01-01 02:03:04"
    with pytest.raises(TypeError):
        checkpoint_text(True)


def test_user_columns_named_like_helpers_survive(spark):
    from tidemark.functions.checkpoint import decode_checkpoint

    df = spark.createDataFrame([("5", "mine", 1, "a")], "c string, _text string, _INT int, _raw string")
    got = parse_checkpoint(df, "c").first()
    assert (got["_text"], got["_INT"], got["checkpoint"]["as_int"]) == ("mine", 1, 5)
    tagged = df.withColumn("c", F.lit('{"t":"int","v":"7"}'))
    got = decode_checkpoint(tagged, "c").first()
    assert got["_raw"] == "a" and got["checkpoint"]["as_int"] == 7
