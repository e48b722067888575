from __future__ import annotations

from datetime import datetime

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from tidemark.functions.kafka import (
    decode_kafka,
    infer_value_schema,
    offset_rows,
    parse_offsets,
    render_offsets,
)
from tidemark.operators import offsets
from tidemark.operators.landing import land, read_landing
from tidemark.operators.offsets import end_offsets, offset_map_json, offset_range
from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def records(spark):
    """Topic ``a`` has partitions 0 (two thirds of the rows), 1 and 10; topic ``b`` has 0."""
    data = [("a", 0, o) for o in range(20)] + [("a", 1, o) for o in range(5)]
    data += [("a", 10, o) for o in range(3)] + [("b", 0, o) for o in range(2)]
    df = spark.createDataFrame(data, "topic string, partition int, offset bigint")
    value = F.when(F.col("offset") == 1, F.lit("broken")).otherwise(
        F.concat(F.lit('{"n": '), F.col("offset").cast("string"), F.lit(', "s": "x"}'))
    )
    return df.select(
        F.lit("k").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        F.lit(datetime(2024, 1, 1)).alias("timestamp"),
    ).cache()


def test_binary_is_untouched(records):
    assert decode_kafka(records, "binary").schema == records.schema


@pytest.mark.parametrize(("fmt", "schema"), [("string", None), ("json", None), ("other", "n int")])
def test_text_forms_keep_the_metadata(records, fmt, schema):
    got = decode_kafka(records, fmt, schema)
    assert got.columns == records.columns
    assert dict(got.dtypes)["key"] == dict(got.dtypes)["value"] == "string"


def test_json_expands_fields_and_nulls_malformed_values(records):
    got = decode_kafka(records, "json", "n int, s string")
    assert got.columns == ["n", "s", "key", "topic", "partition", "offset", "timestamp"]
    assert got.count() == records.count()
    assert got.where("offset = 1 AND n IS NULL AND s IS NULL").count() == 4
    assert got.where("offset <> 1 AND n = offset").count() == records.count() - 4


def test_value_schema_is_inferred_from_all_rows(spark, records):
    assert infer_value_schema(records).simpleString() == "struct<n:bigint,s:string>"
    values = [('{"a": 1, "mixed": 1, "gone": null}',), ('{"b": {"c": [1.5]}, "mixed": "x"}',), ("broken",)]
    found = infer_value_schema(spark.createDataFrame(values, "value string"))
    assert found.simpleString() == "struct<a:bigint,b:struct<c:array<double>>,gone:string,mixed:string>"
    assert decode_kafka(records, "json", infer_value_schema(records)).where("n IS NOT NULL").count() == records.count() - 4
    with pytest.raises(ValueError, match="not JSON objects"):
        infer_value_schema(spark.createDataFrame([("broken",)], "value string"))


def test_end_offsets_and_sorted_json(records):
    ends = end_offsets(records)
    assert rows(ends, "topic", "partition", "end_offset") == [("a", 0, 20), ("a", 1, 5), ("a", 10, 3), ("b", 0, 2)]
    assert offset_map_json(ends).first().offsets == '{"a":{"0":20,"1":5,"10":3},"b":{"0":2}}'


def test_offset_map_round_trip(spark):
    text = '{"t": {"0": 1500, "1": 2500}, "u": {"3": 7}}'
    assert render_offsets(parse_offsets(text)) == text
    exploded = offset_rows(spark.createDataFrame([(text,)], "j string"), "j")
    assert rows(exploded) == [("t", 0, 1500), ("t", 1, 2500), ("u", 3, 7)]


START, END = '{"a":{"0":5,"1":2}}', '{"a":{"0":8,"1":2,"10":2}}'


@pytest.mark.parametrize("limit", [offsets.BROADCAST_ENTRIES, 0])
def test_range_is_closed_below_and_open_above(records, monkeypatch, limit):
    monkeypatch.setattr(offsets, "BROADCAST_ENTRIES", limit)
    got = offset_range(records, START, END)
    assert got.columns == records.columns
    # partition 10 is new and read from its start; topic b is not in the snapshot
    assert rows(got, "topic", "partition", "offset") == [
        ("a", 0, 5), ("a", 0, 6), ("a", 0, 7), ("a", 10, 0), ("a", 10, 1),
    ]


def test_consecutive_ranges_cover_everything_once(records):
    cuts = [None, START, END, offset_map_json(end_offsets(records)).first().offsets]
    parts = [rows(offset_range(records, a, b), "topic", "partition", "offset") for a, b in zip(cuts, cuts[1:])]
    whole = rows(records, "topic", "partition", "offset")
    assert sorted(sum(parts, [])) == whole


def test_sentinels(records):
    total = records.count()
    assert offset_range(records, None, None).count() == total
    assert offset_range(records, "earliest", "latest").count() == total
    assert offset_range(records, "latest", None).count() == 0
    assert offset_range(records, '{"a":{"0":-1,"1":-2}}', '{"a":{"0":9,"1":-1}}').count() == 5
    with pytest.raises(ValueError):
        offset_range(records, None, "earliest")


def test_small_map_is_broadcast_and_rows_are_not_shuffled(records):
    plan = plan_text(offset_range(records, START, END))
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    assert "HashPartitioning" not in plan


def test_widest_limits_reach_the_scan_of_archived_records(spark, records):
    path = land(records, scratch_path(spark, "archive"))
    plan = plan_text(offset_range(read_landing(spark, path), '{"a":{"0":5,"1":2}}', '{"a":{"0":8,"1":3}}'))
    assert "GreaterThanOrEqual(offset,2)" in plan and "LessThan(offset,8)" in plan


def test_start_only_keeps_partitions_it_does_not_name(records):
    got = offset_range(records, '{"a":{"0":19,"1":-1}}', None)
    assert got.where("topic = 'a' AND partition = 0").count() == 1
    assert got.where("topic = 'a' AND partition = 1").count() == 0
    assert got.where("topic = 'b' OR partition = 10").count() == 5
    assert offset_range(records, None, "{}").count() == 0


def test_fields_may_be_called_like_types(spark):
    values = [('{"VOID":1,"VARIANT":1.5,"OBJECT":{"DECIMAL":null,"x y: VOID":[{"a":1.25}]},"m":1}',), ('{"m":"t"}',)]
    found = infer_value_schema(spark.createDataFrame(values, "value string"))
    kinds = {f.name: f.dataType.simpleString() for f in found}
    assert kinds["VOID"] == "bigint" and kinds["VARIANT"] == "double" and kinds["m"] == "string"
    assert "DECIMAL:string" in kinds["OBJECT"] and "a:double" in kinds["OBJECT"]


RECORD = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def test_payload_fields_beside_metadata_of_the_same_name(spark):
    df = spark.createDataFrame([("k", '{"timestamp":"t","n":1}', "top", 0, 7, None)], RECORD)
    schema = "timestamp string, n int"
    with pytest.raises(ValueError, match="timestamp"):
        decode_kafka(df, "json", schema)
    got = decode_kafka(df, "json", schema, metadata_prefix="kafka_").first()
    assert (got["timestamp"], got["n"], got["kafka_offset"], got["kafka_key"]) == ("t", 1, 7, "k")


def test_malformed_values_are_kept_when_asked_for(spark):
    df = spark.createDataFrame([("k", '{"n":1}', "t", 0, 1, None), ("k", "{oops", "t", 0, 2, None)], RECORD)
    got = decode_kafka(df, "json", "n int", malformed="bad").orderBy("offset").collect()
    assert [(r["n"], r["bad"]) for r in got] == [(1, None), (None, "{oops")]
