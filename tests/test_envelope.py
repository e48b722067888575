from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.envelope import event_envelope, flatten_event, queue_message

def fixed_time():
    return F.lit("2024-01-01T00:00:00.000000+00:00")


@pytest.fixture(scope="module")
def payload(spark):
    return spark.createDataFrame(
        [("ok", 5, {"a": 1}, [1, 2], None, True, datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"))],
        "status string, count int, nested struct<a:int>, lst array<int>, gone string, flag boolean, "
        "at timestamp, price decimal(5,2)",
    )


def test_kafka_envelope(payload):
    got = event_envelope(payload, payload.columns, {"env": "prod", "status": "override"}, fixed_time(), F.lit("k")).first()
    assert bytes(got.key) == b"k"
    assert json.loads(bytes(got.value)) == {
        "status": "override", "count": 5, "nested": {"a": 1}, "lst": [1, 2], "gone": None, "flag": True,
        "at": "2024-01-02 03:04:05", "price": "1.50", "env": "prod",
        "published_at": "2024-01-01T00:00:00.000000+00:00",
    }


def test_no_key_unless_asked(payload):
    assert "key" not in event_envelope(payload, ["count"]).columns


def test_publish_time_defaults_to_now_in_utc(payload, spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        body = json.loads(bytes(event_envelope(payload, ["count"]).first().value))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    published = datetime.fromisoformat(body["published_at"])
    assert abs(datetime.now(timezone.utc) - published) < timedelta(minutes=5)


def test_flat_values_are_all_text(payload):
    fields = flatten_event(payload, payload.columns, {"env": "prod"}, fixed_time()).first().fields
    assert json.loads(fields.pop("nested")) == {"a": 1} and json.loads(fields.pop("lst")) == [1, 2]
    assert fields == {
        "status": "ok", "count": "5", "gone": "None", "flag": "True", "at": "2024-01-02 03:04:05",
        "price": "1.50", "env": "prod", "published_at": "2024-01-01T00:00:00.000000+00:00",
    }


def test_queue_message(payload):
    got = queue_message(payload, ["status", "count"], "https://q", {"env": "prod", "n": 1}, fixed_time()).first().message
    assert got.QueueUrl == "https://q"
    assert json.loads(got.MessageBody) == {"status": "ok", "count": 5}
    assert {k: (v.DataType, v.StringValue) for k, v in got.MessageAttributes.items()} == {
        "env": ("String", "prod"), "n": ("String", "1"),
        "published_at": ("String", "2024-01-01T00:00:00.000000+00:00"),
    }
