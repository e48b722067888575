"""Bounded and streaming reads of Kafka topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.kafka import OffsetMap, parse_offsets, render_offsets
from tidemark.operators.offsets import EARLIEST, EARLIEST_OFFSET, LATEST
from tidemark.sources.connector import Read, texts


def _connection(
    bootstrap_servers: str, topics: str, group_id: str | None, credentials: Mapping[str, str] | None
) -> dict[str, str]:
    who = credentials or {}
    # Option names of Spark's Kafka source.
    options = {
        "subscribe": topics,
        "failOnDataLoss": "false",
        "kafka.group.id": group_id or None,
    }
    return _client(bootstrap_servers, who) | texts(options)


def _client(bootstrap_servers: str, who: Mapping[str, str]) -> dict[str, str]:
    # Settings of the Kafka client.
    options = {"kafka.bootstrap.servers": bootstrap_servers}
    user, password = who.get("sasl_username"), who.get("sasl_password")
    if user and password:
        user, password = (text.replace("\\", "\\\\").replace('"', '\\"') for text in (user, password))
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_PLAINTEXT",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{user}" password="{password}";',
        }
    return options


def kafka_write_options(
    bootstrap_servers: str, topic: str, credentials: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Options for sending ``key`` and ``value`` columns to a topic."""
    return _client(bootstrap_servers, credentials or {}) | {"topic": topic}


def send(df: DataFrame, options: Mapping[str, str]) -> None:
    """Send enveloped events; every task sends its own rows."""
    wanted = [name for name in ("key", "value") if name in df.columns]
    df.select(*wanted).write.format("kafka").options(**options).save()


def kafka_read(
    bootstrap_servers: str,
    topics: str,
    *,
    start: str | None = None,
    end: str | None = None,
    group_id: str | None = None,
    credentials: Mapping[str, str] | None = None,
    min_partitions: int | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """A batch between two offset snapshots.

    ``min_partitions`` cuts large offset ranges, so one busy topic-partition is read by
    many tasks.
    """
    options = _connection(bootstrap_servers, topics, group_id, credentials)
    options |= texts(
        {
            "startingOffsets": start or EARLIEST,
            "endingOffsets": end or LATEST,
            "minPartitions": min_partitions,
        }
    )
    return Read("kafka", options).with_options(read_options)


def broker_end_offsets(
    spark: SparkSession,
    bootstrap_servers: str,
    topics: str,
    credentials: Mapping[str, str] | None = None,
    read_options: Mapping[str, object] | None = None,
) -> OffsetMap:
    """End offset of every partition of the topics, asked of the brokers once from the driver.

    Uses the client that comes with the Kafka connector package; no record is read.
    """
    jvm = spark.sparkContext._jvm
    # Class names of the Kafka client.
    reader = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
    settings = _client(bootstrap_servers, credentials or {}) | texts(dict(read_options or {}))
    properties = jvm.java.util.Properties()
    for key, value in settings.items():
        if key.startswith("kafka."):
            properties.setProperty(key.removeprefix("kafka."), value)
    properties.setProperty("key.deserializer", reader)
    properties.setProperty("value.deserializer", reader)
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(properties)
    try:
        ends: OffsetMap = {}
        for topic in topics.split(","):
            places = jvm.java.util.ArrayList()
            for info in consumer.partitionsFor(topic.strip()):
                places.add(jvm.org.apache.kafka.common.TopicPartition(info.topic(), info.partition()))
            found = consumer.endOffsets(places)
            ends[topic.strip()] = {int(p.partition()): int(found.get(p)) for p in places}
        return ends
    finally:
        consumer.close()


def kafka_stream(
    bootstrap_servers: str,
    topics: str,
    *,
    start: str | None = None,
    group_id: str | None = None,
    credentials: Mapping[str, str] | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """The same topics as a stream; its progress lives in the query's checkpoint."""
    options = _connection(bootstrap_servers, topics, group_id, credentials)
    options["startingOffsets"] = start or EARLIEST
    return Read("kafka", options).with_options(read_options)


def complete_start(start: str, end: str) -> str:
    """Give partitions added since the last run a start, as the Kafka source demands one for each."""
    known, goal = parse_offsets(start), parse_offsets(end)
    filled: OffsetMap = {
        topic: {p: known.get(topic, {}).get(p, EARLIEST_OFFSET) for p in parts}
        for topic, parts in goal.items()
    }
    return render_offsets(filled)
