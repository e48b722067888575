from __future__ import annotations

import json

import pytest

from tidemark.plans.spec import KafkaSource, PathSource, PipelineSpec, SpecError, TableSource

SINK = {"endpoint": "hdfs://nn:9000", "source_system_name": "sys"}


def build(read_type, source, sink=SINK, write_type="hadoop", **more):
    config = {"read_type": read_type, "write_type": write_type, "source": source, "sink": sink} | more
    return PipelineSpec.from_dict("p", config)


@pytest.mark.parametrize("kind", ["sql", "mysql", "nosql", "cassandra"])
def test_table_types(kind):
    spec = build(kind, {"database": "d", "table": "t"})
    assert isinstance(spec.source, TableSource) and spec.source.segments() == ["d", "default", "t"]
    with pytest.raises(SpecError, match="table"):
        build(kind, {"database": "d"})
    with pytest.raises(SpecError, match="database"):
        build(kind, {"table": "t"})


def test_dynamodb_needs_no_database():
    assert build("dynamodb", {"table": "t"}).source.table == "t"


def test_connector_needs_a_format():
    with pytest.raises(SpecError, match="format"):
        build("connector", {"database": "d", "table": "t"})


@pytest.mark.parametrize("kind", ["file", "s3"])
def test_path_types(kind):
    spec = build(kind, {"path": "s3://b/in/x", "file_format": "csv"})
    assert isinstance(spec.source, PathSource) and spec.source.mode == "copy"
    assert spec.source.segments() == ["in/x"]
    with pytest.raises(SpecError, match="path"):
        build(kind, {})
    with pytest.raises(ValueError, match="file format"):
        build(kind, {"path": "/x", "file_format": "xml"})
    with pytest.raises(SpecError, match="mode"):
        build(kind, {"path": "/x", "mode": "move"})


def test_kafka():
    spec = build("kafka", {"topic": "orders-events", "group_id": "g", "starting_offsets": "latest"})
    assert isinstance(spec.source, KafkaSource) and spec.source.segments() == ["orders-events"]
    with pytest.raises(SpecError, match="topic"):
        build("kafka", {})
    with pytest.raises(SpecError, match="value_format"):
        build("kafka", {"topic": "t", "value_format": "xml"})


@pytest.mark.parametrize(("field", "value"), [("read_type", "ftp"), ("write_type", "gcs")])
def test_unknown_types(field, value):
    config = {"read_type": "sql", "write_type": "s3", "source": {"database": "d", "table": "t"}, "sink": SINK}
    with pytest.raises(SpecError, match=f"unknown {field}"):
        PipelineSpec.from_dict("p", config | {field: value})


def test_sink_checks():
    source = {"database": "d", "table": "t"}
    with pytest.raises(SpecError, match="endpoint"):
        build("sql", source, {"source_system_name": "s"})
    with pytest.raises(SpecError, match="source_system_name"):
        build("sql", source, {"endpoint": "e"})
    with pytest.raises(SpecError, match="keys"):
        build("sql", source, SINK | {"mode": "upsert"})
    with pytest.raises(SpecError, match="sink mode"):
        build("sql", source, SINK | {"mode": "replace"})
    assert build("sql", source, SINK | {"mode": "merge", "keys": ["id"]}).sink.keys == ("id",)


def test_secrets_complete_source_and_sink(tmp_path):
    config = {
        "read_type": "sql",
        "write_type": "hadoop",
        "metric_type": "kafka_queue",
        "count_records": True,
        "source": {"credential_ref": "pg", "database": "d", "table": "t", "unknown": 1,
                   "read_options": {"numPartitions": 8}},
        "sink": {"credential_ref": "hdfs", "source_system_name": "s"},
        "spark": {"spark.sql.shuffle.partitions": 4},
    }
    secrets = {
        "pg": {"host": "h", "port": "5432", "username": "u", "password": "p"},
        "hdfs": {"endpoint": "hdfs://nn"},
    }
    file = tmp_path / "orders.json"
    file.write_text(json.dumps(config))
    spec = PipelineSpec.from_file(str(file), secrets)
    assert spec.dag_id == "orders" and spec.count_records
    assert (spec.source.host, spec.source.port, spec.sink.endpoint) == ("h", 5432, "hdfs://nn")
    assert spec.source_credentials["username"] == "u" and "password" not in repr(spec)
    assert spec.spark == {"spark.sql.shuffle.partitions": "4"}
    kafka = config | {"read_type": "kafka", "source": {"credential_ref": "k", "topic": "t"}}
    assert PipelineSpec.from_dict("p", kafka, secrets | {"k": {"bootstrap_servers": "b:1"}}).source.bootstrap_servers == "b:1"
