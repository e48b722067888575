"""Connector presets for document and wide-column stores.

Filters and windows are plain DataFrame predicates on top: each connector pushes what
its store can evaluate.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import types as T

from tidemark.sources.connector import DEFAULT_FETCH_SIZE, Read, texts

_PIPELINE = "spark.mongodb.read.aggregation.pipeline"  # fixed value: the connector's option name


def mongodb_read(
    host: str,
    port: int,
    database: str,
    collection: str,
    credentials: Mapping[str, str],
    *,
    pipeline: str | None = None,
    schema: T.StructType | str | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """A MongoDB collection, or the aggregation ``pipeline`` over it, verbatim."""
    user, password = (quote(str(credentials.get(k)), safe="") for k in ("username", "password"))
    # URI form and option names of the connector.
    options = texts(
        {
            "spark.mongodb.read.connection.uri": (
                f"mongodb://{user}:{password}@{host}:{port}/{database}?authSource=admin"
            ),
            "spark.mongodb.read.database": database,
            "spark.mongodb.read.collection": collection,
            _PIPELINE: pipeline,
        }
    )
    return Read("mongodb", options, schema).with_options(read_options)


def mongodb_above(read: Read, column: str, low: int | str) -> Read:
    """Add the one-sided window as a ``$match`` stage, unless a pipeline is already set."""
    stage = json.dumps([{"$match": {column: {"$gt": low}}}])
    return read if _PIPELINE in read.options else read.with_options({_PIPELINE: stage})


def mongodb_max(read: Read, column: str) -> Read:
    """The same collection reduced to its high-water mark inside the store."""
    stage = json.dumps([{"$group": {"_id": None, "checkpoint_to": {"$max": f"${column}"}}}])
    return Read(read.format, read.options).with_options({_PIPELINE: stage})


def dynamodb_read(
    table: str,
    credentials: Mapping[str, str],
    *,
    throughput: int = DEFAULT_FETCH_SIZE,
    schema: T.StructType | str | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """A DynamoDB table."""
    # Option names of the connector.
    options = texts(
        {
            "tableName": table,
            "region": credentials.get("aws_region"),
            "accessKey": credentials.get("aws_access_key_id"),
            "secretKey": credentials.get("aws_secret_access_key"),
            "readThroughput": throughput,
        }
    )
    return Read("dynamodb", options, schema).with_options(read_options)


def cassandra_read(
    host: str,
    port: int,
    keyspace: str,
    table: str,
    credentials: Mapping[str, str],
    *,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    schema: T.StructType | str | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """A Cassandra table."""
    # Format and option names of the connector.
    options = texts(
        {
            "keyspace": keyspace,
            "table": table,
            "spark.cassandra.connection.host": host,
            "spark.cassandra.connection.port": port,
            "spark.cassandra.auth.username": credentials.get("username"),
            "spark.cassandra.auth.password": credentials.get("password"),
            "spark.cassandra.input.fetch.size_in_rows": fetch_size,
        }
    )
    return Read("org.apache.spark.sql.cassandra", options, schema).with_options(read_options)
