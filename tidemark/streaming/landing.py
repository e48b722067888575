"""Landing as a bounded stream: each call takes what is new and stops."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.kafka import decode_kafka
from tidemark.functions.paths import normalize_scheme
from tidemark.operators.landing import balanced, check_format
from tidemark.sources.connector import Read


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files under a path as a stream; ``maxFilesPerTrigger`` in ``options`` bounds one batch."""
    reader = spark.readStream.format(check_format(file_format)).schema(schema)
    return reader.options(**dict(options or {})).load(normalize_scheme(path))


def stream_topic(
    spark: SparkSession, read: Read, value_format: str = "json", schema: T.StructType | str | None = None
) -> DataFrame:
    """Kafka topics as a stream, decoded like a batch."""
    return decode_kafka(
        spark.readStream.format(read.format).options(**read.options).load(), value_format, schema
    )


def land_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    transforms: Sequence[Callable[[DataFrame], DataFrame]] = (),
    options: Mapping[str, str] | None = None,
) -> str:
    """Land everything that arrived since the last call with the same ``checkpoint``, then stop.

    Progress and the file sink's log live in shared folders, so a restart repeats or loses
    nothing, whichever executor died. With ``partition_by`` every batch is rebalanced on those columns as in
    :func:`land`, so a batch writes a few files for each directory, not one for each task.
    """
    for transform in transforms:
        stream = stream.transform(transform)
    if partition_by:
        stream = balanced(stream, partition_by)
    writer = (
        stream.writeStream.format(check_format(file_format))
        .options(**dict(options or {}))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(path).awaitTermination()
    return path
