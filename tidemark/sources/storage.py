"""Hadoop settings for S3 and S3-compatible stores."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tidemark.sources.connector import texts

_PREFIX = "fs.s3a."


def s3a_settings(
    credentials: Mapping[str, str], *, writing: bool = False, bucket: str | None = None
) -> dict[str, str]:
    """``fs.s3a.*`` settings from credentials; an own endpoint turns on path-style access.

    With ``bucket`` they hold for that bucket alone, so a source and a sink with different
    credentials or endpoints do not disturb each other.
    """
    endpoint = credentials.get("aws_endpoint")
    # Setting names and classes of the S3A connector.
    implementation = {"fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    settings = {
        "fs.s3a.access.key": credentials.get("aws_access_key_id", ""),
        "fs.s3a.secret.key": credentials.get("aws_secret_access_key", ""),
        "fs.s3a.endpoint.region": credentials.get("aws_region", "us-east-1"),
        "fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
        "fs.s3a.endpoint": endpoint,
        "fs.s3a.path.style.access": "true" if endpoint else None,
        "fs.s3a.fast.upload": "true" if writing else None,
        "fs.s3a.fast.upload.buffer": "bytebuffer" if writing else None,
    }
    if bucket:
        own = f"{_PREFIX}bucket.{bucket}."
        settings = {key.replace(_PREFIX, own, 1): value for key, value in settings.items()}
    return implementation | texts(settings)


def configure_s3a(
    spark: SparkSession,
    credentials: Mapping[str, str],
    *,
    writing: bool = False,
    bucket: str | None = None,
) -> None:
    """Set them on the running session, where later reads and writes pick them up."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in s3a_settings(credentials, writing=writing, bucket=bucket).items():
        hadoop.set(key, value)


@contextmanager
def s3a_access(
    spark: SparkSession,
    credentials: Mapping[str, str],
    *,
    writing: bool = False,
    bucket: str | None = None,
) -> Iterator[None]:
    """:func:`configure_s3a` for the length of a block; what was set before is put back after it."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = {key: hadoop.get(key) for key in s3a_settings(credentials, writing=writing, bucket=bucket)}
    configure_s3a(spark, credentials, writing=writing, bucket=bucket)
    try:
        yield
    finally:
        for key, value in before.items():
            hadoop.unset(key) if value is None else hadoop.set(key, value)
