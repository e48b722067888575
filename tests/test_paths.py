from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.paths import (
    bucket_of,
    key_path,
    landing_path,
    landing_path_column,
    normalize_scheme,
    sanitize_run_id,
)

MOMENT = datetime(2023, 11, 2, 7, 5, 9)


def test_table_path():
    got = landing_path(
        "hdfs://lakehouse:8020", "billing-db", ["ledger", "main", "invoices"], MOMENT, "nightly 2024/01"
    )
    assert got == (
        "hdfs://lakehouse:8020/billing-db/ledger/main/invoices/"
        "ingestion_date=2023-11-02/ingestion_time=07-05-09/run_id=nightly_2024_01"
    )


def test_run_id_keeps_only_letters_and_digits():
    assert sanitize_run_id("by-hand:2023.11.02 07+05") == "by_hand_2023_11_02_07_05"


def test_scheme():
    assert normalize_scheme("s3://drop-zone/outgoing/") == "s3a://drop-zone/outgoing/"
    assert normalize_scheme("s3a://b/s3://x") == "s3a://b/s3://x"
    assert normalize_scheme("hdfs://n/s3://x") == "hdfs://n/s3://x"


def test_file_source_path_nests_without_scheme_and_bucket():
    assert key_path("s3://drop-zone/outgoing/daily/") == "outgoing/daily"
    assert key_path("/data/in/") == "data/in"
    assert key_path("s3://bucket-only") == ""
    got = landing_path("s3://lake", "sftp", [key_path("s3://raw/outgoing/")], MOMENT, "r")
    assert got.startswith("s3a://lake/sftp/outgoing/ingestion_date=2023-11-02/")


def test_bucket():
    assert bucket_of("s3://raw/in") == bucket_of("s3a://raw") == "raw"
    assert bucket_of("hdfs://n/x") is None and bucket_of("/x") is None


def test_column_form_agrees_with_string_form(spark):
    df = spark.createDataFrame([("sys", "t", MOMENT, "a:b")], "s string, t string, m timestamp_ntz, r string")
    column = landing_path_column("s3://lake/", F.col("s"), [F.lit("db"), F.col("t")], F.col("m"), F.col("r"))
    assert df.select(column).first()[0] == landing_path("s3://lake/", "sys", ["db", "t"], MOMENT, "a:b")
