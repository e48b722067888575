from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.landing import land, read_landing
from tidemark.session import delete_folder, folder_entries, runtime_conf, scratch_path
from tidemark.sources.kafka import kafka_stream
from tidemark.streaming.landing import land_stream, stream_files, stream_topic

DDL = "id bigint, v string"


def batch(spark, low, high):
    return spark.range(low, high).select("id", F.lit("v").alias("v"))


def test_each_call_lands_only_what_is_new(spark):
    root = scratch_path(spark, "stream")
    drop, out, progress = f"{root}/drop", f"{root}/out", f"{root}/progress"

    def call():
        stream = stream_files(spark, drop, DDL, options={"maxFilesPerTrigger": "1"})
        land_stream(stream, out, progress)
        return rows(read_landing(spark, out), "id")

    land(batch(spark, 0, 10).repartition(3), drop)
    assert call() == [(i,) for i in range(10)]
    assert len(call()) == 10
    land(batch(spark, 10, 15), drop)
    assert call() == [(i,) for i in range(15)]


def test_transforms_and_partitions(spark):
    root = scratch_path(spark, "stream")
    land(batch(spark, 0, 10), f"{root}/drop")
    land_stream(
        stream_files(spark, f"{root}/drop", DDL),
        f"{root}/out",
        f"{root}/progress",
        partition_by=["g"],
        transforms=[lambda df: df.where("id > 3"), lambda df: df.withColumn("g", F.col("id") % 2)],
    )
    got = read_landing(spark, f"{root}/out")
    assert got.count() == 6 and rows(got.groupBy("g").count()) == [(0, 3), (1, 3)]


def test_partitioned_batches_write_as_few_files_as_a_batch_landing(spark):
    root = scratch_path(spark, "stream")
    source = batch(spark, 0, 4000).withColumn("g", F.col("id") % 5)
    land(source.repartition(24), f"{root}/drop")
    with runtime_conf(spark, {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}):
        land_stream(stream_files(spark, f"{root}/drop", f"{DDL}, g bigint"), f"{root}/out", f"{root}/progress", partition_by=["g"])
        land(spark.read.parquet(f"{root}/drop"), f"{root}/batch", partition_by=["g"])
    count = lambda path: len(spark.read.parquet(path).inputFiles())
    assert spark.read.parquet(f"{root}/out").count() == 4000
    assert count(f"{root}/out") <= 2 * count(f"{root}/batch") < 24 * 5
    # A batch that is given again (its commit was lost) changes nothing.
    commits = f"{root}/progress/commits"
    last = max((n for n, _ in folder_entries(spark, commits) if n.isdigit()), key=int)
    delete_folder(spark, f"{commits}/{last}")
    land_stream(stream_files(spark, f"{root}/drop", f"{DDL}, g bigint"), f"{root}/out", f"{root}/progress", partition_by=["g"])
    assert rows(spark.read.parquet(f"{root}/out").groupBy("g").count()) == [(g, 800) for g in range(5)]


def test_topic_stream_reaches_spark_and_stops_at_the_missing_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_topic(spark, kafka_stream("b:9092", "t"))
