"""File trees: scans, listings and modification times."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import normalize_scheme
from tidemark.operators.landing import check_format
from tidemark.session import qualified, scratch_path
from tidemark.sources.stores import LISTING, tree_lister, store_settings


def read_files(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Lazy scan of a path in any of the seven formats, ``s3://`` read as ``s3a://``."""
    reader = spark.read.format(check_format(file_format)).options(**dict(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(normalize_scheme(path))


def infer_schema(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> T.StructType:
    """Schema found in the files themselves."""
    return read_files(spark, path, file_format, options=options).schema


def file_inventory(spark: SparkSession, path: str, *, recursive: bool = False) -> DataFrame:
    """Rows ``path, modificationTime, length`` of every file under a path, contents unread.

    Spark's own listings leave out empty files and names starting with ``_`` or ``.``; here
    tasks walk the tree and nothing is left out. One task takes a small tree at once; folders it does not reach are
    dealt to all tasks, which go on likewise. The listing is kept in the scratch folder; only whether folders are left
    reaches the driver.
    """
    root = qualified(spark, normalize_scheme(path))
    lister = tree_lister(store_settings(spark, root), recursive)
    folders = spark.createDataFrame([(root,)], "path string")
    rounds: list[str] = []
    while True:
        rounds.append(scratch_path(spark, "listing"))
        tasks = spark.sparkContext.defaultParallelism if len(rounds) > 1 else 1
        folders.repartition(tasks).mapInPandas(lister, LISTING).write.parquet(rounds[-1])
        folders = spark.read.schema(LISTING).parquet(rounds[-1]).where("folder").select("path")
        if not recursive or folders.isEmpty():
            break
    found = spark.read.schema(LISTING).parquet(*rounds)
    return found.where("NOT folder").select("path", "modificationTime", "length")


def _without_checksums(files: DataFrame) -> DataFrame:
    """Hadoop's local file system keeps a checksum beside each file and shows none of them."""
    return files.where(~F.col("path").rlike(r"/\.[^/]+\.crc$"))


def file_count(spark: SparkSession, path: str) -> DataFrame:
    """One row ``cnt``: files directly under the path, checksum files of Hadoop aside."""
    return _without_checksums(file_inventory(spark, path)).agg(F.count(F.lit(1)).alias("cnt"))


def latest_modification(spark: SparkSession, path: str) -> DataFrame:
    """One row ``checkpoint_to``: the newest modification time in the tree."""
    return _without_checksums(file_inventory(spark, path, recursive=True)).agg(
        F.max("modificationTime").alias("checkpoint_to")
    )
