"""Byte-exact copy of a file tree as a Spark job."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator, Mapping
from datetime import datetime

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.window import incremental_window
from tidemark.session import qualified, scratch_path
from tidemark.functions.paths import normalize_scheme
from tidemark.sources.files import file_inventory
from tidemark.sources.stores import is_posix, open_store, posix_path, store_settings

# The task function travels whole, so executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 256 << 20
TASK_BYTES = 1 << 30
_BUFFER = 8 << 20
Settings = tuple[Mapping[str, str], Mapping[str, str]]

MANIFEST = "src string, dst string, offset bigint, bytes bigint"


def _pump(read, write, count: int) -> int:
    left = count
    while left:
        block = read(min(left, _BUFFER))
        if not block:
            raise OSError(f"source ended {left} bytes early")
        write(block)
        left -= len(block)
    return count


def _copy_chunk(
    src: str, dst: str, offset: int, count: int, size: int, settings: Settings = ({}, {})
) -> int:
    """Copy one byte range in constant memory; repeating it gives the same file."""
    source_fs, source_path = open_store(src, settings[0])
    with source_fs.open_input_file(source_path) as source:
        if source.size() != size:
            raise OSError(f"{src} changed while it was copied")
        source.seek(offset)
        if is_posix(dst):
            path = posix_path(dst)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            handle = os.open(path, os.O_CREAT | os.O_WRONLY, 0o644)
            with os.fdopen(handle, "wb") as sink:
                sink.truncate(size)
                sink.seek(offset)
                return _pump(source.read, sink.write, count)
        target_fs, target_path = open_store(dst, settings[1])
        folder, _, name = target_path.rpartition("/")
        if target_fs.type_name == "s3":
            # An object appears only when its stream closes; there is nothing to rename.
            with target_fs.open_output_stream(target_path) as sink:
                return _pump(source.read, sink.write, count)
        target_fs.create_dir(folder, recursive=True)
        partial = f"{folder}/.{name}.{uuid.uuid4().hex}.partial"
        with target_fs.open_output_stream(partial) as sink:
            _pump(source.read, sink.write, count)
        if target_fs.get_file_info(target_path).is_file:
            target_fs.delete_file(target_path)
        target_fs.move(partial, target_path)
        return count


def _copier(settings: Settings):
    def copied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [
                _copy_chunk(r.src, r.dst, r.offset, r.bytes, r.size, settings)
                for r in batch.itertuples(index=False)
            ]
            yield batch[["src", "dst", "offset"]].assign(bytes=done)

    return copied


def _below(root: str) -> Column:
    """Path below ``root``; the bare file name when ``root`` itself is a file."""
    base = root.rstrip("/")
    below = F.substring("path", F.lit(len(base) + 2), F.length("path"))
    return F.when(F.col("path") == base, F.element_at(F.split("path", "/"), -1)).otherwise(below)


def copy_files(
    spark: SparkSession,
    source: str,
    destination: str,
    *,
    modified_after: datetime | str | None = None,
    modified_until: datetime | str | None = None,
    files: DataFrame | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Copy every file below ``source`` and return the manifest ``src, dst, bytes``.

    Where the destination can be written at an offset, large files are split into
    chunks copied by different tasks; elsewhere one task streams one file. The source is
    kept, existing files are overwritten, and the bytes are not parsed. Empty files and
    names starting with ``_`` or ``.`` are copied too; ``_SUCCESS`` is written in any case.
    ``files`` is a listing of the source made before, or a part of one; without it the source is listed here.
    Keys, region and endpoint of an S3 store come from the session's Hadoop configuration.
    """
    target = qualified(spark, destination.rstrip("/"))
    root = qualified(spark, normalize_scheme(source))
    settings = (store_settings(spark, root), store_settings(spark, target))
    listed = file_inventory(spark, source, recursive=True) if files is None else files
    files = incremental_window(listed, "modificationTime", modified_after, modified_until)
    size = F.col("length")
    step = F.lit(chunk_bytes).cast("bigint") if is_posix(target) else size
    chunks = files.select(
        F.col("path").alias("src"),
        F.concat(F.lit(f"{target}/"), _below(root)).alias("dst"),
        size.alias("size"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(size - 1, F.lit(0)), F.greatest(step, F.lit(1)))).alias("offset"),
        step.alias("step"),
    ).select("src", "dst", "size", "offset", F.least("step", F.col("size") - F.col("offset")).alias("bytes"))
    total = chunks.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    wanted = max(spark.sparkContext.defaultParallelism, (total.bytes or 0) // TASK_BYTES)
    spread = chunks.repartition(max(1, min(total.n, wanted)))
    log = scratch_path(spark, "copy-manifest")
    spread.mapInPandas(_copier(settings), MANIFEST).write.parquet(log)
    marker_fs, marker_path = open_store(target, settings[1])
    marker_fs.create_dir(marker_path, recursive=True)
    marker_fs.open_output_stream(f"{marker_path}/_SUCCESS").close()
    return spark.read.schema(MANIFEST).parquet(log).groupBy("src", "dst").agg(F.sum("bytes").alias("bytes"))
