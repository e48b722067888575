"""Landing: write a frame below a path, and read a landing tree back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkAssertionError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats and modes a landing accepts.
FILE_FORMATS = ("parquet", "csv", "json", "avro", "orc", "delta", "text")
LAND_MODES = ("append", "overwrite")


def check_format(file_format: str) -> str:
    """The format in lower case, or an error naming the known ones."""
    name = file_format.lower()
    if name not in FILE_FORMATS:
        raise ValueError(f"unknown file format {file_format!r}; one of {', '.join(FILE_FORMATS)}")
    return name


def land(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    *,
    rebalance: bool | None = None,
    observation: Observation | None = None,
) -> str:
    """Write the frame to ``path`` and return the path.

    With ``partition_by`` the rows are first rebalanced on those columns: adaptive
    execution merges small directories into few files and splits a hot one over many
    tasks. Without it no shuffle is added, unless ``rebalance=True`` asks for even files,
    as is right for few rows left over from many tasks. An ``observation`` receives ``record_count``
    from the write itself; it sits in the writing stage, whose retried tasks Spark counts
    once.
    """
    fmt = check_format(file_format)
    if mode not in LAND_MODES:
        raise ValueError(f"unknown mode {mode!r}; use 'append' or 'overwrite', or the upsert operator")
    if fmt == "text" and [f.dataType for f in df.schema] != [T.StringType()]:
        raise ValueError("the text format needs exactly one string column")
    even = bool(partition_by) if rebalance is None else rebalance
    rows = balanced(df, partition_by) if even else df
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("record_count"))
    out = rows.write.format(fmt).mode(mode).options(**dict(options or {}))
    if partition_by:
        # An overwrite replaces the whole path, whatever the session's default says.
        out = out.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    out.save(path)
    return path


def counted(observation: Observation) -> int | None:
    """Rows an observed landing wrote; null when nothing was written with it.

    A window folded to an empty relation leaves nothing to observe, which counts as zero.
    """
    try:
        return observation.get.get("record_count") or 0
    except PySparkAssertionError:
        return None


def balanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Even out the rows, by ``columns`` if any, splitting hot values."""
    return df.hint("rebalance", *columns)


def read_landing(
    spark: SparkSession,
    base: str,
    file_format: str = "parquet",
    schema: T.StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a landing tree; ingestion date, time and run id come back from the directories.

    A run id stays text even when all of them look like numbers, which Spark would infer.
    """
    reader = spark.read.format(check_format(file_format)).options(**dict(options or {}))
    if schema is not None:
        return reader.schema(schema).load(base)
    found = reader.load(base)
    guessed = [f.name for f in found.schema if f.name == "run_id" and f.dataType != T.StringType()]
    if not guessed:
        return found
    fields = [
        T.StructField(f.name, T.StringType() if f.name in guessed else f.dataType, f.nullable, f.metadata)
        for f in found.schema
    ]
    return reader.schema(T.StructType(fields)).load(base)
