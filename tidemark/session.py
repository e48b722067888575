"""Session helpers: shared scratch folders and scoped runtime settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    ``spark.checkpoint.dir`` wins, then a directory set with
    ``setCheckpointDir``. Only a local-mode session falls back to a temporary
    folder; on a cluster a machine-local folder would lose data, so it is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; it is not created and never reused."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and the file system behind it, as the session is configured."""
    parsed = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return parsed, parsed.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system behind ``path`` has it: one metadata call from the driver."""
    parsed, file_system = _hadoop_path(spark, path)
    return file_system.exists(parsed)


def folder_entries(spark: SparkSession, path: str) -> list[tuple[str, datetime]]:
    """Name and modification time of everything directly in a folder; an absent one is empty."""
    parsed, file_system = _hadoop_path(spark, path)
    if not file_system.exists(parsed):
        return []
    found = file_system.listStatus(parsed)
    return [(e.getPath().getName(), datetime.fromtimestamp(e.getModificationTime() / 1000, tz=timezone.utc)) for e in found]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, from the file system's own summary."""
    parsed, file_system = _hadoop_path(spark, path)
    return file_system.getContentSummary(parsed).getLength() if file_system.exists(parsed) else 0


def delete_folder(spark: SparkSession, path: str) -> None:
    parsed, file_system = _hadoop_path(spark, path)
    file_system.delete(parsed, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system, making the folder above the new name."""
    parsed, file_system = _hadoop_path(spark, source)
    new, _ = _hadoop_path(spark, target)
    file_system.mkdirs(new.getParent())
    if not file_system.rename(parsed, new):
        raise OSError(f"could not move {source} to {target}")


def broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which the session broadcasts a side of a join by itself; -1 for never."""
    jvm_conf = spark._jsparkSession.sessionState().conf()
    return int(jvm_conf.autoBroadcastJoinThreshold())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme Spark would read it by; bare paths get the default file system."""
    if "://" in path:
        return path
    parsed, file_system = _hadoop_path(spark, path)
    return file_system.makeQualified(parsed).toString()


@contextmanager
def runtime_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply runtime SQL settings for one run and put the old values back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
