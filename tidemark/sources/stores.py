"""Access to a file store from inside a task: which client, with which settings, and what a folder holds."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import SparkSession

# Task functions travel whole, so executors need not have this package installed.
register_pickle_by_value(sys.modules[__name__])

_URI = re.compile(r"(?:([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?)?(.*)", re.S)
LISTING = "path string, modificationTime timestamp, length bigint, folder boolean"

# The S3A settings a client needs, by the name of Arrow's argument.
_S3_KEYS = {
    "access_key": "access.key",
    "secret_key": "secret.key",
    "session_token": "session.token",
    "region": "endpoint.region",
    "endpoint_override": "endpoint",
}


def split_uri(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and path as they are written: blanks and percent signs belong to the name."""
    scheme, authority, path = _URI.fullmatch(uri).groups(default="")
    return scheme.lower(), authority, path


def is_posix(uri: str) -> bool:
    return split_uri(uri)[0] in ("", "file")


def posix_path(uri: str) -> str:
    return "/" + split_uri(uri)[2].lstrip("/")


def store_settings(spark: SparkSession, uri: str) -> dict[str, str]:
    """Client settings for a store: what the session's Hadoop configuration says of its bucket."""
    scheme, bucket, _ = split_uri(uri)
    if scheme not in ("s3", "s3a"):
        return {}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for name, key in _S3_KEYS.items():
        value = hadoop.get(f"fs.s3a.bucket.{bucket}.{key}") or hadoop.get(f"fs.s3a.{key}")
        if value:
            found[name] = value
    return found


def open_store(uri: str, settings: Mapping[str, str]):
    """Arrow file system and path of a URI, which is taken apart without decoding."""
    from pyarrow import fs

    scheme, authority, path = split_uri(uri)
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), posix_path(uri)
    if scheme in ("s3", "s3a"):
        known = dict(settings)
        endpoint = known.get("endpoint_override", "")
        if "://" in endpoint:
            known["scheme"], _, known["endpoint_override"] = endpoint.partition("://")
        return fs.S3FileSystem(**known), f"{authority}{path}"
    if scheme == "hdfs":
        host, _, port = authority.partition(":")
        return fs.HadoopFileSystem(host or "default", int(port or 0)), path
    return fs.FileSystem.from_uri(f"{scheme}://{authority}")[0], f"{authority}{path}"


def tree_lister(
    settings: Mapping[str, str], recursive: bool, folders: int = 256
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task function: folders (or single files) in, all files below them out.

    A task walks down to as many ``folders`` as given; those it has not entered come out as rows with ``folder`` set, for
    other tasks to go on with. Without ``recursive`` no folder below is entered, and none comes out. Empty
    files, names that start with ``_`` or ``.`` and such folders are listed like any other.
    """
    known = dict(settings)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        entered = 0
        for batch in batches:
            waiting = list(batch["path"])
            while waiting:
                uri = waiting.pop()
                store, path = open_store(uri, known)
                here = store.get_file_info(path)
                if here.type == fs.FileType.NotFound:
                    raise FileNotFoundError(uri)
                if here.type == fs.FileType.Directory:
                    entries = store.get_file_info(fs.FileSelector(path.rstrip("/") or "/"))
                    names = [uri.rstrip("/") + "/" + entry.base_name for entry in entries]
                else:
                    entries, names = [here], [uri]
                entered += 1
                below = {n for e, n in zip(entries, names) if e.type == fs.FileType.Directory}
                if recursive and entered < folders:
                    waiting += below
                    below = set()
                rows = [(e, n) for e, n in zip(entries, names) if e.type != fs.FileType.Directory or (recursive and n in below)]
                if entered >= folders and waiting:
                    yield pd.DataFrame(
                        {
                            "path": waiting,
                            "modificationTime": pd.to_datetime([0] * len(waiting), unit="us", utc=True),
                            "length": 0,
                            "folder": True,
                        }
                    )
                    waiting = []
                if not rows:
                    continue
                yield pd.DataFrame(
                    {
                        "path": [n for _, n in rows],
                        "modificationTime": pd.to_datetime([e.mtime_ns // 1000 for e, _ in rows], unit="us", utc=True),
                        "length": [e.size or 0 for e, _ in rows],
                        "folder": [e.type == fs.FileType.Directory for e, _ in rows],
                    }
                )

    return listed
