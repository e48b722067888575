"""Landing paths, run ids and storage schemes, as strings and as columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCHEMA = "default"
_UNSAFE = "[^a-zA-Z0-9]"


def sanitize_run_id(run_id: str | Column) -> str | Column:
    """Replace everything but ASCII letters and digits by an underscore."""
    if isinstance(run_id, Column):
        return F.regexp_replace(run_id, _UNSAFE, "_")
    return re.sub(_UNSAFE, "_", run_id)


def normalize_scheme(path: str | Column) -> str | Column:
    """``s3://`` at the start becomes ``s3a://``; anything else is untouched."""
    if isinstance(path, Column):
        return F.regexp_replace(path, "^s3://", "s3a://")
    return re.sub("^s3://", "s3a://", path)


def key_path(uri: str) -> str:
    """Path of a storage URI without scheme and authority, so it can nest in a landing path."""
    scheme, found, rest = uri.partition("://")
    if not found:
        return uri.strip("/")
    return rest.partition("/")[2].strip("/")


def bucket_of(uri: str) -> str | None:
    """Bucket of an S3 URI; null for any other path."""
    scheme, _, rest = normalize_scheme(uri).partition("://")
    return rest.partition("/")[0] if scheme == "s3a" else None


def landing_path(
    endpoint: str, system: str, segments: Sequence[str], moment: datetime, run_id: str
) -> str:
    """``endpoint/system/segments…/ingestion_date=…/ingestion_time=…/run_id=…``."""
    parts = [system, *segments]
    tail = [
        f"ingestion_date={moment:%Y-%m-%d}",
        f"ingestion_time={moment:%H-%M-%S}",
        f"run_id={sanitize_run_id(run_id)}",
    ]
    root = normalize_scheme(endpoint).rstrip("/")
    return "/".join([root, *filter(None, (p.strip("/") for p in parts)), *tail])


def landing_path_column(
    endpoint: str, system: Column, segments: Sequence[Column], moment: Column, run_id: Column
) -> Column:
    """Column form of :func:`landing_path`, for deriving many paths at once."""
    return F.concat_ws(
        "/",
        F.lit(normalize_scheme(endpoint).rstrip("/")),
        system,
        *segments,
        F.concat(F.lit("ingestion_date="), F.date_format(moment, "yyyy-MM-dd")),
        F.concat(F.lit("ingestion_time="), F.date_format(moment, "HH-mm-ss")),
        F.concat(F.lit("run_id="), sanitize_run_id(run_id)),
    )
