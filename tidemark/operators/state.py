"""Run state as append-only tables: checkpoints and run events.

Each append is one committed file, so a lost executor or a failed run leaves the table
as it was. Reads reduce the log to the newest entry per key.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.paths import sanitize_run_id
from tidemark.session import path_exists

CHECKPOINT_SCHEMA = "dag_id string, checkpoint_to string, updated_at timestamp, seq bigint"
EVENT_SCHEMA = (
    "dag_id string, run_id string, status string, start_time timestamp, stop_time timestamp, "
    "checkpoint_from string, checkpoint_to string, read_type string, ingestion_date date, "
    "record_count bigint, path string, error string, extra map<string,string>, seq bigint"
)

LISTING_SCHEMA = "dag_id string, listing string, updated_at timestamp, seq bigint"

Event = dict[str, Any]


def now_utc() -> datetime:
    return datetime.now(tz=timezone.utc)


def sequence_number() -> int:
    """Tie-break between entries that carry the same timestamp."""
    return time.time_ns()


class StateLog:
    """An append-only table at a path; absent means empty."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str) -> None:
        self.spark, self.path = spark, path
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        entries = self.spark.read.schema(self.schema).parquet(self.path)
        return entries.select(*self.schema.names)

    def append(self, entry: Mapping[str, Any]) -> DataFrame:
        """Add one entry, and return it as a frame; fields it does not name are null."""
        text = json.dumps(entry, default=_json_text)
        parsed = F.from_json(F.lit(text), self.schema, {"mode": "FAILFAST"})
        row = self.spark.range(0, 1, 1, 1).select(parsed.alias("entry")).select("entry.*")
        row.write.mode("append").parquet(self.path)
        return row


def _json_text(value: Any) -> str:
    return value.isoformat() if isinstance(value, (date, datetime)) else str(value)


def newest(entries: DataFrame, *columns: str) -> Row | None:
    """The last entry of a log, found without a shuffle; null when there is none."""
    return entries.orderBy(*(F.col(c).desc() for c in columns)).limit(1).first()


def latest_checkpoints(log: DataFrame, tie_break: str = "seq") -> DataFrame:
    """Newest entry per pipeline of a log ``dag_id, checkpoint_to, updated_at, <tie_break>``.

    The aggregate combines within each task first: a pipeline with most of the entries
    sends one row per task into the shuffle.
    """
    order = F.struct("updated_at", tie_break)
    return log.groupBy("dag_id").agg(
        F.max_by("checkpoint_to", order).alias("checkpoint_to"),
        F.max("updated_at").alias("updated_at"),
    )


class RunState:
    """Checkpoints and run events below one root folder.

    Each pipeline has folders of its own, so a lookup lists and reads only the entries of
    that pipeline.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.checkpoint_log = StateLog(spark, f"{root}/checkpoints", CHECKPOINT_SCHEMA)
        self.event_log = StateLog(spark, f"{root}/run_events", EVENT_SCHEMA)
        self.listing_log = StateLog(spark, f"{root}/listings", LISTING_SCHEMA)

    def _own(self, log: StateLog, dag_id: str) -> StateLog:
        folder = f"{log.path}/pipeline={sanitize_run_id(dag_id)}"
        return StateLog(self.spark, folder, log.schema)

    def checkpoint(self, dag_id: str) -> str | None:
        """Text of the pipeline's checkpoint; null means it has never completed."""
        own = self._own(self.checkpoint_log, dag_id)
        if not own.exists():
            return None
        last = newest(own.read().where(F.col("dag_id") == dag_id), "updated_at", "seq")
        return None if last is None else last.checkpoint_to

    def checkpoints(self) -> DataFrame:
        """Every pipeline's checkpoint."""
        return latest_checkpoints(self.checkpoint_log.read())

    def save_checkpoint(self, dag_id: str, value: str | None) -> bool:
        """Insert or move the pipeline's checkpoint; an empty value changes nothing."""
        if not value:
            return False
        entry = {"dag_id": dag_id, "checkpoint_to": value}
        self._own(self.checkpoint_log, dag_id).append(entry | {"updated_at": now_utc(), "seq": sequence_number()})
        return True

    def listing(self, dag_id: str) -> str | None:
        """Where the file listing lies that the pipeline has copied everything of; null before the first."""
        own = self._own(self.listing_log, dag_id)
        if not own.exists():
            return None
        last = newest(own.read().where(F.col("dag_id") == dag_id), "updated_at", "seq")
        return None if last is None else last.listing

    def keep_listing(self, dag_id: str, files: DataFrame) -> str:
        """Write a listing down for good and return its path; :meth:`save_listing` makes it the pipeline's own."""
        path = f"{self.root}/listed_files/pipeline={sanitize_run_id(dag_id)}/listing={sequence_number()}"
        files.write.parquet(path)
        return path

    def save_listing(self, dag_id: str, path: str) -> None:
        entry = {"dag_id": dag_id, "listing": path}
        self._own(self.listing_log, dag_id).append(entry | {"updated_at": now_utc(), "seq": sequence_number()})

    def events(self) -> DataFrame:
        return self.event_log.read()

    def landed_run(self, dag_id: str, run_id: str) -> Row | None:
        """The newest event of a run that has landed its data, or null."""
        own = self._own(self.event_log, dag_id)
        if not own.exists():
            return None
        same = (F.col("dag_id") == dag_id) & (F.col("run_id") == run_id)
        return newest(own.read().where(same & F.col("path").isNotNull()), "seq")

    def append_event(self, event: Event, extra: Mapping[str, Any] | None = None) -> DataFrame:
        """Append one run event and return it as a one-row frame. ``extra`` overrides known fields; new names go to the map."""
        merged = event | dict(extra or {})
        known = {f.name for f in self.event_log.schema}
        entry = {name: value for name, value in merged.items() if name in known}
        more = {k: None if v is None else str(v) for k, v in merged.items() if k not in known}
        log = self._own(self.event_log, event["dag_id"])
        return log.append(entry | {"extra": more or None, "seq": sequence_number()})
