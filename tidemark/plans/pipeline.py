"""One pipeline run: look up, bound, read, conform, land, record, advance.

The upper bound is fixed before anything is read and is the value stored afterwards,
so consecutive runs neither overlap nor leave a gap. The order of effects is data, event,
checkpoint. A run id that has landed before is repeated with the bounds and the path of its
event, so running it again replaces its rows by the same rows and never moves a checkpoint
that later runs have advanced.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checkpoint import CheckpointValue, checkpoint_text, field_type, typed_literal
from tidemark.functions.kafka import OffsetMap, decode_kafka, parse_offsets, render_offsets
from tidemark.functions.paths import bucket_of, landing_path, sanitize_run_id
from tidemark.operators.aggregates import high_water_text, record_count
from tidemark.operators.conform import conform
from tidemark.operators.copy import copy_files
from tidemark.operators.landing import counted, land
from tidemark.operators.listing import changed_files
from tidemark.operators.lookback import earlier_bound, identity_of, not_landed
from tidemark.operators.offsets import end_offsets, offset_map_json, offset_range
from tidemark.operators.state import RunState, now_utc
from tidemark.operators.upsert import read_current, upsert_into
from tidemark.operators.window import apply_filters, incremental_window
from tidemark.plans.spec import (
    CONNECTOR,
    JDBC_TYPES,
    KafkaSource,
    PathSource,
    PipelineSpec,
    TableSource,
)
from tidemark.session import runtime_conf
from tidemark.sources.connector import Read, custom_query, load, texts
from tidemark.sources.files import file_inventory, read_files
from tidemark.sources.jdbc import DIALECTS, even_split_read, jdbc_read, max_query, split_read
from tidemark.sources.kafka import broker_end_offsets, complete_start, kafka_read
from tidemark.sources.nosql import cassandra_read, dynamodb_read, mongodb_max, mongodb_read
from tidemark.sources.storage import s3a_access

log = logging.getLogger(__name__)

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RunResult:
    """What one run did."""

    path: str
    checkpoint_from: str | None
    checkpoint_to: str | None
    record_count: int | None


def run_pipeline(
    spark: SparkSession,
    spec: PipelineSpec,
    state: RunState,
    run_id: str,
    moment: datetime,
    *,
    checkpoint_to: CheckpointValue | None = None,
    frame: DataFrame | None = None,
    transforms: Sequence[Transform] = (),
    extra: Mapping[str, Any] | None = None,
    publish: Callable[[DataFrame], None] | None = None,
    full_read_on_error: bool = False,
    topic_ends: Callable[[KafkaSource], OffsetMap] | None = None,
) -> RunResult:
    """Run a pipeline once.

    ``checkpoint_to`` replaces the computed high-water mark, as for a backfill. ``frame`` stands
    in for the connector: any frame of the source's shape. ``transforms`` run after filters
    and before conforming. ``publish`` receives the run's event as a one-row frame, to be
    enveloped and sent, before the checkpoint moves; if it fails, so does the run. A failing
    high-water query fails the run unless ``full_read_on_error`` asks for an unbounded read
    that leaves the checkpoint where it was. ``topic_ends`` tells the end offsets of a topic
    in place of the brokers. A bound that is not above the stored checkpoint is recorded in the
    event but never stored.
    """
    before = state.landed_run(spec.dag_id, run_id)
    run = _Run(
        spark, spec, state, run_id, moment, frame, tuple(transforms), full_read_on_error, before, topic_ends
    )
    event: dict[str, Any] = {"dag_id": spec.dag_id, "run_id": run_id, "start_time": now_utc()}
    try:
        with runtime_conf(spark, _runtime_settings(spark, spec)):
            result = run.execute(checkpoint_text(checkpoint_to))
        event |= {
            "status": "success",
            "stop_time": now_utc(),
            "checkpoint_from": result.checkpoint_from,
            "checkpoint_to": result.checkpoint_to,
            "read_type": spec.read_type,
            "ingestion_date": moment.date(),
            "record_count": result.record_count,
            "path": result.path,
            **run.notes,
        }
        recorded = state.append_event(event, extra)
        if publish is not None:
            publish(recorded)
        if before is None or state.checkpoint(spec.dag_id) == before.checkpoint_from:
            advanced = run.advanced(state.checkpoint(spec.dag_id), result.checkpoint_to)
            if advanced is None and result.checkpoint_to is not None:
                log.warning("%s: bound %s is not above the stored one", run_id, result.checkpoint_to)
            state.save_checkpoint(spec.dag_id, advanced)
        if run.notes and (before is None or state.listing(spec.dag_id) == run.notes["listed_before"]):
            state.save_listing(spec.dag_id, run.notes["listing"])
        return result
    except Exception as error:
        failed = event | {"status": "failed", "stop_time": now_utc(), "error": str(error)}
        try:
            recorded = state.append_event(failed)
            if publish is not None:
                publish(recorded)
        except Exception:  # the original error must reach the caller
            log.exception("could not record the failure of %s", run_id)
        raise


def _runtime_settings(spark: SparkSession, spec: PipelineSpec) -> dict[str, str]:
    """The spec's settings a running session can take; launch-time ones belong to the caller."""
    return {k: v for k, v in spec.spark.items() if spark.conf.isModifiable(k)}


@dataclass(frozen=True)
class _Late:
    """The overlap of a window with earlier ones: above ``floor``, and to be compared with landed rows up to ``known``."""

    column: str
    floor: str | None
    known: str


@dataclass(frozen=True)
class _Run:
    spark: SparkSession
    spec: PipelineSpec
    state: RunState
    run_id: str
    moment: datetime
    frame: DataFrame | None
    transforms: tuple[Transform, ...]
    full_read_on_error: bool
    before: Row | None
    end_offsets: Callable[[KafkaSource], OffsetMap] | None = None
    # Type of the checkpoint column, once the source has been seen.
    kinds: list[T.DataType] = field(default_factory=list)
    # What a file copy has compared: the listing of its source, and the one before.
    notes: dict[str, str | None] = field(default_factory=dict)

    def advanced(self, stored: str | None, reached: str | None) -> str | None:
        """What to store after a run that reached a bound: null unless that is above the stored one.

        Bounds compare in the type of their column, offset maps partition by partition.
        """
        if reached is None or stored is None or stored == reached:
            return reached
        if isinstance(self.spec.source, KafkaSource):
            old, new = parse_offsets(stored), parse_offsets(reached)
            best = {t: dict(old.get(t, {})) for t in old.keys() | new.keys()}
            for topic, parts in new.items():
                for part, offset in parts.items():
                    best[topic][part] = max(offset, best[topic].get(part, offset))
            return None if best == old else render_offsets(best)
        kind = self.kinds[-1] if self.kinds else T.StringType()
        higher = typed_literal(reached, kind) > typed_literal(stored, kind)
        return reached if self.spark.range(1).select(higher).first()[0] else None

    def execute(self, fixed: str | None) -> RunResult:
        spec = self.spec
        with ExitStack() as access:
            if spec.read_type == "s3" and isinstance(spec.source, PathSource):
                bucket = bucket_of(spec.source.path)
                access.enter_context(s3a_access(self.spark, spec.source_credentials, bucket=bucket))
            if spec.write_type == "s3":
                bucket = bucket_of(spec.sink.endpoint)
                access.enter_context(s3a_access(self.spark, spec.sink_credentials, writing=True, bucket=bucket))
            return self._execute(fixed)

    def _execute(self, fixed: str | None) -> RunResult:
        spec = self.spec
        low = self.state.checkpoint(spec.dag_id)
        self.kinds.clear()
        if self.before is not None:
            low, fixed = self.before.checkpoint_from, self.before.checkpoint_to
        if isinstance(spec.source, KafkaSource):
            return self._kafka(spec.source, low, fixed)
        if isinstance(spec.source, PathSource):
            if spec.source.mode == "copy" and self.frame is None:
                return self._copy(spec.source, low, fixed)
            rows = self.frame if self.frame is not None else self._files(spec.source)
            return self._windowed(spec.source, rows, rows, "", low, fixed)
        return self._table(spec.source, low, fixed)

    # Sources

    def _files(self, source: PathSource) -> DataFrame:
        return read_files(
            self.spark, source.path, source.file_format, source.read_schema, texts(source.read_options)
        )

    def _table(self, source: TableSource, low: str | None, fixed: str | None) -> RunResult:
        column = source.checkpoint_column
        if self.frame is not None or self.spec.read_type == CONNECTOR:
            rows = self.frame if self.frame is not None else load(self.spark, self._plain(source))
            if source.query:
                rows = custom_query(rows, source.query)
            return self._windowed(source, rows, rows, "", low, fixed)
        read = self._read(source)
        if column and self.spec.read_type in JDBC_TYPES:
            top, name = load(self.spark, max_query(read, column)), "checkpoint_to"
        elif column and self.spec.read_type == "nosql" and not source.query:
            top, name = load(self.spark, mongodb_max(read, column)), "checkpoint_to"
        else:
            top, name = None, ""
        if source.split_column:
            split = even_split_read if source.split_by == "rows" else split_read
            read = split(self.spark, read, source.split_column, source.split_partitions)
        rows = load(self.spark, read)
        return self._windowed(source, rows, rows if top is None else top, name, low, fixed)

    def _plain(self, source: TableSource) -> Read:
        return Read(source.format, texts(source.read_options), source.read_schema)

    def _read(self, source: TableSource) -> Read:
        secret, kind = self.spec.source_credentials, self.spec.read_type
        more, schema = source.read_options, source.read_schema
        if kind in JDBC_TYPES:
            dialect = DIALECTS[kind]
            named = source.table if source.schema == "" else f"{source.schema}.{source.table}"
            return jdbc_read(
                dialect,
                dialect.address(source.host, source.port, source.database),
                table=None if source.query else named,
                query=source.query,
                credentials=secret,
                fetch_size=source.fetch_size,
                schema=schema,
                read_options=more,
            )
        if kind == "dynamodb":
            return dynamodb_read(
                source.table, secret, throughput=source.fetch_size, schema=schema, read_options=more
            )
        where = (source.host, source.port, source.database, source.table, secret)
        if kind == "cassandra":
            return cassandra_read(*where, fetch_size=source.fetch_size, schema=schema, read_options=more)
        return mongodb_read(*where, pipeline=source.query, schema=schema, read_options=more)

    # Bounds

    def _mark(self, rows: DataFrame, column: str, fixed: str | None) -> tuple[str | None, bool]:
        """Upper bound of the run, and whether the read may be bounded by it."""
        if fixed is not None:
            return fixed, True
        try:
            return high_water_text(rows, column), True
        except Exception:
            if not self.full_read_on_error:
                raise
            log.exception("no high-water mark for %s: reading everything", self.spec.dag_id)
            return None, False

    def _windowed(
        self,
        source: TableSource | PathSource,
        rows: DataFrame,
        marked: DataFrame,
        mark_column: str,
        low: str | None,
        fixed: str | None,
    ) -> RunResult:
        column, high, bounded, whole = source.checkpoint_column, None, False, rows
        if column:
            self.kinds.append(field_type(rows, column))
            if marked is rows and low is not None:
                # Row groups below the checkpoint need not be read; nothing above it means nothing new.
                marked = rows.where(F.col(column) > typed_literal(low, self.kinds[-1]))
            high, bounded = self._mark(marked, mark_column or column, fixed)
            if bounded and high is None and marked is not rows and not mark_column:
                high = low
        if column and bounded and source.incremental:
            if high is None and low is None:
                # No value in the source yet: only rows that no later window can reach.
                rows = rows.where(F.col(column).isNull())
            else:
                rows = incremental_window(rows, column, low, low if high is None else high)
        late = None
        if column and bounded and source.incremental and source.lookback:
            top = low if high is None else high
            floor = None if low is None else earlier_bound(self.spark, low, self.kinds[-1], source.lookback)
            if floor is not None:
                rows = incremental_window(whole, column, floor, top)
            # A run that is repeated may find rows of its own window among what later runs have landed.
            known = low if self.before is None else top
            late = None if known is None else _Late(column, floor, known)
        # A later window keeps few of the rows its tasks scan: gather them into full files.
        scattered = bounded and source.incremental and low is not None
        return self._land(apply_filters(rows, source.filters), low, high, scattered, late)

    # Effects

    def _path(self) -> str:
        if self.before is not None:
            return self.before.path
        return self._leaf()

    def _leaf(self) -> str:
        sink = self.spec.sink
        return landing_path(
            sink.endpoint, sink.source_system_name, self.spec.source.segments(), self.moment, self.run_id
        )

    def _without_landed(self, rows: DataFrame, late: _Late) -> DataFrame:
        """The rows above the checkpoint, and those of the overlap that no run has landed."""
        sink, column = self.spec.sink, late.column
        keyed = sink.mode in ("upsert", "merge")
        keys = list(sink.keys) if keyed else identity_of(rows.schema, self.spec.source.identity, column)
        if keyed:
            identity_of(rows.schema, keys, column)
            version = sanitize_run_id(self.run_id)
            landed = read_current(self.spark, self._keyed_base(), sink.file_format, without=version)
        else:
            landed = self._landed_rows(rows.schema, late)
        if landed is None:
            return rows
        kind = field_type(rows, column)
        known = typed_literal(late.known, kind)
        if late.floor is not None:
            landed = landed.where(F.col(column) > typed_literal(late.floor, kind))
        if not keyed:
            landed = landed.where(F.col(column) <= known)
        above = F.col(column) > known
        fresh, again = rows.where(above | F.col(column).isNull()), rows.where(F.col(column) <= known)
        return fresh.unionByName(not_landed(again, landed, keys, column, keyed=keyed))

    def _landed_rows(self, schema: T.StructType, late: _Late) -> DataFrame | None:
        """What other runs have landed, pruned to those whose bound lies above the overlap's lower one."""
        kind, state = self.kinds[-1], self.state
        others = state.events().where((F.col("dag_id") == self.spec.dag_id) & (F.col("run_id") != self.run_id))
        landed = others.where(F.col("path").isNotNull() & F.col("checkpoint_to").isNotNull())
        reaching = landed
        if late.floor is not None:
            reaching = landed.where(F.col("checkpoint_to").cast(kind) > typed_literal(late.floor, kind))
        paths = sorted(row.path for row in reaching.select("path").distinct().collect())  # one for each run concerned
        if not paths:
            return None
        sink = self.spec.sink
        reader = self.spark.read.format(sink.file_format).options(**texts(sink.write_options)).schema(schema)
        if not sink.partition_by:
            return reader.load(paths)
        # Directories below each run's own root are its partitions.
        return reduce(DataFrame.unionByName, (reader.load(path) for path in paths))

    def _keyed_base(self) -> str:
        return self._leaf().rsplit("/", 3)[0]

    def _land(
        self, rows: DataFrame, low: str | None, high: str | None, scattered: bool = False, late: _Late | None = None
    ) -> RunResult:
        sink = self.spec.sink
        for transform in self.transforms:
            rows = rows.transform(transform)
        rows = conform(rows, sink.schema, sink.on_mismatch)
        if late is not None:
            rows = self._without_landed(rows, late)
        seen = Observation() if self.spec.count_records else None
        path = self._path()
        if sink.mode in ("upsert", "merge"):
            base = self._keyed_base()
            version = sanitize_run_id(self.run_id)
            path = upsert_into(
                self.spark, base, rows, sink.keys, version, sink.order_by,
                mode=sink.mode, file_format=sink.file_format, unique=sink.unique_keys,
                buckets=sink.buckets, observation=seen,
            )
        else:
            # A run id that has landed before replaces its own leaf, also where runs append.
            mode = "overwrite" if self.before is not None else sink.mode
            land(
                rows, path, sink.file_format, mode, sink.partition_by,
                texts(sink.write_options), rebalance=scattered or None, observation=seen,
            )
        return RunResult(path, low, high, None if seen is None else counted(seen))

    def _copy(self, source: PathSource, low: str | None, fixed: str | None) -> RunResult:
        if not source.modified_only:
            files = file_inventory(self.spark, source.path, recursive=True)
            high = self._newest_file(files, fixed) if source.checkpoint_column else None
            return self._copied(source, files, low, high)
        repeated = dict(self.before.extra or {}) if self.before is not None else {}
        if "listing" in repeated:
            listing, seen, high = repeated["listing"], repeated.get("listed_before"), fixed
            files = read_files(self.spark, listing)
        else:
            files = file_inventory(self.spark, source.path, recursive=True)
            if fixed is not None:
                files = incremental_window(files, "modificationTime", None, fixed)
            high, seen = self._newest_file(files, fixed), self.state.listing(self.spec.dag_id)
            if self.before is not None:  # landed before listings were kept
                files = incremental_window(files, "modificationTime", low, high)
                return self._copied(source, files, low, high)
            listing = self.state.keep_listing(self.spec.dag_id, files)
            files = read_files(self.spark, listing)
        self.notes.update(listing=listing, listed_before=seen)
        if seen is not None:
            files = changed_files(files, read_files(self.spark, seen))
        elif low is not None:  # a checkpoint from before listings were kept
            files = incremental_window(files, "modificationTime", low, high)
        return self._copied(source, files, low, high)

    def _newest_file(self, files: DataFrame, fixed: str | None) -> str | None:
        self.kinds.append(T.TimestampType())
        return self._mark(files, "modificationTime", fixed)[0]

    def _copied(self, source: PathSource, files: DataFrame, low: str | None, high: str | None) -> RunResult:
        path = self._path()
        manifest = copy_files(self.spark, source.path, path, files=files)
        count = record_count(manifest).first().cnt if self.spec.count_records else None
        return RunResult(path, low, low if high is None else high, count)

    def _kafka(self, source: KafkaSource, low: str | None, fixed: str | None) -> RunResult:
        start = low or source.starting_offsets
        if self.frame is not None:
            high = fixed or self._snapshot(self.frame, low)
            rows = offset_range(self.frame, start, high)
        else:
            high = fixed or self._ends(source, low)
            begin = complete_start(start, high) if high and start.startswith("{") else start
            rows = load(self.spark, self._topic(source, begin, high))
            if high is None:
                # Nothing to bound the read by: records that arrive meanwhile wait for the next run.
                rows = rows.where(F.lit(False))
        rows = decode_kafka(rows, source.value_format, source.value_schema)
        return self._land(apply_filters(rows, source.filters), low, high)

    def _ends(self, source: KafkaSource, low: str | None) -> str | None:
        """End offsets as the brokers tell them, never below the stored ones.

        Partitions added since the last run are among them, and empty ones: Spark's source wants all named.
        """
        asked = self.end_offsets or (
            lambda s: broker_end_offsets(
                self.spark, s.bootstrap_servers, s.topic, self.spec.source_credentials, s.read_options
            )
        )
        known = parse_offsets(low) if low else {}
        merged = {topic: dict(parts) for topic, parts in known.items()}
        for topic, parts in asked(source).items():
            for part, end in parts.items():
                merged.setdefault(topic, {})[part] = max(end, known.get(topic, {}).get(part, 0))
        return render_offsets(merged) if merged else None

    def _topic(self, source: KafkaSource, start: str, end: str | None) -> Read:
        return kafka_read(
            source.bootstrap_servers,
            source.topic,
            start=start,
            end=end,
            group_id=source.group_id,
            credentials=self.spec.source_credentials,
            min_partitions=source.min_partitions or self.spark.sparkContext.defaultParallelism,
            read_options=source.read_options,
        )

    def _snapshot(self, rows: DataFrame, low: str | None) -> str | None:
        """End offsets now, keeping the old ones of partitions without new records.

        Only offsets are aggregated; the map that reaches the driver has one entry per
        topic-partition.
        """
        found = offset_map_json(end_offsets(rows)).first().offsets
        ends = parse_offsets(found) if found else {}
        known = parse_offsets(low) if low else {}
        merged = {t: known.get(t, {}) | ends.get(t, {}) for t in known.keys() | ends.keys()}
        return render_offsets(merged) if merged else None
