"""Declarative pipeline specs: a mapping in, validated frozen dataclasses out."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any, Union

from tidemark.functions.paths import DEFAULT_SCHEMA, key_path
from tidemark.operators.landing import check_format
from tidemark.sources.connector import DEFAULT_FETCH_SIZE

# The source and sink types a spec may name, and the generic connector.
JDBC_TYPES = ("sql", "mysql")
STORE_TYPES = ("nosql", "dynamodb", "cassandra")
CONNECTOR = "connector"
PATH_TYPES = ("file", "s3")
KAFKA = "kafka"
READ_TYPES = (*JDBC_TYPES, *STORE_TYPES, CONNECTOR, *PATH_TYPES, KAFKA)
WRITE_TYPES = ("hadoop", "s3")
SINK_MODES = ("append", "overwrite", "upsert", "merge")
VALUE_FORMATS = ("json", "string", "binary")


class SpecError(ValueError):
    """A spec names an unknown type or lacks a required field."""


def _require(kind: str, **values: object) -> None:
    missing = [name for name, value in values.items() if not value]
    if missing:
        raise SpecError(f"{kind} spec lacks {', '.join(missing)}")


def _one_of(name: str, value: str, known: tuple[str, ...]) -> str:
    if value not in known:
        raise SpecError(f"unknown {name} {value!r}; one of {', '.join(known)}")
    return value


@dataclass(frozen=True)
class TableSource:
    """A relational table, a store's collection, or any connector's rows.

    ``split_column`` reads a relational table over ``split_partitions`` connections, cut into equal widths of the
    column, or with ``split_by="rows"`` into slices of about equal numbers of rows. With
    ``incremental=False`` a checkpoint is still taken but the read is not bounded by it.
    ``lookback`` (an interval, or a number) reads that far below the checkpoint again for late rows;
    those that have landed are known by ``identity`` (all columns by default) and the checkpoint value.
    """

    database: str = ""
    schema: str = DEFAULT_SCHEMA
    table: str = ""
    host: str = ""
    port: int = 0
    query: str | None = None
    checkpoint_column: str | None = None
    filters: dict[str, str] = field(default_factory=dict)
    read_options: dict[str, Any] = field(default_factory=dict)
    read_schema: str | None = None
    format: str = ""
    split_column: str | None = None
    split_partitions: int = 64
    split_by: str = "width"
    fetch_size: int = DEFAULT_FETCH_SIZE
    incremental: bool = True
    lookback: str | None = None
    identity: tuple[str, ...] = ()

    def segments(self) -> list[str]:
        return [self.database, self.schema or DEFAULT_SCHEMA, self.table]


@dataclass(frozen=True)
class PathSource:
    """A file tree, copied byte for byte (``mode="copy"``) or read as rows (``mode="rows"``).

    ``modified_only`` copies just the files that the listing of the last run lacks: new ones, and
    those with another size or time. ``lookback`` and ``identity`` are those of a table source.
    """

    path: str = ""
    file_format: str = "parquet"
    mode: str = "copy"
    checkpoint_column: str | None = None
    modified_only: bool = False
    filters: dict[str, str] = field(default_factory=dict)
    read_options: dict[str, Any] = field(default_factory=dict)
    read_schema: str | None = None
    incremental: bool = True
    lookback: str | None = None
    identity: tuple[str, ...] = ()

    def segments(self) -> list[str]:
        return [key_path(self.path)]


@dataclass(frozen=True)
class KafkaSource:
    """One or more topics, read between two offset snapshots."""

    bootstrap_servers: str = ""
    topic: str = ""
    group_id: str = ""
    starting_offsets: str = "earliest"
    value_format: str = "json"
    value_schema: str | None = None
    min_partitions: int | None = None
    filters: dict[str, str] = field(default_factory=dict)
    read_options: dict[str, Any] = field(default_factory=dict)

    def segments(self) -> list[str]:
        return [self.topic]


Source = Union[TableSource, PathSource, KafkaSource]


@dataclass(frozen=True)
class Sink:
    """Where and how rows land. ``upsert`` and ``merge`` keep a keyed, versioned table.

    ``unique_keys`` states that a run never reads one key twice, as from a table whose
    primary key it is, and spares the shuffle that would make sure. ``buckets`` sets the number
    of hash buckets of a keyed table, which otherwise follows its size.
    """

    endpoint: str = ""
    source_system_name: str = ""
    file_format: str = "parquet"
    mode: str = "overwrite"
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    unique_keys: bool = False
    buckets: int | None = None
    schema: str | None = None
    on_mismatch: str = "fail"
    write_options: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class PipelineSpec:
    """Everything one pipeline needs, apart from the run itself."""

    dag_id: str
    read_type: str
    write_type: str
    source: Source
    sink: Sink
    count_records: bool = False
    spark: dict[str, str] = field(default_factory=dict)
    source_credentials: dict[str, str] = field(default_factory=dict, repr=False)
    sink_credentials: dict[str, str] = field(default_factory=dict, repr=False)

    @classmethod
    def from_dict(
        cls,
        dag_id: str,
        config: Mapping[str, Any],
        secrets: Mapping[str, Mapping[str, Any]] | None = None,
    ) -> PipelineSpec:
        """Build and check a spec.

        ``secrets`` maps each ``credential_ref`` to its values; ``host``, ``port``, ``path``,
        ``bootstrap_servers`` and ``endpoint`` found there complete the source and sink.
        Unknown keys are ignored.
        """
        read_type = _one_of("read_type", config.get("read_type", ""), READ_TYPES)
        write_type = _one_of("write_type", config.get("write_type", ""), WRITE_TYPES)
        source_raw, sink_raw = dict(config.get("source") or {}), dict(config.get("sink") or {})
        source_secret = dict((secrets or {}).get(source_raw.get("credential_ref"), {}))
        sink_secret = dict((secrets or {}).get(sink_raw.get("credential_ref"), {}))
        return cls(
            dag_id=dag_id,
            read_type=read_type,
            write_type=write_type,
            source=_source(read_type, source_raw | source_secret),
            sink=_sink(sink_raw | sink_secret),
            count_records=bool(config.get("count_records", False)),
            spark={k: str(v) for k, v in (config.get("spark") or {}).items()},
            source_credentials=source_secret,
            sink_credentials=sink_secret,
        )

    @classmethod
    def from_file(
        cls, path: str, secrets: Mapping[str, Mapping[str, Any]] | None = None
    ) -> PipelineSpec:
        """Spec from a JSON file, or a YAML one where PyYAML is installed; named after the file."""
        file = Path(path)
        if file.suffix in (".yaml", ".yml"):
            import yaml

            config = yaml.safe_load(file.read_text())
        else:
            config = json.loads(file.read_text())
        return cls.from_dict(file.stem, config, secrets)


def _pick(kind: type, raw: Mapping[str, Any]) -> dict[str, Any]:
    names = {f.name for f in fields(kind)}
    picked = {k: v for k, v in raw.items() if k in names and v is not None}
    for name in ("partition_by", "keys", "order_by", "identity"):
        if name in picked:
            picked[name] = tuple(picked[name])
    if "lookback" in picked:
        if not raw.get("checkpoint_column"):
            raise SpecError("a look-back needs a checkpoint_column")
        picked["lookback"] = str(picked["lookback"])
    return picked


def _source(read_type: str, raw: Mapping[str, Any]) -> Source:
    if read_type == KAFKA:
        kafka = KafkaSource(**_pick(KafkaSource, raw))
        _require("kafka source", topic=kafka.topic)
        _one_of("value_format", kafka.value_format, VALUE_FORMATS)
        return kafka
    if read_type in PATH_TYPES:
        path = PathSource(**_pick(PathSource, raw))
        _require("path source", path=path.path)
        _one_of("mode", path.mode, ("copy", "rows"))
        check_format(path.file_format)
        return path
    table = TableSource(**(_pick(TableSource, raw) | {"port": int(raw.get("port") or 0)}))
    _one_of("split_by", table.split_by, ("width", "rows"))
    needed = {"table": table.table}
    if read_type != "dynamodb":
        needed["database"] = table.database
    if read_type == CONNECTOR:
        needed["format"] = table.format
    _require("table source", **needed)
    return table


def _sink(raw: Mapping[str, Any]) -> Sink:
    sink = Sink(**_pick(Sink, raw))
    _require("sink", endpoint=sink.endpoint, source_system_name=sink.source_system_name)
    _one_of("sink mode", sink.mode, SINK_MODES)
    check_format(sink.file_format)
    if sink.mode in ("upsert", "merge"):
        _require(f"{sink.mode} sink", keys=sink.keys)
    return sink
