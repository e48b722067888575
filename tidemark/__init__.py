"""tidemark: incremental landing of tables, files and topics as Spark DataFrame operators."""

from tidemark.functions.checkpoint import (
    decode_checkpoint,
    encode_checkpoint,
    format_checkpoint,
    parse_checkpoint,
)
from tidemark.functions.envelope import event_envelope, flatten_event, queue_message
from tidemark.functions.kafka import decode_kafka, infer_value_schema, offset_rows
from tidemark.functions.paths import landing_path, landing_path_column, normalize_scheme, sanitize_run_id
from tidemark.operators.aggregates import high_water_mark, record_count
from tidemark.operators.conform import SchemaMismatch, conform, schema_report, validate_schema
from tidemark.operators.copy import copy_files
from tidemark.operators.landing import land, read_landing
from tidemark.operators.offsets import end_offsets, offset_map_json, offset_range
from tidemark.operators.retention import retain_latest
from tidemark.operators.state import RunState, latest_checkpoints
from tidemark.operators.upsert import merge_columns, read_current, upsert, upsert_into
from tidemark.operators.window import apply_filters, incremental_window
from tidemark.plans.pipeline import RunResult, run_pipeline
from tidemark.plans.spec import PipelineSpec, SpecError
from tidemark.sources.connector import Read, custom_query, load
from tidemark.sources.files import file_count, file_inventory, latest_modification, read_files
from tidemark.sources.jdbc import Dialect, jdbc_read, split_read
from tidemark.sources.kafka import kafka_read, kafka_stream
from tidemark.sources.nosql import cassandra_read, dynamodb_read, mongodb_read
from tidemark.sources.storage import configure_s3a, s3a_settings
from tidemark.streaming.landing import land_stream, stream_files, stream_topic

__all__ = [
    "Dialect",
    "PipelineSpec",
    "Read",
    "RunResult",
    "RunState",
    "SchemaMismatch",
    "SpecError",
    "apply_filters",
    "cassandra_read",
    "configure_s3a",
    "conform",
    "copy_files",
    "custom_query",
    "decode_checkpoint",
    "decode_kafka",
    "dynamodb_read",
    "encode_checkpoint",
    "end_offsets",
    "event_envelope",
    "file_count",
    "file_inventory",
    "flatten_event",
    "format_checkpoint",
    "high_water_mark",
    "incremental_window",
    "infer_value_schema",
    "jdbc_read",
    "kafka_read",
    "kafka_stream",
    "land",
    "land_stream",
    "landing_path",
    "landing_path_column",
    "latest_checkpoints",
    "latest_modification",
    "load",
    "merge_columns",
    "mongodb_read",
    "normalize_scheme",
    "offset_map_json",
    "offset_range",
    "offset_rows",
    "parse_checkpoint",
    "queue_message",
    "read_current",
    "read_files",
    "read_landing",
    "record_count",
    "retain_latest",
    "run_pipeline",
    "s3a_settings",
    "sanitize_run_id",
    "schema_report",
    "split_read",
    "stream_files",
    "stream_topic",
    "upsert",
    "upsert_into",
    "validate_schema",
]
