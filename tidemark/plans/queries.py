"""The driver's queries: each goes through the operators, over whole tables.

Paths given to a query are those of the test tables; whatever a query writes goes below the
session's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.checkpoint import (
    decode_checkpoint,
    encode_checkpoint,
    field_type,
    format_checkpoint,
    parse_checkpoint,
)
from tidemark.functions.envelope import event_envelope, flatten_event, published_text, queue_message
from tidemark.functions.kafka import (
    decode_kafka,
    infer_value_schema,
    parse_offsets,
    render_offsets,
)
from tidemark.functions.paths import landing_path, landing_path_column, normalize_scheme, sanitize_run_id
from tidemark.operators.aggregates import high_water_mark, record_count
from tidemark.operators.conform import conform, schema_report
from tidemark.operators.copy import copy_files
from tidemark.operators.landing import land, read_landing
from tidemark.operators.offsets import end_offsets, offset_map_json, offset_range
from tidemark.operators.retention import retain_latest
from tidemark.operators.state import RunState, latest_checkpoints
from tidemark.operators.upsert import read_current, upsert_into
from tidemark.operators.window import apply_filters, incremental_window
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.spec import PipelineSpec
from tidemark.session import move_folder, scratch_path
from tidemark.sources.connector import Read, custom_query, load
from tidemark.sources.files import read_files
from tidemark.sources.jdbc import column_cuts, equi_depth_predicates, sliced, split_predicates
from tidemark.streaming.landing import land_stream, stream_files

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

SPLITS = 16


def query(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function name, with the SQL it must agree with."""

    def add(fn: Query) -> Query:
        _QUERIES[name or fn.__name__] = fn
        _ORACLES[name or fn.__name__] = oracle
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table through the generic connector read, as any table source is."""
    return load(spark, Read("parquet", {"path": f"{sf_dir}/{name}.parquet"}))


def _file(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_files(spark, f"{sf_dir}/{name}.parquet")


def _topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows from ``events``: the event id is the offset, so no sort is needed.

    Offsets rise within a partition and have gaps, as in a compacted topic.
    """
    return _file(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


# Table sources


@query("SELECT * FROM orders")
def table_full_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return incremental_window(orders, "o_orderdate", None, None)


@query(
    "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01 00:00:00' "
    "AND o_orderdate <= TIMESTAMP '1997-01-01 00:00:00'"
)
def table_window_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return incremental_window(orders, "o_orderdate", datetime(1996, 1, 1), datetime(1997, 1, 1))


@query(
    "WITH m AS (SELECT max(o_orderkey) AS top FROM orders) SELECT orders.* FROM orders, m "
    "WHERE o_orderkey > top // 4 AND o_orderkey <= top * 3 // 4"
)
def table_window_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    top = high_water_mark(orders, "o_orderkey").first().checkpoint_to
    return incremental_window(orders, "o_orderkey", top // 4, top * 3 // 4)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def table_custom_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return custom_query(
        _table(spark, sf_dir, "orders"),
        "SELECT o_orderkey, o_totalprice FROM {source} WHERE o_orderstatus = 'F'",
    )


@query(
    "WITH b AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders) "
    "SELECT o_orderkey, o_totalprice, "
    f"CAST(least({SPLITS - 1}, greatest(0, (o_orderkey - low) * {SPLITS} // (high - low + 1))) AS INTEGER) "
    "AS split FROM orders, b"
)
def table_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    bounds = orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).first()
    slices = split_predicates("o_orderkey", bounds.low, bounds.high, SPLITS)
    # Every row is told by the conditions themselves which slice reads it; all slices share one scan.
    told = [F.when(F.expr(condition), F.lit(i)) for i, condition in enumerate(slices)]
    return orders.select("o_orderkey", "o_totalprice", F.coalesce(*told).alias("split"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def table_equi_depth_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read through slices of about equal numbers of rows, whatever the customers' shares are."""
    orders = _table(spark, sf_dir, "orders")
    slices = equi_depth_predicates("o_custkey", column_cuts(orders, "o_custkey", SPLITS))
    return sliced(orders, slices).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT count(*) AS cnt FROM orders")
def table_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_count(_table(spark, sf_dir, "orders"))


@query("SELECT max(o_orderdate) AS checkpoint_to FROM orders")
def table_max_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(_table(spark, sf_dir, "orders"), "o_orderdate")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000")
def table_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = {"o_orderstatus": "= 'F'", "o_totalprice": "> 250000"}
    return apply_filters(_table(spark, sf_dir, "orders"), filters)


# File sources

_PART = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
)


def _round_trip(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    path = land(_file(spark, sf_dir, "part"), scratch_path(spark, file_format), file_format)
    return read_files(spark, path, file_format, _PART)


@query("SELECT * FROM part")
def file_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "csv")


@query("SELECT * FROM part")
def file_scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


@query("SELECT * FROM part")
def file_scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "orc")


@query("SELECT p_name AS value FROM part")
def file_scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _file(spark, sf_dir, "part").select("p_name")
    return read_files(spark, land(names, scratch_path(spark, "text"), "text"), "text")


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'")
def file_lower_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_window(_file(spark, sf_dir, "events"), "ts", datetime(2024, 1, 10), None)


@query(
    "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00' "
    "AND ts <= TIMESTAMP '2024-01-20 00:00:00'"
)
def file_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _file(spark, sf_dir, "events")
    return incremental_window(events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20))


@query("SELECT * FROM events WHERE event_type = 'purchase' AND value > 50")
def file_post_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_filters(
        _file(spark, sf_dir, "events"), {"event_type": "= 'purchase'", "value": "> 50"}
    )


@query("SELECT max(ts) AS checkpoint_to FROM events")
def file_max_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(_file(spark, sf_dir, "events"), "ts")


# Kafka-shaped frames

_KAFKA_SQL = (
    "CAST(user_id AS VARCHAR) AS \"key\", 'events' AS topic, CAST(user_id % 3 AS INTEGER) AS \"partition\", "
    "event_id AS \"offset\", ts AS \"timestamp\""
)
_ENDS_SQL = "SELECT user_id % 3 AS p, max(event_id) + 1 AS e FROM events GROUP BY 1"


@query(f"SELECT props AS \"value\", {_KAFKA_SQL} FROM events")
def kafka_decode_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_kafka(_topic(spark, sf_dir), "string")


@query(f"SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {_KAFKA_SQL} FROM events")
def kafka_decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_kafka(_topic(spark, sf_dir), "json", "k bigint")


@query(
    f"WITH b AS ({_ENDS_SQL}) SELECT event_id AS \"offset\", CAST(p AS INTEGER) AS \"partition\", props AS \"value\" "
    "FROM events JOIN b ON user_id % 3 = p WHERE event_id >= e // 4 AND event_id < e * 3 // 4"
)
def kafka_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = _topic(spark, sf_dir)
    ends = parse_offsets(offset_map_json(end_offsets(topic)).first().offsets)
    start = {t: {p: o // 4 for p, o in parts.items()} for t, parts in ends.items()}
    end = {t: {p: o * 3 // 4 for p, o in parts.items()} for t, parts in ends.items()}
    rows = offset_range(topic, render_offsets(start), render_offsets(end))
    return decode_kafka(rows, "string").select("offset", "partition", "value")


@query(
    f"SELECT 'events' AS topic, CAST(p AS INTEGER) AS \"partition\", e AS end_offset FROM ({_ENDS_SQL}) x"
)
def kafka_end_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return end_offsets(_topic(spark, sf_dir))


@query(
    "SELECT '{\"events\":{' || string_agg('\"' || p || '\":' || e, ',' ORDER BY p) || '}}' AS offsets "
    f"FROM ({_ENDS_SQL}) x"
)
def kafka_offset_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_map_json(end_offsets(_topic(spark, sf_dir)))


@query(
    "SELECT 'k' AS field, CASE WHEN json_extract_string(CAST(json_group_structure(CAST(props AS JSON)) AS JSON), '$.k') "
    "IN ('BIGINT', 'UBIGINT') THEN 'bigint' ELSE 'other' END AS type FROM events"
)
def kafka_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infer_value_schema(_topic(spark, sf_dir))
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in found], "field string, type string"
    )


# Column functions


def _checkpoint_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    texts = F.array(F.concat(F.lit(" "), F.col("event_id").cast("string")), stamp, F.col("props"))
    return _file(spark, sf_dir, "events").select("event_id", F.posexplode(texts).alias("n", "s"))


_TEXTS_SQL = (
    "SELECT event_id, 0 AS n, ' ' || event_id AS s, 'int' AS t, CAST(event_id AS VARCHAR) AS v FROM events "
    "UNION ALL SELECT event_id, 1, strftime(ts, '%Y-%m-%dT%H:%M:%S'), 'ts', strftime(ts, '%Y-%m-%dT%H:%M:%S') "
    "FROM events UNION ALL SELECT event_id, 2, props, 'str', props FROM events"
)


@query(
    "SELECT s, t, CASE WHEN t = 'int' THEN v END AS as_int, "
    "CASE WHEN t = 'ts' THEN replace(v, 'T', ' ') END AS as_ts, CASE WHEN t = 'str' THEN v END AS as_str "
    f"FROM ({_TEXTS_SQL}) x"
)
def checkpoint_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_checkpoint(_checkpoint_texts(spark, sf_dir), "s")
    c = F.col("checkpoint")
    stamp = F.date_format(c["as_ts"], "yyyy-MM-dd HH:mm:ss").alias("as_ts")
    whole = c["as_int"].cast("string").alias("as_int")
    return parsed.select("s", c["t"].alias("t"), whole, stamp, c["as_str"].alias("as_str"))


@query(
    "SELECT event_id, CAST(n AS INTEGER) AS n, CASE WHEN t = 'int' THEN '{\"t\":\"int\",\"v\":' || v || '}' "
    "WHEN t = 'ts' THEN '{\"t\":\"ts\",\"v\":\"' || v || '\"}' "
    "ELSE '{\"t\":\"str\",\"v\":' || CAST(to_json(v) AS VARCHAR) || '}' END AS encoded, v AS decoded "
    f"FROM ({_TEXTS_SQL}) x"
)
def checkpoint_serde(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_checkpoint(_checkpoint_texts(spark, sf_dir), "s")
    encoded = parsed.select("event_id", "n", encode_checkpoint(F.col("checkpoint")).alias("encoded"))
    back = F.col("back")
    whole, text = back["as_int"].cast("string"), back["as_str"]
    stamp = F.date_format(back["as_ts"], "yyyy-MM-dd'T'HH:mm:ss")
    return decode_checkpoint(encoded, "encoded", "back").select(
        "event_id", "n", "encoded", F.coalesce(whole, stamp, text).alias("decoded")
    )


@query(
    "SELECT event_id, '''' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '''' AS ts_literal, "
    "CAST(event_id AS VARCHAR) AS int_literal FROM events"
)
def checkpoint_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _file(spark, sf_dir, "events")
    return events.select(
        "event_id",
        format_checkpoint(F.col("ts"), field_type(events, "ts")).alias("ts_literal"),
        format_checkpoint(F.col("event_id"), field_type(events, "event_id")).alias("int_literal"),
    )


@query("SELECT page_id, regexp_replace(url, '[^a-zA-Z0-9]', '_', 'g') AS run_id FROM pages")
def run_id_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file(spark, sf_dir, "pages").select("page_id", sanitize_run_id(F.col("url")).alias("run_id"))


@query(
    "SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN 's3a://' || substr(url, 9) "
    "ELSE url END AS path FROM pages"
)
def scheme_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = F.regexp_replace("url", "^https://", "s3://")
    return _file(spark, sf_dir, "pages").select("page_id", normalize_scheme(uri).alias("path"))


@query(
    "SELECT event_id, 's3a://landing/erp/db1/public/' || event_type || '/ingestion_date=' || "
    "strftime(ts, '%Y-%m-%d') || '/ingestion_time=' || strftime(ts, '%H-%M-%S') || '/run_id=' || "
    "regexp_replace('run:' || event_id, '[^a-zA-Z0-9]', '_', 'g') AS path FROM events",
    name="landing_path",
)
def landing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = [F.lit("db1"), F.lit("public"), F.col("event_type")]
    run_id = F.concat(F.lit("run:"), F.col("event_id").cast("string"))
    path = landing_path_column("s3://landing/", F.lit("erp"), segments, F.col("ts"), run_id)
    return _file(spark, sf_dir, "events").select("event_id", path.alias("path"))


# Landing

_TWO_LANDINGS = (
    "SELECT supplier.*, '2023-11-02' AS ingestion_date, '07-05-09' AS ingestion_time, "
    "'nightly_one' AS run_id FROM supplier UNION ALL "
    "SELECT supplier.*, '2023-11-03', '09-00-00', 'nightly_two' FROM supplier "
    "WHERE s_acctbal > 1000"
)


@query(_TWO_LANDINGS)
def land_and_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, root = _table(spark, sf_dir, "supplier"), scratch_path(spark, "landing")
    segments = ["erp", "public", "supplier"]
    first = landing_path(root, "pg", segments, datetime(2023, 11, 2, 7, 5, 9), "nightly one")
    second = landing_path(root, "pg", segments, datetime(2023, 11, 3, 9), "nightly two")
    land(suppliers, first)
    land(apply_filters(suppliers, {"s_acctbal": "> 1000"}), second)
    landed = read_landing(spark, f"{root}/pg/erp/public/supplier")
    return landed.withColumn("ingestion_date", F.date_format("ingestion_date", "yyyy-MM-dd"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def land_partition_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = land(orders, scratch_path(spark, "by-status"), partition_by=["o_orderstatus"])
    return read_landing(spark, path)


@query("SELECT * FROM supplier WHERE s_acctbal > 1000")
def land_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, path = _table(spark, sf_dir, "supplier"), scratch_path(spark, "overwrite")
    land(suppliers, path)
    land(apply_filters(suppliers, {"s_acctbal": "> 1000"}), path, mode="overwrite")
    return read_landing(spark, path)


@query(
    "SELECT 'o_orderstatus' AS column_name, 'int' AS expected, 'string' AS actual, count(o_orderstatus) AS n_values FROM orders "
    "UNION ALL SELECT 'o_note', 'string', NULL, 0"
)
def schema_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift of the table from an expected schema, and how many values each drifting column holds."""
    orders = _table(spark, sf_dir, "orders")
    report = schema_report(orders, "o_orderkey bigint, o_orderstatus int, o_note string, o_totalprice double")
    drifting = [row.column_name for row in report.where("actual IS NOT NULL").collect()]
    counts = orders.agg(*(F.count(c).alias(c) for c in drifting))
    held = counts.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, drifting)), F.array(*map(F.col, drifting)))).alias("column_name", "n"))
    return report.join(held, "column_name", "left").select(
        "column_name", "expected", "actual", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_values")
    )


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
    "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate FROM orders"
)
def prewrite_prune_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = "o_orderkey string, o_totalprice decimal(18,2), o_orderdate date, absent string"
    landed = conform(_table(spark, sf_dir, "orders"), expected, "cast")
    return landed.select(*(F.col(c).cast("string").alias(c) for c in landed.columns))


_LINE_UPDATES = (
    "SELECT l_orderkey * 2 AS k, max((l_shipdate, l_linestatus)) AS r FROM lineitem GROUP BY 1"
)


def _line_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many updates per order, half of them for orders that do not exist."""
    return _table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 2).alias("o_orderkey"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("o_orderdate"),
    )


@query(
    f"WITH u AS ({_LINE_UPDATES}) SELECT coalesce(k, o_orderkey) AS o_orderkey, "
    "CASE WHEN k IS NOT NULL THEN r[2] ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN k IS NOT NULL THEN CAST(r[1] AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate "
    "FROM orders FULL OUTER JOIN u ON o_orderkey = k"
)
def sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "upsert")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    upsert_into(spark, base, orders, ["o_orderkey"], "run_1", unique=True)
    upsert_into(spark, base, _line_updates(spark, sf_dir), ["o_orderkey"], "run_2", ["o_orderdate"])
    return read_current(spark, base)


@query(
    f"WITH u AS ({_LINE_UPDATES}) SELECT coalesce(k, o_orderkey) AS o_orderkey, o_totalprice, "
    "CASE WHEN k IS NOT NULL THEN r[2] ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN k IS NOT NULL THEN CAST(r[1] AS TIMESTAMP) ELSE o_orderdate END AS o_orderdate "
    "FROM orders FULL OUTER JOIN u ON o_orderkey = k"
)
def sink_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "merge")
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate"
    )
    upsert_into(spark, base, orders, ["o_orderkey"], "run_1", unique=True)
    upsert_into(
        spark, base, _line_updates(spark, sf_dir), ["o_orderkey"], "run_2", ["o_orderdate"], mode="merge"
    )
    return read_current(spark, base)


@query(
    "WITH top AS (SELECT max(o_totalprice) * 0.99 AS price FROM orders) SELECT o_orderkey, "
    "CASE WHEN o_totalprice >= price THEN 'X' ELSE o_orderstatus END AS o_orderstatus, "
    "CASE WHEN o_totalprice >= price THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice FROM orders, top"
)
def sink_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few keys of a table in 32 buckets change, first whole rows, then one column."""
    base = scratch_path(spark, "upsert-buckets")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    top = orders.agg((F.max("o_totalprice") * 0.99).alias("price"))
    costly = orders.join(F.broadcast(top), F.col("o_totalprice") >= F.col("price")).drop("price")
    upsert_into(spark, base, orders, ["o_orderkey"], "run_1", unique=True, buckets=32)
    halved = costly.withColumn("o_totalprice", F.col("o_totalprice") / 2)
    upsert_into(spark, base, halved, ["o_orderkey"], "run_2", unique=True)
    marked = costly.select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    upsert_into(spark, base, marked, ["o_orderkey"], "run_3", unique=True, mode="merge")
    return read_current(spark, base)


@query("SELECT * FROM supplier")
def passthrough_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = land(_table(spark, sf_dir, "supplier"), scratch_path(spark, "copy-source"))
    target = scratch_path(spark, "copy-target")
    copy_files(spark, source, target)
    return read_files(spark, target)


# Run state


@query(
    "SELECT event_type AS dag_id, CAST(arg_max(event_id, (ts, event_id)) AS VARCHAR) AS checkpoint_to, "
    "max(ts) AS updated_at FROM events GROUP BY event_type"
)
def checkpoint_store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _file(spark, sf_dir, "events").select(
        F.col("event_type").alias("dag_id"),
        F.col("event_id").cast("string").alias("checkpoint_to"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )
    return latest_checkpoints(log)


def _run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("dag_id"),
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.col("user_id").alias("record_count"),
        published_text(F.col("ts")).alias("at"),
    )


_PAYLOAD = ["dag_id", "run_id", "status", "record_count"]
_ATTRIBUTES = {"service": "landing"}
_AT_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00')"
_BODY_SQL = (
    "'dag_id': event_type, 'run_id': 'run-' || event_id, "
    "'status': CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, 'record_count': user_id"
)


@query(
    f"SELECT event_id, CAST(to_json({{{_BODY_SQL}, 'service': 'landing', 'published_at': {_AT_SQL}}}) AS VARCHAR) "
    "AS value FROM events"
)
def run_event_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = event_envelope(_run_events(spark, sf_dir), _PAYLOAD, _ATTRIBUTES, F.col("at"))
    return sent.select("event_id", F.col("value").cast("string").alias("value"))


@query(
    "SELECT event_id, unnest(['dag_id', 'run_id', 'status', 'record_count', 'service', 'published_at']) AS field, "
    "unnest([event_type, 'run-' || event_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END, "
    f"CAST(user_id AS VARCHAR), 'landing', {_AT_SQL}]) AS value FROM events"
)
def run_event_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_event(_run_events(spark, sf_dir), _PAYLOAD, _ATTRIBUTES, F.col("at"))
    return flat.select("event_id", F.explode("fields").alias("field", "value"))


@query(
    "SELECT event_id, 'https://queue/landing' AS queue_url, "
    f"CAST(to_json({{{_BODY_SQL}}}) AS VARCHAR) AS body, "
    f"'String' AS service_type, 'landing' AS service, {_AT_SQL} AS published_at FROM events"
)
def run_event_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = queue_message(
        _run_events(spark, sf_dir), _PAYLOAD, "https://queue/landing", _ATTRIBUTES, F.col("at")
    )
    message = F.col("message")
    attributes = message["MessageAttributes"]
    return sent.select(
        "event_id",
        message["QueueUrl"].alias("queue_url"),
        message["MessageBody"].alias("body"),
        attributes["service"]["DataType"].alias("service_type"),
        attributes["service"]["StringValue"].alias("service"),
        attributes["published_at"]["StringValue"].alias("published_at"),
    )


@query(
    "SELECT event_id, event_type, ts FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn <= 1000"
)
def run_event_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _file(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return retain_latest(events, "event_type", ["ts", "event_id"])


@query(
    "SELECT event_id, event_type, ts FROM (SELECT *, row_number() OVER "
    "(PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn <= 1500"
)
def run_event_retention_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows per stream than Spark trims by rank: kept by position instead."""
    events = _file(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return retain_latest(events, "event_type", ["ts", "event_id"], 1500)


# End to end


def _orders_spec(sf_dir: str, endpoint: str) -> PipelineSpec:
    return PipelineSpec.from_dict(
        "orders_landing",
        {
            "read_type": "connector",
            "write_type": "hadoop",
            "count_records": True,
            "source": {
                "format": "parquet",
                "read_options": {"path": f"{sf_dir}/orders.parquet"},
                "database": "erp",
                "schema": "public",
                "table": "orders",
                "checkpoint_column": "o_orderdate",
            },
            "sink": {"endpoint": endpoint, "source_system_name": "pg"},
        },
    )


@query(
    "SELECT CASE WHEN o_orderdate <= TIMESTAMP '1996-01-01 00:00:00' THEN 'run_1' "
    "WHEN o_orderdate <= TIMESTAMP '1997-01-01 00:00:00' THEN 'run_2' ELSE 'run_3' END AS run_id, "
    "count(*) AS record_count, CASE min(CASE WHEN o_orderdate <= TIMESTAMP '1996-01-01 00:00:00' THEN 1 "
    "WHEN o_orderdate <= TIMESTAMP '1997-01-01 00:00:00' THEN 2 ELSE 3 END) "
    "WHEN 1 THEN '1996-01-01 00:00:00' WHEN 2 THEN '1997-01-01 00:00:00' "
    "ELSE strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') END AS checkpoint_to FROM orders GROUP BY 1"
)
def pipeline_table_to_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "pipeline")
    spec, state = _orders_spec(sf_dir, f"{root}/landing"), RunState(spark, f"{root}/state")
    run_pipeline(spark, spec, state, "run_1", datetime(2024, 1, 15), checkpoint_to=datetime(1996, 1, 1))
    run_pipeline(spark, spec, state, "run_2", datetime(2024, 1, 16), checkpoint_to=datetime(1997, 1, 1))
    run_pipeline(spark, spec, state, "run_3", datetime(2024, 1, 17))
    return state.events().select("run_id", "record_count", "checkpoint_to")


@query(
    "SELECT event_id, ts, CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN 'run_1' "
    "WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'run_2' ELSE 'run_3' END AS run_id FROM events"
)
def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "incremental")
    spec = PipelineSpec.from_dict(
        "events_landing",
        {
            "read_type": "file",
            "write_type": "hadoop",
            "source": {
                "path": f"{sf_dir}/events.parquet",
                "mode": "rows",
                "checkpoint_column": "ts",
            },
            "sink": {"endpoint": f"{root}/landing", "source_system_name": "lake"},
        },
    )
    state = RunState(spark, f"{root}/state")
    run_pipeline(spark, spec, state, "run_1", datetime(2024, 1, 10), checkpoint_to=datetime(2024, 1, 10))
    run_pipeline(spark, spec, state, "run_2", datetime(2024, 1, 20), checkpoint_to=datetime(2024, 1, 20))
    run_pipeline(spark, spec, state, "run_3", datetime(2024, 1, 31))
    landed = "/".join([root, "landing", "lake", *spec.source.segments()])
    return read_landing(spark, landed).select("event_id", "ts", "run_id")


@query(
    "SELECT event_id, ts, CASE WHEN ts > TIMESTAMP '2024-01-20 00:00:00' THEN 'run_3' "
    "WHEN ts > TIMESTAMP '2024-01-10 00:00:00' THEN CASE WHEN event_id % 5 = 0 THEN 'run_3' ELSE 'run_2' END "
    "WHEN event_id % 5 = 0 THEN 'run_2' ELSE 'run_1' END AS run_id FROM events"
)
def pipeline_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth event arrives a run later than its time says; each lands once."""
    root, events = scratch_path(spark, "late"), _file(spark, sf_dir, "events").select("event_id", "ts")
    spec = PipelineSpec.from_dict(
        "late_events",
        {
            "read_type": "connector",
            "write_type": "hadoop",
            "source": {
                "database": "lake",
                "table": "events",
                "format": "parquet",
                "checkpoint_column": "ts",
                "lookback": "30 days",
                "identity": ["event_id"],
            },
            "sink": {"endpoint": f"{root}/landing", "source_system_name": "lake"},
        },
    )
    state, late = RunState(spark, f"{root}/state"), F.col("event_id") % 5 == 0
    arrived = F.lit(False)
    for run, day in enumerate([10, 20], 1):
        bound = F.lit(f"2024-01-{day}").cast(field_type(events, "ts"))
        frame = events.where((~late & (F.col("ts") <= bound)) | arrived)
        run_pipeline(spark, spec, state, f"run_{run}", datetime(2024, 1, day), frame=frame, checkpoint_to=datetime(2024, 1, day))
        arrived = F.col("ts") <= bound
    for run in (3, 4):
        run_pipeline(spark, spec, state, f"run_{run}", datetime(2024, 1, 30), frame=events)
    landed = "/".join([root, "landing", "lake", *spec.source.segments()])
    return read_landing(spark, landed).select("event_id", "ts", "run_id")


@query(
    f"WITH b AS ({_ENDS_SQL}) SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {_KAFKA_SQL}, "
    "CASE WHEN event_id < e // 2 THEN 'run_1' ELSE 'run_2' END AS run_id FROM events JOIN b ON user_id % 3 = p"
)
def pipeline_kafka_to_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, topic = scratch_path(spark, "kafka"), _topic(spark, sf_dir)
    spec = PipelineSpec.from_dict(
        "events_topic",
        {
            "read_type": "kafka",
            "write_type": "hadoop",
            "source": {"topic": "events", "value_format": "json", "value_schema": "k bigint"},
            "sink": {"endpoint": f"{root}/landing", "source_system_name": "broker"},
        },
    )
    state = RunState(spark, f"{root}/state")
    ends = parse_offsets(offset_map_json(end_offsets(topic)).first().offsets)
    half = render_offsets({t: {p: o // 2 for p, o in parts.items()} for t, parts in ends.items()})
    run_pipeline(spark, spec, state, "run_1", datetime(2024, 1, 15), checkpoint_to=half, frame=topic)
    run_pipeline(spark, spec, state, "run_2", datetime(2024, 1, 16), frame=topic)
    landed = read_landing(spark, f"{root}/landing/broker/events")
    return landed.drop("ingestion_date", "ingestion_time")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, 'run_1' AS run_id FROM orders")
def pipeline_file_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "file-copy")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    source = land(orders, f"{root}/drop/orders", partition_by=["o_orderstatus"])
    spec = PipelineSpec.from_dict(
        "orders_drop",
        {
            "read_type": "file",
            "write_type": "hadoop",
            "count_records": True,
            "source": {"path": source},
            "sink": {"endpoint": f"{root}/landing", "source_system_name": "sftp"},
        },
    )
    state = RunState(spark, f"{root}/state")
    run_pipeline(spark, spec, state, "run_1", datetime(2024, 1, 15))
    landed = "/".join([root, "landing", "sftp", *spec.source.segments()])
    return read_landing(spark, landed).drop("ingestion_date", "ingestion_time")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def pipeline_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file tree grows between the runs by files that are older than what was copied before; each arrives once."""
    root = scratch_path(spark, "changed-files")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    spec = PipelineSpec.from_dict(
        "orders_parts",
        {
            "read_type": "file",
            "write_type": "hadoop",
            "source": {"path": f"{root}/drop", "modified_only": True},
            "sink": {"endpoint": f"{root}/landing", "source_system_name": "sftp"},
        },
    )
    # Every status is written before the first run and enters the tree, with its old time, before its own run.
    made = land(orders, f"{root}/made", partition_by=["o_orderstatus"])
    state = RunState(spark, f"{root}/state")
    for run, status in enumerate(["P", "O", "F", None], 1):
        if status is not None:
            move_folder(spark, f"{made}/o_orderstatus={status}", f"{root}/drop/o_orderstatus={status}")
        run_pipeline(spark, spec, state, f"run_{run}", datetime(2024, 1, 15))
    landed = "/".join([root, "landing", "sftp", *spec.source.segments()])
    return read_landing(spark, landed).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("SELECT * FROM events")
def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, events = scratch_path(spark, "stream"), _file(spark, sf_dir, "events")
    drop, progress = f"{root}/drop", f"{root}/progress"
    for low, high in ((None, datetime(2024, 1, 15)), (datetime(2024, 1, 15), None)):
        land(incremental_window(events, "ts", low, high), drop)
        land_stream(stream_files(spark, drop, events.schema), f"{root}/landed", progress)
    return read_landing(spark, f"{root}/landed")
