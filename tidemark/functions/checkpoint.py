"""Checkpoint values: parsing, literals and a tagged JSON form.

A checkpoint travels as text and is cast to the type of the column it bounds,
so integers, decimals, timestamps and zero-padded strings all keep full
precision.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import free_names

CheckpointValue = Union[int, float, Decimal, date, datetime, str]

# The tags of the JSON form.
TAG_INT, TAG_TS, TAG_STR = "int", "ts", "str"

# The texts read as an integer, and as an ISO date or timestamp.
_INT_TEXT = r"^[+-]?[0-9]+$"
_ISO_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)


def checkpoint_text(value: CheckpointValue | None) -> str | None:
    """Lossless text of a driver-side checkpoint value."""
    if value is None:
        return None
    if isinstance(value, bool):
        raise TypeError(f"a boolean cannot be a checkpoint: {value!r}")
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return value if isinstance(value, str) else str(value)


def typed_literal(value: CheckpointValue, data_type: T.DataType) -> Column:
    """A foldable literal of exactly ``data_type``.

    Matching the column's own type keeps casts off the column, which is what lets
    Catalyst push the comparison into Parquet, ORC and JDBC scans.
    """
    if isinstance(data_type, T.BooleanType):
        raise TypeError("a boolean column cannot carry a checkpoint")
    return F.lit(checkpoint_text(value)).cast(data_type)


def field_type(df: DataFrame, column: str) -> T.DataType:
    """Type of a (possibly nested) column, resolved by the analyzer."""
    return df.select(F.col(column)).schema[0].dataType


def _read_text(df: DataFrame, text: Column) -> tuple[DataFrame, Column, Column, Column]:
    """Text as integer, else ISO timestamp, else itself.

    Each step is a column of its own, so no branch repeats the work of another. A pattern
    guards each cast, because a failing cast costs an exception per row.
    """
    text_, int_, ts_ = free_names(df.columns, "_text", "_int", "_ts")
    df = df.withColumn(text_, F.trim(text))
    raw, dashed = F.col(text_), F.substring(text_, 5, 1) == "-"
    df = df.withColumn(int_, F.when(raw.rlike(_INT_TEXT), raw.try_cast("bigint")))
    stamp = F.col(int_).isNull() & dashed & raw.rlike(_ISO_TEXT)
    df = df.withColumn(ts_, F.when(stamp, raw.try_cast("timestamp")))
    plain = F.when(F.col(int_).isNull() & F.col(ts_).isNull(), raw)
    return df, F.col(int_), F.col(ts_), plain


def parse_checkpoint(df: DataFrame, column: str, into: str = "checkpoint") -> DataFrame:
    """Add ``into`` = ``struct<t, as_int, as_ts, as_str>`` for any stored checkpoint.

    Numbers are truncated to whole values, timestamps and dates are kept, text
    is trimmed and read as an integer, else as an ISO timestamp, else left as is.
    Null stays null. A boolean column is refused while the plan is built.
    """
    kind, raw, none = field_type(df, column), F.col(column), F.lit(None)
    if isinstance(kind, T.BooleanType):
        raise TypeError(f"column {column!r} is boolean and cannot hold a checkpoint")
    columns = df.columns
    if isinstance(kind, T.NumericType):
        as_int, as_ts, as_str = raw, none, none
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        as_int, as_ts, as_str = none, raw, none
    else:
        df, as_int, as_ts, as_str = _read_text(df, raw.cast("string"))
    tag = (
        F.when(as_int.isNotNull(), TAG_INT)
        .when(as_ts.isNotNull(), TAG_TS)
        .when(as_str.isNotNull(), TAG_STR)
    )
    parts = F.struct(
        tag.alias("t"),
        as_int.cast("bigint").alias("as_int"),
        as_ts.cast("timestamp").alias("as_ts"),
        as_str.cast("string").alias("as_str"),
    )
    return df.select(*columns, F.when(raw.isNotNull(), parts).alias(into))


def format_checkpoint(column: Column, data_type: T.DataType) -> Column:
    """SQL literal text: timestamps quoted with a blank between date and time, the rest plain.

    Fractions of a second appear only when present, always with six digits.
    """
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        micros = F.date_format(column, "SSSSSS")
        text = F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))
        return F.when(column.isNotNull(), F.concat(F.lit("'"), text, F.lit("'")))
    return column.cast("string")


def encode_checkpoint(parsed: Column) -> Column:
    """Tagged JSON ``{"t": …, "v": …}`` of a :func:`parse_checkpoint` struct."""
    stamp = F.date_format(parsed["as_ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    stamp = F.regexp_replace(stamp, r"\.000000$", "")

    def tagged(value: Column) -> Column:
        return F.to_json(F.struct(parsed["t"].alias("t"), value.alias("v")))

    return (
        F.when(parsed["t"] == TAG_INT, tagged(parsed["as_int"]))
        .when(parsed["t"] == TAG_TS, tagged(stamp))
        .when(parsed["t"] == TAG_STR, tagged(parsed["as_str"]))
    )


def decode_checkpoint(df: DataFrame, column: str, into: str = "checkpoint") -> DataFrame:
    """Inverse of :func:`encode_checkpoint`; an unknown tag or a non-object gives null."""
    (raw,) = free_names(df.columns, "_raw")
    tagged = df.withColumn(raw, F.from_json(column, "t string, v string"))
    tag, value = F.col(raw)["t"], F.col(raw)["v"]
    parts = F.struct(
        tag.alias("t"),
        F.when(tag == TAG_INT, value.try_cast("bigint")).alias("as_int"),
        F.when(tag == TAG_TS, value.try_cast("timestamp")).alias("as_ts"),
        F.when(tag == TAG_STR, value).alias("as_str"),
    )
    known = F.when(tag.isin(TAG_INT, TAG_TS, TAG_STR), parts)
    return tagged.select(*df.columns, known.alias(into))


def utc_text(micros: int) -> str:
    """ISO text with an explicit UTC offset, safe in any session time zone."""
    seconds, rest = divmod(micros, 1_000_000)
    moment = datetime.fromtimestamp(seconds, tz=timezone.utc).replace(microsecond=rest)
    return moment.isoformat(sep=" ")
