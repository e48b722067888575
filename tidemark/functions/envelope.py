"""Run-event envelopes for Kafka, Redis Streams and SQS, built as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How consumers of the flat form see an absent value and booleans.
ABSENT, TRUE_TEXT, FALSE_TEXT = "None", "True", "False"

_JSON_SCALARS = (T.StringType, T.BooleanType, T.NumericType)
_NESTED = (T.StructType, T.MapType, T.ArrayType)


def published_now() -> Column:
    """Current time as ISO text in UTC."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return published_text(utc.cast("timestamp_ntz"))


def published_text(utc: Column) -> Column:
    """ISO text of a UTC wall-clock column."""
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _merged(
    df: DataFrame,
    payload: Sequence[str],
    attributes: Mapping[str, str] | None,
    published_at: Column | None,
) -> dict[str, tuple[Column, T.DataType]]:
    """Payload, then attributes, then the publish time; a later name wins in place."""
    text = T.StringType()
    merged = {name: (F.col(name), df.schema[name].dataType) for name in payload}
    merged.update({name: (F.lit(str(v)), text) for name, v in (attributes or {}).items()})
    merged["published_at"] = (published_now() if published_at is None else published_at, text)
    return merged


def _json_ready(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType) or not isinstance(kind, _JSON_SCALARS + _NESTED):
        return column.cast("string")
    return column


def event_envelope(
    df: DataFrame,
    payload: Sequence[str],
    attributes: Mapping[str, str] | None = None,
    published_at: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """Add Kafka ``value`` bytes (and ``key``): one JSON object per row, nulls kept."""
    merged = _merged(df, payload, attributes, published_at)
    fields = [_json_ready(col, kind).alias(name) for name, (col, kind) in merged.items()]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    out = df.withColumn("value", body.cast("binary"))
    return out if key is None else out.withColumn("key", key.cast("string").cast("binary"))


def _flat_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _NESTED):
        text = F.to_json(column)
    elif isinstance(kind, T.BooleanType):
        text = F.when(column, TRUE_TEXT).when(~column, FALSE_TEXT)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(ABSENT))


def flatten_event(
    df: DataFrame,
    payload: Sequence[str],
    attributes: Mapping[str, str] | None = None,
    published_at: Column | None = None,
    into: str = "fields",
) -> DataFrame:
    """Add ``into`` = ``map<string,string>`` for a stream entry; nested values become JSON."""
    pairs: list[Column] = []
    for name, (col, kind) in _merged(df, payload, attributes, published_at).items():
        pairs += [F.lit(name), _flat_text(col, kind)]
    return df.withColumn(into, F.create_map(*pairs))


def queue_message(
    df: DataFrame,
    payload: Sequence[str],
    queue_url: str,
    attributes: Mapping[str, str] | None = None,
    published_at: Column | None = None,
    into: str = "message",
) -> DataFrame:
    """Add ``into`` = ``struct<QueueUrl, MessageBody, MessageAttributes>`` for an SQS send.

    The body holds the payload alone; attributes and the publish time travel beside it.
    """
    published = published_now() if published_at is None else published_at
    body = F.struct(*(_json_ready(F.col(n), df.schema[n].dataType).alias(n) for n in payload))
    pairs: list[Column] = []
    for name, value in [*((attributes or {}).items()), ("published_at", published)]:
        text = value if isinstance(value, Column) else F.lit(str(value))
        pairs += [
            F.lit(name),
            F.struct(F.lit("String").alias("DataType"), text.alias("StringValue")),
        ]
    return df.withColumn(
        into,
        F.struct(
            F.lit(queue_url).alias("QueueUrl"),
            F.to_json(body, {"ignoreNullFields": "false"}).alias("MessageBody"),
            F.create_map(*pairs).alias("MessageAttributes"),
        ),
    )
