"""Kafka value decoding and offset maps."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OFFSET_MAP = "map<string,map<string,bigint>>"
METADATA = ("key", "topic", "partition", "offset", "timestamp")

OffsetMap = dict[str, dict[int, int]]


def decode_kafka(
    df: DataFrame,
    value_format: str = "json",
    schema: T.StructType | str | None = None,
    *,
    metadata_prefix: str = "",
    malformed: str | None = None,
) -> DataFrame:
    """Decode the binary key and value of Kafka-shaped rows.

    ``binary`` changes nothing. ``json`` with a schema expands the value into
    columns beside the metadata, malformed values giving null fields; ``malformed`` names a
    column that keeps their text. Metadata columns take ``metadata_prefix``; a payload field
    that would still share a name with one is an error. Every other case casts key and value to text.
    """
    if value_format == "binary":
        return df
    text = df.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )
    if value_format != "json" or schema is None:
        return text
    kind = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f"{metadata_prefix}{name}" for name in METADATA]
    clash = {name.lower() for name in names} & {f.name.lower() for f in kind.fields}
    if clash:
        raise ValueError(f"payload fields {sorted(clash)} share a metadata name; set metadata_prefix")
    options = {}
    if malformed is not None:
        kind = T.StructType([*kind.fields, T.StructField(malformed, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed}
    metadata = [F.col(old).alias(new) for old, new in zip(METADATA, names)]
    parsed = text.select(F.from_json("value", kind, options).alias("data"), F.struct(*metadata).alias("record"))
    return parsed.select("data.*", "record.*")


# Types as schema_of_variant writes them, outside of quoted field names.
_VARIANT_TYPES = re.compile(
    r"`(?:[^`]|``)*`|\bOBJECT<|(?:(?<=: )|(?<=ARRAY<))(?:VOID|VARIANT|DECIMAL\(\d+,[1-9]\d*\))(?=[,>]|$)"
)


def _column_type(found: re.Match) -> str:
    text = found[0]
    if text.startswith("`"):
        return text
    if text.startswith("OBJECT"):
        return "STRUCT<"
    return "DOUBLE" if text.startswith("DECIMAL") else "STRING"


def infer_value_schema(df: DataFrame) -> T.StructType:
    """Schema of JSON values, merged over every row inside the tasks, for :func:`decode_kafka`.

    Malformed values do not count. Fractions become doubles, since a decimal just wide
    enough for today's values would lose tomorrow's; fields of mixed type become text. Only
    types are replaced: a field may be called like one.
    """
    parsed = F.try_parse_json(F.col("value").cast("string"))
    found = df.agg(F.schema_of_variant_agg(parsed)).first()[0]
    if not (found or "").startswith("OBJECT<"):
        raise ValueError(f"the values are not JSON objects but {found}")
    return T.DataType.fromDDL(_VARIANT_TYPES.sub(_column_type, found))


def offset_rows(df: DataFrame, column: str) -> DataFrame:
    """Explode a JSON offset map into rows ``topic, partition, offset``."""
    topics = df.select(F.explode(F.from_json(F.col(column), OFFSET_MAP)).alias("topic", "parts"))
    return topics.select("topic", F.explode("parts").alias("p", "offset")).select(
        "topic", F.col("p").cast("int").alias("partition"), "offset"
    )


def parse_offsets(text: str) -> OffsetMap:
    """Offset map from its JSON text."""
    raw = json.loads(text)
    return {topic: {int(p): int(o) for p, o in parts.items()} for topic, parts in raw.items()}


def render_offsets(offsets: OffsetMap) -> str:
    """JSON text of an offset map, topics and partitions as sorted text keys."""
    named = {topic: {str(p): o for p, o in parts.items()} for topic, parts in offsets.items()}
    return json.dumps(named, sort_keys=True)
