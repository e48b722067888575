"""Late rows: windows that overlap what earlier runs have read, less what they have landed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checkpoint import typed_literal, utc_text

_MOMENTS = (T.TimestampType, T.TimestampNTZType, T.DateType)


def earlier_bound(spark: SparkSession, bound: str, kind: T.DataType, lookback: str) -> str:
    """The text of a checkpoint moved back by ``lookback``: an interval (``"3 days"``) or a number."""
    value = typed_literal(bound, kind)
    if isinstance(kind, _MOMENTS):
        moved = (value - F.expr(f"INTERVAL {lookback}")).cast(kind)
    elif isinstance(kind, T.NumericType):
        moved = (value - F.lit(str(lookback)).cast(kind)).cast(kind)
    else:
        raise TypeError(f"a look-back needs a time or a number, not {kind.simpleString()}")
    if isinstance(kind, T.TimestampType):
        return utc_text(spark.range(1).select(F.unix_micros(moved)).first()[0])
    return spark.range(1).select(moved.cast("string")).first()[0]


def _comparable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def identity_of(schema: T.StructType, keys: Sequence[str], column: str) -> list[str]:
    """The columns that tell landed rows apart: the keys, or else every column that can be compared."""
    missing = [c for c in (*keys, column) if c not in schema.names]
    if missing:
        raise ValueError(f"a look-back needs what it compares in the landed rows, which lack {', '.join(missing)}")
    return list(keys) or [f.name for f in schema.fields if f.name != column and _comparable(f.dataType)]


def not_landed(rows: DataFrame, landed: DataFrame, keys: Sequence[str], column: str, *, keyed: bool = False) -> DataFrame:
    """The rows whose key and checkpoint value are not among the landed ones; nulls equal nulls.

    ``keyed`` says that ``landed`` is a table of the newest row for each key: there a row is known when its key has one that is as
    new or newer. An anti join on the keys: repeated rows that have not landed all stay, and only the landed keys, never the
    landed rows, are shuffled or broadcast.
    """
    names = [f"_landed_{i}" for i in range(len(keys))]
    known = landed.select(F.col(column).alias("_landed_at"), *(F.col(k).alias(n) for k, n in zip(keys, names)))
    at = known["_landed_at"] >= rows[column] if keyed else known["_landed_at"] == rows[column]
    pairs: list[Column] = [rows[k].eqNullSafe(known[n]) for k, n in zip(keys, names)]
    return rows.join(known, reduce(Column.__and__, pairs, at), "left_anti")
