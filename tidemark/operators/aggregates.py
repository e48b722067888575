"""High-water marks and counts: partial aggregation in every task, one row out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checkpoint import field_type, utc_text


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """One row ``checkpoint_to``: the largest value of the checkpoint column.

    Not-a-number sorts above everything in Spark and would end all later windows, so it
    does not count.
    """
    return df.agg(_largest(df, column).alias("checkpoint_to"))


def _largest(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(field_type(df, column), (T.FloatType, T.DoubleType)):
        return F.max(F.when(~F.isnan(value), value))
    return F.max(value)


def high_water_text(df: DataFrame, column: str) -> str | None:
    """Lossless text of the high-water mark; null when there is no value at all.

    A timestamp with time-zone meaning is rendered with its UTC offset, so a
    change of session time zone or of summer time cannot move the window.
    """
    kind = field_type(df, column)
    if isinstance(kind, T.BooleanType):
        raise TypeError(f"column {column!r} is boolean and cannot be a checkpoint")
    top = _largest(df, column)
    if isinstance(kind, T.TimestampType):
        micros = df.agg(F.unix_micros(top)).first()[0]
        return None if micros is None else utc_text(micros)
    return df.agg(top.cast("string")).first()[0]


def record_count(df: DataFrame) -> DataFrame:
    """One row ``cnt``."""
    return df.agg(F.count(F.lit(1)).alias("cnt"))
