"""Incremental windows and filter dictionaries, all left to Catalyst to push down."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.checkpoint import CheckpointValue, field_type, typed_literal


def incremental_window(
    df: DataFrame,
    column: str | None,
    low: CheckpointValue | None,
    high: CheckpointValue | None,
    *,
    need_both: bool = False,
) -> DataFrame:
    """Keep ``low < column <= high``; an equal or regressed window reads nothing.

    Only ``high`` (a first run): everything up to it, and rows without a value,
    which no later window could reach. Only ``low``: everything above it. Neither,
    or no column: the whole frame. ``need_both`` reads the whole frame unless both
    bounds are known.
    """
    if column is None or (need_both and (low is None or high is None)):
        return df
    if low is None and high is None:
        return df
    value, kind = F.col(column), field_type(df, column)
    if low is None:
        return df.where((value <= _bound(df, high, kind)) | _unordered(value, kind))
    floor = _bound(df, low, kind)
    if high is None:
        return df.where(value > floor)
    ceiling = _bound(df, high, kind)
    return df.where((floor < ceiling) & (value > floor) & (value <= ceiling))


def _bound(df: DataFrame, value: CheckpointValue, kind: T.DataType) -> Column:
    """A typed literal, refused when the value does not fit the column.

    With ANSI casts Spark refuses it; without them it would turn into null and the window
    would silently read nothing.
    """
    literal = typed_literal(value, kind)
    spark = df.sparkSession
    if spark.conf.get("spark.sql.ansi.enabled") == "false":
        if spark.range(1).select(literal.isNull()).first()[0]:
            raise ValueError(f"{value!r} is not a {kind.simpleString()} checkpoint")
    return literal


def _unordered(value: Column, kind: T.DataType) -> Column:
    """Rows no window can reach: null, and not-a-number in floating-point columns."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def filter_conjunction(filters: Mapping[str, str]) -> Column:
    """One predicate from ``{"age": "> 18", "status": "= 'active'"}``."""
    terms = [F.expr(f"{column} {test}") for column, test in filters.items()]
    return reduce(Column.__and__, terms, F.lit(True))


def apply_filters(df: DataFrame, filters: Mapping[str, str] | None) -> DataFrame:
    """Apply a filter dictionary; an empty one changes nothing."""
    return df.where(filter_conjunction(filters)) if filters else df
