"""Schema checks and conforming before a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Drift = tuple[str, str, "str | None"]


class SchemaMismatch(ValueError):
    """Raised with every differing column at once."""


def _expected(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def schema_drift(df: DataFrame, schema: T.StructType | str) -> list[Drift]:
    """``(column, expected, actual)`` of each expected column that is absent or typed otherwise.

    Extra columns, column order and nullability do not matter.
    """
    actual = {f.name: f.dataType for f in df.schema}
    return [
        (f.name, f.dataType.simpleString(), actual[f.name].simpleString() if f.name in actual else None)
        for f in _expected(schema)
        if actual.get(f.name) != f.dataType
    ]


def schema_report(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The drift as a frame ``column_name, expected, actual``."""
    return df.sparkSession.createDataFrame(
        schema_drift(df, schema), "column_name string, expected string, actual string"
    )


def validate_schema(df: DataFrame, schema: T.StructType | str | None) -> DataFrame:
    """Return the frame unchanged, or raise :class:`SchemaMismatch`."""
    drift = schema_drift(df, schema) if schema is not None else []
    if drift:
        lines = [f"{name}: expected {want}, found {got or 'nothing'}" for name, want, got in drift]
        raise SchemaMismatch("Schema validation failed\n" + "\n".join(lines))
    return df


def conform(
    df: DataFrame, schema: T.StructType | str | None, on_mismatch: str = "fail"
) -> DataFrame:
    """Prune to the expected columns, in their order, with their types.

    ``fail`` demands equal types first; ``cast`` converts and lets a bad value fail
    the job; ``try_cast`` turns bad values into null. Under the last two, columns
    the frame lacks are skipped.
    """
    if on_mismatch not in ("fail", "cast", "try_cast"):
        raise ValueError(f"unknown on_mismatch {on_mismatch!r}")
    if schema is None:
        return df
    if on_mismatch == "fail":
        validate_schema(df, schema)
    convert = Column.try_cast if on_mismatch == "try_cast" else Column.cast
    present = [f for f in _expected(schema) if f.name in df.columns]
    return df.select(*(convert(F.col(f.name), f.dataType).alias(f.name) for f in present))
