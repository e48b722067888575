"""Relational sources over Spark's JDBC reader."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.connector import DEFAULT_FETCH_SIZE, Read, load, texts

PARTITION_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


@dataclass(frozen=True)
class Dialect:
    """Driver class and URL form of one database; add one to support another."""

    driver: str
    url: str

    def address(self, host: str, port: int, database: str) -> str:
        return self.url.format(host=host, port=port, database=database)


# Driver classes and URL forms the databases define.
DIALECTS: dict[str, Dialect] = {
    "sql": Dialect("org.postgresql.Driver", "jdbc:postgresql://{host}:{port}/{database}"),
    "mysql": Dialect(
        "com.mysql.cj.jdbc.Driver",
        "jdbc:mysql://{host}:{port}/{database}?useSSL=false&allowPublicKeyRetrieval=true",
    ),
}


def jdbc_read(
    dialect: Dialect,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    credentials: Mapping[str, str] | None = None,
    fetch_size: int = DEFAULT_FETCH_SIZE,
    schema: str | None = None,
    read_options: Mapping[str, object] | None = None,
) -> Read:
    """Options of one JDBC read.

    A custom query takes the place of the table. The table is named as such rather than
    wrapped in ``SELECT *``, so Spark pushes filters, columns and window bounds itself.
    ``schema`` (DDL) becomes ``customSchema``, the form this source accepts.
    """
    if bool(table) == bool(query):
        raise ValueError("give either a table or a query")
    who = credentials or {}
    options = texts(
        {
            "url": url,
            "driver": dialect.driver,
            "dbtable": table if table else f"({query}) AS subq",
            "user": who.get("username"),
            "password": who.get("password"),
            "fetchsize": fetch_size,
            "customSchema": schema,
        }
    )
    read = Read("jdbc", options).with_options(read_options)
    given = [name for name in PARTITION_OPTIONS if name in read.options]
    if given and "partitionColumn" in given and len(given) != len(PARTITION_OPTIONS):
        raise ValueError(f"a partitioned read needs all of {', '.join(PARTITION_OPTIONS)}")
    return read


def max_query(read: Read, column: str) -> Read:
    """The same read reduced to ``MAX(column)`` inside the database."""
    return _aggregate(read, f"MAX({column}) AS checkpoint_to")


def count_query(read: Read) -> Read:
    """The same read reduced to ``COUNT(*)`` inside the database."""
    return _aggregate(read, "COUNT(*) AS cnt")


def bounds_query(read: Read, column: str) -> Read:
    """The same read reduced to the smallest and largest split value."""
    return _aggregate(read, f"MIN({column}) AS low, MAX({column}) AS high")


def _aggregate(read: Read, columns: str) -> Read:
    dropped = {"dbtable", "customSchema", *PARTITION_OPTIONS}
    kept = {k: v for k, v in read.options.items() if k not in dropped}
    return Read("jdbc", kept | {"query": f"SELECT {columns} FROM {read.options['dbtable']}"})


def split_options(column: str, low: object, high: object, partitions: int) -> dict[str, str]:
    """Options of a parallel read between two bounds; empty when the table is empty.

    The bounds only place the cuts: rows outside them are still read. Pick a unique column,
    since a single repeated value cannot be cut.
    """
    if low is None or high is None:
        return {}
    if isinstance(low, Decimal) and isinstance(high, Decimal):
        # Spark's reader wants whole numbers: the whole ones around them.
        low, high = math.floor(low), math.ceil(high)
    return texts(
        {
            "partitionColumn": column,
            "lowerBound": low,
            "upperBound": high if high != low else _after(high),
            "numPartitions": partitions,
        }
    )


def _after(value: object) -> object:
    return value + 1 if isinstance(value, int) else value


def split_read(spark: SparkSession, read: Read, column: str, partitions: int) -> Read:
    """Turn a one-connection read into ``partitions`` parallel ones.

    One MIN/MAX query in the database supplies the bounds.
    """
    row = load(spark, bounds_query(read, column)).first()
    return read.with_options(split_options(column, row["low"], row["high"], partitions))


def split_predicates(column: str, low: int, high: int, partitions: int) -> list[str]:
    """One condition per slice of a read cut into equal widths between two whole bounds.

    The outer slices are open and nulls go with the first, so every row is in exactly one.
    Read through them (``table.where(...)``, or a reader's ``predicates``) where a source has no
    partitioned read of its own.
    """
    width = high - low + 1
    cuts = [low - (-i * width // partitions) for i in range(1, partitions)]
    if not cuts:
        return ["TRUE"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def _sql_literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    return f"DATE '{value.isoformat()}'" if isinstance(value, date) else str(value)


def equi_depth_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """One condition per slice of a read cut at quantiles, so that slices hold about as many rows whatever the values are.

    ``cuts`` are quantiles of the column by equal steps. A value that stands at several of them fills whole slices and
    gets one of its own, as nulls do; the outer slices are open. Every row is in exactly one slice, also rows that came
    after the cuts were made.
    """
    known = sorted(c for c in cuts if c is not None)
    if not known:
        return ["TRUE"]
    places = sorted(set(known))
    heavy = {c for c in places if known.count(c) > 1}
    out, start = [], ""
    for cut in places:
        text = _sql_literal(cut)
        out.append(f"{start}{column} < {text}")
        if cut in heavy:
            out.append(f"{column} = {text}")
        start = f"{column} {'>' if cut in heavy else '>='} {text} AND "
    return [*out, start.removesuffix(" AND "), f"{column} IS NULL"]


def cuts_query(read: Read, column: str, partitions: int) -> Read:
    """The same read reduced to the smallest value of each of ``partitions`` equal shares of its rows."""
    kept = {k: v for k, v in read.options.items() if k not in {"dbtable", "customSchema", *PARTITION_OPTIONS}}
    tiles = f"SELECT {column} AS cut, NTILE({partitions}) OVER (ORDER BY {column}) AS tile FROM {read.options['dbtable']} WHERE {column} IS NOT NULL"
    return Read("jdbc", kept | {"query": f"SELECT MIN(cut) AS cut FROM ({tiles}) AS tiles GROUP BY tile"})


def even_split_read(spark: SparkSession, read: Read, column: str, partitions: int) -> Read:
    """Turn a one-connection read into parallel ones of about equal numbers of rows.

    The database is asked once for the cuts, by an index scan or a sort of the column there; one row for each
    slice comes back. The smallest value of all is no cut.
    """
    cuts = sorted(row["cut"] for row in load(spark, cuts_query(read, column, partitions)).collect())
    return replace(read, predicates=tuple(equi_depth_predicates(column, cuts[1:])))


def column_cuts(df: DataFrame, column: str, partitions: int, accuracy: int = 10_000) -> list[object]:
    """Inner quantiles of a column by equal steps, from one scan that combines digests in each task."""
    steps = [i / partitions for i in range(1, partitions)]
    if not steps:
        return []
    return df.agg(F.percentile_approx(column, steps, accuracy)).first()[0] or []


def sliced(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """A frame read slice by slice: each condition reaches a scan of its own, which skips what lies outside."""
    return reduce(DataFrame.unionByName, (df.where(condition) for condition in predicates))


def read_jdbc(spark: SparkSession, read: Read) -> DataFrame:
    """Run a JDBC read."""
    return load(spark, read)


def jdbc_schema(spark: SparkSession, read: Read) -> T.StructType:
    """Schema of the table or query; Spark asks the database for it without rows."""
    return load(spark, read).schema
