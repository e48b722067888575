"""Any Spark data source as a bounded read: a format, options and an optional schema."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DEFAULT_FETCH_SIZE = 10_000  # fixed value: rows per round trip unless overridden


@dataclass(frozen=True)
class Read:
    """What to hand to ``spark.read``: built by the presets, executed by :func:`load`."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | str | None = None
    # Conditions of a read over several connections, one for each; together they take every row once.
    predicates: tuple[str, ...] = ()

    def with_options(self, more: Mapping[str, object] | None) -> Read:
        """Later options win, so a user's ``read_options`` override a preset."""
        return Read(self.format, self.options | texts(more), self.schema, self.predicates)


def texts(options: Mapping[str, object] | None) -> dict[str, str]:
    """Option values as Spark expects them; unset ones dropped."""
    out = {}
    for key, value in (options or {}).items():
        if value is not None:
            out[key] = str(value).lower() if isinstance(value, bool) else str(value)
    return out


def load(spark: SparkSession, read: Read) -> DataFrame:
    if read.predicates and read.format == "jdbc":
        options = {k: v for k, v in read.options.items() if k not in ("url", "dbtable")}
        return spark.read.options(**options).jdbc(read.options["url"], read.options["dbtable"], predicates=list(read.predicates))
    reader = spark.read.format(read.format).options(**read.options)
    return (reader.schema(read.schema) if read.schema is not None else reader).load()


def custom_query(df: DataFrame, query: str) -> DataFrame:
    """Run Spark SQL over a frame the query names ``{source}``."""
    return df.sparkSession.sql(query, source=df)
