"""Keep the newest entries of every stream, exactly, however large one stream is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import free_names
from tidemark.session import scratch_path

# Fixed value: the stream length kept when nothing else is asked for.
DEFAULT_MAX_LEN = 1000

# Rows of one stream are spread over this many groups before the final ranking.
SALTS = 256
# Spark trims ranked groups before the shuffle only up to this length (its own default).
WINDOW_LIMIT = 1000
_POSITION_BITS = 33
# Quantiles by which a stream is cut, and how exact they are; cuts that miss are found by counting and not used.
_CUTS, _ACCURACY = 128, 2000
# Streams whose cuts are sent to every task; with more of them the cuts are joined as Spark sees fit.
_BROADCAST_STREAMS = 50_000


def retain_latest(
    df: DataFrame,
    stream: str,
    order_by: Sequence[str],
    max_len: int | None = DEFAULT_MAX_LEN,
) -> DataFrame:
    """The ``max_len`` newest rows per stream by ``order_by``, largest first; null keeps all.

    ``order_by`` must end in a unique column for the result to be exact under ties.
    """
    if max_len is None:
        return df
    if max_len <= 0:
        return df.limit(0)
    if max_len <= WINDOW_LIMIT:
        return _two_level(df, stream, order_by, max_len)
    value = _cut_value(df, order_by[0])
    if value is None:
        return _by_position(df, stream, order_by, max_len)
    return _by_selection(df, stream, order_by, max_len, value)


def _two_level(df: DataFrame, stream: str, order_by: Sequence[str], n: int) -> DataFrame:
    """Top n per (stream, salt), then top n per stream.

    The salt is the task number, so every task feeds one group per stream and Spark's
    group limit trims it to n rows before the shuffle. Any assignment of salts gives
    the same answer.
    """
    newest = [F.col(c).desc() for c in order_by]
    salt, rank = free_names(df.columns, "_salt", "_rn")
    salted = df.withColumn(salt, F.spark_partition_id() % SALTS)
    near = Window.partitionBy(stream, salt).orderBy(*newest)
    far = Window.partitionBy(stream).orderBy(*newest)
    first = salted.withColumn(rank, F.row_number().over(near)).where(F.col(rank) <= n)
    last = first.withColumn(rank, F.row_number().over(far)).where(F.col(rank) <= n)
    return last.select(*df.columns)


def _cut_value(df: DataFrame, column: str) -> Column | None:
    """The first order column as a number that sorts alike, or null for types without one."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    return F.col(column) if isinstance(kind, T.IntegralType) else None


def _by_selection(df: DataFrame, stream: str, order_by: Sequence[str], n: int, value: Column) -> DataFrame:
    """Keep what lies above a cut, and order only the rows around it.

    Approximate quantiles, combined in each task, place two cuts on either side of every stream's n-th newest row; exact counts
    tell whether they do, and how many rows lie above the upper one. Those are kept by a plain filter, and only the rows
    between the cuts (about a hundredth of a stream) are sorted for the rest. A stream whose cuts miss is sorted
    whole, so the result is exact whatever the quantiles are. ``df`` is scanned three times and must give the same rows.
    """
    names = free_names(df.columns, "_value", "_of", "_upper", "_lower", "_left", "_rows")
    at, of, upper, lower, left, total = names
    rows = df.withColumn(at, value.cast("bigint"))
    steps = F.array(*(F.lit(i / _CUTS) for i in range(_CUTS + 1)))
    found = rows.groupBy(F.col(stream).alias(of)).agg(
        F.count(F.lit(1)).alias(total), F.percentile_approx(at, steps, _ACCURACY).alias("q"), F.count(at).alias("known")
    )
    place = F.floor((1 - n / F.col("known")) * _CUTS).cast("int")
    cuts = found.select(
        of,
        total,
        F.when(F.col("known") > n, F.get("q", F.least(place + 2, F.lit(_CUTS)))).alias(upper),
        F.when(F.col("known") > n, F.get("q", F.greatest(place - 1, F.lit(0)))).alias(lower),
    )
    path = scratch_path(df.sparkSession, "retention-cuts")
    cuts.write.parquet(path)
    cuts = df.sparkSession.read.parquet(path)
    small = cuts.count() <= _BROADCAST_STREAMS

    def beside(other: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(other) if small else other, rows[stream].eqNullSafe(other[of]))

    above, inside = F.coalesce(F.col(at) > F.col(upper), F.lit(False)), F.coalesce(F.col(at) >= F.col(lower), F.lit(False))
    counted = beside(cuts.drop(total)).groupBy(of).agg(F.count_if(above).alias("above"), F.count_if(inside).alias("inside"))
    sure = (F.col("above") < n) & (F.col("inside") >= n)
    checked = cuts.join(counted.withColumnRenamed(of, "_again"), F.col(of).eqNullSafe(F.col("_again"))).select(
        of,
        total,
        F.when(sure, F.col(upper)).alias(upper),
        F.when(sure, F.col(lower)).alias(lower),
        (n - F.when(sure, F.col("above")).otherwise(0)).alias(left),
    )
    path = scratch_path(df.sparkSession, "retention-checked")
    checked.write.parquet(path)
    placed = beside(df.sparkSession.read.parquet(path))
    whole = F.col(total) <= n
    kept = placed.where(whole | above).select(*df.columns)
    between = placed.where(~whole & ~above & (F.col(lower).isNull() | inside)).drop(at, of, upper, lower, total)
    return kept.unionByName(_by_position(between, stream, order_by, F.col(left)).select(*df.columns))


def _by_position(df: DataFrame, stream: str, order_by: Sequence[str], n: int | Column) -> DataFrame:
    """Range-sort once, then keep rows by their position counted across range partitions.

    ``n`` may be a column that is the same for all rows of a stream.

    No task ever holds a whole stream. The sorted rows are written to the shared folder
    because the positions must not be computed twice.
    """
    spark = df.sparkSession
    newest = [F.col(c).desc() for c in order_by]
    ranged = df.repartitionByRange(F.col(stream), *newest).sortWithinPartitions(stream, *newest)
    path = scratch_path(spark, "positions")
    pos, part = free_names([*df.columns, "_stream", "_piece", "_first", "_rows", "_before"], "_pos", "_part")
    ranged.withColumn(pos, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(part, F.shiftright(pos, _POSITION_BITS))
    pieces = rows.groupBy(F.col(stream).alias("_stream"), F.col(part).alias("_piece")).agg(
        F.min(pos).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One entry per stream and range partition: a stream's entries number at most the partitions.
    before = Window.partitionBy("_stream").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    match = rows[stream].eqNullSafe(starts["_stream"]) & (rows[part] == starts["_piece"])
    if not isinstance(n, Column):
        starts = starts.where(F.col("_before") < n)
    kept = rows.join(starts, match)
    place = rows[pos] - starts["_first"] + starts["_before"]
    return kept.where(place < n).select(*(rows[c] for c in df.columns))
