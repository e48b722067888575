"""Bounded reads of Kafka-shaped frames by per-partition offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.kafka import OffsetMap, parse_offsets

EARLIEST, LATEST = "earliest", "latest"
# How Spark's Kafka source writes the two sentinels inside a map.
EARLIEST_OFFSET, LATEST_OFFSET = -2, -1

# An offset map holds one entry per topic-partition and comes from the driver, so
# its size is known before planning. Beyond this many entries the join is left to
# Spark, which shuffles and splits skewed partitions.
BROADCAST_ENTRIES = 100_000


def end_offsets(df: DataFrame) -> DataFrame:
    """Rows ``topic, partition, end_offset``: one past the largest offset held."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def offset_map_json(ends: DataFrame) -> DataFrame:
    """One row ``offsets``: the JSON map of all end offsets, keys sorted as text.

    The two collected lists hold topic-partitions, whose number does not grow with the rows.
    """
    entry = F.struct(F.col("partition").cast("string").alias("p"), F.col("end_offset").alias("o"))
    topics = ends.groupBy("topic").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("parts")
    )

    def by_topic(a: Column, b: Column) -> Column:
        return F.when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)

    pairs = F.array_sort(F.collect_list(F.struct("topic", "parts")), by_topic)
    return topics.agg(F.to_json(F.map_from_entries(pairs)).alias("offsets"))


def _offsets(bound: str | None) -> OffsetMap | None:
    return None if bound is None or bound in (EARLIEST, LATEST) else parse_offsets(bound)


def _bounds(start: OffsetMap | None, end: OffsetMap | None) -> list[tuple[str, int, int, int]]:
    """``(topic, partition, from, to)`` of every partition the deciding map names."""
    rows = []
    for topic, parts in (end if end is not None else start or {}).items():
        for partition in parts:
            low = (start or {}).get(topic, {}).get(partition, EARLIEST_OFFSET)
            high = LATEST_OFFSET if end is None else end[topic][partition]
            rows.append((topic, partition, low, high))
    return rows


def offset_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Rows with ``start <= offset < end`` per topic-partition.

    Each bound is a JSON offset map, ``earliest``, ``latest`` or null. A partition
    missing from ``start`` is new and read from its beginning; one missing from ``end``
    did not exist at the snapshot and is left to the next run.
    """
    if start == LATEST:
        return df.limit(0)
    if end == EARLIEST:
        raise ValueError("the end of an offset range cannot be 'earliest'")
    low_map, high_map = _offsets(start), _offsets(end)
    if low_map is None and high_map is None:
        return df
    bounds = _bounds(low_map, high_map)
    if not bounds:
        return df if high_map is None else df.limit(0)
    table = df.sparkSession.createDataFrame(
        bounds, "topic string, partition int, _from bigint, _to bigint"
    )
    if len(bounds) <= BROADCAST_ENTRIES:
        table = F.broadcast(table)
    offset, low, high = F.col("offset"), F.col("_from"), F.col("_to")
    above = low.isNull() | ((low != LATEST_OFFSET) & (offset >= low))
    below = high.isNull() | (high == LATEST_OFFSET) | (offset < high)
    how = "left" if high_map is None else "inner"
    rows = _outer_limits(df, bounds, how).join(table, ["topic", "partition"], how)
    return rows.where(above & below).select(*df.columns)


def _outer_limits(df: DataFrame, bounds: list[tuple[str, int, int, int]], how: str) -> DataFrame:
    """Widest limits over all partitions, as plain predicates a scan of archived records can use."""
    if how != "inner":
        return df
    lowest, highs = min(b[2] for b in bounds), [b[3] for b in bounds]
    if all(b[2] != LATEST_OFFSET for b in bounds) and lowest > 0:
        df = df.where(F.col("offset") >= lowest)
    return df if LATEST_OFFSET in highs else df.where(F.col("offset") < max(highs))
