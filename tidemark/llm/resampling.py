"""Importance resampling towards a target text collection by bit-sliced aggregation.

Every run of one to three words falls into one of 10,000 hash buckets. The bucket counts of a document are kept as bit
planes: bit ``b`` of plane ``j`` is bit ``j`` of the count of bucket ``b``. Corpus counts are vertical sums of
planes (carry-save addition), and the weight of a document, the sum of the gains of its features, is the sum of
``2 ** (j + k) * popcount(plane j & gain plane k)`` over the planes of positive gains less that over the negative ones:
exact in whole numbers.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, NON_WORD, UPPER, staged

BUCKETS, MAX_WORDS = 10_000, 3
#: Documents whose planes are weighed together.
ROWS_AT_ONCE = 512


def _plane_bytes(buckets: int) -> int:
    """Bytes of a plane: whole 64-bit words."""
    return -(-buckets // 64) * 8


def feature_planes(words: list[bytes], buckets: int, max_words: int) -> tuple[int, bytes]:
    """The number of features and the bit planes of their bucket counts, lowest bit first.

    The crc32 of a longer run goes on from that of the shorter one, so no run is ever joined to a string.
    """
    spaced = [b" " + word for word in words]
    sums = list(map(zlib.crc32, words))
    all_sums = [sums]
    for size in range(1, max_words):
        sums = list(map(zlib.crc32, spaced[size:], sums))
        all_sums.append(sums)
    flat = np.concatenate([np.array(s, np.int64) for s in all_sums])
    counts = np.bincount(flat % buckets, minlength=_plane_bytes(buckets) * 8)
    top = int(counts.max()).bit_length()
    planes = [np.packbits((counts >> j & 1).astype(np.uint8), bitorder="little").tobytes() for j in range(top)]
    return len(flat), b"".join(planes)


def with_planes(df: DataFrame, key: str, text: str, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """``key, n_words, n_features, planes`` of every row. Null texts have no words. No shuffle."""
    fold = str.maketrans(UPPER, LOWER)
    split = re.compile(NON_WORD).split

    def planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for t in batch.column(1).to_pylist():
                t = t or ""
                t = t.lower() if t.isascii() else t.translate(fold)
                words = [word.encode() for word in split(t) if word]
                out.append((len(words), *feature_planes(words, buckets, max_words)))
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", "n_words", "n_features", "planes"])

    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return picked.mapInArrow(planes, f"key {kind}, n_words bigint, n_features bigint, planes binary")


class VerticalSum:
    """Sums of bit planes for all buckets at once: plane ``j`` of the sum holds bit ``j`` of every total."""

    def __init__(self) -> None:
        self.planes: list[int] = []

    def add(self, plane: int, level: int) -> None:
        """Adds ``2 ** level`` to every bucket whose bit is set, carrying upwards."""
        while plane:
            while len(self.planes) <= level:
                self.planes.append(0)
            self.planes[level], plane = self.planes[level] ^ plane, self.planes[level] & plane
            level += 1

    def totals(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for level, plane in enumerate(self.planes):
            bits = np.frombuffer(plane.to_bytes(_plane_bytes(buckets), "little"), np.uint8)
            out += np.unpackbits(bits, bitorder="little", count=buckets).astype(np.int64) << level
        return out


def bucket_totals(planes: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows: one vertical sum in every task, then a sum for each bucket.

    What reaches the driver is one number for each bucket, whatever the size of the table.
    """
    size = _plane_bytes(buckets)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = VerticalSum()
        for batch in batches:
            for data in batch.column(0).to_pylist():
                for level in range(len(data) // size):
                    total.add(int.from_bytes(data[level * size : (level + 1) * size], "little"), level)
        counts = total.totals(buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    rows = planes.select("planes").mapInArrow(add_up, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """What a feature of each bucket adds to a weight: the smoothed log ratio of its shares, in thousandths."""
    buckets = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log((float(t) + 1) * (s_all + buckets) / ((float(s) + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ]


def gain_planes(gain: list[int]) -> list[tuple[int, np.ndarray]]:
    """Planes of the gains' magnitudes with their factors, ``2 ** k`` where gains are positive and ``-2 ** k`` else."""
    out = []
    size = _plane_bytes(len(gain)) * 8
    for sign in (1, -1):
        part = np.zeros(size, np.int64)
        part[: len(gain)] = [max(sign * g, 0) for g in gain]
        for k in range(int(part.max()).bit_length()):
            bits = np.packbits((part >> k & 1).astype(np.uint8), bitorder="little")
            out.append((sign * (1 << k), bits.view(np.uint64)))
    return out


def weights_of(data: list[bytes], signed: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """The weight of each row from its planes."""
    size = _plane_bytes(buckets)
    levels = np.array([len(planes) // size for planes in data], np.int64)
    matrix = np.frombuffer(b"".join(data), np.uint64).reshape(-1, size // 8)
    sums = np.zeros(len(matrix), np.int64)
    for factor, gain in signed:
        sums += factor * np.bitwise_count(matrix & gain).sum(axis=1, dtype=np.int64)
    ends = np.cumsum(levels)
    level = np.arange(len(matrix)) - np.repeat(ends - levels, levels)
    running = np.concatenate(([0], np.cumsum(sums << level)))
    return running[ends] - running[ends - levels]


def with_weights(planes: DataFrame, gain: list[int]) -> DataFrame:
    """``key, n_words, n_features, weight``: the sum of the gains of a row's features."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = gain_planes(gain)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                weight = weights_of(part.column(3).to_pylist(), signed, buckets)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(weight)], ["key", "n_words", "n_features", "weight"])

    kind = planes.schema["key"].dataType.simpleString()
    return planes.mapInArrow(weigh, f"key {kind}, n_words bigint, n_features bigint, weight bigint")


def _scale(score):
    """A bin of ``score`` that never falls as the score rises; there are fewer than 90,000 bins of 64-bit scores."""
    return F.floor(F.signum(score.cast("double")) * F.log1p(F.abs(score.cast("double"))) * 1000)


def ranked(scored: DataFrame, drawn: int, chosen: str = "eligible") -> DataFrame:
    """``scored`` plus ``rank``: 1, 2, 3, ... for the ``drawn`` highest scores of the ``chosen`` rows, else null.

    Ties go to the smaller key, null keys last. A histogram over a bounded number of score bins finds the bin in which the draw
    ends; only rows from there on are sorted, by ranges, and positions are counted across the partitions. Equal rows are
    told apart by their row number, so no range holds more than others. ``scored`` must be staged.
    """
    bins = scored.where(F.col(chosen)).groupBy(_scale(F.col("score")).alias("bin")).agg(F.count("*").alias("n")).collect()
    left, cut = drawn, None
    for row in sorted(bins, key=lambda row: row["bin"], reverse=True):
        if left <= 0:
            break
        left, cut = left - row["n"], row["bin"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select("*", none)
    high = F.col(chosen) & (_scale(F.col("score")) >= cut)
    order = [F.desc("score"), F.col("key").isNull(), F.col("key"), F.desc("weight"), F.col("row")]
    slots = max(scored.sparkSession.sparkContext.defaultParallelism, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = scored.where(high).withColumn("row", F.monotonically_increasing_id())
    spread = numbered.repartitionByRange(slots, *order).sortWithinPartitions(*order)
    placed = staged(spread.withColumn("at", F.monotonically_increasing_id()), "resampling-order")
    counts = placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect()  # one row a partition
    before, offsets = 0, []
    for row in sorted(counts, key=lambda row: row["part"]):
        offsets.append((row["part"], before))
        before += row["n"]
    starts = F.broadcast(scored.sparkSession.createDataFrame(offsets, "part long, before long"))
    placed = placed.join(starts, F.shiftright(placed["at"], 33) == starts["part"], "left")
    position = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    placed = placed.select(*scored.columns, F.when(position <= drawn, position).cast("long").alias("rank"))
    return placed.unionByName(scored.where(~F.coalesce(high, F.lit(False))).select("*", none))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = 5,
    min_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """``key, n_features, weight, score, rank`` of every document of ``docs``, drawn towards ``target``.

    ``score`` is the weight plus a Gumbel number that follows from the seed and the key alone; ``floor(percent * N / 100)`` of the N
    documents with ``min_words`` words are drawn, highest scores first (ties to smaller keys, then greater weights; rows equal in
    all that in any order), without replacement. All counts cover all rows of both tables and whole texts. Null
    and empty texts have no features and weight 0; a null key takes the number of the seed alone and loses ties; repeated keys are
    rows of their own; other columns are not looked at. An empty ``docs`` gives an empty result, an
    empty ``target`` gains against no counts.
    """
    planes = staged(with_planes(docs, key, text, buckets, max_words), "resampling-planes")
    aims = with_planes(target.select(F.col(f"`{target_text}`").alias("text")).withColumn("key", F.lit(0)), "key", "text", buckets, max_words)
    gain = gains(bucket_totals(planes, buckets), bucket_totals(aims, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    noise = F.floor(-1000 * F.log(-F.log(uniform)))
    scored = with_weights(planes, gain).select(
        "key", "n_features", "weight", (F.col("weight") + noise).alias("score"), (F.col("n_words") >= min_words).alias("eligible")
    )
    scored = staged(scored, "resampling-scores")
    drawn = percent * scored.where(F.col("eligible")).count() // 100
    out = ranked(scored, drawn).select(F.col("key").alias(key), "n_features", "weight", "score", "rank")
    return out
