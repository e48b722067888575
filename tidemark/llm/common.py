"""Helpers shared by the operators: staged tables, row keys, word splitting, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: Letters that contracts fold to lower case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Everything that is neither an ASCII letter, an ASCII digit nor a character beyond ASCII.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader (the path may be one that only Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: lineage ends there.

    Later jobs read finished files, so losing an executor repeats nothing upstream and values
    that depend on evaluation order (row numbers) are fixed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], base: str) -> str:
    """A column name that clashes with none of ``taken`` (Spark compares them without case)."""
    used = {name.lower() for name in taken}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def folded(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else; null becomes empty.

    Texts of ASCII alone take Spark's fast ``lower``; the others are translated letter by letter.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null and for texts without words."""
    return F.filter(F.split(folded(text), NON_WORD), lambda word: word != "")


def connected_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges`` (``a``, ``b`` long).

    Alternates hooking to the smallest neighbouring label with pointer jumping, so rounds grow with the logarithm of
    the longest chain. Every round is a reduction with map-side combination and is staged;
    neither links nor labels leave the executors. Empty edges give an empty result.
    """
    spark = edges.sparkSession
    links = staged(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-links"
    )
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("low"))
        near = near.select("a", F.least("a", "low").alias("low"))
        # Large star: every larger neighbour (and the node itself) points to the smallest of the neighbourhood.
        large = both.join(near, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.unionByName(near.where("low < a").select("a", F.col("low").alias("b"))).where("a <> b").distinct()
        large = staged(large.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")), f"{label}-large")
        # Small star: every smaller neighbour of a node points to the smallest one.
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(least, "b").select(
            F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("b")), F.struct(F.col("low").alias("a"), F.col("a").alias("b")))).alias("e")
        )
        after = staged(small.select("e.a", "e.b").where("a <> b").distinct(), f"{label}-links")
        # Done when every node has one parent and no parent has one itself: a star for each component.
        parents = after.groupBy("b").agg(F.count("*").alias("n"), F.min("a").alias("a"))
        loose = parents.where("n > 1").select(F.lit(1).alias("x")).unionByName(
            after.select("a").distinct().join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select(F.lit(1).alias("x"))
        )
        links = after
        if loose.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("component")))


#: What a worker calls before it serves another operator: each empties a table that an operator keeps from task to task.
DROPS: list[Callable[[], None]] = []


def give_back() -> None:
    """Return memory that a Python worker has freed to the system: workers live on and serve other functions."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]):
    """A task function that does what ``run`` does, then returns what memory it has freed.

    Tables that other operators keep in the worker (``DROPS``) go first.
    """

    def wrapped(batches: Iterator) -> Iterator:
        for drop in DROPS:
            drop()
        give_back()
        yield from run(batches)
        give_back()

    return wrapped


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once for each row, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]
