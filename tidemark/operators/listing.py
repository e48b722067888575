"""Change detection between two listings of a file tree."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.names import free_names


def changed_files(files: DataFrame, seen: DataFrame) -> DataFrame:
    """The rows of a listing that an earlier one lacks: new paths, and known ones with another size or time.

    Times are compared for equality alone, so a file that appears later with an old time counts as new, and one that
    gets an older time counts as changed. An anti join on the three columns: a tree of any size is compared
    by path across all tasks, and the earlier listing is broadcast only where Spark finds it small.
    """
    names = free_names(files.columns, "_seen_path", "_seen_time", "_seen_size")
    old = seen.select("path", "modificationTime", "length").toDF(*names)
    same = (files["path"] == old[names[0]]) & files["modificationTime"].eqNullSafe(old[names[1]])
    return files.join(old, same & files["length"].eqNullSafe(old[names[2]]), "left_anti")
