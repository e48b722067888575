"""Keyed upsert and column-wise merge over plain files, and versioned tables to hold them.

The updates of a run are small beside the table they change, so both operators are
written as joins whose only possible build side is the updates: Catalyst broadcasts it
when its size statistics allow, and shuffles (splitting skewed keys) when not.

A table lies in hash buckets of its key, each in a folder of its own. A version's manifest names the folder of
every bucket; a change reads and rewrites the buckets its keys fall into and takes the others over as they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import free_names
from tidemark.operators.landing import land, read_landing
from tidemark.operators.state import StateLog, newest, now_utc, sequence_number
from tidemark.session import broadcast_bytes, delete_folder, folder_entries, runtime_conf, stored_bytes

# Formats whose files carry their own column types, as a table that is read back needs.
TYPED_FORMATS = ("parquet", "orc", "avro", "delta")
VERSION_SCHEMA = (
    "version string, path string, updated_at timestamp, seq bigint, buckets int, bytes bigint, "
    "parts array<struct<root: string, held: array<int>>>, columns string"
)
# Rows dealt by bucket may be joined on bucket and key where they are.
_BY_BUCKET = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
# A table without a given number of buckets gets more of them as it outgrows this size for each.
BUCKET_BYTES = 256 << 20


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


def newest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the largest by ``order_by`` (then by the remaining columns).

    A maximum combines inside each task before the shuffle, so a key holding most of
    the rows costs one row per task, and every column travels once. Maps compare as their
    sorted entries; columns that hold maps deeper down break no ties.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [*order_by, *(c for c in rest if c not in order_by)]
    if not rest:
        return df.select(*keys).distinct()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    maps = {c for c in rank if isinstance(kinds[c], T.MapType) and not _holds_map(kinds[c].valueType)}
    plain = [c for c in rank if c in maps or not _holds_map(kinds[c])]
    (row,) = free_names(df.columns, "_row")
    ranked = [(F.array_sort(F.map_entries(c)) if c in maps else F.col(c)).alias(f"c{i}") for i, c in enumerate(plain)]
    if len(plain) < len(rank):
        last = F.max_by(F.struct(*rest), F.struct(*ranked) if ranked else F.lit(0)).alias(row)
        return df.groupBy(*keys).agg(last).select(*keys, f"{row}.*").select(*df.columns)
    last = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias(row))

    def column(name: str) -> Column:
        if name in keys:
            return F.col(name)
        held = F.col(row)[f"c{plain.index(name)}"]
        return (F.map_from_entries(held) if name in maps else held).alias(name)

    return last.select(*(column(c) for c in df.columns))


def _marks(df: DataFrame, keys: Sequence[str], bucket: str | None = None) -> DataFrame:
    """The keys under names of their own, so a join with rows of the same origin is unambiguous."""
    extra = [] if bucket is None else [F.col(bucket).alias("_key_bucket")]
    return df.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)), *extra)


def _same_key(rows: DataFrame, marks: DataFrame, keys: Sequence[str], bucket: str | None = None) -> Column:
    """Null-safe equality of the keys; equal buckets come first, so that rows dealt by bucket can stay where they are."""
    pairs = [] if bucket is None else [rows[bucket] == marks["_key_bucket"]]
    pairs += [rows[k].eqNullSafe(marks[f"_key_{i}"]) for i, k in enumerate(keys)]
    return reduce(Column.__and__, pairs)


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Whole-row upsert: update rows replace the target rows of their key, new keys are added.

    Several updates of one key are first reduced to the newest. Target rows whose key is
    not updated are all kept, repeated keys included; a null key counts as a key. The
    updates are read twice: pass rows at rest, as :func:`upsert_into` does.
    """
    return _replace_rows(target, newest_per_key(updates, keys, order_by), keys)


def _replace_rows(target: DataFrame, fresh: DataFrame, keys: Sequence[str], bucket: str | None = None) -> DataFrame:
    if set(target.columns) != set(fresh.columns):
        raise ValueError("upsert needs the same columns on both sides; use merge_columns")
    marks = _marks(fresh, keys, bucket)
    if bucket is None:
        kept = target.join(marks, _same_key(target, marks, keys), "left_anti")
    else:
        # An anti join would be moved below the deal by bucket, and shuffled there by key.
        marks = marks.withColumn("_hit", F.lit(True))
        both = target.join(marks, _same_key(target, marks, keys, bucket), "left")
        kept = both.where(marks["_hit"].isNull()).select(*(target[c] for c in target.columns))
    return kept.unionByName(fresh)


def merge_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Column-wise merge: updates may carry some of the columns, the others keep their value.

    New keys are inserted with null in the columns the updates lack. As for
    :func:`upsert`, the updates must be rows at rest.
    """
    return _replace_columns(target, newest_per_key(updates, keys, order_by), keys)


def _replace_columns(
    target: DataFrame, fresh: DataFrame, keys: Sequence[str], bucket: str | None = None, *, one_pass: bool = False
) -> DataFrame:
    """``one_pass`` reads the target once, by a full join that has to be shuffled."""
    extra = set(fresh.columns) - set(target.columns)
    if extra:
        raise ValueError(f"columns unknown to the target: {sorted(extra)}")
    changed = [c for c in fresh.columns if c not in keys and c != bucket]
    side = fresh.select(
        *(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)),
        *([] if bucket is None else [F.col(bucket).alias("_key_bucket")]),
        F.struct(*changed).alias("_new"),
        F.lit(True).alias("_hit"),
    )
    on = _same_key(target, side, keys, bucket)
    if one_pass:
        (held,) = free_names(target.columns, "_known")
        known = target.withColumn(held, F.lit(True))
        both = known.join(side, _same_key(known, side, keys, bucket), "full")
        key_of = {k: side[f"_key_{i}"] for i, k in enumerate(keys)}
        if bucket is not None:
            key_of[bucket] = side["_key_bucket"]
        return both.select(
            *(
                F.when(side["_hit"], side["_new"][c]).otherwise(known[c]).alias(c)
                if c in changed
                else F.when(known[held], known[c]).otherwise(key_of[c]).alias(c)
                if c in key_of
                else known[c]
                for c in target.columns
            )
        )
    merged = target.join(side, on, "left").select(
        *(
            F.when(side["_hit"], side["_new"][c]).otherwise(target[c]).alias(c)
            if c in changed
            else target[c]
            for c in target.columns
        )
    )
    # Which updates are new: find the matched keys from the small side, then exclude them.
    wanted = _marks(fresh, keys)
    keyed = target.select(*keys)
    matched = keyed.join(wanted, _same_key(keyed, wanted, keys), "left_semi").distinct()
    known = _marks(matched, keys)
    inserts = fresh.join(known, _same_key(fresh, known, keys), "left_anti")
    return merged.unionByName(inserts, allowMissingColumns=True)


def _versions(spark: SparkSession, base: str) -> DataFrame | None:
    pointer = StateLog(spark, f"{base}/pointer", VERSION_SCHEMA)
    return pointer.read() if pointer.exists() else None


def _newest(entries: DataFrame | None) -> Row | None:
    return None if entries is None else newest(entries, "updated_at", "seq")


def _hashed_kind(kind: T.DataType) -> T.DataType:
    """The type a key is hashed in: whole numbers of all widths fall into the same buckets, and so do floats."""
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    return T.DoubleType() if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else kind


def bucket_column(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of each row, from 0. Equal keys share one, null and minus zero included."""

    def hashed(key: str) -> Column:
        kind = _hashed_kind(df.schema[key].dataType)
        value = F.col(key).cast(kind)
        return F.when(value == 0, F.lit(0.0)).otherwise(value) if isinstance(kind, T.DoubleType) else value

    return F.pmod(F.xxhash64(*(hashed(k) for k in keys)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class _Version:
    """What one row of the pointer says: where the buckets of a version lie."""

    buckets: int
    size: int
    parts: tuple[tuple[str, tuple[int, ...]], ...]
    columns: T.StructType | None

    @classmethod
    def of(cls, entry: Row) -> _Version:
        if entry.buckets is None:  # written before tables had buckets
            return cls(1, 0, ((entry.path, (0,)),), None)
        columns = None if entry.columns is None else T.StructType.fromJson(json.loads(entry.columns))
        return cls(entry.buckets, entry.bytes or 0, tuple((p.root, tuple(p.held)) for p in entry.parts), columns)

    def folders(self, wanted: set[int] | None = None) -> list[str]:
        if self.buckets == 1:
            return [root for root, _ in self.parts]
        return [f"{root}{b}" for root, held in self.parts for b in held if wanted is None or b in wanted]

    def without(self, buckets: set[int]) -> tuple[tuple[str, tuple[int, ...]], ...]:
        left = ((root, tuple(b for b in held if b not in buckets)) for root, held in self.parts)
        return tuple((root, held) for root, held in left if held)

    def read(self, spark: SparkSession, file_format: str, wanted: set[int] | None = None) -> DataFrame:
        folders = self.folders(wanted)
        if not folders and self.columns is not None:
            return spark.createDataFrame([], self.columns)
        reader = spark.read.format(file_format)
        return (reader if self.columns is None else reader.schema(self.columns)).load(folders)


def read_current(
    spark: SparkSession, base: str, file_format: str = "parquet", *, without: str | None = None
) -> DataFrame | None:
    """The version a table's pointer names, or null before the first one.

    ``without`` leaves a version out, as a retry of that one does.
    """
    entries = _versions(spark, base)
    if entries is not None and without is not None:
        entries = entries.where(F.col("version") != without)
    current = _newest(entries)
    return None if current is None else _Version.of(current).read(spark, file_format)


def _nullable(kind: T.DataType) -> T.DataType:
    """The type as files hold it: everything may be null."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType), True)
    return kind


def _bucket_count(given: int | None, before: _Version | None) -> int:
    """The given number, or the table's own, or the next power of two once its buckets have outgrown their size."""
    if given:
        return given
    if before is None:
        return 1
    needed = -(-before.size // BUCKET_BYTES)
    return 1 << (needed - 1).bit_length() if needed > (2 * before.buckets if before.buckets > 1 else 1) else before.buckets


def upsert_into(
    spark: SparkSession,
    base: str,
    updates: DataFrame,
    keys: Sequence[str],
    version: str,
    order_by: Sequence[str] = (),
    *,
    mode: str = "upsert",
    file_format: str = "parquet",
    unique: bool = False,
    buckets: int | None = None,
    observation: Observation | None = None,
) -> str:
    """Write the next version of the table at ``base``, then move its pointer.

    The updates are reduced and written down first, so the join that needs them twice sees
    the same rows both times even over a live source, and plans with their true size. Only the buckets that hold a key of
    theirs are read and rewritten. The table has as many ``buckets`` as are asked for (another number
    than before rewrites it whole), else as its size calls for; small tables are one bucket. A change of column
    types rewrites it whole too, so that all buckets agree.

    Readers see the old version until the pointer row is appended. A retry of the newest
    ``version`` starts again from the one before it and writes to new folders, so nothing a
    reader may hold is touched; an older version is already contained in the table and
    changes nothing. One writer per table is assumed. ``unique`` says that no key occurs twice
    among the updates, as in rows of a table with that primary key; they are then taken as
    they come, without the shuffle that reduces them. An ``observation`` receives
    ``record_count``, the number of keys updated. Returns the folder of what was written.
    """
    if mode not in ("upsert", "merge"):
        raise ValueError(f"unknown mode {mode!r}; use 'upsert' or 'merge'")
    if file_format not in TYPED_FORMATS:
        raise ValueError(f"a keyed table needs one of {', '.join(TYPED_FORMATS)}, not {file_format!r}")
    if file_format == "delta":
        if buckets not in (None, 1):
            raise ValueError("delta tables lie in one folder")
        buckets = 1
    versions, attempt = _versions(spark, base), sequence_number()
    last = _newest(versions)
    if last is not None and last.version != version:
        if not versions.where(F.col("version") == version).isEmpty():
            return last.path
    elif last is not None:
        last = _newest(versions.where(F.col("version") != version))
    before = None if last is None else _Version.of(last)
    path = f"{base}/data/version={version}/attempt={attempt}"
    fresh = updates if unique else newest_per_key(updates, keys, order_by)
    count = _bucket_count(buckets, before)
    if before is None:
        (name,) = free_names(fresh.columns, "_bucket")
        if count > 1:
            fresh = fresh.withColumn(name, bucket_column(fresh, keys, count))
            fresh = fresh.repartition(count, name)
        _write(fresh, path, file_format, name if count > 1 else None, observation)
        table, kept, share = fresh.drop(name).schema, (), 0
    else:
        staged = f"{base}/updates/version={version}/attempt={attempt}"
        land(fresh, staged, file_format, observation=observation)
        settled = read_landing(spark, staged, file_format, fresh.schema)
        change = _replace_rows if mode == "upsert" else _replace_columns
        large = stored_bytes(spark, staged) > broadcast_bytes(spark)
        more = {"one_pass": True} if large and mode == "merge" else {}
        like = before.read(spark, file_format) if before.columns is None else spark.createDataFrame([], before.columns)
        table = change(like, settled, keys).schema
        alike = before.columns is not None and _nullable(table) == _nullable(before.columns)
        if count == 1:
            _write(change(before.read(spark, file_format), settled, keys, **more), path, file_format, None, None)
            kept, share = (), 0
        else:
            (name,) = free_names({*table.names, *settled.columns}, "_bucket")
            settled = settled.select(*(F.col(k).cast(table[k].dataType).alias(k) if k in keys else F.col(k) for k in settled.columns))
            settled = settled.withColumn(name, bucket_column(settled, keys, count))
            touched = None
            if alike and count == before.buckets:
                touched = {row[0] for row in settled.select(name).distinct().collect()}  # at most one row a bucket
            current = before.read(spark, file_format, touched)
            current = current.select(*(F.col(k).cast(table[k].dataType).alias(k) if k in keys else F.col(k) for k in current.columns))
            current = current.withColumn(name, bucket_column(current, keys, count))
            slots = max(1, count if touched is None else len(touched))
            if large:
                # Both sides are dealt by bucket once; join and files follow that deal.
                sides = current.repartition(slots, name), settled.repartition(slots, name)
                changed = change(*sides, keys, name, **more)
            else:
                changed = change(current, settled, keys).repartition(slots, name)
            if touched is None or touched:
                with runtime_conf(spark, _BY_BUCKET):
                    _write(changed, path, file_format, name, None)
            kept = () if touched is None else before.without(touched)
            share = sum(len(held) for _, held in kept) / count
    written = _written_parts(spark, path, count)
    entry = {
        "version": version, "path": path, "updated_at": now_utc(), "seq": attempt, "buckets": count,
        "bytes": stored_bytes(spark, path) + round(share * (before.size if before else 0)),
        "parts": [{"root": root, "held": held} for root, held in (*kept, *written)],
        "columns": _nullable(table).json(),
    }
    StateLog(spark, f"{base}/pointer", VERSION_SCHEMA).append(entry)
    return path


def _write(rows: DataFrame, path: str, file_format: str, bucket: str | None, observation: Observation | None) -> None:
    if bucket is None:
        land(rows, path, file_format, observation=observation)
    else:
        land(rows, path, file_format, partition_by=[bucket], rebalance=False, observation=observation)


def _written_parts(spark: SparkSession, path: str, buckets: int) -> tuple[tuple[str, tuple[int, ...]], ...]:
    """Folder prefix and numbers of the buckets a write has made: one metadata call."""
    if buckets == 1:
        return ((path, (0,)),)
    found: dict[str, list[int]] = {}
    for name, _ in folder_entries(spark, path):
        match = re.fullmatch(r"(_bucket_*=)(\d+)", name)
        if match:
            found.setdefault(f"{path}/{match[1]}", []).append(int(match[2]))
    return tuple((root, tuple(sorted(held))) for root, held in found.items())


def expire_versions(spark: SparkSession, base: str, keep: int = 1, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete what none of the newest ``keep`` versions of a table reaches and return the folders deleted.

    Folders younger than ``older_than`` stay: a reader or a running write may hold them. Versions that are only
    reached by older pointer rows can no longer be read afterwards. Metadata calls of the driver, one for each version.
    """
    versions = _versions(spark, base)
    if versions is None:
        return []
    if keep < 1:
        raise ValueError("the newest version has to stay")
    entries = versions.orderBy(F.desc("updated_at"), F.desc("seq")).limit(keep).collect()
    reached = {root.rsplit("/", 1)[0] if "attempt=" not in root.rsplit("/", 1)[1] else root for e in entries for root, _ in _Version.of(e).parts}
    limit = datetime.now(tz=timezone.utc) - older_than
    gone = []
    for area in ("data", "updates"):
        for version, _ in folder_entries(spark, f"{base}/{area}"):
            for attempt, changed in folder_entries(spark, f"{base}/{area}/{version}"):
                path = f"{base}/{area}/{version}/{attempt}"
                if path not in reached and changed <= limit:
                    delete_folder(spark, path)
                    gone.append(path)
    return gone
