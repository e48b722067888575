"""Exact removal of repeated byte strings with suffix arrays.

Every window of LENGTH bytes is filed under the least hash of the K-byte grams in it; equal windows meet under the same
anchor at the same offset. Anchors that stand at one place only cannot repeat. The stretches of text around the others are dealt to
shards by anchor, and each shard is decided by a suffix array: induced sorting, then permuted common prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import giving_back, sliced, staged
from tidemark.llm.sais import permuted_prefixes, suffix_array

LENGTH = 200
K = 64
#: Bytes of a text searched for anchors at a time, bytes of one suffix array, and bytes of one anchor's stretches beyond which they are
#: compared by window instead (see :func:`overflow_spans`).
CHUNK, SHARD, GROUP = 2_000_000, 1_500_000, 6_000_000
#: Bytes of short texts searched together (the arrays over them should stay in a core's cache), and places of one batch of stretches.
BLOCK, PLACES = 250_000, 20_000
_PLACE_BITS = 23


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_BYTE = _scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes (a power of two) from each position on."""
    out, size, factor = _BYTE[data], 1, 0x9E3779B97F4A7C15
    spare = np.empty_like(out)
    while size < k:
        into = spare[: max(0, len(out) - size)]
        np.multiply(out[:-size], np.uint64(factor), out=into)
        into += out[size:]
        out, spare = into, out
        size, factor = size * 2, factor * factor & (1 << 64) - 1
    return _scramble(out)


def anchors(texts: list[bytes], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``text number, anchor, first window, windows`` for runs of windows with the same anchor; texts are searched together."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    hashes = gram_hashes(data, k)
    packed = hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    grams, width = length - k + 1, 1
    spare = np.empty_like(packed)
    while width < grams:
        step = min(width, grams - width)
        packed, spare = np.minimum(packed[:-step], packed[step:], out=spare[: max(0, len(packed) - step)]), packed
        width += step
    # Runs begin where the anchor changes, at a text's first window and behind its last.
    turn = np.ones(len(packed), bool)
    turn[1:] = packed[1:] != packed[:-1]
    edges = np.concatenate([starts, ends - length + 1])[np.tile(sizes >= length, 2)]
    turn[edges[edges < len(turn)]] = True
    first = np.flatnonzero(turn)
    count = np.diff(np.append(first, len(turn)))
    owner = np.searchsorted(ends, first, side="right")
    inside = first + length <= ends[owner]
    first, count, owner = first[inside], count[inside], owner[inside]
    anchor = (packed[first] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    return owner, hashes[anchor], first - starts[owner], count


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of at most CHUNK bytes that share ``length - 1``, so that every window lies in exactly one."""
    at = 0
    while True:
        yield at, text[at : at + CHUNK]
        at += CHUNK - length + 1
        if at + length > len(text):
            return


def text_key(text: Column) -> list[Column]:
    """128 bits by which texts are told apart."""
    return [F.xxhash64(text).alias("th"), F.xxhash64(F.lit(1), text, F.octet_length(text)).alias("tk")]


def anchor_rows(texts: DataFrame, length: int, k: int) -> DataFrame:
    """``anchor, th, tk, first, windows`` of all texts; copies within a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()

        def result(part: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
            number, anchor, first, count = anchors([p[3] for p in part], length, k)
            th, tk, base = (np.array([p[i] for p in part], np.int64)[number] for i in (0, 1, 2))
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(th), pa.array(tk), pa.array((first + base).astype(np.int64)), pa.array(count.astype(np.int32))],
                ["anchor", "th", "tk", "first", "windows"],
            )

        for batch in sliced(batches):
            part, size = [], 0
            for th, tk, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (th, tk) in seen:
                    continue
                seen.add((th, tk))
                for base, piece in _pieces(text, length):
                    if size + len(piece) > BLOCK and part:
                        yield result(part)
                        part, size = [], 0
                    part.append((th, tk, base, piece))
                    size += len(piece)
            if part:
                yield result(part)

    long_enough = texts.where(F.octet_length("text") >= length).select("th", "tk", F.col("text").cast("binary"))
    return long_enough.mapInArrow(giving_back(run), "anchor bigint, th bigint, tk bigint, first bigint, windows int")


def repeated_anchors(rows: DataFrame) -> DataFrame:
    """The rows whose anchor stands at two places or more, each place once; a sorted stream, whatever a group's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last place of the stream, and whether it was given out
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([[h], c]) for h, c in zip(held[0], columns)]
            a = columns[0]
            new_place = np.ones(len(a), bool)
            new_place[1:] = (a[1:] != a[:-1]) | (columns[1][1:] != columns[1][:-1]) | (columns[2][1:] != columns[2][:-1]) | (columns[3][1:] != columns[3][:-1])
            keep = np.flatnonzero(new_place)
            columns = [c[keep] for c in columns]
            a = columns[0]
            like_next = np.concatenate([a[1:] == a[:-1], [False]])
            like_last = np.concatenate([[held is not None and held[1] and len(a) > 0], a[1:] == a[:-1]])
            give = like_next | like_last
            given_last = bool(give[-1])
            if held is not None and held[1]:
                give[0] = False  # given out with its own batch
            held = ([c[-1] for c in columns], given_last)
            if give.any():
                kinds = [pa.int64()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c[give], k) for c, k in zip(columns, kinds)], ["anchor", "th", "tk", "first", "windows"])

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "th", "tk", "first")
    return ordered.mapInArrow(run, "anchor bigint, th bigint, tk bigint, first bigint, windows int")


_PART_SCHEMA = "anchor bigint, s1 bigint, s2 bigint, th bigint, tk bigint, first bigint, windows int, part binary"


def stretches(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """A row per place with the hash of its stretch (its windows and what they reach); each task ships a stretch's bytes once."""
    listed = places.groupBy("th", "tk").agg(F.collect_list(F.struct("anchor", "first", "windows")).alias("places"))
    once = texts.groupBy("th", "tk").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]
        names = [c.split()[0] for c in _PART_SCHEMA.split(", ")]

        def result(held: list[tuple]) -> pa.RecordBatch:
            marks, parts = [], []
            for _, _, data, places in held:
                for first, windows in zip(places.field(1).to_pylist(), places.field(2).to_pylist()):
                    part = data[first : first + windows + length - 1]
                    mark = xxhash.xxh3_128_digest(part)
                    marks.append(mark)
                    parts.append(None if mark in seen else part)
                    seen.add(mark)
            mark = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
            sizes = [len(h[3]) for h in held]
            th, tk = (np.repeat(np.array([h[i] for h in held], np.int64), sizes) for i in (0, 1))
            anchor, first, windows = (np.concatenate([h[3].field(i).to_numpy(zero_copy_only=False) for h in held]) for i in range(3))
            columns = [anchor, mark[:, 0], mark[:, 1], th, tk, first, windows, parts]
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)

        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                th, tk, data = (batch.column(i)[row].as_py() for i in range(3))
                places = batch.column(3)[row].values
                for at in range(0, len(places), PLACES):
                    held.append((th, tk, data, places[at : at + PLACES]))
                    size += len(held[-1][3])
                    if size >= PLACES:
                        yield result(held)
                        held, size = [], 0
        if held:
            yield result(held)

    return once.join(listed, ["th", "tk"]).select("th", "tk", F.col("text").cast("binary"), "places").mapInArrow(giving_back(run), _PART_SCHEMA)


def repeated_ranges(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``part number, low, high``: what the windows cover that stand elsewhere in the parts too, by one suffix array over all of them."""
    joined = b"\xff".join(parts) + b"\xff"  # no byte of UTF-8, so no window crosses it
    text = np.append(np.frombuffer(joined, np.uint8) + np.uint8(2), np.uint8(0))  # 0xff wraps to 1, the end is 0
    before, prefix = permuted_prefixes(text, suffix_array(text))
    hit = np.flatnonzero(prefix >= length)
    marked = np.zeros(len(text) + 1, bool)
    marked[hit] = True
    marked[before[hit]] = True
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    # Common prefixes may reach over the end of a part: only whole windows count, and runs end with them.
    edges = np.zeros(len(text) + 2, np.int8)
    edges[starts], edges[starts + sizes - length + 1] = 1, -1
    marked &= np.cumsum(edges[:-1], dtype=np.int8) > 0
    turns = np.flatnonzero(marked[1:] != marked[:-1]) + 1
    low, high = (turns[::2], turns[1::2]) if not marked[0] else (np.append(0, turns[1::2]), turns[::2])
    part = np.searchsorted(starts, low, side="right") - 1
    return part, low - starts[part], high - starts[part] + length - 1


_SPAN_SCHEMA = "th bigint, tk bigint, low bigint, high bigint, anchor bigint, part binary"
_SPAN_KINDS = [pa.int64()] * 5 + [pa.binary()]


_SPAN_NAMES = [c.split()[0] for c in _SPAN_SCHEMA.split(", ")]


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_SPAN_KINDS)], _SPAN_NAMES)


def _range_batch(*columns: np.ndarray) -> pa.RecordBatch:
    """Ranges (``th, tk, low, high``) without anchor and bytes."""
    rest = [pa.nulls(len(columns[0]), kind) for kind in _SPAN_KINDS[4:]]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), *rest], _SPAN_NAMES)


def shard_spans(rows: DataFrame, length: int, shard: int, group: int) -> DataFrame:
    """``th, tk, low, high``: ranges covered by repeated windows.

    Rows come sorted by anchor and stretch. A stretch at two places repeats wholly; those at one place are collected, whole
    anchors together, until ``shard`` bytes go to one suffix array. If one anchor's stretches exceed ``group`` bytes, the rows beyond and
    those collected are passed on with their bytes (``part`` set, ``anchor`` given).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_rows: list[tuple] = []  # anchor, th, tk, first, whole, part
        size = anchor_size = anchor_from = 0
        current, over = None, False
        stretch: list = []  # the stretch read last: (anchor, s1, s2), part, its first place, whether it has more
        passed: list[tuple] = []  # overflow rows

        def solve(rows: list[tuple]) -> list[pa.RecordBatch]:
            if not rows:
                return []
            part, low, high = repeated_ranges([r[5] for r in rows], length)
            th, tk, first = (np.array([r[i] for r in rows], np.int64)[part] for i in (1, 2, 3))
            new = ~np.array([r[4] for r in rows], bool)[part]
            return [_range_batch(th[new], tk[new], (first + low)[new], (first + high)[new])]

        def drop_settled() -> None:
            """Forget the last anchor's stretches if all of them repeat: no other is there to meet them."""
            nonlocal size
            if all(r[4] for r in shard_rows[anchor_from:]):
                size -= sum(len(r[5]) for r in shard_rows[anchor_from:])
                del shard_rows[anchor_from:]

        def close() -> list[pa.RecordBatch]:
            """Take in the stretch read last; give the spans that are due."""
            nonlocal size, anchor_size, anchor_from, current, over, stretch
            if not stretch:
                return []
            (anchor, _, _), part, (th, tk, first, windows), whole = stretch
            stretch, out = [], []
            if anchor != current:
                drop_settled()
                if size >= shard:
                    out += solve(shard_rows)
                    shard_rows.clear()
                    size = 0
                current, over, anchor_size, anchor_from = anchor, False, 0, len(shard_rows)
            anchor_size += len(part)
            shard_rows.append((anchor, th, tk, first, whole, part))
            size += len(part)
            if over or anchor_size > group:
                over = True
                # One row for a stretch that repeats: it is only there for others to meet, and is given twice to count as repeated.
                for row in shard_rows[anchor_from:]:
                    passed.extend([(row[1], row[2], row[3], row[3], row[0], row[5])] * (2 if row[4] else 1))
                size -= sum(len(r[5]) for r in shard_rows[anchor_from:])
                del shard_rows[anchor_from:]
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = [c.to_numpy() for c in batch.columns[:3]]
            th, tk, first, windows = (c.to_numpy() for c in batch.columns[3:7])
            new = np.ones(len(first), bool)
            new[0] = not stretch or stretch[0] != tuple(int(m[0]) for m in marks)
            new[1:] = (marks[0][1:] != marks[0][:-1]) | (marks[1][1:] != marks[1][:-1]) | (marks[2][1:] != marks[2][:-1])
            whole = ~new
            whole[:-1] |= ~new[1:]
            if not new[0] and not stretch[3]:
                a, b, c, n = stretch[2]
                yield _span_batch([(a, b, c, c + n + length - 1, None, None)])
                stretch[3] = True
            if whole.any():
                yield _range_batch(th[whole], tk[whole], first[whole], (first + windows + length - 1)[whole])
            heads = np.flatnonzero(new)
            parts = batch.column(7).take(pa.array(heads)).to_pylist()
            for *mark, part, a, b, c, n, again in zip(*(m[heads].tolist() for m in marks), parts, *(v[heads].tolist() for v in (th, tk, first, windows, whole))):
                yield from close()
                stretch = [tuple(mark), part, (a, b, c, n), again]
            if passed:
                yield _span_batch(passed)
                passed.clear()
        yield from close()
        if passed:
            yield _span_batch(passed)
        drop_settled()
        yield from solve(shard_rows)

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "s1", "s2", F.col("part").isNull())
    return ordered.mapInArrow(giving_back(run), _SPAN_SCHEMA)


def overflow_spans(rows: DataFrame, length: int) -> DataFrame:
    """Ranges of the stretches that were too many for one suffix array, by the 128-bit hash of every window.

    This is the exact way for an anchor that a large share of all texts has in different surroundings: its windows are spread by hash and
    read as sorted streams.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for th, tk, first, _, _, part in zip(*(c.to_pylist() for c in batch.columns)):
                marks = [xxhash.xxh3_128_intdigest(part[i : i + length]) for i in range(len(part) - length + 1)]
                n = len(marks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(m >> 64) - (1 << 63) for m in marks], pa.int64()), pa.array([(m & (1 << 64) - 1) - (1 << 63) for m in marks], pa.int64()),
                     pa.array([th] * n, pa.int64()), pa.array([tk] * n, pa.int64()), pa.array(range(first, first + n), pa.int64())],
                    ["w1", "w2", "th", "tk", "at"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, given = None, False
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[:2] == row[:2]:
                    if not given:
                        out.append((*held[2:4], held[4], held[4] + length, None, None))
                    out.append((*row[2:4], row[4], row[4] + length, None, None))
                    held, given = row, True
                else:
                    held, given = row, False
            if out:
                yield _span_batch(out)

    schema = "w1 bigint, w2 bigint, th bigint, tk bigint, at bigint"
    spread = rows.mapInArrow(windows, schema).repartition("w1", "w2").sortWithinPartitions("w1", "w2")
    return spread.mapInArrow(meet, _SPAN_SCHEMA)


def cover(row: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, low, high``: maximal runs of the union of the spans of each row's text, whose size is given; none in texts shorter than a window."""
    long_enough = sizes[row] >= length
    row, low, high = row[long_enough], low[long_enough], np.minimum(high, sizes[row])[long_enough]
    # Texts are laid one behind the other with a byte between them, so no run reaches into the next one.
    start = np.cumsum(sizes + 1) - sizes - 1
    low, high = low + start[row], high + start[row]
    order = np.argsort(low)
    row, low, high = row[order], low[order], np.maximum.accumulate(high[order])
    opens = np.ones(len(low), bool)
    opens[1:] = low[1:] > high[:-1]
    at = np.flatnonzero(opens)
    row = row[at]
    return row, low[at] - start[row], high[np.append(at, len(low))[1:] - 1] - start[row]


def find_spans(texts: DataFrame, length: int = LENGTH, k: int = K, shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """``th, tk, spans`` for texts (``th, tk, text``) with repeated windows; ``spans`` may overlap, and reach beyond the end for whole texts."""
    places = staged(repeated_anchors(anchor_rows(texts, length, k)), "suffix-places")
    found = staged(shard_spans(stretches(texts, places, length), length, shard, group), "suffix-spans")
    spans = found.where("part IS NULL")
    over = found.where("part IS NOT NULL")
    if not over.isEmpty():
        spans = spans.unionByName(overflow_spans(over, length))
    copies = texts.where(F.octet_length("text") >= length).groupBy("th", "tk").count().where("count > 1")
    whole = copies.select("th", "tk", F.lit(0).cast("bigint").alias("low"), F.lit(1 << 62).alias("high"))
    return spans.select("th", "tk", "low", "high").unionByName(whole).groupBy("th", "tk").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def remove_repeats(
    df: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, k: int = K, shard: int = SHARD, group: int = GROUP, with_text: bool = False
) -> DataFrame:
    """Per row of ``df``: ``key, n_bytes, n_removed, n_spans, kept_sha256``, and ``kept`` (binary) if ``with_text``.

    A byte is removed if it lies in a ``length``-byte string of its text that also starts anywhere else, in the same text or
    another. Null is an empty text; texts shorter than ``length`` stay whole; a repeated row loses all of its text, as its copy is there.
    """
    return _removed(df.select(F.col(f"`{key}`").alias("key"), *_keyed(F.col(f"`{text}`"))), length, k, shard, group, with_text, [key])


def _keyed(text: Column) -> list[Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [whole.alias("text"), *text_key(whole)]


def _removed(rows: DataFrame, length: int, k: int, shard: int, group: int, with_text: bool, names: list[str]) -> DataFrame:
    spans = find_spans(rows.select("th", "tk", "text"), length, k, shard, group)
    joined = rows.join(spans, ["th", "tk"], "left").select("key", F.col("text").cast("binary"), "spans")
    result = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            spans = batch.column(2)
            owner = np.repeat(np.arange(len(texts)), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            found = spans.flatten()
            row, low, high = cover(owner, *(found.field(i).to_numpy(zero_copy_only=False) for i in range(2)), sizes, length)
            upto = np.searchsorted(row, np.arange(len(texts) + 1))
            low, high = low.tolist(), high.tolist()
            out = []
            for number, data in enumerate(texts):
                kept, at, runs = [], 0, range(upto[number], upto[number + 1])
                for run in runs:
                    kept.append(data[at : low[run]])
                    at = high[run]
                left = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_text]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in out], t) for i, t in enumerate(kinds))], result)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(giving_back(cut), schema).withColumnRenamed("key", names[0])
