"""Periodic runs in texts: stretches of words that repeat with a period, found by multi-scale minimizers.

At scale ``t`` (a power of two) every place has the hash of the ``t`` words from it, and every window of ``t / 2`` places
has a minimum. Inside a run of period ``q`` with ``t / 2 < q <= t`` window minima come again after exactly ``q`` places,
and no equal hash stands between them, as ``t`` words that repeat earlier would give the run a smaller period. So
neighbouring equal minima at a distance of that scale are seeds; each is extended word by word to both sides. Periods too
short for a scale are found by comparing the words with themselves at every lag.

Texts of a batch lie behind each other in one array, a word of its own between any two.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

#: Fixed value: words are what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Periods up to here are found by direct lag scans; the first scale comes next.
SHORT = 8
#: Words of a batch looked at together; a longer text goes alone.
BATCH_WORDS = 60_000
RUN_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _mixed(values: np.ndarray) -> np.ndarray:
    """64-bit integers spread over all bits (multiply and fold)."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places (rising, once each) that hold the leftmost minimum of some window of ``width`` places, a power of two."""
    least, place, reach = values, np.arange(len(values)), 1
    while reach < width:
        left, right = least[:-reach], least[reach:]
        place = np.where(left <= right, place[:-reach], place[reach:])
        least = np.minimum(left, right)
        reach *= 2
    return place[np.concatenate(([True], place[1:] != place[:-1]))] if len(place) else place


def _agreeing(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words equal the words ``lag`` later: first place and end."""
    size = len(words) - lag
    end, step = at, 64
    while end < size:
        stop = min(size, end + step)
        same = words[end:stop] == words[end + lag : stop + lag]
        if not same.all():
            end += int(np.argmin(same))
            break
        end, step = stop, step * 2
    first, step = at, 64
    while first > 0:
        start = max(0, first - step)
        same = words[start:first] == words[start + lag : first + lag]
        if not same.all():
            first -= int(np.argmin(same[::-1]))
            break
        first, step = start, step * 2
    return first, end


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int, times: int) -> np.ndarray:
    """``start, length, period`` of all runs, by start and period, in texts that lie behind each other.

    ``words`` are numbers of words, texts of ``sizes`` words each followed by one number that occurs nowhere else. A run has at
    least ``least`` words and ``times`` periods (4 or more); its period is its smallest one.
    """
    if times < 4:
        raise ValueError("window minima need runs of at least four periods")
    found: dict[tuple[int, int], int] = {}

    def keep(first: int, end: int, lag: int) -> None:
        if end + lag - first >= max(least, times * lag):
            found.setdefault((first, end + lag), lag)  # lags rise, so the smallest period of a stretch stays

    longest = int(sizes.max()) if len(sizes) else 0
    for lag in range(1, min(SHORT, longest // times) + 1):
        same = np.concatenate(([False], words[lag:] == words[:-lag], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        firsts, ends = edges[::2], edges[1::2]
        long = ends - firsts >= max(least - lag, (times - 1) * lag)
        for first, end in zip(firsts[long].tolist(), ends[long].tolist()):
            keep(first, end, lag)

    # Hashes of t words by doubling, over the texts that are long enough for a period of the scale.
    place = np.arange(len(words))
    texts = np.repeat(sizes, sizes + 1)
    hashes, width = _mixed(words.astype(np.uint64) + np.uint64(1)), 1
    while width <= SHORT or times * (width // 2 + 1) <= longest:
        if width > SHORT:
            spots = window_minima(hashes, width // 2)
            values = hashes[spots]
            order = np.lexsort((spots, values))
            one, two = order[:-1], order[1:]
            gap = spots[two] - spots[one]
            pairs = (values[one] == values[two]) & (gap > width // 2) & (gap <= width)
            seeds = np.stack((gap[pairs], place[spots[one[pairs]]]))
            seen_lag, seen_end = 0, -1
            for lag, at in seeds[:, np.lexsort((seeds[1], seeds[0]))].T.tolist():
                if lag == seen_lag and at < seen_end:
                    continue
                first, end = _agreeing(words, at, lag)
                seen_lag, seen_end = lag, end
                keep(first, end, lag)
        # The next scale; texts too short for it leave.
        if len(hashes) <= width:
            break
        hashes = _mixed(hashes[:-width] * np.uint64(0xD6E8FEB86659FD93) + hashes[width:])
        place, texts = place[: len(hashes)], texts[: len(hashes)]
        width *= 2
        enough = texts >= times * (width // 2 + 1)
        if width > SHORT and not enough.all():
            place, texts, hashes = place[enough], texts[enough], hashes[enough]
    runs = ((first, end - first, lag) for (first, end), lag in found.items())
    return np.array(sorted(runs, key=lambda run: (run[0], run[2])), np.int64).reshape(-1, 3)


def _batch_runs(texts: list[list[str]], least: int, times: int) -> list[tuple[np.ndarray, str]]:
    """For each list of words its runs (starts counted from 0) and the words that stay, joined by spaces."""
    sizes = np.array([len(words) for words in texts], np.int64)
    heads = np.cumsum(sizes + 1) - sizes - 1
    known: dict[str, int] = {}
    number = known.setdefault
    flat = np.empty(int((sizes + 1).sum()), np.int64)
    for head, size, words in zip(heads.tolist(), sizes.tolist(), texts):
        flat[head : head + size] = [number(word, len(known)) for word in words]
    flat[heads + sizes] = -1 - np.arange(len(texts))
    runs = find_runs(flat, sizes, least, times)
    # One word in front of a run's repeats adds one to the depth there, and the end takes it back.
    depth = np.zeros(len(flat) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(depth) > 0
    owner = np.searchsorted(heads, runs[:, 0], side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, (head, size, words) in enumerate(zip(heads.tolist(), sizes.tolist(), texts)):
        own = runs[bounds[i] : bounds[i + 1]] - [head, 0, 0]
        if len(own):
            words = [word for word, gone in zip(words, dropped[head : head + size].tolist()) if not gone]
        out.append((own, " ".join(words)))
    return out


def detect_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """``key, n_words, runs, collapsed`` of every row: its periodic runs and the text without their repeats.

    A run is a stretch of consecutive words with smallest period ``q`` and at least ``max(least, times * q)`` words that
    no neighbouring word extends. ``runs`` holds start (words from 0), length and period by start, then period;
    ``collapsed`` the words that no run holds after its first period, joined by one space. Null and empty texts have no
    words and no runs; texts are taken whole; repeated rows give repeated results, and every row stands alone, so
    other columns, ties and clashing names play no part. An empty table gives an empty result. No shuffle.
    """
    split = re.compile(WORD).findall

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [split(t) if t else [] for t in batch.column(1).to_pylist()]
            found: list[tuple[np.ndarray, str]] = []
            start = size = 0
            for i in range(len(texts) + 1):
                if i == len(texts) or (i > start and size + len(texts[i]) > BATCH_WORDS):
                    found += _batch_runs(texts[start:i], least, times) if i > start else []
                    start, size = i, 0
                if i < len(texts):
                    size += len(texts[i])
            flat = np.concatenate([runs for runs, _ in found]) if found else np.empty((0, 3), np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(runs) for runs, _ in found], dtype=np.int64))).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), structs),
                    pa.array([kept for _, kept in found], pa.string()),
                ],
                ["key", "n_words", "runs", "collapsed"],
            )

    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    out = picked.mapInArrow(detect, f"key {kind}, n_words bigint, runs {RUN_TYPE}, collapsed string")
    return out.withColumnRenamed("key", key)


def strongest_run(runs: Column) -> Column:
    """The run with the greatest exact length over period (ties: smallest start, then period); null without runs.

    Quotients are compared as products, so nothing is rounded.
    """
    first = F.try_element_at(runs, F.lit(1))
    return F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))),
        first,
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )


def with_planted_runs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` in which every tenth key (by crc32) has a run of known place and period planted in its words.

    With ``h`` the crc32 of the key as text, ``g = h div 10``: if ``h % 10 = 0``, words from ``a = g % n`` on repeat
    the original from ``a`` with period ``1 + (n - a) div (3 + g % 8)``. Texts without words and null keys stay.
    """
    hashed = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        moved = F.transform(words, lambda word, i: F.when(i < a, word).otherwise(F.get(words, a + (i - a) % p)))
        return F.when(n > 0, F.array_join(moved, " "))

    words = F.filter(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+"), lambda word: word != "")
    new = F.coalesce(F.when(hashed % 10 == 0, let(words, planted)), F.col(f"`{text}`"))
    return df.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
