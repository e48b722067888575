"""Exact Jaccard self-join of shingle sets by universe partitioning.

Sets that reach the threshold differ in at most H tokens, with H fixed by their size band. The token universe is hashed
into segments, so by the pigeonhole principle some segments agree (or, where a segment is allotted a threshold of
one, differ by one token and meet in a one-deletion neighbourhood). More segments are cut than that, so linked sets share
``k`` signatures at least: each set is left with all but its ``k - 1`` most frequent ones, among which one is still shared
(the rarest of the shared ones has ``k - 1`` more frequent ones behind it). Signatures of passages that many texts hold are thus never
met. Sets that meet are candidates, and candidates are verified exactly on their tokens.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, giving_back, staged

#: Tokens of one block in verification; larger candidate groups are split and compared block by block.
BLOCK_TOKENS = 1_000_000
#: Signatures that a task gathers before it hands them on.
FLUSH = 100_000
#: Linked sets share one signature more for every so many tokens by which they may differ.
MARGIN = 12
#: What a false agreement costs, in signatures.
FALSE_COST = 40.0


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word ``n``-grams; a shorter text is one shingle, one without words has none.

    Words are runs without white space of ASCII, A-Z lower-cased.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mix(out + hashes[i : i + len(out)])
    return np.unique(out)


@dataclass(frozen=True)
class Scheme:
    """How sets of one size band are cut: ``segments``, of which the first ``deleting`` tolerate one token.

    ``spare`` segments more than the pigeonhole needs may be skipped, which is done with empty ones; linked sets share
    ``agreeing`` signatures at least.
    """

    band: int
    segments: int
    deleting: int
    spare: int
    agreeing: int


@lru_cache(maxsize=None)
def band_edges(percent: int, upto: int) -> tuple[int, ...]:
    """First sizes of the bands: sets that can reach the threshold lie in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1))
    return tuple(edges)


@lru_cache(maxsize=None)
def scheme_of(percent: int, band: int, low: int, high: int) -> Scheme:
    """The cheapest allocation for pairs whose smaller set has ``low`` to ``high`` tokens.

    The cost of an allocation is its signatures, one-deletion neighbours included, plus what false agreements cost.
    """
    differ = (high + high * 100 // percent) * (100 - percent) // (100 + percent)
    best = None
    # Larger sets have a few more segments, so that linked ones agree in several; small ones may tolerate tokens instead.
    agreeing = 2 + differ // MARGIN if differ >= 4 else 1
    for deleting in range(0, differ + 2 if agreeing == 1 else 1):
        segments = max(1, deleting, differ + agreeing - deleting)
        empty = (segments - deleting) * math.exp(-low / segments)
        spare = math.ceil(empty + math.sqrt(empty)) if segments - deleting > 1 else 0
        segments = max(1, deleting, differ + agreeing + spare - deleting)
        mean = low / segments
        cost = (segments - deleting) * (1 + FALSE_COST * math.exp(-mean)) + deleting * (1 + mean + FALSE_COST * math.exp(1 - mean))
        if segments + deleting >= differ + agreeing + spare and (best is None or cost < best[0]):
            best = (cost, Scheme(band, segments, deleting, spare, agreeing))
    return best[1]


def signatures(tokens: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The signatures a set is filed under: equal segments of two sets give equal signatures."""
    seed = np.uint64(scheme.band * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    mixed = _mix(tokens ^ seed)
    segment = ((mixed >> np.uint64(32)) * np.uint64(scheme.segments) >> np.uint64(32)).astype(np.int64)
    content = _mix(mixed)
    order = np.argsort(segment, kind="stable")
    counts = np.bincount(segment, minlength=scheme.segments)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(content[order])])
    ends = np.cumsum(counts)
    sums = running[ends] - running[ends - counts]
    place = np.arange(1, scheme.segments + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    empty = (counts == 0) & (np.arange(scheme.segments) >= scheme.deleting)
    take = np.ones(scheme.segments, bool) if empty.sum() > scheme.spare else ~empty
    out = [_mix(sums[take] + place[take] + seed)]
    if scheme.deleting:
        near = segment < scheme.deleting
        out.append(_mix(sums[segment[near]] - content[near] + place[segment[near]] + seed))
    return np.concatenate(out)


def schemes_of(size: int, percent: int) -> list[Scheme]:
    """The schemes a set takes part in: that of its own band, and that of the band below if it can link with its sets."""
    edges = band_edges(percent, 1 << (size + 1).bit_length())
    band = int(np.searchsorted(edges, size, side="right")) - 1
    out = [scheme_of(percent, band, edges[band], edges[band + 1] - 1)]
    if band and 100 * (edges[band] - 1) >= percent * size:
        out.append(scheme_of(percent, band - 1, edges[band - 1], edges[band] - 1))
    return out


def filed_signatures(tokens: np.ndarray, percent: int) -> list[tuple[int, np.ndarray]]:
    """Band and distinct signatures for each scheme a set takes part in."""
    return [(scheme.band, np.unique(signatures(tokens, scheme))) for scheme in schemes_of(len(tokens), percent)]


def all_signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    return np.unique(np.concatenate([found for _, found in filed_signatures(tokens, percent)]))


@lru_cache(maxsize=None)
def shared_by_band(percent: int) -> tuple[int, ...]:
    """For each band how many signatures of its scheme linked sets share at least, for sets of up to 2 ** 40 tokens."""
    edges = band_edges(percent, 1 << 40)
    return tuple(scheme_of(percent, band, low, high - 1).agreeing for band, (low, high) in enumerate(zip(edges, edges[1:])))


def needed(size: int, percent: int) -> int:
    """How many signatures a set shares at least with any set it links with."""
    return min(scheme.agreeing for scheme in schemes_of(size, percent)) if size else 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


_ROW = ["sig", "sh", "key", "th", "n"]


def _signature_rows(sigs: list[np.ndarray], owners: list[np.ndarray], bands: list[np.ndarray], key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The signatures gathered, at most FLUSH to a batch; the lists are emptied."""
    sig, owner, band = np.concatenate(sigs), np.concatenate(owners), np.concatenate(bands)
    for gathered in (sigs, owners, bands):
        gathered.clear()
    for at in range(0, len(sig), FLUSH):
        part = slice(at, at + FLUSH)
        none = pa.nulls(len(sig[part]), pa.int64())
        yield pa.RecordBatch.from_arrays([_signed(sig[part]), _signed(owner[part]), none.cast(key_type), none, pa.array(band[part])], _ROW)


def emit(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``sig, sh, key, th, n`` for ``th, key, text``: a row per document (``n`` its size) and a row per signature.

    Of a signature ``n`` is -1 less the band of its scheme. ``sh`` is the hash of a set; equal sets emit signatures once per task, so exact copies are combined before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        row = 0
        for batch in batches:
            hashes, sizes, sigs, owners, bands, waiting = [], [], [], [], [], 0
            for text in batch.column(2):
                tokens = shingles(text.as_py(), words)
                sh = xxhash.xxh3_64_intdigest(tokens.tobytes())
                hashes.append(sh)
                sizes.append(len(tokens))
                if len(tokens) and sh not in seen:
                    seen.add(sh)
                    for band, found in filed_signatures(tokens, percent):
                        sigs.append(found)
                        owners.append(np.full(len(found), sh, np.uint64))
                        bands.append(np.full(len(found), -1 - band, np.int32))
                        waiting += len(found)
                    if waiting >= FLUSH:
                        yield from _signature_rows(sigs, owners, bands, batch.column(1).type)
                        waiting = 0
            n = len(hashes)
            spread = _mix(np.arange(row, row + n, dtype=np.uint64))
            row += n
            own = np.array(hashes, np.uint64)
            yield pa.RecordBatch.from_arrays([_signed(spread), _signed(own), batch.column(1), batch.column(0), pa.array(sizes, pa.int32())], _ROW)
            if sigs:
                yield from _signature_rows(sigs, owners, bands, batch.column(1).type)

    return texts.select("th", "key", "text").mapInArrow(giving_back(run), f"sig bigint, sh bigint, key {texts.schema['key'].dataType.simpleString()}, th bigint, n int")


def meet(rows: DataFrame) -> DataFrame:
    """``sig, sh, key, th, n``: document rows as they are (``n`` not negative), and the rows of signatures that several sets have.

    Groups arrive sorted and are read as a stream, of which one row is held back, so a signature of very many sets takes no memory.
    """
    names = ["sig", "sh", "key", "th", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last signature row so far, and whether its signature has been given out already
        for batch in batches:
            is_doc = batch.column(4).to_numpy() >= 0
            docs = batch.filter(pa.array(is_doc))
            if docs.num_rows:
                yield docs
            sig, sh, n = (batch.column(i).to_numpy()[~is_doc] for i in (0, 1, 4))
            if not len(sig):
                continue
            before_open = False
            if held is not None:
                sig, sh, n = (np.concatenate([[old], new]).astype(new.dtype) for old, new in zip(held[:3], (sig, sh, n)))
                before_open = held[3]
            # Equal sets file equal signatures in several tasks; they stand next to each other.
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (sh[1:] != sh[:-1])])
            sig, sh, n = sig[fresh], sh[fresh], n[fresh]
            like_next = np.concatenate([sig[1:] == sig[:-1], [False]])
            like_last = np.concatenate([[before_open], sig[1:] == sig[:-1]])
            out = (like_next | like_last)[:-1]
            held = (sig[-1], sh[-1], n[-1], bool(like_last[-1]))
            if out.any():
                none = pa.nulls(int(out.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[:-1][out]), pa.array(sh[:-1][out]), none.cast(batch.column(2).type), none, pa.array(n[:-1][out])], names
                )
            key_type = batch.column(2).type
        if held is not None and held[3]:
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([held[0]]), pa.array([held[1]]), none.cast(key_type), none, pa.array([held[2]], pa.int32())], names
            )

    ordered = rows.repartition("sig").sortWithinPartitions("sig", "sh")
    return ordered.mapInArrow(giving_back(run), f"sig bigint, sh bigint, key {rows.schema['key'].dataType.simpleString()}, th bigint, n int")


def candidate_links(met: DataFrame, percent: int) -> DataFrame:
    """``a, b``: links from the first set of every signature group to its others, without what cannot make a set link.

    A set that shares fewer signatures of a scheme than linked ones do leaves that scheme; the others lose as many of their most
    frequent signatures as linked ones share beyond the first.
    """
    least = F.element_at(F.array(*map(F.lit, shared_by_band(percent))), -F.col("n"))
    own = Window.partitionBy("sh", "n")
    enough = met.withColumn("shared", F.count("*").over(own)).where(F.col("shared") >= least).select("sig", "sh", "n")
    enough = staged(enough, "jaccard-enough")
    often = enough.groupBy("sig").agg(F.count("*").alias("often")).where("often > 1")
    order = own.orderBy(F.desc("often"), F.desc("sig"))
    rare = enough.join(often, "sig").withColumn("place", F.row_number().over(order)).where(F.col("place") >= least).select("sig", "sh")
    rare = staged(rare, "jaccard-rare")
    firsts = rare.groupBy("sig").agg(F.min("sh").alias("a"), F.count("*").alias("sets")).where("sets > 1").select("sig", "a")
    return rare.join(firsts, "sig").select("a", F.col("sh").alias("b")).where("a <> b").distinct()


def linked(a: int, b: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def verify_group(ids: list[int], sets: list[np.ndarray], sides: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among the sets, by exact intersection sizes.

    ``sets`` is emptied to save memory. Pairs that are connected already are skipped. With two sides only pairs across them are compared. Sets are met through their
    rarest tokens: two sets that reach the threshold share one among the rarest ``n - ceil(n * percent / 100) + 1`` of each.
    """
    label = np.arange(len(ids))
    two = len(set(sides)) > 1
    sizes = np.array([len(s) for s in sets])
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    sets.clear()  # ranks stand for tokens from here on, in half the bytes
    n_values, inverse = len(values), inverse.astype(np.int32)
    del values
    rarity = np.empty(n_values, np.int32)
    rarity[np.argsort(np.bincount(inverse), kind="stable")] = np.arange(n_values, dtype=np.int32)
    ends = np.cumsum(sizes)
    ranked = [np.sort(rarity[inverse[e - n : e]]) for e, n in zip(ends, sizes)]
    del inverse, rarity
    prefix = [r[: n - -(-n * percent // 100) + 1] for r, n in zip(ranked, sizes)]
    owner = np.repeat(np.arange(len(ids)), [len(p) for p in prefix])
    tokens = np.concatenate(prefix)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    side, flag, links = np.array(sides), np.zeros(n_values, np.int32), []
    for x in range(len(ids)):
        near = np.flatnonzero(label[x + 1 :] != label[x]) + x + 1
        near = near[100 * np.minimum(sizes[near], sizes[x]) >= percent * np.maximum(sizes[near], sizes[x])]
        if two:
            near = near[side[near] != side[x]]
        if len(near) > 32:  # else comparing them all is less work
            low, high = np.searchsorted(tokens, prefix[x], "left"), np.searchsorted(tokens, prefix[x], "right")
            near = np.intersect1d(near, np.concatenate([owner[a:b] for a, b in zip(low, high)]))
        if not len(near):
            continue
        flag[ranked[x]] = 1
        for y in near.tolist():
            if label[y] != label[x] and linked(sizes[x], sizes[y], int(flag[ranked[y]].sum()), percent):
                label[label == label[y]] = label[x]
                links.append((ids[x], ids[y]))
        flag[ranked[x]] = 0
    return links


def verify(members: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b`` (set hashes): verified links of ``comp, blocks, sh, text``.

    A candidate group of more than BLOCK_TOKENS tokens is cut into ``blocks`` by hash, and every two blocks meet in a task of
    their own, so memory stays bounded; pairs are never written out. Texts travel rather than their hashes, which do not compress.
    """
    cut = members.withColumn("block", F.pmod(F.xxhash64("sh"), F.col("blocks")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("comp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "sh", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(group: list) -> pa.RecordBatch:
            ids, sets, sides = ([g[k] for g in group] for k in range(3))
            group.clear()
            links = verify_group(ids, sets, sides, percent)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

        current, group = None, []
        for batch in batches:
            comp, i, j, block, sh = (batch.column(k).to_pylist() for k in range(5))
            texts = batch.column(5)
            for k in range(batch.num_rows):
                if (comp[k], i[k], j[k]) != current:
                    if len(group) > 1:
                        yield result(group)
                    current, group = (comp[k], i[k], j[k]), []
                group.append((sh[k], shingles(texts[k].as_py(), words), block[k]))
        if len(group) > 1:
            yield result(group)

    return met.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "sh").mapInArrow(giving_back(run), "a bigint, b bigint")


def with_set_hash(df: DataFrame, words: int, name: str, text: str = "text") -> DataFrame:
    """``df`` plus the hash of each row's shingle set, as :func:`near_duplicates` gives it."""

    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            marks = np.fromiter((xxhash.xxh3_64_intdigest(shingles(t, words).tobytes()) for t in texts), np.uint64, len(texts))
            yield pd.Series(marks.view(np.int64))

    return df.withColumn(name, F.pandas_udf(hashes, "bigint")(F.col(f"`{text}`").cast("string")))


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, percent: int = 80) -> DataFrame:
    """``key, n_shingles, set_hash, component_id, component`` for every row of ``df``; ``key`` must be orderable.

    Rows link when ``100 * intersection >= percent * union`` of their shingle sets; ``component_id`` is the smallest key
    reachable by links, which other components may have too if keys repeat; ``component`` tells components apart. Null, empty and wordless texts have no shingles and link with nothing, not even each other. Repeated
    rows and equal sets are one class. Shingles are compared by 64-bit hashes.
    """
    texts = df.select(F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("th"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    first = staged(meet(emit(texts, words, percent)), "jaccard-signatures")
    docs = first.where("n >= 0").select("key", "th", "sh", "n")
    classes = docs.where("n > 0").groupBy("sh").agg(F.min("th").alias("th"), F.min("n").alias("n"))
    near = candidate_links(first.where("n < 0").select("sig", "sh", "n"), percent)
    candidates = connected_components(near, "jaccard-candidates").withColumnRenamed("node", "sh")
    # One text for each candidate set; copies are combined in each task before the shuffle.
    sets = classes.join(candidates, "sh").select("sh", F.col("component").alias("comp"), "th", "n")
    sets = staged(sets, "jaccard-sets")
    sizes = sets.groupBy("comp").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    once = texts.groupBy("th").agg(F.first("text").alias("text"))
    members = once.join(sets.join(sizes, "comp"), "th").select("comp", "blocks", "sh", "text")
    links = connected_components(verify(members, words, percent), "jaccard-links")
    labelled = docs.join(links.withColumnRenamed("node", "sh"), "sh", "left").select("key", "n", "sh", F.coalesce("component", "sh").alias("comp"))
    lowest = labelled.where("n > 0").groupBy("comp").agg(F.min("key").alias("low"))
    joined = labelled.withColumn("at", F.when(F.col("n") > 0, F.col("comp"))).join(lowest.withColumnRenamed("comp", "at"), "at", "left")
    return joined.select(
        F.col("key").alias(key), F.col("n").cast("bigint").alias("n_shingles"), F.col("sh").alias("set_hash"), F.coalesce("low", "key").alias("component_id"),
        F.col("comp").alias("component"),
    )
