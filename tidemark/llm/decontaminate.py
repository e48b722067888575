"""Benchmark decontamination over a distributed positional inverted index.

The index keeps, for every training text, which benchmark term stands at which word. A test window is looked up by the
postings of its rarest term; the lists of its other terms, adjusted by their offsets, are intersected with
them from the second rarest on, until the whole phrase is confirmed. Everything is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, staged, words_of

WINDOW = 10
#: Test words handled in one pass; a longer benchmark is taken in blocks, each against all documents.
BLOCK_WORDS = 200_000


def build_index(df: DataFrame, terms: list[str], text: str = "text", key: str = "doc_id", rid: str | None = None) -> DataFrame:
    """``rid, key, n_words, ids``, staged: for each word of a text the hash of its term, 0 for words of no test text.

    ``terms`` is bounded by :data:`BLOCK_WORDS`. Hashes repeat, so the columnar file keeps them as a dictionary.
    ``rid`` tells repeated rows apart: a column of ``df`` if one is named, else rows are numbered here. Texts without test words keep a null list, null texts have no words.
    """

    def read(words):
        ids = F.transform(words, lambda w: F.when(w.isin(terms), F.xxhash64(w)).otherwise(F.lit(0)))
        return F.struct(F.size(words).cast("bigint").alias("n_words"), ids.alias("ids"))

    number = F.col(f"`{rid}`") if rid else F.monotonically_increasing_id()
    texts = df.select(number.alias("rid"), F.col(f"`{key}`").alias("key"), let(words_of(F.col(f"`{text}`").cast("string")), read).alias("r"))
    return staged(texts.select("rid", "key", "r.n_words", "r.ids"), "positional-index")


def test_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """``item, ids``: every run of WINDOW words of an item, or all of a shorter one; items without words have none."""
    words = benchmark.select(F.col(f"`{item}`").alias("item"), F.transform(words_of(F.col(f"`{text}`").cast("string")), lambda w: F.xxhash64(w)).alias("ids"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ids") - (WINDOW - 1)))
    return words.where(F.size("ids") > 0).select("item", "ids", F.explode(starts).alias("at")).select("item", F.slice("ids", F.col("at"), WINDOW).alias("ids")).distinct()


def with_rarest_terms(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``windows`` plus ``lists``: their terms as (count in all training text, offset, term), rarest first."""
    counts = index.select(F.explode("ids").alias("term")).where("term <> 0").groupBy("term").agg(F.count("*").alias("n"))
    terms = windows.select("item", "ids", F.posexplode("ids").alias("off", "term")).join(counts, "term", "left")
    ranked = terms.groupBy("item", "ids").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("lists"))
    return ranked.where(F.col("lists")[0]["n"] > 0)


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``rid, item, start, length``: exact occurrences of test windows, through their rarest terms.

    ``windows`` comes from one block of the benchmark and is broadcast, which its bound allows; a term that a third of
    all texts contain is then no hot key. Postings carry the words around them, so the intersection needs no shuffle.
    """
    ranked = staged(with_rarest_terms(windows, index), "ranked-windows").select(
        "item", F.col("ids").alias("want"), F.col("lists")[0]["term"].alias("term"), F.col("lists")[0]["off"].alias("off"),
        F.get("lists", F.lit(1))["term"].alias("term2"), F.get("lists", F.lit(1))["off"].alias("off2"),
    )
    anchors = [row["term"] for row in ranked.select("term").distinct().collect()]  # at most one per window of the block
    if not anchors:
        anchors = [0]

    def posting(ids, i):
        low = F.greatest(i - (WINDOW - 1), F.lit(0))
        return F.struct(i.alias("pos"), F.get(ids, i).alias("term"), low.alias("low"), F.slice(ids, low + 1, 2 * WINDOW - 1).alias("near"))

    def postings(ids):
        places = F.filter(F.transform(ids, lambda t, i: F.when(t.isin(anchors), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: posting(ids, i))

    lists = index.where(F.size("ids") > 0).select("rid", F.explode(let(F.col("ids"), postings)).alias("p")).select("rid", "p.*")
    start = F.col("pos") - F.col("off")
    at = start - F.col("low")
    hits = lists.join(F.broadcast(ranked), "term").where(start >= 0)
    hits = hits.where(F.col("term2").isNull() | (F.get("near", at + F.col("off2")) == F.col("term2")))
    hits = hits.where(F.slice("near", F.greatest(at + 1, F.lit(1)), F.size("want")) == F.col("want"))
    return hits.select("rid", "item", start.alias("start"), F.size("want").alias("length"))


def proximity_matches(index: DataFrame, benchmark: DataFrame, slop: int = 30, item: str = "item_id", text: str = "text") -> DataFrame:
    """``key, item, span``: texts in which the three rarest terms of an item stand within ``slop`` words.

    ``span`` is the least such distance. Items with fewer than three different terms take those they have.
    """
    terms = benchmark.select(F.col(f"`{item}`").alias("item"), F.explode(F.array_distinct(words_of(F.col(f"`{text}`")))).alias("w"))
    counts = index.select(F.explode("ids").alias("term")).where("term <> 0").groupBy("term").agg(F.count("*").alias("n"))
    ranked = terms.select("item", F.xxhash64("w").alias("term")).join(counts, "term", "left").groupBy("item").agg(
        F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))), 1, 3).alias("rare")
    )
    wanted = ranked.select("item", F.size("rare").alias("k"), F.posexplode("rare").alias("slot", "r")).select("item", "k", "slot", "r.term")
    lists = index.where(F.size("ids") > 0).select("rid", "key", F.posexplode("ids").alias("pos", "term")).where("term <> 0")
    places = lists.join(wanted, "term").groupBy("rid", "key", "item", "k").agg(F.array_sort(F.collect_list(F.struct("pos", "slot"))).alias("places"))
    far = F.lit(1 << 30)
    first = F.struct(F.array_repeat(-far, 3).alias("last"), far.alias("best"))

    def step(state, place):
        last = F.transform(state["last"], lambda p, i: F.when(i == place["slot"], place["pos"]).otherwise(p))
        span = place["pos"] - F.array_min(F.slice(last, 1, F.col("k")))
        return F.struct(last.alias("last"), F.least(state["best"], span).alias("best"))

    spans = places.select("key", "item", F.aggregate("places", first, step, lambda s: s["best"]).alias("span"))
    return spans.where(F.col("span") <= slop)


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``documents``: ``key, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word is hit if it stands inside an occurrence of a test window. Null texts have no words; repeated rows repeat; a null
    item id hits words but is not listed. An empty benchmark leaves every document clean.
    """
    tests = benchmark.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    words = tests.select("item_id", "text", F.size(words_of(F.col("text"))).alias("n"))
    blocks = max(1, -(-(words.agg(F.sum("n")).first()[0] or 0) // BLOCK_WORDS))
    found, index, number = [], None, None
    if blocks > 1:  # rows keep one number in all blocks, whatever order they come in
        rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        documents, text, source, number = staged(rows, "numbered-documents"), "text", "key", "rid"
    else:
        source = key
    for block in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block) if blocks > 1 else tests
        terms = [row["w"] for row in part.select(F.explode(words_of(F.col("text"))).alias("w")).distinct().collect()]
        index = build_index(documents, terms or [""], text, source, number)
        found.append(phrase_matches(index, test_windows(part)))
    matches = reduce(DataFrame.unionByName, found)
    hits = matches.groupBy("rid").agg(
        F.array_sort(F.collect_set(F.struct("start", F.col("length")))).alias("places"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )

    def cover(state, place):
        end = place["start"] + place["length"]
        fresh_words = F.greatest(end - F.greatest(place["start"], state["end"]), F.lit(0))
        return F.struct(F.greatest(end, state["end"]).alias("end"), (state["hit"] + fresh_words).alias("hit"))

    covered = F.aggregate("places", F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")), cover, lambda s: s["hit"])
    counted = hits.select("rid", covered.cast("bigint").alias("n_hit"), "items")
    joined = index.select("rid", "key", "n_words").join(counted, "rid", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
