"""Operators as filters over the columns of ``documents``: rows in, rows out."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard, suffix, toxicity
from tidemark.llm.common import fresh, give_back, giving_back, sliced, staged

#: Pre-tokens that a task of the last stage takes over from earlier ones on its worker.
KEPT_MEMO = 150_000


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold; null and empty texts stay."""
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.toxicity_score(model, F.col("text")) < toxicity.THRESHOLD)


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, a null id being the largest.

    Documents without words stay. If the smallest id stands in several rows of a group, the one whose text has
    the smallest hash stays, once. Rows that have no partner are not touched, whatever their id.
    """
    info = jaccard.near_duplicates(docs, words=words, percent=percent)
    # Rows of one id and set fare alike, so decisions are made for (id, set) and few of them remove anything.
    sets = info.where("n_shingles > 0").groupBy("doc_id", "set_hash", "component").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("set_hash").alias("mark"))
    firsts = sets.groupBy("component").agg(F.min(order).alias("first"), F.sum("n").alias("rows")).where("rows > 1")
    one = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("set_hash") == F.col("first.mark"))
    judged = sets.join(firsts, "component").withColumn("one", one).where("NOT one OR n > 1")
    judged = judged.select(F.col("doc_id").alias("id"), F.col("set_hash").alias("mark"), "one")
    marked = jaccard.with_set_hash(docs, words, fresh(docs.columns, "set_hash"))
    mark = marked.columns[-1]
    joined = marked.join(judged, marked["doc_id"].eqNullSafe(judged["id"]) & (marked[mark] == judged["mark"]), "left")
    clear = joined.where(F.col("one").isNull()).select(*docs.columns)
    again = joined.where("one").withColumn("r", F.row_number().over(Window.partitionBy("doc_id", mark).orderBy(F.xxhash64("text"), "text"))).where("r = 1")
    return clear.unionByName(again.select(*docs.columns))


def without_repeats(docs: DataFrame) -> DataFrame:
    """All documents, their texts without repeated 200-byte strings; ``n_chars`` follows.

    A character of which only some bytes are covered goes with them. A text that repeats whole becomes empty.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("key"), "text")
    # Written down first: each task then has one Python worker at a time, as the texts are decoded by another function.
    kept = staged(suffix.remove_repeats(rows, key="key", with_text=True).select("key", "kept"), "stages-kept")

    def decode(batches):
        for batch in sliced(batches):
            texts = [data.decode(errors="ignore") for data in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "text"])

    texts = kept.mapInArrow(giving_back(decode), f"key {rows.schema['key'].dataType.simpleString()}, text string")
    sizes = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return texts.select(*[F.col("text") if c == "text" else sizes.alias(c) if c == "n_chars" else F.col(f"key.`{c}`") for c in names])


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no 10-word window of a test text occurs.

    Null, empty and wordless texts stay, also where they repeat; repeated rows and rows of one id are judged by their own texts; an empty
    benchmark removes nothing.
    """
    whole = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    mark = fresh(docs.columns, "mark")
    marked = docs.withColumn(mark, F.struct(F.col("doc_id").alias("id"), whole.alias("text")))
    found = decontaminate.decontaminate(marked, benchmark, key=mark).where("contaminated").select(F.col(mark)["id"].alias("id"), F.col(mark)["text"].alias("text")).distinct()
    # Row by id and whole text: a clash of short hashes would lose a clean one.
    same = docs["doc_id"].eqNullSafe(found["id"]) & (F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")) == found["text"])
    return docs.join(found, same, "left_anti")


def encoded(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

    Null and empty texts have no ids; repeated rows give repeated results; other columns are not looked at.
    """

    def lean_codec() -> bpe.Codec:
        give_back()
        own = bpe.public_codec()
        if len(own.memo) > KEPT_MEMO:  # what tasks before have left
            own.memo = dict(own.memo_start)
        return own

    return bpe.token_digests(docs, make=lean_codec)
