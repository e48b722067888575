"""License scan by diagonal voting.

Every rolling word 3-gram of a text is hashed and joined to the template positions with that hash. A match votes for its
diagonal (text position minus template position); neighbouring diagonals of a template are merged, and what
gathered enough votes is a span. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, words_of

K = 3
#: Diagonals this near belong to one span: a word more or less in between.
SLACK = 2
#: Votes for each K-gram of a template that make a span of it.
ENOUGH = 0.6

#: Phrases whose exact occurrences are counted, with their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Opening words of public licenses, matched approximately.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]


def template_grams(spark: SparkSession, base: list[tuple[str, str]], templates: list[tuple[str, str]]) -> DataFrame:
    """``h, template, label, exact, n_grams, at, gram``: one row per K-gram of each template, from configuration."""
    rows = [(i, label, i < len(base), text) for i, (label, text) in enumerate([*base, *templates])]
    named = spark.createDataFrame(rows, "template int, label string, exact boolean, text string")
    split = named.withColumn("w", words_of(F.col("text"))).withColumn("n_grams", F.size("w") - (K - 1)).where("n_grams > 0")
    grams = split.select("template", "label", "exact", "n_grams", F.posexplode(F.sequence(F.lit(1), F.col("n_grams"))).alias("at", "from"), "w")
    grams = grams.withColumn("gram", F.slice("w", F.col("from"), K))
    return grams.select(F.xxhash64(*[F.get("gram", F.lit(i)) for i in range(K)]).alias("h"), "template", "label", "exact", "n_grams", "at", "gram")


def scan_licenses(
    df: DataFrame, text: str = "text", key: str = "doc_id", base: list[tuple[str, str]] = BASE, templates: list[tuple[str, str]] = TEMPLATES
) -> tuple[DataFrame, DataFrame]:
    """Documents and spans.

    The first frame has one row per row of ``df``: ``key, n_words, n_base, first_word, last_word, base_labels, labels,
    score``; null and empty texts have no words and no labels, repeated rows repeat. ``score`` is the share of votes of the best
    template (1 for a base phrase). The second has every span: ``key, template, label, exact, first_word, last_word, share``.

    Templates are configuration and broadcast (their K-grams are literals of the plan). The hash of every rolling K-gram is
    computed; those no template has are dropped before rows are made of them, as the join would do. Only hits are
    shuffled, a handful per text, keyed by row, so frequent license lines make no hot key.
    """
    spark = df.sparkSession
    grams = template_grams(spark, base, templates)
    hashes = [row["h"] for row in grams.select("h").distinct().collect()]  # one per K-gram of the configured templates

    def hit(words, i):
        gram = F.slice(words, i + 1, K)
        return F.struct(i.alias("pos"), F.xxhash64(*[F.get(gram, F.lit(j)) for j in range(K)]).alias("h"), gram.alias("gram"))

    def read(words):
        last = F.size(words) - K
        places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        known = F.filter(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(K)]).isin(hashes))
        return F.struct(F.size(words).cast("bigint").alias("n_words"), F.transform(known, lambda i: hit(words, i)).alias("hits"))

    texts = df.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{key}`").alias("key"), let(words_of(F.col(f"`{text}`").cast("string")), read).alias("r"))
    rows = texts.select("rid", "key", "r.n_words", F.explode_outer("r.hits").alias("hit"))
    rows = rows.select("rid", "key", "n_words", F.col("hit.pos").alias("pos"), F.col("hit.h").alias("h"), F.col("hit.gram").alias("gram"))
    # The words are compared too, so a clash of hashes is no match.
    voted = rows.join(F.broadcast(grams), ["h", "gram"], "left").repartition("rid")
    votes = voted.groupBy("rid", "key", "n_words", "template", "label", "exact", "n_grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("at").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    # Neighbouring diagonals of a template merge, unless its phrase must stand exactly.
    along = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(along) > SLACK), F.lit(True))
    numbered = votes.withColumn("apart", apart.cast("int")).withColumn("bundle", F.sum("apart").over(along))
    merged = numbered.groupBy("rid", "key", "n_words", "template", "label", "exact", "bundle").agg(
        F.least(F.lit(1.0), F.sum("votes") / F.first("n_grams")).alias("share"),
        F.min("diagonal").cast("bigint").alias("start"), F.min("low").cast("bigint").alias("low"), (F.max("high") + (K - 1)).cast("bigint").alias("high"),
    )
    is_base = F.coalesce(F.col("exact") & (F.col("share") == 1.0), F.lit(False))
    is_span = F.coalesce(is_base | (~F.col("exact") & (F.col("share") >= ENOUGH)), F.lit(False))
    place = F.when(is_base, F.col("start"))

    def joined(flag):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(flag, F.col("label")))))

    documents = merged.groupBy("rid", "key", "n_words").agg(
        F.count(place).alias("n_base"), F.min(place).alias("first_word"), F.max(place).alias("last_word"),
        joined(is_base).alias("base_labels"), joined(is_span).alias("labels"),
        F.coalesce(F.max(F.when(~F.col("exact") | is_base, F.col("share"))), F.lit(0.0)).alias("score"),
    ).drop("rid").withColumnRenamed("key", key)
    spans = merged.where(is_span).select(
        F.col("key").alias(key), "template", "label", "exact", F.col("low").alias("first_word"), F.col("high").alias("last_word"), "share"
    )
    return documents, spans
