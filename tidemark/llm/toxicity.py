"""Toxicity by weak supervision.

Lexicons of words and word beginnings are drawn from labelled training rows. Voters built on them and on patterns
(several hits, dense hits, no hit) label the rows noisily; a generative model estimates each voter's accuracy and the
correlations among voters, and a linear classifier is trained on its posterior labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import giving_back, staged

#: Labelled rows a model is fitted on at most: those with the smallest hash of their id.
MAX_ROWS = 20_000
#: Entries of the lexicon at most, the most telling first.
MAX_LEXICON = 600
#: Lengths of word beginnings, and of those that several different words of a text share.
PREFIXES = (4, 5, 6, 7, 8)
SHARED = (4, 5, 6, 7)
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]{2,}")


def words_in(text: str | None) -> tuple[set[str], int]:
    """The distinct words of a text and how many words it has."""
    words = _WORD.findall((text or "").lower())
    return set(words), len(words)


def starts(words: set[str], n: int) -> set[str]:
    return {w[:n] for w in words if len(w) > n}


def _tagged(text: str | None) -> list[str]:
    """All features of a text: its words, their beginnings, and the beginnings that at least two of them share."""
    words, _ = words_in(text)
    out = [f"word:{w}" for w in words]
    for n in PREFIXES:
        counted = Counter(w[:n] for w in words if len(w) > n)
        out += [f"start{n}:{item}" for item in counted]
        if n in SHARED:
            out += [f"shared{n}:{item}" for item, times in counted.items() if times > 1]
    return out


@dataclass
class ToxicityModel:
    """``weights`` by kind and entry of the lexicon; an empty lexicon scores every text with the intercept."""

    intercept: float = -20.0
    count_weight: float = 0.0
    weights: dict[str, dict[str, float]] = field(default_factory=dict)
    voters: pd.DataFrame | None = None

    def hits(self, text: str | None) -> tuple[dict[str, set[str]], int]:
        """The lexicon entries a text has, by kind, and its number of words."""
        words, n = words_in(text)
        found = {}
        begin = {k: starts(words, k) for k in PREFIXES if f"start{k}" in self.weights or f"shared{k}" in self.weights}
        for kind, entries in self.weights.items():
            if kind == "word":
                found[kind] = words & entries.keys()
            elif kind.startswith("start"):
                found[kind] = begin[int(kind[5:])] & entries.keys()
            else:
                size = int(kind[6:])
                near = begin[size] & entries.keys()
                found[kind] = {s for s in near if sum(w.startswith(s) and len(w) > size for w in words) > 1}
        return found, n

    def score(self, text: str | None) -> float:
        hits, _ = self.hits(text)
        total = math.fsum(self.weights[kind][item] for kind, items in hits.items() for item in items)  # in any order
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.intercept + total + self.count_weight * math.log1p(sum(map(len, hits.values())))))))


def remainder(key: Column) -> Column:
    """crc32 of the id as text, mod 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``rid, toxic, text``, staged: at most ``max_rows`` labelled ids outside the held-out fold, smallest hash first.

    Rows without a label or with a null id or label are left out; an id labelled twice counts as toxic if one label says so. Of the
    texts of one id the one with the smallest hash stands for it, so there are at most ``max_rows`` rows too. ``rid`` is that id:
    nothing a model is made of depends on how the rows lie in files and partitions.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.where(remainder(F.col("doc_id")) != 2).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # A minimum is combined in each task, so an id of very many rows is no hot key.
    least = F.min(F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("h"), "text")).alias("r")
    rows = sample.groupBy("doc_id").agg(least, F.first("toxic").alias("toxic"))
    return staged(rows.select(F.col("doc_id").alias("rid"), F.col("toxic").cast("int").alias("toxic"), "r.text"), "toxicity-rows")


def _sketches(text: str | None, n: int = 3) -> list[int]:
    """Least hashes of the word 3-grams: near copies agree in most of them."""
    words = (text or "").split()
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return [min(xxhash.xxh64_intdigest(g, seed) >> 1 for g in grams) for seed in range(n)]


def without_copies(rows: DataFrame) -> DataFrame:
    """The sample with one row of each set of near copies, that of the smallest id: their words would look telling by mere repetition."""

    def sketch(texts: pd.Series) -> pd.Series:
        return pd.Series([_sketches(t) for t in texts])

    known = rows.select("rid", F.pandas_udf(sketch, "array<bigint>")("text").alias("s")).toPandas().sort_values("rid")  # bounded sample
    seen: set[tuple[int, int]] = set()
    kept = []
    for rid, marks in zip(known["rid"], known["s"]):
        marks = set(enumerate(int(m) for m in marks))
        if not marks & seen:
            kept.append((rid,))
        seen |= marks
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(kept, rows.select("rid").schema)), "rid")


def _feature_counts(rows: DataFrame, among: set[str] | None = None) -> DataFrame:
    """How many rows have each feature (those ``among`` a set), added up in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(_tagged(text) if among is None else among.intersection(_tagged(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["feature", "n"])

    return rows.select("text").mapInArrow(giving_back(count), "feature string, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))


def draw_lexicon(rows: DataFrame, n_rows: int, n_toxic: int) -> dict[str, float]:
    """Features that toxic rows have significantly more often, with their log odds.

    Kept if at least 4 in 5 of their rows are toxic and the divergence from the base rate outweighs the number of features tried.
    """
    positive = {r["feature"]: r["n"] for r in _feature_counts(rows.where("toxic = 1")).where("n >= 3").collect()}  # bounded sample
    if not positive:
        return {}
    negative = {r["feature"]: r["n"] for r in _feature_counts(rows.where("toxic <> 1"), set(positive)).collect()}
    base = n_toxic / n_rows
    found = []
    for feature, p in positive.items():
        q = negative.get(feature, 0)
        share = p / (p + q)
        if share < max(0.8, base):
            continue
        gain = (p + q) * (share * math.log(share / base) + (1 - share) * math.log(max(1 - share, 1e-12) / (1 - base)))
        if gain > math.log(len(positive)) + 2:
            found.append((gain, feature, math.log((p + 0.5) / (q + 0.5))))
    found.sort(key=lambda f: (-f[0], f[1]))
    return {feature: odds for _, feature, odds in found[:MAX_LEXICON]}


#: What a voter may say.
TOXIC, ABSTAIN, CLEAN = 1, 0, -1
#: Lexicon voters: the kinds each of them looks at; every group is split in two voters by hash.
GROUPS = {"word": ("word",), "short": ("start4", "start5"), "long": ("start6", "start7", "start8"), "shared": tuple(f"shared{n}" for n in SHARED)}
VOTERS = [f"{group}-{half}" for group in GROUPS for half in (0, 1)] + ["several", "dense", "none", "no-word", "at-most-one"]


def votes_of(hits: dict[str, set[str]], n_words: int) -> list[int]:
    """The votes on one text: the lexicon voters, then patterns on all hits."""
    votes = []
    for kinds in GROUPS.values():
        items = [item for kind in kinds for item in hits.get(kind, ())]
        for half in (0, 1):
            votes.append(TOXIC if any(xxhash.xxh32_intdigest(item) % 2 == half for item in items) else ABSTAIN)
    words, total = len(hits.get("word", ())), sum(map(len, hits.values()))
    shared = any(hits.get(kind) for kind in GROUPS["shared"])
    votes.append(TOXIC if total >= 3 else ABSTAIN)
    votes.append(TOXIC if total >= max(2, 0.02 * n_words) else ABSTAIN)
    votes.append(CLEAN if total == 0 else ABSTAIN)
    votes.append(CLEAN if words == 0 and not shared else ABSTAIN)
    votes.append(CLEAN if total <= 1 and n_words >= 50 else ABSTAIN)
    return votes


def label_model(votes: np.ndarray, prior: float, rounds: int = 60) -> tuple[np.ndarray, pd.DataFrame, np.ndarray]:
    """Posterior of the toxic class for each row, voter accuracies, and correlations between voters.

    Expectation-maximisation over the table of each voter's votes given the class. Voters that agree beyond what the class
    explains (correlation of their residuals) share their weight instead of counting twice.
    """
    n, m = votes.shape
    said = np.stack([votes == v for v in (CLEAN, ABSTAIN, TOXIC)], axis=2).astype(float)
    posterior = np.clip(prior + 0.4 * np.sign(votes.sum(axis=1)), 0.02, 0.98)
    weight, correlation = np.ones(m), np.eye(m)
    for i in range(rounds):
        tables = []
        for q in (1 - posterior, posterior):
            tables.append((np.einsum("n,nmv->mv", q, said) + 0.1) / (q.sum() + 0.3))
        if i % 5 == 4:
            expected = [t @ np.array([-1.0, 0.0, 1.0]) for t in tables]
            residual = votes - np.outer(1 - posterior, expected[0]) - np.outer(posterior, expected[1])
            scale = np.sqrt((residual**2).mean(axis=0)) + 1e-9
            correlation = (residual / scale).T @ (residual / scale) / n
            weight = 1 / np.maximum(1.0, np.clip(correlation, 0, None).sum(axis=1))
        log_odds = math.log(prior / (1 - prior)) + np.einsum("nmv,mv,m->n", said, np.log(tables[1] / tables[0]), weight)
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
    spoken = votes != ABSTAIN
    right = np.where(votes == TOXIC, posterior[:, None], 1 - posterior[:, None])
    accuracy = (right * spoken).sum(axis=0) / np.maximum(spoken.sum(axis=0), 1)
    return posterior, pd.DataFrame({"accuracy": accuracy, "coverage": spoken.mean(axis=0), "weight": weight}), correlation


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.02, steps: int = 400) -> np.ndarray:
    """Weights of a logistic regression on soft targets (accelerated gradient; last column is the intercept)."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, before = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge / max(1.0, len(x) ** 0.5))
    penalty[-1] = 0.0
    rate = 4.0 / max(1e-9, float((x**2).sum(axis=1).mean()) + 1.0)
    for i in range(steps):
        ahead = w + i / (i + 3) * (w - before)
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        before, w = w, ahead - rate * (x.T @ (p - target) / len(x) + penalty * ahead)
    return w


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """A model from a bounded sample of labelled rows; only ids and labels of the training fold are read.

    Without any toxic (or any clean) training row nothing can be learned: every text scores near 0.
    """
    rows = staged(without_copies(training_rows(documents, labels, max_rows)), "toxicity-sample")
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("toxic") == 1, 1)).alias("p")).first()
    if not counts["p"] or counts["p"] == counts["n"]:
        return ToxicityModel()
    model = ToxicityModel()
    for feature, odds in draw_lexicon(rows, counts["n"], counts["p"]).items():
        kind, _, item = feature.partition(":")
        model.weights.setdefault(kind, {})[item] = odds
    if not model.weights:
        return model
    order = {(kind, item): i for i, (kind, item) in enumerate((k, e) for k, entries in model.weights.items() for e in entries)}

    def look(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            hits, n_words = model.hits(text)
            out.append((votes_of(hits, n_words), [order[k, item] for k, items in hits.items() for item in items]))
        return pd.DataFrame(out, columns=["votes", "places"])

    looked = rows.select("rid", F.pandas_udf(look, "votes array<int>, places array<int>")("text").alias("r")).select("rid", "r.*")
    seen = looked.toPandas().sort_values("rid")  # bounded sample, in an order of its own
    votes = np.array(seen["votes"].tolist(), dtype=float)
    posterior, voters, _ = label_model(votes, counts["p"] / counts["n"])
    x = np.zeros((len(seen), len(order) + 1), np.float32)
    for i, places in enumerate(seen["places"]):
        x[i, places] = 1.0
        x[i, -1] = math.log1p(len(places))
    w = fit_linear(x, posterior)
    for (kind, item), i in order.items():
        model.weights[kind][item] = float(w[i])
    model.count_weight, model.intercept = float(w[-2]), float(w[-1])
    model.voters = voters.set_index(pd.Index(VOTERS))
    return model


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """The score of a text, 0 to 1; null is an empty text. Only the text is read."""
    slim = ToxicityModel(model.intercept, model.count_weight, model.weights)

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([slim.score(t) for t in texts], dtype=float)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from giving_back(scored)(batches)

    return F.pandas_udf(score, "double")(text.cast("string"))


def score_documents(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``; repeated rows repeat."""
    model = fit(documents, labels, max_rows)
    scored = documents.select("doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
