"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts, a small network learns which parts hold a vector's neighbours, and
it files every vector under its likeliest part. A query goes to its several most probable parts, whose vectors are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Vectors the parts are learned from at most: those with the smallest hash of their id.
SAMPLE = 6144
#: Vectors a part should hold, the fewest parts (if each has LEAST sample vectors to learn from) and the most a sample can tell apart.
PART_SIZE, MIN_PARTS, MAX_PARTS, LEAST = 2000, 8, 64, 8
#: Share of true neighbours that held-out sample queries must find; it sets the number of parts a query visits.
TARGET_RECALL = 0.95
GRAPH_DEGREE = 12
#: Vectors and queries that meet in one task.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 512


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def neighbours(vectors: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest inner products of each query, itself included if it is among ``vectors``."""
    out = []
    for at in range(0, len(queries), 1024):
        with np.errstate(all="ignore"):  # products may overflow
            scores = queries[at : at + 1024] @ vectors.T
        out.append(np.argpartition(-scores, min(k, scores.shape[1] - 1), axis=1)[:, :k])
    return np.concatenate(out)


def bisect_graph(edges: np.ndarray, nodes: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of ``nodes``, equal in size, with few edges between them.

    Grown from a far node by breadth, then improved by swapping the pairs of nodes that gain most while the cut shrinks.
    """
    inside = np.zeros(n, bool)
    inside[nodes] = True
    e = edges[inside[edges[:, 0]] & inside[edges[:, 1]]]
    rng = np.random.default_rng(seed)
    half = len(nodes) // 2
    reach = np.full(n, -1.0)
    start = nodes[rng.integers(len(nodes))]
    for _ in range(2):  # the node reached last is a far one
        reach[nodes] = np.inf
        front, step = np.array([start]), 0
        reach[start] = 0
        while len(front):
            step += 1
            near = np.concatenate([e[np.isin(e[:, 0], front), 1], e[np.isin(e[:, 1], front), 0]])
            front = np.unique(near[np.isinf(reach[near])])
            reach[front] = step
        finite = nodes[np.isfinite(reach[nodes])]
        start = finite[np.argmax(reach[finite])]
    order = nodes[np.lexsort((rng.random(len(nodes)), reach[nodes]))]
    side = np.zeros(n, np.int8)
    side[order[half:]] = 1
    for _ in range(60):
        across = side[e[:, 0]] != side[e[:, 1]]
        pull = np.where(across, 1.0, -1.0)
        gain = np.bincount(e[:, 0], pull, n) + np.bincount(e[:, 1], pull, n)
        a, b = nodes[side[nodes] == 0], nodes[side[nodes] == 1]
        a, b = a[np.argsort(-gain[a])], b[np.argsort(-gain[b])]
        m = int((gain[a[: min(len(a), len(b))]] + gain[b[: min(len(a), len(b))]] > 0).sum())
        if not m:
            break
        m = max(1, m // 4)  # few at a time, as the gains of neighbours interact
        before = across.sum()
        side[a[:m]], side[b[:m]] = 1, 0
        if (side[e[:, 0]] != side[e[:, 1]]).sum() >= before:
            side[a[:m]], side[b[:m]] = 0, 1
            break
    return nodes[side[nodes] == 0], nodes[side[nodes] == 1]


def balanced_parts(vectors: np.ndarray, parts: int, degree: int = GRAPH_DEGREE) -> np.ndarray:
    """The part of each vector: the neighbour graph halved again and again (``parts`` is a power of two)."""
    n = len(vectors)
    near = neighbours(vectors, vectors, min(n, degree + 1))
    edges = np.stack([np.repeat(np.arange(n), near.shape[1]), near.ravel()], axis=1)
    edges = edges[edges[:, 0] != edges[:, 1]]
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups = [half for i, g in enumerate(groups) for half in bisect_graph(edges, g, n, i + len(groups))]
    part = np.zeros(n, np.int32)
    for i, g in enumerate(groups):
        part[g] = i
    return part


def directions(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length one; those of the largest and smallest finite numbers too."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


@dataclass
class Router:
    """A network with one hidden layer that gives the probability of each part; ``probes`` parts are visited."""

    weights: list[np.ndarray]
    probes: int

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        scores = np.maximum(directions(vectors) @ w1 + b1, 0) @ w2 + b2
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)


def train_router(vectors: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 20, seed: int = 1) -> Router:
    """Adam on the cross entropy against ``targets``, the shares of each vector's neighbours in the parts."""
    rng = np.random.default_rng(seed)
    d, p = vectors.shape[1], targets.shape[1]
    w = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)) * 4, np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, p)), np.zeros(p)]
    w = [x.astype(np.float32) for x in w]
    m, v, t = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0
    router = Router(w, 1)
    x_all = directions(vectors)
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        for rows in np.array_split(rng.permutation(len(vectors)), max(1, len(vectors) // 256)):
            x, y = x_all[rows], targets[rows]
            h = np.maximum(x @ w[0] + w[1], 0)
            delta = (router.probabilities(vectors[rows]) - y) / len(rows)
            back = (delta @ w[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((x.T @ back, back.sum(axis=0), h.T @ delta, delta.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= (rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return router


def fit_router(sample: np.ndarray, parts: int, k: int, target: float = TARGET_RECALL) -> Router:
    """Cut the sample's neighbour graph, learn the parts, and set the probes by held-out sample queries.

    A sample is sparser than the whole, so its neighbours lie further and the measured recall is a cautious one.
    """
    held = np.arange(len(sample)) % 5 == 4 if len(sample) >= 200 else np.zeros(len(sample), bool)
    base = sample[~held]
    part = balanced_parts(base, parts)
    near = neighbours(base, base, min(len(base), GRAPH_DEGREE + 1))
    targets = np.zeros((len(base), parts), np.float32)
    np.add.at(targets, (np.repeat(np.arange(len(base)), near.shape[1]), part[near].ravel()), 1.0 / near.shape[1])
    router = train_router(base, targets)
    filed = router.probabilities(base).argmax(axis=1)
    queries = sample[held] if held.any() else base
    truth = filed[neighbours(base, queries, min(len(base), k))]
    order = np.argsort(-router.probabilities(queries), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    ranks = np.take_along_axis(rank, truth, axis=1)
    reached = [(ranks < m).mean() for m in range(1, parts + 1)]
    router.probes = next((m for m, r in enumerate(reached, 1) if r >= target), parts)
    return router


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), -1)


def search(df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", target: float = TARGET_RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` holds for its ``k`` nearest other vectors found.

    Nearness is the inner product in double precision; ties go to the smaller key. Rows whose vector is null, zero, or has
    null or non-finite components, or another than the commonest number of them, take no part. Equal vectors are one entry that keeps
    its ``k + 1`` smallest keys, all an answer can name. A repeated key answers and is found once, with the largest product of any of its
    vectors; a null key takes no part. With fewer than ``k`` other vectors all are returned. Products too large for a double are infinite, and
    those without a value (infinity minus infinity) come last.

    Memory: parts are searched in blocks of VECTOR_BLOCK vectors against QUERY_BLOCK queries, so neither large parts
    nor very common vectors meet in one task.
    """
    keep = k + 1
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not widths:
        return df.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("v") == widths[0]["d"])
    # Row limits by rank are applied in each task before the shuffle, so a vector of very many rows costs few of them.
    once = rows.select("v", "id").distinct()  # rows that repeat take no place from other keys
    near = once.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= keep)
    entries = near.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = staged(entries.withColumn("rep", F.monotonically_increasing_id()), "ann-entries")  # one number for each vector, fixed once written
    asked = staged(rows.where("q").select("id", "v").distinct().join(entries.select("v", "rep"), "v").select("id", "rep"), "ann-queries")
    total = entries.count()
    first = F.col("ids")[0]
    sample = entries.orderBy(F.xxhash64(first), first, "v").limit(SAMPLE).select("v").toArrow()  # bounded
    points = _matrix(sample.column("v").combine_chunks())
    parts = 1
    while parts * 2 <= min(MAX_PARTS, max(MIN_PARTS, total / PART_SIZE), len(points) / LEAST):
        parts *= 2
    router = fit_router(points, parts, k, target) if parts > 1 else None

    def probabilities(values: pd.Series) -> np.ndarray:
        return router.probabilities(np.stack(values.to_numpy())) if router else np.ones((len(values), 1))

    def file(values: pd.Series) -> pd.Series:
        return pd.Series(probabilities(values).argmax(axis=1))

    filed = staged(entries.select("rep", "ids", "v", F.pandas_udf(file, "int")("v").alias("part")), "ann-filed")
    sizes = {r["part"]: r["count"] for r in filed.groupBy("part").count().collect()}  # one row per part
    held = np.array([sizes.get(i, 0) for i in range(parts)])

    def visit(values: pd.Series) -> pd.Series:
        out = []
        for p in probabilities(values):
            order = np.argsort(-p)
            enough = int(np.searchsorted(np.cumsum(held[order]), 8 * keep) + 1)  # so many vectors at least, if there are
            out.append([int(i) for i in order[: max(router.probes if router else 1, enough)] if held[i]])
        return pd.Series(out)

    wanted = entries.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    visits = staged(wanted.select("rep", "v", F.explode(F.pandas_udf(visit, "array<int>")("v")).alias("part")), "ann-visits")
    busy = {r["part"]: r["count"] for r in visits.groupBy("part").count().collect()}
    blocks = df.sparkSession.createDataFrame(
        [(p, int(-(-n // VECTOR_BLOCK)), int(-(-busy.get(p, 1) // QUERY_BLOCK))) for p, n in sizes.items()], "part int, vbs bigint, qbs bigint"
    )
    mark = F.xxhash64("rep")
    stored = filed.join(F.broadcast(blocks), "part").select(
        "part", F.pmod(mark, F.col("vbs")).alias("vb"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qbs") - 1)).alias("qb"), F.lit(0).alias("kind"), "rep", "ids", "v"
    )
    posed = visits.join(F.broadcast(blocks), "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("vbs") - 1)).alias("vb"), F.pmod(mark, F.col("qbs")).alias("qb"), F.lit(1).alias("kind"), "rep",
        F.array().cast("array<bigint>").alias("ids"), "v",
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(ids: list[list[int]], points: list, queries: list[int], vectors: list) -> pa.RecordBatch:
            c, q = np.array(points), np.array(vectors)
            out_q, out_id, out_s = [], [], []
            with np.errstate(all="ignore"):  # products may overflow
                scores = q @ c.T
                rounding = 1e-15 * (c.shape[1] + 8) * np.linalg.norm(q, axis=1) * np.linalg.norm(c, axis=1).max()
                for i, query in enumerate(queries):
                    cut = keep
                    while True:  # until so many different keys are among the best
                        least = -np.partition(-scores[i], cut - 1)[cut - 1] if cut < len(c) else -np.inf
                        if cut >= len(c) or len({v for n in np.flatnonzero(~(scores[i] < least)) for v in ids[n]}) >= keep:
                            break
                        cut *= 4
                    near = np.flatnonzero(~(scores[i] < least - rounding[i]))
                    best: dict[int, tuple[bool, float]] = {}
                    for n, s in zip(near.tolist(), (c[near] * q[i]).sum(axis=1).tolist()):
                        rank = (s != s, -s)
                        for v in ids[n]:
                            if v not in best or rank < best[v]:
                                best[v] = rank
                    for (_, s), v in sorted((rank, v) for v, rank in best.items())[:keep]:
                        out_q.append(query)
                        out_id.append(v)
                        out_s.append(-s)
            return pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_s, pa.float64())], ["rep", "vec_id", "score"])

        current, ids, points, queries, vectors = None, [], [], [], []
        for batch in batches:
            matrix = batch.column(6).values.to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else None
            for i, (*place, kind, rep, members) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(6)))):
                if place != current:
                    if points and queries:
                        yield solve(ids, points, queries, vectors)
                    current, ids, points, queries, vectors = place, [], [], [], []
                if kind:
                    queries.append(rep)
                    vectors.append(matrix[i])
                else:
                    ids.append(members)
                    points.append(matrix[i])
        if points and queries:
            yield solve(ids, points, queries, vectors)

    met = stored.unionByName(posed).repartition("part", "vb", "qb").sortWithinPartitions("part", "vb", "qb", "kind")
    found = met.mapInArrow(score, "rep bigint, vec_id bigint, score double")
    # No value (NaN) ranks below every number.
    value = F.max(F.struct((~F.isnan("score")).alias("valid"), "score")).alias("s")
    best = Window.partitionBy("rep").orderBy(F.desc("s"), "vec_id")
    top = found.groupBy("rep", "vec_id").agg(value).withColumn("r", F.row_number().over(best)).where(F.col("r") <= keep)
    lists = top.groupBy("rep").agg(F.collect_list(F.struct("vec_id", "s.score")).alias("found"))
    own = asked.join(lists, "rep").select(F.col("id").alias("query_id"), F.explode("found").alias("hit")).select("query_id", "hit.*")
    answers = own.where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(value)
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "s.score")
