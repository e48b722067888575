from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import jaccard

SCHEMA = "doc_id bigint, text string, sh string"


def shingle_set(text, n):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, n, percent):
    sets = [shingle_set(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), key), key)
    return sorted((key, len(s), low[root(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, sizes):
    rng = random.Random(seed)
    texts = []
    for size in sizes:
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(5)):
            copy = list(base)
            for _ in range(rng.randrange(max(1, size // 20) + 1)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randrange(2)] = [f"x{rng.randrange(99)}"] * rng.randrange(2)
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 80)])
def test_components_match_brute_force(spark, n, percent):
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 17, 20, 25, 30, 45, 60, 90, 140, 200, 300] * 3
    texts = near_copies(n, sizes)
    texts += texts[:4] + [t.upper() for t in texts[4:6]] + ["", None, "  \t", "one", "One two", "one two", "É a", "é a"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], SCHEMA).repartition(3)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df, words=n, percent=percent).collect())
    assert got == brute(rows, n, percent)


def test_blocks_give_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 120)
    rows = list(enumerate(near_copies(9, [30, 31, 60, 61, 62, 90] * 4)))
    df = spark.createDataFrame([(k, t, None) for k, t in rows], SCHEMA)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df, words=2, percent=80).collect())
    assert got == brute(rows, 2, 80)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_linked_sets_share_a_signature(percent):
    """The pigeonhole guarantee, at the edge: pairs that just reach the threshold."""
    rng = np.random.default_rng(percent)
    for size in [*range(1, 60), 100, 170, 300, 700]:
        for _ in range(6):
            tokens = rng.integers(0, 2**63, size * 2, dtype=np.uint64)
            a = np.sort(tokens[:size])
            grown = int(rng.integers(0, size * 100 // percent - size + 1))
            lost = next(k for k in range(size, -1, -1) if 100 * (size - k) >= percent * (size + grown))
            b = np.sort(np.concatenate([a[rng.permutation(size)[lost:]], tokens[size : size + grown]]))
            shared = set(jaccard.all_signatures(a, percent).tolist()) & set(jaccard.all_signatures(b, percent).tolist())
            assert len(b) == 0 or len(shared) >= max(jaccard.needed(len(s), percent) for s in (a, b) if len(s) == max(len(a), len(b)))


def shared_passages(seed, documents, passages=6):
    """Texts that hold common passages in own surroundings, some of them with near copies."""
    rng = random.Random(seed)
    common = [" ".join(f"p{k}x{i}" for i in range(40)) for k in range(passages)]
    texts = []
    for d in range(documents):
        own = [f"d{d}x{i}" for i in range(rng.randrange(120, 260))]
        parts = [" ".join(own), *rng.sample(common, rng.randrange(1, 3))]
        rng.shuffle(parts)
        texts.append(" ".join(parts))
        if d % 6 == 0:
            words = texts[-1].split()
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    return texts


def test_common_passages_make_no_large_candidate_groups(spark, monkeypatch):
    seen = []
    verify = jaccard.verify
    monkeypatch.setattr(jaccard, "verify", lambda members, *more: seen.append(members.groupBy("comp").count().agg({"count": "max"}).first()[0]) or verify(members, *more))
    rows = list(enumerate(shared_passages(2, 150)))
    df = spark.createDataFrame([(k, t, None) for k, t in rows], SCHEMA)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect())
    assert got == brute(rows, 5, 80)
    assert seen[0] <= 20  # true groups have two sets


@pytest.mark.parametrize("percent", [80, 85])
def test_linked_sets_keep_a_shared_signature(percent):
    """Without their most frequent signatures linked sets still meet, whatever is frequent."""
    rng = np.random.default_rng(percent)
    for size in [30, 60, 100, 170, 300, 700]:
        for _ in range(6):
            tokens = rng.integers(0, 2**63, size * 2, dtype=np.uint64)
            gone = next(k for k in range(size, -1, -1) if 100 * (size - k) >= percent * size)
            a, b = np.sort(tokens[:size]), np.sort(rng.permutation(tokens[:size])[gone:])
            weight = lambda sig: (int(sig) % 7, int(sig))
            met = False
            for band, own in jaccard.filed_signatures(a, percent):
                for other_band, other in jaccard.filed_signatures(b, percent):
                    if band == other_band:
                        k = jaccard.shared_by_band(percent)[band]
                        assert len(np.intersect1d(own, other)) >= k
                        both = set(own.tolist()) & set(other.tolist())
                        met |= bool(set(sorted(map(int, own), key=weight)[: len(own) - k + 1]) & set(sorted(map(int, other), key=weight)[: len(other) - k + 1]) & both)
            assert met


def test_groups_cross_batches(spark):
    """Signature groups longer than an Arrow batch, repeated rows among them, and single rows at every border."""
    rows = [(s, h) for s, sets in [(1, 300), (2, 1), (3, 2), (4, 97), (5, 1), (6, 98), (7, 1)] for h in range(sets)]
    rows += rows[::3]
    df = spark.createDataFrame([(s, h, None, None, -1) for s, h in rows] + [(9, 9, 5, 5, 0)], "sig long, sh long, key long, th long, n int")
    got = [(r["sig"], r["sh"]) for r in jaccard.meet(df.coalesce(1)).where("n < 0").collect()]
    assert sorted(got) == sorted({(s, h) for s, h in rows if s not in (2, 5, 7)})
    assert jaccard.meet(df).where("n >= 0").count() == 1


def test_repeated_rows_and_null_keys(spark):
    rows = [(5, "a b c d e f", None), (5, "a b c d e f", None), (None, "z y x w v", None), (7, None, None), (7, None, None)]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 1, 0), (5, 2, 5), (5, 2, 5), (7, 0, 7), (7, 0, 7)]
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
