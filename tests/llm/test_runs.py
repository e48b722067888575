"""Periodic runs against a scan of every lag, alone and through the registered query."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import runs
from tidemark.llm.queries import op12_periodic_runs


def brute(words, least=6, times=4):
    """Every maximal stretch for every lag; the smallest lag of a stretch is its period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda run: (run[0], run[2]))


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(pick):
    letters = pick.choice([1, 2, 2, 3, 5, 50])
    size = pick.choice([0, 1, 5, 7, 30, 100, 400])
    if pick.random() < 0.5:
        return [str(pick.randrange(letters)) for _ in range(size)]
    out = []
    while len(out) < size:
        part = [str(pick.randrange(letters)) for _ in range(pick.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 60]))]
        out += (part * 10)[: int(len(part) * pick.uniform(1, 9))]
    return out


def check(texts, least=6, times=4):
    got = runs._batch_runs(texts, least, times)
    for words, (found, kept) in zip(texts, got, strict=True):
        want = brute(words, least, times)
        assert [tuple(run) for run in found.tolist()] == want
        assert kept == collapsed(words, want)
    return sum(len(found) for found, _ in got)


def test_random_batches_agree_with_every_lag():
    pick = random.Random(5)
    assert sum(check([random_words(pick) for _ in range(pick.randint(1, 8))]) for _ in range(60)) > 200


@pytest.mark.parametrize(("least", "times"), [(6, 4), (1, 4), (40, 4), (6, 5), (20, 7)])
def test_other_bounds(least, times):
    pick = random.Random(6)
    check([random_words(pick) for _ in range(40)], least, times)


def test_words_of_fibonacci_and_thue_morse():
    a, b = ["a"], ["a", "b"]
    while len(b) < 900:
        a, b = b, b + a
    morse = [str(bin(i).count("1") & 1) for i in range(700)]
    check([b, morse, b[1:], b[:500] * 4])


def test_every_period_is_found_at_every_place():
    texts = []
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 129]:
        for lead in (0, 3):
            texts.append([f"x{i}" for i in range(lead)] + [str(i % q) for i in range(max(6, 4 * q))] + ["end"])
            texts.append([str(i % q) for i in range(max(6, 4 * q) - 1)])
    assert check(texts) == 2 * 45


def test_repeats_across_texts_are_no_runs():
    assert check([["a", "b"]] * 50) == 0
    assert check([[str(i) for i in range(20)]] * 9) == 0


def test_long_texts_take_no_more_than_linear_work():
    for words in (["x"] * 100_000, [str(i % 9001) for i in range(100_000)], ["b" if i % 1000 else "a" for i in range(100_000)]):
        found, kept = runs._batch_runs([words], 6, 4)[0]
        assert len(found) >= 1 and len(kept) < len(" ".join(words))


def test_window_minima_cover_every_window():
    values = np.array([5, 3, 3, 9, 1, 1, 1, 8, 7, 6, 2], np.uint64)
    for width in (1, 2, 4, 8):
        want = {int(i + np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)}
        assert runs.window_minima(values, width).tolist() == sorted(want)
    assert runs.window_minima(values[:3], 8).tolist() == []


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest_row(doc_id, text):
    words = planted(doc_id, re.findall(runs.WORD, text or ""))
    found = brute(words)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if found else (None,) * 3
    milli = 1000 * best[1] // best[2] if found else None
    hashes = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, found)))
    return (doc_id, len(found), *best, milli, *hashes)


def small_documents(spark, path):
    pick = random.Random(8)
    rows = [(i, " \t".join(random_words(pick)), "clash", 1) for i in range(150)]
    rows += [(i, "\n".join(f"w{k}" for k in range(pick.randint(1, 90))), None, 2) for i in range(-60, 0)]
    rows += [(200, None, None, 0), (201, "", None, 0), (202, " \n\t", None, 0), (None, "b " * 9, None, 0), (None, None, None, 0), (150, "é\x0bé é é é é\xa0é", "x", 3), (150, "é\x0bé é é é é\xa0é", "x", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, `Runs` string, best int").write.parquet(f"{path}/documents.parquet")
    return rows


def test_registered_query_against_brute_force(spark, tmp_path):
    rows = small_documents(spark, tmp_path)
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    want = [digest_row(doc_id, text) for doc_id, text, *_ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5 and sum(r[1] for r in got) > 60


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 8000")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for row in runs.detect_runs(docs).collect():
        words = re.findall(runs.WORD, texts[row["doc_id"]])
        want = brute(words)
        assert [tuple(run) for run in row["runs"]] == want and row["n_words"] == len(words)
        assert row["collapsed"] == collapsed(words, want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, `Runs` string")
    assert runs.detect_runs(runs.with_planted_runs(empty)).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(np.arange(5), np.array([5]), 2, 3)
