from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import sais, suffix

SCHEMA = "doc_id bigint, text string, th string"


def text_of(parts):
    return np.frombuffer(b"".join(bytes(c + 2 for c in p) + b"\x01" for p in parts) + b"\0", np.uint8)


@pytest.mark.parametrize("letters", [b"ab", b"abcdef", b"a"])
def test_suffix_arrays_and_common_prefixes(letters):
    for seed in range(80):
        rng = random.Random(seed)
        parts = [bytes(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 6))]
        text = text_of(parts + parts[: seed % 2])
        raw = text.tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        order = sais.suffix_array(text)
        assert order.tolist() == want
        before, prefix = sais.permuted_prefixes(text, order)
        for low, high in zip(want, want[1:]):
            n = 0
            while max(low, high) + n < len(raw) and raw[low + n] == raw[high + n]:
                n += 1
            assert before[high] == low and prefix[high] == n


def brute(texts, length):
    """Flags of repeated bytes, by comparing all windows."""
    places = {}
    for t, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            places.setdefault(data[i : i + length], []).append((t, i))
    flags = [bytearray(len(d)) for d in texts]
    for found in places.values():
        if len(found) > 1:
            for t, i in found:
                flags[t][i : i + length] = b"\1" * length
    return flags


def expected(texts, length):
    out = []
    for data, flags in zip(texts, brute(texts, length)):
        kept = bytes(b for b, f in zip(data, flags) if not f)
        spans = sum(f and (i == 0 or not flags[i - 1]) for i, f in enumerate(flags))
        out.append((len(data), sum(flags), spans, hashlib.sha256(kept).hexdigest()))
    return out


def made_texts(seed, n=40):
    rng = random.Random(seed)
    passage = "".join(rng.choice("abcdé ") for _ in range(70))
    texts = []
    for _ in range(n):
        text = "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(120)))
        if rng.random() < 0.4:
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + passage[rng.randrange(30) :] + text[cut:]
        texts.append(text)
    return texts + texts[:3] + ["x" * 90, "xy" * 60, None, "", "short"]


@pytest.mark.parametrize(("group", "shard"), [(6_000_000, 1_500_000), (200, 1_000), (6_000_000, 10)])
def test_removal_matches_brute_force(spark, group, shard):
    texts = made_texts(group + shard)
    rows = [(i // 2, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix.remove_repeats(df, length=32, k=8, shard=shard, group=group).collect()
    want = expected([(t or "").encode() for t in texts], 32)
    assert sorted(tuple(r) for r in got) == sorted((i // 2, *w) for i, w in enumerate(want))


def test_long_texts_are_searched_in_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 150)
    texts = made_texts(7)
    pieces = {}
    for number, data in enumerate(t.encode() for t in texts if t):
        parts = list(suffix._pieces(data, 32))
        windows = sorted(at + i for at, p in parts for i in range(len(p) - 31))
        assert windows == list(range(max(0, len(data) - 31)))
        pieces[number] = len(parts)
    assert max(pieces.values()) > 1


def test_equal_windows_share_anchor_and_offset():
    rng = random.Random(3)
    middle = bytes(rng.randrange(97, 103) for _ in range(120))
    texts = [bytes(rng.randrange(97, 103) for _ in range(n)) + middle + bytes(rng.randrange(97, 103) for _ in range(n)) for n in (0, 13, 57)]
    number, anchor, first, count = suffix.anchors(texts, 32, 8)
    of = {}
    for t, a, f, c in zip(number.tolist(), anchor.tolist(), first.tolist(), count.tolist()):
        for i in range(f, f + c):
            assert (t, i) not in of
            of[t, i] = a
    assert len(of) == sum(len(t) - 31 for t in texts)
    marks = {}
    for (t, i), a in of.items():
        assert marks.setdefault(texts[t][i : i + 32], a) == a


def test_no_documents(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_lose_everything_and_short_texts_nothing(spark):
    rows = [(1, "w" + "é" * 120, ""), (1, "w" + "é" * 120, ""), (2, "short", ""), (3, "short", "")]
    got = sorted(tuple(r)[:4] for r in suffix.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 241, 241, 1), (1, 241, 241, 1), (2, 5, 0, 0), (3, 5, 0, 0)]


def test_induction_takes_few_sweeps_on_repeating_texts(monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    parts = [(rng.choice(words) + rng.choice(passages)[rng.randrange(40) :]).encode() for _ in range(300)]
    raw = b"\xff".join(parts) + b"\xff"
    sweeps = []
    place = sais._place
    monkeypatch.setattr(sais, "_place", lambda *given: (sweeps.append(1), place(*given)))
    text = np.append(np.frombuffer(raw, np.uint8) + np.uint8(2), np.uint8(0))
    order = sais.suffix_array(text)
    data = text.tobytes()
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    assert len(sweeps) < 150


@pytest.mark.parametrize(("group", "shard"), [(6_000_000, 1_500_000), (200, 1_000)])
def test_stretches_that_cross_batches(spark, group, shard):
    texts = made_texts(11, n=15)
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        got = suffix.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(2), length=32, k=8, shard=shard, group=group).collect()
    finally:
        spark.conf.set(name, before)
    want = expected([(t or "").encode() for t in texts], 32)
    assert sorted(tuple(r) for r in got) == sorted((i, *w) for i, w in enumerate(want))


def test_ranges_of_parts_match_brute_force():
    for seed in range(30):
        rng = random.Random(seed)
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(8, 40))) for _ in range(rng.randrange(1, 6))]
        flags = brute(parts, 8)
        got = [bytearray(len(p)) for p in parts]
        for part, low, high in zip(*(c.tolist() for c in suffix.repeated_ranges(parts, 8))):
            got[part][low:high] = b"\1" * (high - low)
        assert got == flags


def test_anchors_pass_over_texts_without_a_window():
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in (0, 31, 90, 0, 5, 32, 31)]
    number, _, first, count = suffix.anchors(texts, 32, 8)
    windows = sorted((t, i) for t, f, c in zip(number.tolist(), first.tolist(), count.tolist()) for i in range(f, f + c))
    assert windows == [(t, i) for t, text in enumerate(texts) for i in range(len(text) - 31)]
