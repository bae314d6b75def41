"""Repeated passages against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from waybill.llm import substring


def brute(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words):
        for i in range(len(w) - width + 1):
            if r[0] is not None:
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1):
            if r[0] is not None and first[tuple(w[i:i + width])] < r[0]:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def check(spark, rows, columns="doc_id long, text string", width=13):
    df = spark.createDataFrame(rows, columns)
    got = [tuple(r) for r in substring.without_repeats(df, width).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute([r[:2] for r in rows], width)))


def corpus(seed, n=80, vocabulary=6):
    rng = random.Random(seed)
    passages = [[f"p{k}w{j}" for j in range(rng.randint(10, 40))] for k in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(40))]
        rows.append((rng.randrange(3 * n), rng.choice([" ", "\n", "\t\x0b "]).join(words)))
    return rows


@pytest.mark.parametrize("seed,width", [(1, 13), (2, 5), (3, 2), (4, 1)])
def test_against_brute_force(spark, seed, width):
    check(spark, corpus(seed), width=width)


def test_small_slices_and_a_full_sketch(spark, monkeypatch):
    for name, value in (("SLICE", 50), ("HOLD", 100), ("HOLD_FOUND", 100), ("LEAST_BITS", 6), ("MOST_BITS", 6), ("SEGMENT_BITS", 3)):
        monkeypatch.setattr(substring, name, value)
    check(spark, corpus(5), width=5)


def test_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    check(spark, [(1, None), (2, ""), (3, " \n"), (4, passage), (4, passage), (5, passage + " x"), (4, "other " + passage),
                  (None, passage), (6, "few words"), (7, "the " * 5000), (8, "the " * 13 + passage.upper()), (-3, "é " * 14),
                  (9, "É é " + "é " * 30)])
    check(spark, [])
    check(spark, [(2, passage, "x", 1), (1, passage, "y", 2)], "doc_id long, text string, starts string, mark int")


def test_sketch_never_counts_too_low(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 40, 60))) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, t string")
    merged = substring.sketch(df, 3, 12)
    bits = substring._shared(spark, merged, 12).value
    words = [w.encode() for _, t in rows for w in t.split()]
    hashes, _, _ = substring.windows(words, np.full(50, 60), 3)
    _, inverse, many = np.unique(hashes, axis=0, return_inverse=True, return_counts=True)
    twice = many[inverse.reshape(-1)] > 1
    for row, cell in enumerate(substring.cells(hashes, 12)):
        assert (np.frombuffer(bits[row], np.uint8)[cell >> 3] >> (cell & 7) & 1)[twice].all()
