"""Dependent rounding: targets by a plain loop, kept words, bounds, and reruns."""

import re
from collections import defaultdict

import numpy as np
import pytest

from waybill.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def check(spark, rows, columns="doc_id long, source string, text string"):
    df = spark.createDataFrame(rows, columns)
    got = mixing.report(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.report(df.repartition(7)).collect()))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[1]] += count(r[2])
        largest[r[1]] = max(largest[r[1]], count(r[2]))
    targets = plain_targets(sizes)
    assert sorted((r.size, r.source_size) for r in got) == sorted((count(r[2]), sizes[r[1]]) for r in rows)
    assert all(0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in got)
    if len({r[0] for r in rows}) == len(rows):
        source = {r[0]: r[1] for r in rows}
        taken = defaultdict(int)
        for r in got:
            assert r.target == pytest.approx(targets[source[r.doc_id]])
            taken[source[r.doc_id]] += r.taken
        for s in sizes:
            assert abs(taken[s] - targets[s]) <= largest[s]


def rows_of(n, sources, seed):
    rng = np.random.default_rng(seed)
    return [(i, sources[min(int(rng.exponential(2)), len(sources) - 1)], " ".join(["w"] * int(rng.pareto(1.2) * 5)))
            for i in range(n)]


def test_many_sources(spark):
    check(spark, rows_of(1500, ["b", "a", "é", None, "Z", "c", "d"], 1))


def test_tree_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 8)
    monkeypatch.setattr(mixing, "FAN", 3)
    check(spark, rows_of(600, ["hot", "x", "y"], 2))


def test_odd_rows(spark):
    check(spark, [(1, "a", None), (2, "a", ""), (3, None, "one two"), (4, "b", " \n three \t"), (5, "b", "x " * 100_000)])
    check(spark, [(1, "a", "w w")] * 5 + [(None, "a", "w"), (2, None, "w w w"), (2, None, "w w w")])
    check(spark, [(1, "a", None)])
    check(spark, [])
    check(spark, [(i, "s", "a b", 1, "t") for i in range(9)],
          "doc_id long, source string, text string, row int, target string")


def test_expectation_and_words_are_kept():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 50, 40).tolist()
    share = rng.random(40).tolist()
    sums = np.zeros(40)
    for turn in range(4000):
        extra, _ = mixing.settle(size, share, rng.integers(0, 1 << 60, 40).tolist(), 0, True)
        assert abs(np.dot(size, extra) - np.dot(size, share)) <= 50
        sums += extra
    assert np.abs(sums / 4000 - share).max() < 0.04


def test_copies_keep_columns(spark):
    rows = [(i, "s" if i % 3 else "t", "a b " * (i % 7), i * 2, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, row int, copies string")
    want = {r.doc_id: r.copies for r in mixing.mix(df).collect()}
    out = mixing.copied(df)
    assert out.columns == df.columns
    got = out.groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == {k: v for k, v in want.items() if v}
