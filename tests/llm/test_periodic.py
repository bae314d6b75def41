"""Runs of words against the definition, tried at every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import periodic


def plain_runs(words, least=24, times=3):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, times * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_report(doc_id, words, least=24, times=3):
    own = plain_runs(words, least, times)
    gone = {i for s, n, q in own for i in range(s + q, s + n)}
    best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(own), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in own)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def sample(rnd):
    n = rnd.randrange(600)
    kind = rnd.randrange(6)
    if kind == 0:
        return [rnd.randrange(2) for _ in range(n)]
    if kind == 1:  # a period, with a few words changed
        base = [rnd.randrange(rnd.choice([2, 5, 1000])) for _ in range(rnd.randrange(1, 150))]
        out = [base[i % len(base)] for i in range(n)]
        for _ in range(rnd.randrange(3) if n else 0):
            out[rnd.randrange(n)] = 2
        return out
    if kind == 2:  # Fibonacci words hold the most runs
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:  # runs within runs
        inner = [rnd.randrange(3) for _ in range(rnd.randrange(1, 8))] * rnd.randrange(3, 9)
        return ((inner + [rnd.randrange(3) for _ in range(rnd.randrange(9))]) * rnd.randrange(2, 7))[:600]
    if kind == 4:  # Thue-Morse: no run at all
        return [i.bit_count() % 2 for i in range(n)]
    return [rnd.randrange(1000) for _ in range(n)]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("least, times", [(24, 3), (10, 3), (40, 4)])
def test_find_runs(seed, least, times):
    rnd = random.Random(seed)
    docs = [sample(rnd) for _ in range(rnd.randrange(1, 9))]
    counts = np.array([len(d) for d in docs], np.int64)
    got = periodic.find_runs(np.array([x for d in docs for x in d], np.int64), counts, least, times)
    starts = np.cumsum(counts) - counts
    want = [(s + int(at), s + n + int(at), q) for at, d in zip(starts, docs) for s, n, q in plain_runs(d, least, times)]
    assert got == want


def test_minimizers_are_window_minima():
    x = np.random.default_rng(3).integers(0, 9, 200).astype(np.uint64)
    for width in (1, 2, 7, 200):
        want = {p for i in range(len(x) - width + 1) for p in range(i, i + width) if x[p] == x[i:i + width].min()}
        assert set(periodic.minimizers(x, width).tolist()) == want
    assert not len(periodic.minimizers(x, 201))


def test_scales_leave_no_period_out():
    seen = [q for low, high, window in periodic.scales(5000) for q in range(low + 1, high + 1) if window >= 1]
    assert seen[:4985] == list(range(17, 5002))


def test_report_and_cases(spark):
    rnd = random.Random(5)
    text = " ".join(f"w{rnd.randrange(40)}" for _ in range(900))
    loop = "\tone two  three\n" * 20
    rows = [(1, text), (2, loop), (2, loop), (None, loop), (3, None), (4, ""), (5, " \n "), (6, "é é " * 30),
            (7, "a " * 30_000), (8, " ".join(f"x{i % 2000}" for i in range(9000)))]
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, key string").repartition(3)
    got = sorted(map(tuple, periodic.report(docs).collect()), key=str)
    want = sorted((plain_report(d, [w.decode() for w in (t or "").encode().split()]) for d, t in rows if d != 7), key=str)
    assert [r for r in got if r[0] != 7] == want
    assert [r for r in got if r[0] == 7][0][1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert periodic.report(docs.limit(0)).collect() == []
    whole = {r.doc_id: r for r in periodic.runs(docs.where("doc_id in (2, 3)").limit(3)).collect()}
    assert whole[2].collapsed == "one two three" and [tuple(r) for r in whole[2].runs] == [(0, 60, 3)]
    assert whole[3].runs == [] and whole[3].collapsed == "" and whole[3].n_words == 0


def test_query_by_the_contract(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{rnd.randrange(300)}" for _ in range(rnd.randrange(0, 400)))) for i in range(300)] + [(None, "a b"), (40, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    from waybill.llm.queries import QUERIES

    def cycled(doc_id, words):
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is None or h % 10 or not n:
            return words
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]

    got = sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    want = sorted((plain_report(d, cycled(d, (t or "").split())) for d, t in rows), key=str)
    assert got == want and sum(r[1] > 0 for r in got) >= 10


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(50, np.int64), np.array([50]), 24, 2)


def test_text_ids(spark):
    docs = spark.createDataFrame([("x", "a b " * 20)], "doc_id string, text string")
    assert periodic.report(docs).withColumn("n", F.col("n_runs")).collect()[0][:4] == ("x", 1, 0, 40)
