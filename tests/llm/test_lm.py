"""Language-model scores against a plain version."""

import re
import zlib
from collections import Counter
from math import log2, log10

import numpy as np
import pytest

from waybill.llm import lm


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [None]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 10


def plain(rows):
    def count(keep):
        one, two = Counter(), Counter()
        for r in rows:
            if keep(fold(r[0])):
                t = tokens_of(r[1])
                one.update(t)
                two.update(zip(["<s>", *t], t))
        one["<s>"] = one[None]
        return one, two, sum(one.values()) - one["<s>"]

    one, two, n = count(lambda f: f not in (None, 0))
    kept, kept2, m = count(lambda f: f not in (None, 0, 1))
    v = len([t for t in one if t != "<s>" and one[t]])
    bucket = lambda c: int(np.ceil(log2(c + 1)))
    p = lambda t, u, a, b, z: (b[t, u] / max(a[t], 1), a[u] / max(z, 1))
    q = lambda x: -2000 if x == 0 else max(round(log2(x) * lm.STEPS), -2000)
    cells = Counter()
    for r in rows:
        if fold(r[0]) == 1:
            t = tokens_of(r[1])
            for a, b in zip(["<s>", *t], t):
                cells[(bucket(kept[a]), *map(q, p(a, b, kept, kept2, m)))] += 1
    mixture = lm.weights([(*k, c) for k, c in cells.items()], 1 / (v + 1))
    out = {}
    for i, r in enumerate(rows):
        t = tokens_of(r[1])
        score = 0
        for a, b in zip(["<s>", *t], t):
            p2, p1 = p(a, b, one, two, n)
            w = mixture[bucket(one[a])]
            score += log10(w[0] * p2 + w[1] * p1 + w[2] / (v + 1))
        base = sum(log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        out[i] = (r[0], fold(r[0]) == 0, len(t), sum(one[x] > 0 for x in t), n, base, score)
    return list(out.values())


def check(spark, rows, columns="doc_id long, text string"):
    got = [tuple(r) for r in lm.report(spark.createDataFrame(rows, columns)).collect()]
    want = plain([r[:2] for r in rows])
    rank = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted(got, key=rank), sorted(want, key=rank)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-9)


def test_against_plain_version(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    monkeypatch.setattr(lm, "CHUNK", 50_000)
    check(spark, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"W{x}" for x in rng.zipf(1.5, 30) % 50)) for i in range(80)]
    rows += [(80, None), (81, ""), (82, " \n "), (None, "w1 w2"), (83, "é É w1 " * 40_000), (5, "again w1"), (5, "again w1")]
    check(spark, rows)
    check(spark, [])
    check(spark, [(k, "a b", "x", 1) for k in range(30) if fold(k) == 0][:2], "doc_id long, text string, score string, role int")


def test_weights_maximise_held_out_likelihood():
    rng = np.random.default_rng(2)
    rows = [(2, int(-rng.integers(0, 60)), int(-rng.integers(20, 90)), int(rng.integers(1, 50))) for _ in range(200)]
    w = lm.weights(rows, 1e-4)[2]
    p = np.array([[2 ** (r[1] / 8), 2 ** (r[2] / 8), 1e-4] for r in rows])
    c = np.array([r[3] for r in rows])
    best = (c * np.log(p @ w)).sum()
    for _ in range(200):
        other = np.abs(w + rng.normal(0, 0.05, 3))
        assert (c * np.log(p @ (other / other.sum()))).sum() <= best + 1e-3 * abs(best)


def test_mixing_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = [r for r in lm.report(docs).collect() if r.held_out]
    assert len(held) > 50 and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    arrays = [rng.integers(0, 1 << 40, 100, dtype=np.uint64), np.empty(0, np.uint32), np.arange(5, dtype=np.uint32)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, lm.all_unpacked(b"".join(map(lm.packed, arrays)))))
