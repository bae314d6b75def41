"""Top-k by impact against plain sorting of all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from waybill.llm import topk, vectors

COLUMNS = "vec_id long, embedding array<float>, label int, place string, KEY int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def plain(rows, every, k):
    own = [(i, r[0], whole(r[1])) for i, r in enumerate(rows) if usable(r[1])]
    out = []
    for i, q, v in own:
        if q is None or q % every:
            continue
        scored = [(-sum(map(lambda a, b: a * b, v, w)), c is None, c or 0) for j, c, w in own if j != i and len(w) == len(v)]
        out += [(q, rank, None if none else c, -s) for rank, (s, none, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    floats = lambda v: v if v is None else [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, floats(v), 1, "p", 2) for i, v in rows], COLUMNS).repartition(parts)


def corpus(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    return [(i, (centers[rng.integers(6)] + spread * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("seed, dims, spread", [(1, 16, 1.0), (2, 3, 0.05), (3, 64, 0.3)])
def test_against_sorting(spark, monkeypatch, seed, dims, spread):
    monkeypatch.setattr(vectors, "LEAST", 50)  # several slices
    monkeypatch.setattr(vectors, "BLOCK", 40 * dims)  # several blocks in a slice
    monkeypatch.setattr(vectors, "ASKED", 20 * dims)  # several blocks of queries
    rows = corpus(seed, 300, dims, spread)
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 5 == 0, k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 5, 5)


def test_ties_copies_nulls_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST", 30)
    rows = corpus(4, 60, 4)
    same = rows[7][1]
    rows += [(100 + i, same) for i in range(80)] + [(10, same), (10, same), (None, same), (None, [1.0, 2, 3, 4])]
    rows += [(20, None), (30, [1.0, None, 2, 3]), (40, [float("nan"), 1, 1, 1]), (50, [float("inf"), 1, 1, 1]),
             (60, [1.0, 2.0]), (70, [2.0, 1.0]), (80, []), (90, []), (110, [0.0, 0, 0, 0])]
    random.Random(1).shuffle(rows)
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=5)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 10, 5)


def test_few_rows_and_none(spark):
    rows = corpus(5, 3, 8)
    assert sorted(map(tuple, topk.top_k(frame(spark, rows), F.col("vec_id") == 0, k=5).collect())) == plain(rows[:3], 9, 5)
    assert topk.top_k(frame(spark, rows).limit(0), F.lit(True)).collect() == []
    assert topk.top_k(frame(spark, rows), F.lit(None).cast("boolean")).collect() == []


def test_text_keys(spark):
    rows = corpus(6, 20, 4)
    named = frame(spark, rows).withColumn("vec_id", F.lpad(F.col("vec_id").cast("string"), 3, "0"))
    got = topk.top_k(named, F.col("vec_id") == "000", k=2).collect()
    assert [(r.query_id, int(r.vec_id), r.score) for r in got] == [("000", c, s) for _, _, c, s in plain(rows, 99, 2)]


def test_too_large_a_component_stops_with_a_message(spark):
    with pytest.raises(PySparkException, match="in magnitude"):
        topk.top_k(frame(spark, [(0, [1e9]), (1, [1.0])]), F.lit(True)).collect()


def test_bounds_never_lose_a_member_and_stop_early():
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(2000, 32)) * rng.choice([1, 1, 40], size=(2000, 32))).astype(np.int64)
    index, read = topk.Index(x), 0
    for own in range(0, 2000, 50):
        rows, scores, postings = topk.members(index, vectors.exact_form(x, int(np.abs(x).max())), x[own], own, float("-inf"), 5)
        read += postings
        all_scores = x @ x[own]
        all_scores[own] = -10**15
        want = np.lexsort((np.arange(2000), -all_scores))[:5]
        assert sorted(rows.tolist()) == sorted(want.tolist()) and sorted(scores.tolist()) == sorted(all_scores[want].tolist())
    assert 0 < read < 40 * index.sizes.sum()
