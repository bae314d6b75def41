"""Hard negatives against plain sorting, the cover tree against its own promises."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_topk import corpus, usable, whole
from waybill.llm import negatives, vectors

COLUMNS = "vec_id long, embedding array<float>, label int, place string, N int"


def plain(rows, every, positives, k):
    own = [(i, r[0], whole(r[1]), r[2]) for i, r in enumerate(rows) if usable(r[1]) and r[2] is not None]
    out = []
    for i, a, v, label in own:
        if a is None or a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), c is None, c or 0, other == label)
                  for j, c, w, other in own if j != i and len(v) == len(w)]
        for ps, none, p, _ in sorted(s for s in scored if s[3])[:positives]:
            far = sorted(s for s in scored if not s[3] and 30 * -ps <= 100 * -s[0] <= 90 * -ps)[:k]
            out += [(a, None if none else p, rank, None if n else c, -ps, -s) for rank, (s, n, c, _) in enumerate(far, 1)]
    return sorted(out, key=str)


def frame(spark, rows, parts=3):
    floats = lambda v: v if v is None else [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, floats(v), label, "p", 2) for i, v, label in rows], COLUMNS).repartition(parts)


def mined(spark, rows, every, **more):
    df = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0, F.col("label"), **more)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, dims, spread", [(1, 16, 1.0), (2, 3, 0.05)])
def test_against_sorting(spark, monkeypatch, seed, dims, spread):
    monkeypatch.setattr(vectors, "LEAST", 50)
    monkeypatch.setattr(vectors, "BLOCK", 40 * dims)
    monkeypatch.setattr(vectors, "ASKED", 10 * dims)
    rnd = random.Random(seed)
    rows = [(i, v, rnd.randrange(4)) for i, v in corpus(seed, 250, dims, spread)]
    got = mined(spark, rows, 10)
    assert got == plain(rows, 10, 5, 10) and len(got) > 200


def test_ties_copies_nulls_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST", 30)
    rnd = random.Random(3)
    rows = [(i, v, rnd.randrange(3)) for i, v in corpus(4, 60, 4)]
    same = [float(np.float32(0.8 * x)) for x in rows[10][1]]
    rows += [(100 + i, same, i % 3) for i in range(90)] + [(10, same, 1), (10, same, 1), (None, same, 2), (None, same, 0)]
    rows += [(20, None, 1), (30, rows[3][1], None), (40, [1.0, None, 2, 3], 1), (50, [float("nan"), 1, 1, 1], 2), (60, [], 1), (70, [], 2),
             (110, [0.0, 0, 0, 0], 0), (120, [0.0, 0, 0, 0], 0), (80, [1.0, 2.0], 0), (90, [2.0, 1.0], 0), (91, [1.0, 1.0], 1)]
    rnd.shuffle(rows)
    assert mined(spark, rows, 10) == plain(rows, 10, 5, 10)


def test_few_rows_none_and_text_labels(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.7, 0.0], 2)]
    assert mined(spark, rows, 9) == plain(rows, 9, 5, 10) == [(0, 1, 1, 2, 65536, 45824)]
    assert mined(spark, rows[:1], 9) == []
    df = frame(spark, rows)
    assert negatives.hard_negatives(df.limit(0), F.lit(True), F.col("label")).collect() == []
    texts = negatives.hard_negatives(df, F.col("vec_id") == 0, F.concat(F.lit("l"), F.col("label").cast("string")))
    assert [tuple(r) for r in texts.collect()] == [(0, 1, 1, 2, 65536, 45824)]


def test_tree_covers_bounds_and_holds_every_row():
    rng = np.random.default_rng(5)
    x = np.vstack([rng.integers(-9, 9, (200, 6)), rng.integers(-200, 200, (200, 6)), np.repeat(rng.integers(-9, 9, (3, 6)), 20, 0)])
    tree = negatives.CoverTree(x, 200)

    def below(node):
        own = {int(tree.point[node])}
        for child in range(tree.first[node], tree.last[node]):
            own |= below(child)
        return own

    assert below(0) == set(range(len(tree.x))) and sorted(tree.rows.tolist()) == list(range(len(x)))
    assert np.bincount(tree.point[tree.fresh]).tolist() == [1] * len(tree.x)
    for node in range(len(tree.point)):
        own = np.array(sorted(below(node)))
        assert tree._apart(tree.point[[node]], own).max() <= tree.radius[node] + tree.slack
        for q in rng.integers(-100, 100, (5, 6)):
            scores = tree.x @ q
            least, most = tree.bounds(np.array([node]), scores[tree.point[[node]]], float(np.linalg.norm(q)))
            assert least[0] <= scores[own].min() and scores[own].max() <= most[0]


def test_descent_skips_what_lies_outside_the_windows():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 32)) * 100
    x = np.rint(np.repeat(centers, 50, 0) + rng.normal(size=(2000, 32))).astype(np.int64)
    tree = negatives.CoverTree(x, 1000)
    fits = np.ones(len(x), bool)
    fits[:50] = False
    top = int((x[:50] @ x[0]).max())
    own = negatives.Windows(np.array([30 * top]), np.array([90 * top]), np.array([-np.inf]), 10)
    assert negatives.descend(tree, x[0], own, fits) < 1000
    scores = x @ x[0]
    ok = fits & (100 * scores >= 30 * top) & (100 * scores <= 90 * top)
    want = np.lexsort((np.arange(len(x)), -scores))
    assert own.rows[0].tolist() == [i for i in want.tolist() if ok[i]][:10]
