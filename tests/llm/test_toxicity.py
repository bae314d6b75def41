"""Classifier chain: held-out accuracy on given labels, out-of-fold features, odd rows."""

import math

import numpy as np
import pytest

from waybill.llm import toxicity


def test_labels_kept_out_are_predicted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in toxicity.report(docs, labels.where("doc_id % 3 <> 0")).collect()}
    tests = labels.where("doc_id % 3 = 0").collect()
    assert len(got) == docs.count()
    missed = [r.doc_id for r in tests if r.toxic and not got[r.doc_id].toxic]
    wrong = [r.doc_id for r in tests if not r.toxic and got[r.doc_id].toxic]
    # 38 toxic rows teach four languages here; on the larger check tables about 1 of 100 is missed.
    assert len(missed) <= 0.5 * sum(r.toxic for r in tests) and len(wrong) <= 0.02 * len(tests)
    clean = {r.doc_id for r in toxicity.clean(docs, labels.where("doc_id % 3 <> 0")).select("doc_id").collect()}
    assert clean == {k for k, r in got.items() if not r.toxic}


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{chr(97 + x % 26)}{chr(97 + x // 26)}" for x in rng.integers(0, 400, 40)]
        if i % 4 == 0:
            words[::9] = ["nasty", "vile", "nasty", "awful", "vile"][: len(words[::9])]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_later_links_see_earlier_probabilities():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 50, 6)) for _ in range(400)]
    first = np.array([bool((r < 10).any()) for r in rows])
    chain = toxicity.Chain(rows, np.column_stack([first, first, first]), np.arange(400) % toxicity.FOLDS, np.ones(400))
    assert [len(link.before) for link in chain.links] == [0, 1, 2]
    assert chain.links[1].before[0] > 0.5 and 0 < chain.threshold < 1


def test_threshold_is_in_the_widest_gap():
    p, y = np.array([0.01, 0.02, 0.03, 0.97, 0.99]), np.array([0, 0, 0, 1, 1])
    assert toxicity.cut(p, y, np.ones(5)) == pytest.approx(0.5, abs=0.01)
    assert toxicity.cut(np.array([0.2, 0.6, 0.7]), np.array([0, 1, 0]), np.array([1, 1, 5.0])) > 0.7


def test_odd_rows(spark):
    rows, labels = rows_of(200)
    rows += [(500, None), (501, ""), (502, "nasty vile"), (None, "nasty vile awful"), (503, "wa " * 100_000 + "vile nasty"),
             (0, rows[0][1]), (0, rows[0][1])]
    shape = "doc_id long, toxic int"
    marks = spark.createDataFrame(labels + [(0, 1), (1, None), (None, 1), (900, 1)], shape)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.report(df, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    toxic = {r.doc_id for r in got if r.toxic}
    assert {i for i in range(200) if i % 4 == 0} | {502, 503, None} == toxic
    assert not any(r.toxic for r in toxicity.report(df, marks.where("toxic = 0")).collect())
    assert not any(r.toxic for r in toxicity.report(df, marks.limit(0)).collect())
    assert toxicity.report(df.limit(0), marks).collect() == []
    odd = spark.createDataFrame([(i, t, True, 0.5, "j") for i, t in rows[:200]],
                                "doc_id long, text string, toxic boolean, score double, k string")
    assert toxicity.clean(odd, marks).columns == odd.columns and toxicity.clean(odd, marks).count() == 150


def test_length_and_distinct_words_are_no_evidence():
    import pandas as pd

    folder = "/root/testdata/sf0.01"
    rows = pd.read_parquet(f"{folder}/documents.parquet").merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    words, toxic = [toxicity.word_list(t) for t in rows.text], (rows.toxic == 1).to_numpy()
    chain = toxicity.Chain([toxicity.features(w) for w in words], toxicity.degrees([toxicity.counted(w) for w in words], toxic),
                           np.arange(len(words)) % toxicity.FOLDS, np.ones(len(words)))
    at = toxicity.CATEGORIES.index("toxic")

    def judged(text):
        return chain.probabilities(text)[at] >= chain.threshold

    rng = np.random.default_rng(4)
    for n in (5_000, 40_000):
        invented = ["".join(map(chr, rng.integers(97, 123, k))) for k in rng.integers(3, 11, n)]
        assert not judged(" ".join(invented))
    good = [t for t, y in zip(rows.text, toxic) if not y and not judged(t)]
    assert len(good) > 0.95 * (~toxic).sum() and not judged(" ".join(good))
    bad = [t for t, y in zip(rows.text, toxic) if y and judged(t)]
    assert len(bad) > 20 and all(judged(" ".join([*good[:20], t, *good[20:40]])) for t in bad[:10])


def test_degrees_reach_the_verdict():
    words = [[b"vile", b"vile", b"nasty"] if i % 3 == 0 else [b"calm", b"w%d" % (i % 7)] for i in range(90)]
    toxic = np.arange(90) % 3 == 0
    labels = toxicity.degrees([toxicity.counted(w) for w in words], toxic)
    assert toxicity.CATEGORIES[-1] == "toxic" and (labels[:, -1] == toxic).all()
    chain = toxicity.Chain([toxicity.features(w) for w in words], labels, np.arange(90) % toxicity.FOLDS, np.ones(90))
    seen = chain.probabilities("vile nasty")
    assert seen[-1] >= chain.threshold > chain.probabilities("calm")[-1]
    chain.links[-1].before = np.zeros(2)
    assert chain.probabilities("vile nasty")[-1] < seen[-1]


def plain_halves(text):
    words = toxicity.word_list(text)
    return [{x for w in words[i:i + toxicity.HALF] for x in [w, *(w[:n] + b"*" for n in (4, 5, 6) if len(w) > n)]}
            for i in range(0, len(words), toxicity.HALF)]


def plain_most(halves, value):
    """The valued words of the stretch of two neighbouring halves that tells most."""
    told = [{w for w in h if value.get(w, 0)} for h in halves] or [set()]
    return max((set().union(*told[i:i + 2]) for i in range(max(len(told) - 1, 1))), key=lambda s: sum(value[w] for w in s))


def plain_link(rows, before, labels):
    """Probability of (halves, earlier probabilities), learned weight by weight."""
    kinds = [[set().union(*r) for r, y in zip(rows, labels) if bool(y) == kind] for kind in (False, True)]
    value = {}
    for w in set().union(*kinds[0], *kinds[1]):
        no, yes = (sum(w in r for r in rs) + 0.5 for rs in kinds)
        ratio = math.log(yes / (len(kinds[1]) + 1)) - math.log(no / (len(kinds[0]) + 1))
        value[w] = max(ratio - toxicity.CHANCE * math.sqrt(1 / no + 1 / yes), 0)
    z, n = {}, {}

    def weight(g, c):
        at, rate = z.get((g, c), 0.0), (1 + math.sqrt(n.get((g, c), 0.0))) / toxicity.ALPHA
        if g == "bias":
            return -at / rate
        return 0.0 if abs(at) <= toxicity.L1 else -(at - math.copysign(toxicity.L1, at)) / (rate + toxicity.L2)

    for _ in range(toxicity.ROUNDS):
        for r, earlier, y in zip(rows, before, labels):
            x = {**{w: value[w] for w in plain_most(r, value)}, **dict(enumerate(earlier)), "bias": 1.0}
            w = {(g, c): weight(g, c) for g in x for c in (0, 1)}
            s = [sum(x[g] * w[g, c] for g in x) for c in (0, 1)]
            p1 = 1 / (1 + math.exp(s[0] - s[1]))
            for (g, c), at in w.items():
                d, old = x[g] * ((p1 if c else 1 - p1) - (c == int(y))), n.get((g, c), 0.0)
                z[g, c] = z.get((g, c), 0.0) + d - (math.sqrt(old + d * d) - math.sqrt(old)) / toxicity.ALPHA * at
                n[g, c] = old + d * d
    told = {w: (weight(w, 1) - weight(w, 0)) * v for w, v in value.items()}
    rest = [weight(k, 1) - weight(k, 0) for k in range(len(before[0]))]
    bias = weight("bias", 1) - weight("bias", 0)
    return lambda halves, earlier: 1 / (1 + math.exp(-(
        sum(told[w] for w in plain_most(halves, told)) + sum(a * b for a, b in zip(rest, earlier)) + bias)))


def test_chain_equals_plain_training(spark):
    rows, labels = rows_of(160)
    rows = [(i, t if i % 10 else " ".join(rows[(i + k) % 160][1] for k in (0, 1, 2, 3, 5, 6, 7))) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    u = toxicity.unit(toxicity.F.col("doc_id").cast("string"), toxicity.F.col("text"), toxicity.F.lit(9))
    order = [r.doc_id for r in docs.withColumn("u", u).orderBy("u").collect()]
    marks, texts = dict(labels), dict(rows)
    toxic = [marks[i] for i in order]
    words = [toxicity.word_list(texts[i]) for i in order]
    share = [{w: sum(w in r for r, y in zip(words, toxic) if y == kind) for w in set().union(*words)} for kind in (0, 1)]
    markers = {w for w in share[1] if share[1][w] >= max(3, toxicity.MARKER_SHARE * sum(toxic))
               and share[1][w] / sum(toxic) >= toxicity.MARKER_RATE * share[0][w] / (160 - sum(toxic))}
    marked = [sum(w in markers for w in r) for r in words]
    degrees = [[y and m >= toxicity.REPEATED for y, m in zip(toxic, marked)],
               [y and m >= toxicity.DENSE * len(r) for y, m, r in zip(toxic, marked, words)], toxic]
    halves = [plain_halves(texts[i]) for i in order]
    before, links = [[] for _ in order], []
    for y in degrees:
        links.append(plain_link(halves, before, y))
        out = {}
        for f in range(toxicity.FOLDS):
            fit = [k for k in range(160) if k % toxicity.FOLDS != f]
            link = plain_link([halves[k] for k in fit], [before[k] for k in fit], [y[k] for k in fit])
            out.update({k: link(halves[k], before[k]) for k in range(160) if k % toxicity.FOLDS == f})
        before = [[*b, out[k]] for k, b in enumerate(before)]
    last = sorted((b[-1], y) for b, y in zip(before, toxic))
    odds = [math.log(p / (1 - p)) for p, _ in last]
    edges = [odds[0] - 1, *odds, odds[-1] + 1]
    errors = [sum(bool(y) for _, y in last[:k]) + sum(not y for _, y in last[k:]) for k in range(161)]
    k = max((k for k in range(161) if errors[k] == min(errors)), key=lambda k: edges[k + 1] - edges[k])
    threshold = 1 / (1 + math.exp(-(edges[k] + edges[k + 1]) / 2))
    for r in toxicity.report(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect():
        seen = []
        for link in links:
            seen.append(link(plain_halves(texts[r.doc_id]), seen))
        assert [r.p_repeated, r.p_dense, r.score] == pytest.approx(seen, abs=1e-6)
        assert r.toxic == (seen[-1] >= threshold)


def test_an_id_of_many_rows_is_bounded(spark, monkeypatch):
    rows, labels = rows_of(100)
    many = rows + [(0, f"nasty vile w{i}") for i in range(2000)]
    sizes, chain = [], toxicity.Chain
    monkeypatch.setattr(toxicity, "SAMPLE", 400)
    monkeypatch.setattr(toxicity, "Chain", lambda given, *rest: sizes.append(len(given.rows)) or chain(given, *rest))
    fitted = toxicity.fit(spark.createDataFrame(many + many, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert 200 < sizes[0] <= 400 and fitted.probabilities("nasty vile")[-1] >= fitted.threshold
