"""Language identification: features and fit against plain versions, held-out accuracy, calibration, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from waybill.llm import langid


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in langid.report(docs).collect()}
    want = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect()}
    assert got.keys() == want.keys()
    assert all(r.held_out == held(k) and 0 <= r.score <= 1 for k, r in got.items())
    tests = [k for k in got if held(k) and langid.has_letter(want[k][1])]
    right = np.array([got[k].lang_pred == want[k][0] for k in tests])
    assert right.mean() > 0.97
    assert abs(np.mean([got[k].score for k in tests]) - right.mean()) < 0.05


def test_only_learnable_rows_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = langid.remainder(langid.F.col("doc_id"), 4)
    other = docs.withColumn("lang", langid.F.when(fold == 2, "xx").otherwise(langid.F.col("lang"))).withColumn(
        "source", langid.F.lit("s"))
    a, b = (sorted(langid.report(d).collect()) for d in (docs, other))
    assert a == b


def test_frequencies_cover_all_texts(spark):
    texts = ["abc", "abca", "", None, "zzz" * 40_000, "Ab é"]
    found, n = langid.frequencies(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3))
    want = np.zeros(1 << langid.BITS, int)
    for t in texts:
        want[np.unique(langid.grams(t or ""))] += 1
    assert n == len(texts) and (found == want).all()


def test_grams_count_every_place():
    text = "abcab" * 2000
    at, counts = langid.counted(text)
    assert counts.sum() == sum(len(text) - n + 1 for n in langid.ORDERS)
    assert (langid.counted("ABCAB")[0] == langid.counted("abcab")[0]).all()
    assert len(langid.grams("")) == 0 and len(langid.grams("é")) == 1


def test_leader_learns_and_is_sparse():
    rng = np.random.default_rng(1)
    leader = langid.Leader(200, 3, l1=0.5)
    rows = []
    for _ in range(600):
        y = int(rng.integers(3))
        at = np.unique(np.append(rng.integers(10, 200, 8), y))
        rows.append((at, np.full(len(at), 1 / np.sqrt(len(at))), y))
    for at, x, y in rows * 2:
        leader.learn(at, x, y)
    w = leader.weights(np.arange(201))
    assert np.mean([(x @ w[at] + w[-1]).argmax() == y for at, x, y in rows]) > 0.99
    assert (w[10:200] == 0).mean() > 0.5


def test_temperature_is_found():
    rng = np.random.default_rng(2)
    true = rng.normal(size=(4000, 3))
    labels = np.array([rng.choice(3, p=langid.softmax(s)) for s in true])
    assert langid.temperature(true * 4, labels) == pytest.approx(4, rel=0.15)
    assert langid.temperature(np.empty((0, 3)), np.empty(0, int)) == 1


def test_odd_rows(spark):
    rows = [(i, ["the cat sat on that mat", "der hund und die katze"][i % 2] + " " * (i % 3), ["en", "de"][i % 2]) for i in range(60)]
    rows += [(60, None, "en"), (61, "", "en"), (62, "12 34 !?", None), (63, "é" * 200_000, None), (None, "the cat", "fr"),
             (64, "the cat sat", None), (65, "und die katze", None)] + [(0, rows[0][1], "en")] * 20
    got = langid.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (60, 61, 62))
    assert by[64].lang_pred == "en" and by[65].lang_pred == "de" and not by[None].held_out
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    shape = "doc_id long, text string, lang string, score int, t string, u int"
    assert langid.report(spark.createDataFrame([], shape)).collect() == []
    alone = langid.report(spark.createDataFrame([(1, "abc", None, 1, "t", 2)], shape)).collect()
    assert [tuple(r)[2:] for r in alone] == [("und", 0.0)]


def plain_grams(text):
    codes, out = [ord(c) for c in (text or "").lower()], {}
    for n in langid.ORDERS:
        for i in range(len(codes) - n + 1):
            h = n * 0x9E3779B1 & 0xFFFFFFFF
            for c in codes[i:i + n]:
                h = (h ^ c) * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 15
            out[h >> 32 - langid.BITS] = out.get(h >> 32 - langid.BITS, 0) + 1
    return out


def shares(scores):
    e = {c: math.exp(s - max(scores.values())) for c, s in scores.items()}
    return {c: x / sum(e.values()) for c, x in e.items()}


def plain_model(rows):
    """Scores of a text and the temperature, learned weight by weight from (u, lang, text)."""
    rows = sorted(rows)
    found = [plain_grams(t) for *_, t in rows]
    langs, seen = sorted({lang for _, lang, _ in rows}), {}
    for counts in found:
        for g in counts:
            seen[g] = seen.get(g, 0) + 1

    def vector(counts):
        x = {g: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + seen.get(g, 0))) + 1) for g, n in counts.items()}
        length = max(math.sqrt(sum(v * v for v in x.values())), 1e-12)
        return {**{g: v / length for g, v in x.items()}, None: 1.0}  # None: the bias

    z, n = {}, {}

    def weight(g, c):
        at, rate = z.get((g, c), 0.0), (langid.BETA + math.sqrt(n.get((g, c), 0.0))) / langid.ALPHA
        if g is None:
            return -at / rate
        return 0.0 if abs(at) <= langid.L1 else -(at - math.copysign(langid.L1, at)) / (rate + langid.L2)

    def scores(x):
        return {c: sum(v * weight(g, c) for g, v in x.items()) for c in langs}

    vectors = [vector(counts) for counts in found]
    held_out = [k for k in range(len(rows)) if k % langid.CALIBRATE == langid.CALIBRATE - 1]
    for _ in range(langid.ROUNDS):
        for k in sorted(set(range(len(rows))) - set(held_out)):
            w = {(g, c): weight(g, c) for g in vectors[k] for c in langs}
            p = shares({c: sum(v * w[g, c] for g, v in vectors[k].items()) for c in langs})
            for (g, c), at in w.items():
                d, old = vectors[k][g] * (p[c] - (c == rows[k][1])), n.get((g, c), 0.0)
                z[g, c] = z.get((g, c), 0.0) + d - (math.sqrt(old + d * d) - math.sqrt(old)) / langid.ALPHA * at
                n[g, c] = old + d * d
    told = [(scores(vectors[k]), rows[k][1]) for k in held_out]

    def loss(heat):
        return -sum(math.log(max(shares({c: v / heat for c, v in s.items()})[y], 1e-300)) for s, y in told)

    heats = [math.exp(math.log(0.02) + k * (math.log(20) - math.log(0.02)) / 4000) for k in range(4001)]
    return lambda text: scores(vector(plain_grams(text))), min(heats, key=loss)


def test_predictions_equal_plain_training(spark):
    rng = random.Random(5)
    words = {"en": ["the", "cat", "sat", "mat", "hat"], "de": ["der", "hund", "und", "katze", "hat"], "fr": ["le", "chat", "et", "la", "mat"]}
    rows = []
    for i in range(150):
        lang = rng.choice(sorted(words))
        other = rng.choice(sorted(words))  # some words of another language, so that not all is plain
        rows.append((i, " ".join(rng.choice(words[lang if rng.random() < 0.7 else other]) for _ in range(rng.randint(1, 8))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    u = langid.unit(langid.F.col("doc_id").cast("string"), langid.F.col("text"), langid.F.lit(3))
    learned = [(r.u, r.lang, r.text) for r in docs.withColumn("u", u).collect() if not held(r.doc_id)]
    scores, heat = plain_model(learned)
    for r in langid.report(docs).collect():
        want = shares({c: v / heat for c, v in scores(rows[r.doc_id][1]).items()})
        best = max(sorted(want), key=want.get)
        assert r.score == pytest.approx(want[best], abs=0.01)
        assert r.lang_pred == best or want[r.lang_pred] == pytest.approx(want[best], abs=1e-4)


def test_sample_is_shared_and_bounded(spark):
    rows = spark.range(6000).selectExpr("if(id % 100 = 0, 'few', if(id % 3 = 0, 'some', 'most')) AS lang", "id").withColumn(
        "u", langid.unit(langid.F.col("id")))
    got = {r.lang: r["count"] for r in langid.sample(rows.unionAll(rows), "lang", 900, ["id"]).distinct().groupBy("lang").count().collect()}
    assert got["few"] == 60 and all(270 <= got[x] <= 300 for x in ("some", "most"))
    assert langid.sample(rows.limit(0), "lang", 900, ["id"]).collect() == []
