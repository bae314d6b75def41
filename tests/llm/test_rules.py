"""Counts against brute force, and the learned list on planted junk."""

import random
import re
from collections import Counter

import numpy as np

from waybill.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def text_of(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" for _ in range(n))


def check(spark, rows, labels=(), columns="doc_id long, text string"):
    got = rules.judge(spark.createDataFrame(rows, columns), spark.createDataFrame(
        list(labels), "doc_id long, quality int, toxic int")).collect()
    want = []
    for r in rows:
        n = brute(r[1])
        want.append((r[0], *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    assert sorted(map(repr, (tuple(r[:7]) for r in got))) == sorted(map(repr, want))
    assert all(r.kept == (not r.base_failed and r.rule == 0) for r in got)
    return got


def test_counts_against_brute_force(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        parts = [rng.choice([" ", "\n", "\t", "\n\n", " # "]).join(text_of(rng, 9).split()) for _ in range(rng.randrange(6))]
        rows.append((i, rng.choice(["\n", " ", " \x0b", "\n \n"]).join(parts + parts[:rng.randrange(3)])))
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, [(1, None), (2, ""), (3, " \n\t"), (4, "the " * 3000), (4, "the " * 3000), (None, "a b"), (5, "x" * 100_000),
                  (6, " ".join(str(i) for i in range(30_000)) * 2), (7, "a b c d e f g h a b c d e f g h i"),
                  (8, "a b c d e f g h"), (9, "💡 💡|<\n💡 💡|<")])
    check(spark, [])
    check(spark, [(1, "a b", 2, "q", "z")], columns="doc_id long, text string, n_words int, kept string, h string")
    check(spark, [(1, text_of(random.Random(2), 50))], [(1, 0, 0), (1, None, 0), (None, 0, 0), (9, 1, 1)])


def test_planted_junk_goes_and_clean_stays(spark):
    rng = random.Random(3)
    rows, labels, junk = [], [], set()
    for i in range(900):
        text = text_of(rng, rng.randint(30, 120))
        if i % 5 == 0:
            text, _ = (text.upper().replace(" ", "!! "), junk.add(i)) if i % 10 else (text.replace(" ", " | "), junk.add(i))
        rows.append((i, text))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(i not in junk), 0))
    kept = {r.doc_id for r in check(spark, rows, labels) if r.kept}
    assert len(kept & junk) <= 2 and len(set(range(900)) - junk - kept) <= 2


def test_list_is_ordered_and_pruned():
    rng = np.random.default_rng(4)
    x = rng.random((4000, len(rules.FEATURES)))
    bad = (x[:, 0] > 0.8) & (x[:, 1] < 0.3) | (x[:, 2] > 0.95)
    learned = rules.learn(x, bad, np.arange(4000) % 3 == 0)
    hit = np.zeros(4000, bool)
    for rule in learned:
        hit |= rules._covers(x, rule)
    assert 1 < len(learned) <= rules.RULES and (hit == bad).mean() > 0.98
    assert rules.learn(x, np.zeros(4000, bool), np.arange(4000) % 3 == 0) == []
    assert rules.learn(x, rng.random(4000) < 0.1, np.arange(4000) % 3 == 0) == []


def test_only_dataframe_functions(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(9)], "doc_id long, text string")
    plan = rules.counts(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
