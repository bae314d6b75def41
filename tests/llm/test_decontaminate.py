"""Wu-Manber search against brute force."""

import hashlib
import random
import re

from waybill.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, width=10):
    windows = {}
    for item, text in bench:
        w = words_of(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(item)
    rows = []
    for doc, text in docs:
        w, hit, items = words_of(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    items |= windows[tuple(w[i:i + size])]
        items = sorted(str(i) for i in items if i is not None)
        rows.append((doc, len(w), len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit)))
    return rows


def check(spark, docs, bench, columns="doc_id long, text string"):
    got = dc.report(spark.createDataFrame(docs, columns), spark.createDataFrame(bench, "item_id long, text string"))
    want = brute([d[:2] for d in docs], bench)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def corpus(seed, vocabulary=30, docs=60):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcdeé") * rng.randint(1, 3) + str(rng.randrange(vocabulary)) for _ in range(n))
    bench = [(i, text(rng.choice([1, 2, 5, 9, 10, 11, 30]))) for i in range(25)]
    rows = []
    for i in range(docs):
        parts = [text(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            w = words_of(rng.choice(bench)[1])
            a = rng.randrange(len(w))
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([", ", "\n", "--"]).join(w[a:a + rng.randint(8, 14)]).upper())
        rows.append((i, ". ".join(parts)))
    return rows, bench


def test_against_brute_force(spark):
    for seed in range(3):
        check(spark, *corpus(seed))


def test_blocks_of_the_benchmark_join_up(spark, monkeypatch):
    monkeypatch.setattr(dc, "PATTERN_BYTES", 600)
    check(spark, *corpus(7, docs=20))


def test_long_items_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(3)
    words = [rng.choice("abcdé") + str(rng.randrange(40)) for _ in range(400)]
    for width, most in ((10, 1), (10, 50), (10, 333), (1, 7), (10, 10**6)):
        found = list(dc.pieces(" ".join(words), width, most))
        windows = [tuple(w[i:i + width]) for w in (p.split() for p, _ in found) for i in range(len(w) - width + 1)]
        assert windows == [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
        assert all(n <= max(most, 0) + 1 or len(p.split()) == width for p, n in found)
    assert [p for p, _ in dc.pieces("One, two", 10, 1)] == ["one two"] and not list(dc.pieces(None, 10, 1))
    bench = [(1, " ".join(words)), (2, " ".join(words[100:130])), (3, "zeta")]
    docs = [(k, " ".join(["x", *words[k * 7:k * 7 + 9 + k % 4], "y"])) for k in range(50)]
    monkeypatch.setattr(dc, "PATTERN_BYTES", 4000)  # the first item alone is four blocks
    searched = list(dc.searches(spark.createDataFrame(bench, "item_id long, text string"), 10))
    assert len(searched) > 2 and all(sum(map(len, s.patterns)) <= 2 * dc.PATTERN_BYTES for s in searched)
    check(spark, docs, bench)
    df, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    assert {r.doc_id for r in dc.clean(df, tests).collect()} == {r[0] for r in brute(docs, bench) if not r[-1]}


def test_odd_rows(spark):
    long = "x " * 200_000 + "one two three four five six seven eight nine ten eleven"
    bench = [(1, "One two three four five six seven eight nine ten"), (1, "zeta"), (None, "beta gamma"), (2, None), (3, "!!"),
             (10, "ZETA"), (4, "é ß")]
    docs = [(1, None), (2, ""), (3, "?!"), (4, long), (4, long), (None, "zeta"), (5, "beta-gamma beta"), (6, "É ß é ß"),
            (7, "zetas azeta"), (8, "one two three four five six seven eight nine")]
    check(spark, docs, bench)
    check(spark, docs, [])
    check(spark, [], bench)
    check(spark, [(1, "zeta", 3, "q")], bench, "doc_id long, text string, n_words int, items string")


def test_clean_keeps_the_others_whole(spark, monkeypatch):
    rows, bench = corpus(9)
    df = spark.createDataFrame([(*r, r[0] * 2, "x") for r in rows], "doc_id long, text string, n long, items string")
    tests = spark.createDataFrame(bench, "item_id long, text string")
    want = {r[0] for r in brute(rows, bench) if not r[-1]}
    out = dc.clean(df, tests)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want
    monkeypatch.setattr(dc, "PATTERN_BYTES", 900)
    assert {r.doc_id for r in dc.clean(df, tests).collect()} == want
