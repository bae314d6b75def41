"""Tables of any columns and keys stay whole: clashing names, text ids, repeated rows, thresholds, counts past 32 bits."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waybill.llm import common, lm, mixing, rules, sharding, simhash, substring, tokens


def named(spark, n=12):
    """Documents with columns that the operators use names like."""
    rows = [(i, f"text of document number {i} " * 3, "abc"[i % 3], 100 + i, f"r{i}", 200 + i, -i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, ROW int, rows string, Shard int, SLOT int")
    return df.withColumn("copies", F.col("doc_id") * 3)


def test_columns_of_clashing_names_survive(spark, tmp_path):
    df = named(spark)
    want = {r.doc_id: tuple(r) for r in df.collect()}
    mixed = mixing.copied(df)
    assert mixed.columns == df.columns and mixed.count() > 0
    assert all(tuple(r) == want[r.doc_id] for r in mixed.collect())
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and all(tuple(r) == want[r.doc_id] for r in kept.collect())
    sharding.write(df, str(tmp_path / "shards"), shards=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {r.doc_id: tuple(r[c] for c in df.columns) for r in back.collect()} == want
    assert {r["shard_"] for r in back.collect()} == {0, 1, 2}


def test_names_that_are_free(spark):
    df = spark.createDataFrame([(1, 2)], "ROW int, row_ int")
    assert common.free(df, "row") == "row__" and common.free(df, "x") == "x"


def test_text_ids(spark):
    base = spark.range(40).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", F.sequence(F.col("id") % 7, F.col("id") % 7 + 20).cast("array<string>")).alias("text"))
    texts = base.withColumn("doc_id", F.format_string("k%03d", "doc_id"))
    key = lambda r: f"k{r[0]:03d}"
    for work in (lambda d: substring.without_repeats(d, width=5), lambda d: tokens.round_trip(d, public_tokenizers.path("byte_bpe_50k.json"))):
        got = sorted(tuple(r) for r in work(texts).collect())
        assert got == sorted((key(r), *r[1:]) for r in work(base).collect()) and len(got) == 40
    scored = {r.doc_id: r[1:] for r in lm.score(texts, F.lit(True), F.col("doc_id") < "k010").collect()}
    assert scored == {key(r): r[1:] for r in lm.score(base, F.lit(True), F.col("doc_id") < 10).collect()}


def test_counts_past_32_bits():
    big = np.array([5_000_000_000, 4_294_967_295, 7], np.uint64)
    assert lm.added(np.array([0, 1, 0]), big, np.ones(3, bool), 2).tolist() == [5_000_000_007, 4_294_967_295]
    assert lm.added(np.array([0, 0, 0]), big, np.array([True, False, True]), 1).tolist() == [5_000_000_007]
    for counts in (big, big[1:]):
        packed = lm.packed(lm.narrow(counts))
        (back,) = lm.all_unpacked(packed)
        assert back.astype(np.int64).tolist() == counts.astype(np.int64).tolist()
    assert lm.narrow(big).dtype == np.uint64 and lm.narrow(big[1:]).dtype == np.uint32


@pytest.mark.parametrize("scale, size", [(1, 100), (1, 3000), (1e-6, 250), (1, 5001), (1, 0)])
def test_threshold_of_least_hashes(spark, scale, size):
    u = np.random.default_rng(1).random(5000) * scale
    rows = spark.createDataFrame([(float(x),) for x in u], "u double")
    most = common.least_hashes(rows, "u", size)
    taken = int((u <= most).sum())
    assert taken <= size and (taken >= 0.9 * min(size, 5000) - 5)
    assert common.least_hashes(rows.limit(0), "u", 5) == 1.0


def test_repeated_rows_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 16)
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(7, "a b c", "s")] * 400 + [(None, "x y", "s")] * 200 + [(i, "w " * (i % 5 + 1), "t") for i in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = df.repartition(5).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("id"), "source",
                                     common.count_words(F.col("text")).alias("size"),
                                     F.xxhash64(F.col("doc_id").cast("string"), "text").alias("seed"))
    folder = common.work_folder(spark)
    apart = mixing._told_apart(common.stage(sized, folder, "sized"), folder)
    assert apart.count() == 660 and apart.select("seed").distinct().count() == 660
    blocks = apart.where("id = 7").groupBy(F.pmod(F.xxhash64("seed", F.lit(1)), F.lit(25))).count().collect()
    assert len(blocks) == 25 and max(b["count"] for b in blocks) < 40
    got = mixing.report(df).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.report(df.repartition(9)).collect()))
    taken = {s: sum(r.taken for r in got if r.source_size == n) for s, n in (("s", 1600), ("t", 180))}
    assert all(abs(taken[s] - next(r.target for r in got if r.source_size == n)) <= 5 for s, n in (("s", 1600), ("t", 180)))


def test_two_pipelines_at_once(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    (_, first), (_, second) = corpus_pipeline.STAGES[1], corpus_pipeline.STAGES[3]
    lazy = first(spark, docs, folder)  # unread while others begin and end
    other = second(spark, docs, folder)
    with common.noted() as made:
        inner = first(spark, docs, folder)
    assert made and inner.count() == lazy.count()
    for used in made:
        common.drop(spark, used)
    assert lazy.count() > 0 and other.count() > 0
    with common.noted() as made:
        pass
    assert made == []


def test_learned_list_applied_in_plain_python(spark):
    import random
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rnd.randrange(25, 80))]
        if i % 4 == 0:
            words = [w.upper() + rnd.choice(["!!", "", " | "]) for w in words]
        rows.append((i, "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9))))
        labels.append((i, int(i % 4 != 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    stats = rules.counts(docs)
    learned = rules.fit(stats, marks)
    assert learned
    measure = {r.doc_id: r for r in stats.select("doc_id", *[rules.feature(n).alias(n) for n in rules.FEATURES]).collect()}
    names = list(rules.FEATURES)

    def first(doc_id):
        for k, rule in enumerate(learned, 1):
            if all((measure[doc_id][names[f]] >= cut) if above else (measure[doc_id][names[f]] < cut) for f, above, cut in rule):
                return k
        return 0

    got = rules.judge(docs, marks).collect()
    assert [r.rule for r in got] == [first(r.doc_id) for r in got]
    assert [r.kept for r in got] == [not r.base_failed and first(r.doc_id) == 0 for r in got]
