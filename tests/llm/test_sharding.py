"""Sharding by sampled splitters: equal bytes, gapless slots, kept groups, split hot keys."""

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np

from waybill.llm import sharding


def check(spark, rows, columns="doc_id long, text string", shards=24):
    df = spark.createDataFrame(rows, columns)
    got = sharding.report(df, shards).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots, loads = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if rows:
        share, most = sum(loads.values()) / shards, max(size(r[1]) for r in rows)
        assert all(abs(loads[s] - share) <= most for s in range(shards))
    return got


def test_sizes_are_near_equal(spark):
    rng = np.random.default_rng(1)
    check(spark, [(i, "é" * int(rng.pareto(1.1) * 20)) for i in range(3000)])


def test_hot_text_and_repeated_rows_are_subdivided(spark):
    rows = [(i, "the same text") for i in range(800)] + [(7, "one row again")] * 700 + [(i, f"text {i}") for i in range(500)]
    check(spark, rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.select(*[sharding.F.lit(1).cast("long").alias(n) for n in ("h1", "h2")],
                      sharding.F.monotonically_increasing_id().alias("row"), sharding.F.lit(10).alias("size"))
    _, sums = sharding.split(keyed, 50, 2)
    assert max(r.bytes for r in sums.collect()) <= 2 * 20_000 / 50


def test_equal_texts_stay_together(spark):
    got = check(spark, [(i, f"text number {i // 5}") for i in range(2000)])
    places = defaultdict(set)
    for r in got:
        places[r.doc_id // 5].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 23


def test_odd_rows(spark):
    check(spark, [(1, None), (2, ""), (None, "a"), (None, None), (3, "x" * 1_000_000), (3, "y")])
    check(spark, [])
    check(spark, [(i, "t", 5, "u") for i in range(40)], "doc_id long, text string, row int, size string", shards=3)


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}", "s") for i in range(300)], "doc_id long, text string, slot string")
    sharding.write(df, str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("doc_id", "text", "slot").exceptAll(df).count() == 0 and back.count() == 300
    assert back.select("shard").distinct().count() == 5


def test_only_dataframe_functions(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    plan = sharding.report(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ranges_of_a_deep_tree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "FANOUT", 3)
    rng = np.random.default_rng(4)
    keys = [tuple(int(v) for v in rng.integers(-3, 4, 3)) for _ in range(300)]
    rows = spark.createDataFrame([(*k, 1) for k in keys], "h1 long, h2 long, row long, size long")
    for count in (0, 1, 2, 3, 8, 9, 40):
        cuts = sorted(set(keys[:count]))
        splitters = spark.createDataFrame(cuts, "h1 long, h2 long, row long")
        got = sharding._with_range(rows, splitters, f"file://{tmp_path}/{count}").collect()
        assert sorted((r.h1, r.h2, r.row, r.range) for r in got) == sorted((*k, bisect.bisect_right(cuts, k)) for k in keys)
