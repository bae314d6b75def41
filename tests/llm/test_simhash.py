"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash

from waybill.llm import simhash
from waybill.llm.components import components
from waybill.llm.common import work_folder


def brute_fingerprint(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\x0b\x0c\r":
        words = words.replace(gap, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = {}
    for i, x in enumerate(ids):
        r = find(i)
        if x is not None:
            found[r] = min(found.get(r, x), x)
    return [found.get(find(i)) for i in range(len(fps))]


def check(spark, rows, columns="doc_id long, text string", radius=4):
    got = simhash.near_duplicates(spark.createDataFrame(rows, columns), radius=radius).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components(fps, [r[0] for r in rows], radius))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_texts_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 500, 400)]
        rows.append((3 * i, " ".join(words)))
        for k in range(i % 4):
            copy = list(words)
            copy[rng.integers(0, 400)] = "other"
            rows.append((3 * i + k, "\t".join(copy).upper()))
    check(spark, rows)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 997}" for i in range(300_000))
    check(spark, [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "a b c d"), (7, "é É"), (None, "one"),
                  (None, "solo text of a row without id"), (9, long), (8, long + " x"), (4, "one"), (4, "two")])


def test_empty_table_and_clashing_columns(spark):
    check(spark, [], "doc_id long, text string")
    check(spark, [(1, "a", "x", 3), (2, "A", "y", 4)], "doc_id long, text string, fp string, root int")


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_planes_against_popcount(radius):
    rng = np.random.default_rng(radius)
    fps = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
    for i in range(350):
        fps[350 + i] = fps[i] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, i % 9, dtype=np.uint64))
    group = np.sort(rng.integers(0, 5, 700)).astype(np.int64)
    order = rng.permutation(350)
    fps = np.r_[fps[:350][order], fps[350:][order]].reshape(2, 350).T.reshape(-1)
    root = simhash.bucket_links(group, np.full(700, 2), fps, radius)
    want = list(range(700))
    for i in range(700):
        for j in range(i):
            if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = want[i], want[j]
                want = [min(a, b) if x in (a, b) else x for x in want]
    assert root.tolist() == want


def test_hot_bucket_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    base = " ".join(f"w{i}" for i in range(600))
    check(spark, [(i, base + f" tail{i}") for i in range(150)] + [(200 + i, f"other text number {i}") for i in range(20)])


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(40)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long"), work_folder(spark)).collect())
    assert got == {i: 0 for i in range(1, 51)} | {100 + i: 100 for i in range(1, 40)}


def test_keep_one(spark):
    rows = [(3, "a b c d e", "x"), (1, "A b c d e", "y"), (1, "A b c d e", "z"), (None, "solo", "p"), (None, "solo", "q"), (7, None, "r"),
            (8, "", "s"), (9, "something else here", "t")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id))] == [1, 7, 9, None]
    assert all(tuple(r) in rows for r in got)
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).collect() == []
