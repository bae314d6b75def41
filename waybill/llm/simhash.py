"""SimHash near-duplicates: fingerprints compared as bit planes, many at a time.

A pair within ``radius`` bits agrees on all but ``radius`` of any blocks the 64 bits are cut into, so it meets in the
bucket of at least one choice of agreeing blocks. Within a bucket the candidates stand as 64 bit planes, 64 candidates
to a machine word; a query's distances to them are counted by carry-save adders, one word operation for 64 distances,
and a word is abandoned once all its candidates exceed the radius.

Defined cases: a null, empty or wordless text has fingerprint zero and links like any other; repeated rows and repeated
ids are rows of their own; a component whose ids are all null has a null ``component_id``; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import LOWER, bounded, free, stage, work_folder
from waybill.llm.components import components

#: Rows of one side of a comparison; larger buckets are cut into blocks that meet pair by pair, each pair a task's group.
BLOCK = 2048
#: Fingerprints an average bucket may hold before the bits are cut finer.
BUCKET = 4096
STEP = 1 << 15
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: For each byte value, its bits dealt to eight byte-wide counters.
SPREAD = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
          .copy().view(np.uint64).reshape(256))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` words; of the whole sequence if it is shorter."""
    import xxhash

    one = xxhash.xxh64_intdigest
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= width:
        return np.array([one(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[width - 1:].tolist()
    return np.fromiter((one(joined[a:b], 42) for a, b in zip(starts.tolist(), ends)), np.uint64, len(ends))


def fingerprint(hashes: np.ndarray) -> int:
    """The signed 64-bit fingerprint: a bit is set if it is set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 17):
        lanes = SPREAD[hashes[at:at + (1 << 17)].view(np.uint8).reshape(-1, 8)]
        runs = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
        ones += runs.view(np.uint8).reshape(len(runs), 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fp)`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    bounded(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fps = [fingerprint(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, fp long")


def exceeds(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose three-bit count is above the radius."""
    above, same = np.zeros_like(counts[0]), ALL
    for k in (2, 1, 0):
        if radius >> k & 1:
            same = same & counts[k]
        else:
            above, same = above | same & counts[k], same & ~counts[k]
    return above


def within(planes: np.ndarray, lanes: np.ndarray, queries: np.ndarray, q: np.ndarray, w: np.ndarray, radius: int):
    """Pairs (index of q, lane of w) at most ``radius`` (up to 7) bits apart.

    ``planes[p, w]`` holds bit p of 64 candidates, ``lanes[w]`` which of them exist. Planes enter four at a time through
    carry-save adders (ones, twos, fours; a carry out of fours is past any radius), and pairs of a query and a word with
    no candidate left are abandoned.
    """
    live = np.arange(len(q))
    ones, twos, fours = (np.zeros(len(q), np.uint64) for _ in range(3))
    over = ~lanes[w]
    for p in range(0, 64, 4):
        a, b, c, d = (planes[p + k][w] ^ (np.uint64(0) - (queries[q] >> np.uint64(p + k) & np.uint64(1))) for k in range(4))
        half = ones ^ a
        pair, ones = ones & a | half & b, half ^ b
        half = ones ^ c
        pair2, ones = ones & c | half & d, half ^ d
        half = twos ^ pair
        four, twos = twos & pair | half & pair2, half ^ pair2
        over = over | fours & four
        fours = fours ^ four
        if p % 8 == 4:
            stay = (over | exceeds([ones, twos, fours], radius)) != ALL
            if stay.sum() < 0.75 * len(stay):
                live, q, w, ones, twos, fours, over = (x[stay] for x in (live, q, w, ones, twos, fours, over))
                if not len(live):
                    break
    near = ~(over | exceeds([ones, twos, fours], radius))
    hit = np.flatnonzero(near)
    bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(bits)
    return live[hit[at]], lane


def _hook(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of linked rows, in place: every row ends below the smallest row reachable."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def bucket_links(group: np.ndarray, side: np.ndarray, fps: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by group, the row each row hangs below (itself if none): links within groups, as trees.

    ``side`` is 0 for queries, 1 for candidates, 2 for both.
    """
    n = len(fps)
    root = np.arange(n)
    queries, cands = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    if not len(queries) or not len(cands):
        return root
    # Candidates of a group start a new word, so that no word mixes groups.
    own = group[cands]
    first = np.r_[True, own[1:] != own[:-1]]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.r_[starts, len(cands)])
    per = -(-sizes // 64)
    base = np.cumsum(per) - per
    rank = np.cumsum(first) - 1
    within_group = np.arange(len(cands)) - starts[rank]
    word = base[rank] + within_group // 64
    slot = word * 64 + within_group % 64
    total = int(per.sum())
    padded, row = np.zeros(total * 64, np.uint64), np.full(total * 64, -1)
    padded[slot], row[slot] = fps[cands], cands
    lanes = np.packbits((row >= 0).reshape(total, 64), axis=1, bitorder="little").view(np.uint64).reshape(total)
    cube = padded.reshape(total, 64)
    planes = np.stack([np.packbits((cube >> np.uint64(p) & np.uint64(1)).astype(bool), axis=1, bitorder="little")
                       .view(np.uint64).reshape(total) for p in range(64)])
    # Every query meets every word of its group.
    at = np.searchsorted(own[starts], group[queries])
    known = (at < len(starts)) & (own[starts][np.minimum(at, len(starts) - 1)] == group[queries])
    queries, at = queries[known], at[known]
    many = per[at]
    ends = np.cumsum(many)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, STEP):
        k = np.arange(lo, min(lo + STEP, int(ends[-1])))
        q = np.searchsorted(ends, k, side="right")
        w = base[at[q]] + k - (ends[q] - many[q])
        pair, lane = within(planes, lanes, fps, queries[q], w, radius)
        a, b = queries[q[pair]], row[w[pair] * 64 + lane]
        apart = a != b
        _hook(root, a[apart], b[apart])
    return root


def _cuts(count: int, radius: int) -> tuple[list[int], int]:
    """Masks of the agreeing bits, one per choice: as few blocks as keep the average bucket below ``BUCKET``."""
    blocks = radius + 1
    while count >> (64 * (blocks - radius) // blocks) > BUCKET and blocks < radius + 4:
        blocks += 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(some) for some in combinations(parts, blocks - radius)], blocks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(fps: DataFrame, radius: int, count: int) -> DataFrame:
    """Distinct ``fp`` to links ``(a, b)`` whose components are those of all pairs within ``radius`` bits.

    Not every pair is given: the members of a bucket come as a tree, so a group of m copies gives m rows, not m * m. A
    bucket over ``BLOCK`` rows is dealt to blocks, and each two blocks are compared by themselves: nothing is left out.
    """
    masks, _ = _cuts(count, radius)
    spread = F.explode(F.array(*[F.struct(F.lit(k).alias("cut"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                                 for k, m in enumerate(masks)]))
    keyed = fps.select("fp", spread.alias("s")).select("fp", "s.cut", "s.key")
    hot = keyed.groupBy("cut", "key").count().where(F.col("count") > BLOCK)
    parts: Column = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (keyed.join(hot, ["cut", "key"], "left").withColumn("parts", parts).withColumn("mine", mine)
             .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
             .select("cut", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                     F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
                     .cast("byte").alias("side"), "fp"))
    order = ["cut", "key", "i", "j"]

    def compare(batches):
        rest: list[np.ndarray] = []

        def done(cols, end):
            change = np.zeros(end, bool)
            for c in cols[:4]:
                change[1:] |= c[1:end] != c[:end - 1]
            group = np.cumsum(change)
            fp = cols[5][:end].view(np.uint64)
            root = bucket_links(group, cols[4][:end], fp, radius)
            moved = np.flatnonzero(root != np.arange(end))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[5][moved]), pa.array(cols[5][root[moved]])], ["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = [np.concatenate(x) for x in zip(rest, cols)] if rest else cols
            if not len(cols[0]):
                continue
            last = np.logical_and.reduce([c == c[-1] for c in cols[:4]])
            cut = int(np.argmax(last))  # rows are sorted: the group that may go on starts here
            if cut:
                yield done(cols, cut)
            rest = [c[cut:] for c in cols]
        if rest:
            yield done(rest, len(rest[0]))

    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long")


def groups(sigs: DataFrame, radius: int, folder: str) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint of ``sigs(id, fp)``: its component by fingerprint."""
    fps = stage(sigs.select("fp").distinct(), folder, "fps")
    links = stage(near_links(fps, radius, fps.count()), folder, "links")
    roots = components(links, folder)
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, fingerprint, component_id)`` of every row: component_id is the smallest key reachable by links."""
    folder = work_folder(docs.sparkSession)
    sigs = stage(fingerprints(docs, width, text, key), folder, "sigs")
    member = stage(groups(sigs, radius, folder), folder, "member")
    first = (sigs.groupBy("fp").agg(F.min("id").alias("id")).join(member, "fp")
             .groupBy("root").agg(F.min("id").alias("component_id")))
    named = member.join(first, "root").select("fp", "component_id")
    return sigs.join(named, "fp").select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def keep_one(docs: DataFrame, width: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each component, with the columns of ``docs``: that of the smallest key (null last).

    Of rows that share it, the first by place stays. Rows are numbered in a written copy, so a retried task cannot
    number them anew.
    """
    folder = work_folder(docs.sparkSession)
    name = free(docs, "row")
    numbered = stage(docs.withColumn(name, F.monotonically_increasing_id()), folder, "numbered")
    sigs = stage(fingerprints(numbered, width, text, name), folder, "sigs")
    member = stage(groups(sigs, radius, folder), folder, "member")
    place = numbered.select(F.col(name).alias("id"), F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"),
                                                             F.col(name).alias("id")).alias("place"))
    kept = (sigs.join(place, "id").join(member, "fp").groupBy("root").agg(F.min("place").alias("place"))
            .select(F.col("place.id").alias(name)))
    return numbered.join(kept, name, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
