"""Mixing sources to target weights, by pivotal dependent rounding of copies.

A document of a source whose target is f times its size should be taken f times on average: floor(f) times for sure, and
once more for a share of the documents. That share is settled by pairs: of two fractional documents, words move from
one to the other, in a random direction weighted so that both keep their expectation, until one of them is whole. A block
of documents leaves at most one fractional document; those meet in blocks of their own, and so on up a tree, until one is
left per source, which falls by its own probability. Words only move between documents, so a source's taken words miss its
target by less than one document.

All randomness comes from hashes of the rows, so reruns agree, whatever the partitions.

Defined cases: a null text has size 0; a document of size 0 carries no words, and its last copy falls by itself; the null
source is a source, last in order; repeated rows are rows of their own, spread over blocks by their number among their
equals; an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import bounded, count_words, free, stage, work_folder

#: Documents of a block at the leaves, and residuals of a block further up.
LEAF, FAN = 4096, 64
TINY = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, place, target)``; one row per source.

    Sources take the weights in turn, in order of their names; targets share the total and stop at ``cap`` times the size.
    With sources in order of the level ``cap * size / weight`` at which they stop, those below the water line stand full
    and the line follows from what is left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_stop = Window.orderBy("stop", "place")
    weight: Column = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                  (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"))
    full = F.sum(F.col("source_size") * cap).over(by_stop.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
              .withColumn("stop", F.col("source_size") * cap / F.col("weight")))
    lined = (ranked.withColumn("full", F.coalesce(full, F.lit(0)))
             .withColumn("left", F.sum("weight").over(by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
             .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
             .withColumn("line", (F.col("total") - F.col("full")) / F.col("left")))
    line = F.min(F.when(F.col("stop") >= F.col("line"), F.struct("stop", "place", "line"))).over(Window.partitionBy())["line"]
    return (lined.withColumn("water", line)
            .select("source", "source_size", "place", F.least(
                (F.col("source_size") * cap).cast("double"), F.col("water") * F.col("weight")).alias("target")))


def _coin(a: int, b: int, level: int) -> float:
    x = (a ^ (b * 0x9E3779B97F4A7C15) ^ (level * 0xD1B54A32D192ED03)) & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return ((x ^ x >> 31) >> 11) / float(1 << 53)


def settle(size: list[int], share: list[float], seed: list[int], level: int, last: bool) -> tuple[list, list]:
    """Settle the fractional copies of one block in order: (extra copy or None, share) of each document.

    At most one document stays unsettled, with the share it has reached; none if this block is the last.
    """
    extra: list[int | None] = [None] * len(size)
    share = list(share)
    held = None
    for j, (s, p, h) in enumerate(zip(size, share, seed)):
        if p <= TINY or p >= 1 - TINY:
            extra[j] = int(p > 0.5)
        elif not s:
            extra[j] = int(_coin(h, 0, level) < p)
        elif held is None:
            held = j
        else:
            i, t, q = held, size[held], share[held]
            up, down = min((1 - q) * t, p * s), min(q * t, (1 - p) * s)
            if _coin(seed[i], h, level) * (up + down) < down:
                q, p = q + up / t, p - up / s
            else:
                q, p = q - down / t, p + down / s
            share[i], share[j], held = q, p, None
            for k, x in ((i, q), (j, p)):
                if x <= TINY or x >= 1 - TINY:
                    extra[k] = int(x > 0.5)
                else:
                    held = k
    if last and held is not None:
        extra[held] = int(_coin(seed[held], 1, level) < share[held])
    return extra, share


def _settled(rows: DataFrame, level: int, last: bool) -> DataFrame:
    """Rows with ``extra`` filled in and ``share`` moved on, block by block (``place``, ``block``)."""
    names = rows.columns
    at = {n: names.index(n) for n in ("place", "block", "size", "share", "seed", "extra")}

    def run(batches):
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            place, block = held.column(at["place"]).to_numpy(), held.column(at["block"]).to_numpy()
            if not len(place):
                continue
            first = int(np.argmax((place == place[-1]) & (block == block[-1])))
            if first:
                yield from done(held.slice(0, first), place[:first], block[:first])
            held = held.slice(first)
        if held is not None and held.num_rows:
            yield from done(held, held.column(at["place"]).to_numpy(), held.column(at["block"]).to_numpy())

    def done(rows, place, block):
        size, share, seed = (rows.column(at[n]).to_pylist() for n in ("size", "share", "seed"))
        cuts = [0, *(np.flatnonzero((np.diff(place) != 0) | (np.diff(block) != 0)) + 1).tolist(), len(size)]
        extra, moved = [], []
        for a, b in zip(cuts, cuts[1:]):
            e, p = settle(size[a:b], share[a:b], seed[a:b], level, last)
            extra += e
            moved += p
        out = rows.set_column(at["extra"], "extra", pa.array(extra, pa.int32()))
        yield from out.set_column(at["share"], "share", pa.array(moved, pa.float64())).to_batches()

    order = ["place", "block", "seed", "row"]
    return rows.repartition("place", "block").sortWithinPartitions(*order).mapInArrow(run, rows.schema)


def _told_apart(sized: DataFrame, folder: str) -> DataFrame:
    """Rows whose seed tells them apart from their equals.

    Rows that are equal in key and text are numbered, and the number goes into their seed: without it all of them would
    meet in one block and toss the same coin. They are numbered within the input partition they come from, the counts of
    the partitions before being added, so however many they are, no task sees them all. Which of them has which number
    does not matter, as they are equal.
    """
    again = sized.groupBy("seed", "source", "size").count().where("count > 1").select(F.col("seed").alias("s")).distinct()
    again = stage(again, folder, "again")
    equal = sized.join(again, F.col("seed") == F.col("s"), "left_semi").withColumn("part", F.shiftright("row", 33))
    counts = equal.groupBy("seed", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("seed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("seed", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("seed", "part").orderBy("row")
    numbered = (equal.withColumn("twin", F.row_number().over(inside)).join(offsets, ["seed", "part"])
                .withColumn("twin", F.col("twin") + F.col("offset")))
    salted = numbered.withColumn("seed", F.when(F.col("twin") > 1, F.xxhash64("seed", "twin")).otherwise(F.col("seed")))
    return stage(sized.join(again, F.col("seed") == F.col("s"), "left_anti").unionByName(salted.select(sized.columns)), folder, "apart")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, text: str = "text", source: str = "source",
        key: str = "doc_id", row: Column | None = None) -> DataFrame:
    """``(row, key, size, source_size, target, copies)`` of every document; ``row`` numbers the rows, if nothing is given.

    Blocks hold about ``LEAF`` documents of one source each, so a source of any size is spread over many tasks, and the
    residuals of ``FAN`` blocks meet at a time.
    """
    folder = work_folder(docs.sparkSession)
    bounded(docs.sparkSession)
    sized = stage(docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(key).alias("id"),
                              F.col(source).cast("string").alias("source"), count_words(F.col(text)).alias("size"),
                              F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("seed")), folder, "sized")
    sized = _told_apart(sized, folder)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = stage(targets(sizes.drop("n"), weights, cap).join(
        sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), folder, "plan")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = plan.withColumnRenamed("source", "s")
    rows = (sized.join(named, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("times", times)
            .withColumn("block", F.pmod(F.xxhash64("seed", F.lit(1)), F.ceil(F.col("n") / LEAF)))
            .select("row", "id", "size", "source_size", "target", "place", "block", "seed",
                    F.floor("times").cast("int").alias("whole"), (F.col("times") - F.floor("times")).alias("share"),
                    F.lit(None).cast("int").alias("extra")))
    blocks = plan.agg(F.max(F.ceil(F.col("n") / LEAF))).first()[0] or 0
    parts, level = [], 0
    while True:
        last = blocks <= 1
        rows = stage(_settled(rows, level, last), folder, f"level{level}")
        parts.append(rows.where("extra IS NOT NULL"))
        if last:
            break
        blocks, level = -(-blocks // FAN), level + 1
        rows = rows.where("extra IS NULL").withColumn("block", F.floor(F.col("block") / FAN))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("row", F.col("id").alias(key), "size", "source_size", "target",
                      (F.col("whole") + F.col("extra")).alias("copies"))


def copied(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    folder = work_folder(docs.sparkSession)
    name = free(docs, "row")
    numbered = stage(docs.withColumn(name, F.monotonically_increasing_id()), folder, "numbered")
    times = free(numbered, "copies")
    taken = mix(numbered, row=F.col(name), **options).where("copies > 0").select(
        F.col("row").alias(name), F.sequence(F.lit(1), "copies").alias(times))
    # Merged at any size: how much is shuffled follows the input, and never rests on the copies fitting one machine.
    return (numbered.join(taken.hint("merge"), name).withColumn(name, F.explode(times))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def report(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Sizes, targets and taken words per document."""
    return mix(docs, weights, cap).select("doc_id", "size", "source_size", "target",
                                          (F.col("size") * F.col("copies")).alias("taken"), "copies")
