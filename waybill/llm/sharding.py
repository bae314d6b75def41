"""Sharding by sampled splitters: size-weighted key samples give boundaries, records are dealt to ranges.

A record's key is the hash of its text, then of its id, then its row number, so equal texts lie next to each other and
no key stands for more than one row. A sample weighted by size gives the boundaries of many small ranges; ranges that
turn out overfull are sampled again and subdivided. With the bytes before each range known, every record's place in the
order of all bytes follows within its range alone, and the shards are equal stretches of that order.

The law is ``bytes``: a shard holds its equal share of all bytes to within one record. Only DataFrame functions run;
ranges grow in number with the records, a record finds its own down a tree of splitters held in small tables, and the
driver sees sums over all, counts of splitters and the few of the root alone. The sample of one turn is sorted in one task: ``SAMPLES`` keys
for each of at most ``MOST_RANGES`` ranges.

Shards are cut by bytes, so equal texts may stand on both sides of a cut, each of them in one shard.

Defined cases: a null text has no bytes, so size 8 and the checksum of nothing; repeated rows and ids are records of
their own; fewer records than shards leave shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import free, stage, unit, work_folder

#: Ranges per shard at least, records per range beyond that, and the most ranges, which bounds the sample. Past that bound
#: ranges hold more records, whose sort spills.
RANGES, RANGE_ROWS, MOST_RANGES = 16, 1_000_000, 1 << 16
#: Sampled keys per range (on average, at most), and how far over its mean a range may be.
SAMPLES, OVERFULL = 32, 2
ROUNDS = 12
KEY = ("h1", "h2", "row")
#: Children of a node of the tree that finds a key's range.
FANOUT = 64


def _sample(rows: DataFrame, rate: float, turn: int) -> DataFrame:
    """Sampled keys, each with the bytes it stands for; a record is drawn with chance ``1 - exp(-rate * size)``."""
    chance = 1 - F.exp(-F.lit(rate) * F.col("size"))
    return (rows.where(unit(*KEY, F.lit(turn)) < chance)
            .select("range", "pieces", *KEY, (F.col("size") / chance).alias("weight")))


def _quantiles(sample: DataFrame) -> DataFrame:
    """Keys that cut each range's sample into ``pieces`` of equal bytes; a key that fills a piece gets a range of its own."""
    ordered, whole = Window.partitionBy("range").orderBy(*KEY), Window.partitionBy("range")
    past = F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    marked = (sample.withColumn("past", past).withColumn("total", F.max("past").over(whole))
              .withColumn("mark", F.floor(F.col("past") * F.col("pieces") / F.col("total"))))
    crossed = F.lag("mark", 1, 0).over(ordered) > F.lag("mark", 2, 0).over(ordered)
    fills = F.col("weight") * F.col("pieces") >= F.col("total")
    return marked.withColumn("cut", crossed | fills).where("cut").select(*KEY).distinct()


def _with_range(rows: DataFrame, splitters: DataFrame, folder: str) -> DataFrame:
    """``rows`` with the number of splitters at or below their key as ``range``, found down a tree of splitters.

    A level of the tree is a small table of nodes with up to ``FANOUT - 1`` keys each, met by an equi-join on the node
    (the root, one node, is given to the expression itself); as nodes stand for like numbers of bytes none is hot, should a level ever be too large to be broadcast.
    """
    count, levels = splitters.count(), 0
    while FANOUT ** levels <= count:
        levels += 1
    numbered = splitters.withColumn("at", F.row_number().over(Window.orderBy(*KEY)))  # at most a few for each range
    steps = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(FANOUT ** (levels - 1 - k)).cast("long").alias("step"))
                      for k in range(levels)])
    if levels:
        entry = F.floor(F.col("at") / F.col("step"))
        tree = stage(numbered.select(*KEY, "at", F.inline(steps))
                     .where((F.col("at") % F.col("step") == 0) & (entry % FANOUT != 0))
                     .groupBy("level", F.floor(entry / FANOUT).alias("node"))
                     .agg(F.array_sort(F.collect_list(F.struct(*KEY))).alias("keys")), folder, "tree")
    if not levels:
        return rows.withColumn("range", F.lit(0).cast("long"))
    key, root = F.struct(*KEY), tree.where("level = 0").first()["keys"]  # fewer than FANOUT
    below = lambda keys: F.size(F.filter(keys, lambda cut: cut <= key)).cast("long")
    found = rows.withColumn("range", below(F.array(*[F.struct(*[F.lit(k[c]).cast("long").alias(c) for c in KEY]) for k in root])))
    for k in range(1, levels):
        nodes = tree.where(F.col("level") == k).select(F.col("node").alias("range"), "keys")
        found = found.join(nodes, "range", "left").select(
            *rows.columns, (F.col("range") * FANOUT + below(F.coalesce("keys", F.array()))).alias("range"))
    return found


def split(rows: DataFrame, ranges: int, samples: int = SAMPLES) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their range, none of several rows over ``OVERFULL`` times its share; bytes and rows per range."""
    folder = work_folder(rows.sparkSession)
    share = (rows.agg(F.sum("size")).first()[0] or 1) / ranges
    whole = rows.withColumn("range", F.lit(0)).withColumn("pieces", F.lit(ranges))
    splitters = stage(_quantiles(_sample(whole, samples / share, 0)), folder, "splitters-0")
    for turn in range(1, ROUNDS + 1):
        dealt = _with_range(rows, splitters, f"{folder}/{turn}")
        sums = stage(dealt.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), folder, f"sums-{turn}")
        over = (sums.where((F.col("rows") > 1) & (F.col("bytes") > OVERFULL * share))  # a row is not divided
                .select("range", (F.floor(F.col("bytes") / share) + 1).alias("pieces")))
        if turn == ROUNDS or over.isEmpty():
            break
        drawn = _sample(dealt.join(over, "range"), samples * 2 ** turn / share, turn)
        more = stage(splitters.union(_quantiles(drawn)).distinct(), folder, f"splitters-{turn}")
        if more.count() == splitters.count():
            break
        splitters = more
    return dealt, sums


def assign(docs: DataFrame, shards: int = 24, range_rows: int = RANGE_ROWS, text: str = "text", key: str = "doc_id",
           row: Column | None = None) -> DataFrame:
    """``(row, key, size, text_crc32, shard, slot)`` of every record; ``row`` numbers the rows, if nothing is given."""
    folder = work_folder(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(docs.select((F.monotonically_increasing_id() if row is None else row).alias("row"), F.col(key).alias("id"),
                             (F.octet_length(body) + 8).cast("long").alias("size"),
                             F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("h1"),
                             F.xxhash64(F.col(key).cast("string")).alias("h2")), folder, "keyed")
    dealt, sums = split(rows, max(shards * RANGES, min(MOST_RANGES, rows.count() // range_rows)))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                         F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
                         F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("range").orderBy(*KEY)
    middle = 2 * (F.col("bytes_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))) - F.col("size")
    placed = stage(dealt.join(starts, "range")
                   .withColumn("at", F.col("rows_before") + F.row_number().over(inside) - 1)
                   .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * F.col("total")))).cast("int"))
                   .select("row", "id", "size", "text_crc32", "shard", "at"), folder, "placed")
    firsts = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(firsts, "shard").select("row", F.col("id").alias(key), "size", "text_crc32", "shard",
                                               (F.col("at") - F.col("first")).alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 24, parts: int = 4, **options) -> None:
    """Write the records into one folder per shard (``shard=k``), each shard by several tasks.

    A column of the records that is called ``shard`` or ``slot`` keeps its name; the new one gets an underscore more.
    """
    folder = work_folder(docs.sparkSession)
    row, shard, slot = (free(docs, want) for want in ("row", "shard", "slot"))
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), folder, "numbered")
    dealt = assign(numbered, shards, row=F.col(f"`{row}`"), **options).select(
        F.col("row").alias(row), F.col("shard").alias(shard), F.col("slot").alias(slot))
    (numbered.join(dealt, row).drop(row)
     .repartition(shards * parts, shard, F.pmod(F.col(slot), F.lit(parts)))
     .write.partitionBy(shard).parquet(path))


def report(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard and slot of every document under the law of equal bytes."""
    return assign(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                       F.lit(None).cast("int").alias("grown_shard"))
