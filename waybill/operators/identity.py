"""Which records are one and the same, by any of several identifying values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def identity_groups(records: DataFrame, record: str, by: Sequence[str], stage: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    """``(record, group)``: records that share a value of a column of ``by`` are of one group, and so are theirs.

    The group is named by its smallest record. Labels go from records to the values they hold and back, the smallest
    wins, until none changes; after each round a record also takes over the label of the record its label names, so long
    chains close in few rounds. A value that very many records share is reduced in each input partition before it is
    shuffled, and no pairs of records are made. NULL and blank values link nothing. ``stage`` writes a frame to a shared
    folder and reads it back: rounds survive lost executors and their plans stay small.
    """
    value = F.explode(F.array(*[
        F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", F.concat(F.lit(f"{c}\u0001"), F.col(c).cast("string"))) for c in by]))
    links = stage("links", records.select(F.col(record).alias("record"), value.alias("value")).filter("value IS NOT NULL").distinct())
    labels = stage("labels0", records.select(F.col(record).alias("record")).distinct().withColumn("label", F.col("record")))
    turn = 0
    while True:
        turn += 1
        held = links.join(labels, "record").groupBy("value").agg(F.min("label").alias("label"))
        told = links.join(held, "value").groupBy("record").agg(F.min("label").alias("told"))
        nearer = labels.join(told, "record", "left").select("record", F.least("label", F.coalesce("told", "label")).alias("near"), "label")
        of = nearer.select(F.col("record").alias("named"), F.col("near").alias("beyond"))
        after = nearer.join(of, F.col("near") == F.col("named"), "left").select(
            "record", F.least("near", F.coalesce("beyond", "near")).alias("label"), F.col("label").alias("was"))
        after = stage(f"labels{turn}", after)
        if after.filter("label <> was").limit(1).count() == 0:
            return after.select(F.col("record").alias(record), F.col("label").alias("group"))
        labels = after.drop("was")
