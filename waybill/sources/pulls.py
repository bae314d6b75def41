"""Pulls: pages that were asked for one after the other and make one whole.

A source hands out a long list page by page; a page that others follow holds a token. The pages of a file are of one
pull. Files are taken in the order they landed: the file after one whose last page holds a token goes on with its pull,
unless it landed more than ``GAP`` later; then the pull was given up. A pull whose last file holds a token is not whole,
be it given up or still on its way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.sources.landing import SEQ

PULL, WHOLE = "_pull", "_whole"
GAP = "1 hour"


def file_pulls(files: DataFrame, gap: str = GAP) -> DataFrame:
    """``(_landed, _file, _more)``, a row per file, with the number of its pull (from 0) and whether that is whole.

    The number is a count of the pulls ended before, summed in two steps: within a day, and over the days before it. No
    task sees more than the files of a day or one row per day.
    """
    day = files.withColumn("_day", F.to_date("_landed"))
    in_day = Window.partitionBy("_day").orderBy("_landed", "_file")
    days = Window.orderBy("_day")
    opens = day.groupBy("_day").agg(F.min("_landed").alias("_first"))
    after = opens.select("_day", F.lead("_first").over(days).alias("_tomorrow"))
    ended = (
        day.withColumn("_next", F.lead("_landed").over(in_day)).join(after, "_day")
        .withColumn("_next", F.coalesce("_next", "_tomorrow"))
        .withColumn("_end", ~F.col("_more") | F.coalesce(F.col("_next") > F.col("_landed") + F.expr(f"INTERVAL {gap}"), F.lit(False)))
        .drop("_tomorrow", "_next"))
    sums = ended.groupBy("_day").agg(F.count_if("_end").alias("_n"))
    before = sums.select("_day", (F.sum("_n").over(days) - F.col("_n")).alias("_before"))
    earlier = F.count_if("_end").over(in_day.rowsBetween(Window.unboundedPreceding, -1))
    numbered = ended.withColumn("_in_day", earlier).join(before, "_day").withColumn(PULL, F.col("_before") + F.col("_in_day"))
    last = numbered.groupBy(PULL).agg(F.max_by("_more", F.struct("_landed", "_file")).alias("_open"))
    return numbered.join(last, PULL).select("_landed", "_file", PULL, (~F.col("_open")).alias(WHOLE))


def with_pulls(pages: DataFrame, gap: str = GAP) -> DataFrame:
    """Parsed pages with the number of their pull and whether it is whole."""
    place = [F.col(f"{SEQ}.{c}") for c in ("_block", "_row") if c in pages.schema[SEQ].dataType.names]
    files = pages.select(f"{SEQ}._landed", f"{SEQ}._file", F.struct(*place).alias("_place"), f"{SEQ}._more").groupBy(
        "_landed", "_file").agg(F.max_by("_more", "_place").alias("_more"))
    pulls = file_pulls(files, gap).select(F.struct("_landed", "_file").alias("_of"), PULL, WHOLE)
    return pages.join(pulls, F.struct(F.col(f"{SEQ}._landed"), F.col(f"{SEQ}._file")) == F.col("_of")).drop("_of")


def whole_pulls(rows: DataFrame) -> DataFrame:
    """Rows of whole pulls; all rows where pulls are not told apart, each file then being one."""
    if PULL in rows.columns:
        return rows.filter(WHOLE)
    origin = rows.schema[SEQ].dataType.names
    return rows.withColumn(PULL, F.struct(*[F.col(f"{SEQ}.{c}") for c in ("_landed", "_file") if c in origin]))
