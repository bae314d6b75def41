"""Picking one row per key, folding repeated lines and numbering true repeats.

A single key may own a large share of all rows, so every step shrinks each input partition to one row per key (or per
key and value) before the shuffle; none of them gathers the rows of such a key in one task. Keys of few rows need no such
step where their rows are wanted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a key beyond which they are numbered in ranges, and the ranges of such a key.
MANY, RANGES = 100_000, 64


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``; ties are settled by the remaining columns, so the pick is total.

    NULL in an ordering column counts as the earliest. Columns must be orderable (no maps). Spark limits a
    ``row_number() = 1`` to one row per key and input partition before it shuffles, whatever the size of a key.
    """
    ties = [c for c in df.columns if c not in keys and c not in order_by]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*order_by, *ties)])
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def latest_batch(df: DataFrame, keys: Sequence[str], batch: Sequence[Column]) -> DataFrame:
    """All rows of each key's newest batch (a report, a pull of stock), told and ordered by the ``batch`` columns.

    The newest batch per key is an aggregate with a map-side step, and the join that follows is a plain inner join, so a
    key with very many rows is neither gathered nor sorted in one task. Rows with a NULL key have no batch and go.
    """
    newest = df.groupBy(*keys).agg(F.max(F.struct(*batch)).alias("_newest"))
    marked = df.withColumn("_batch", F.struct(*batch)).join(newest, list(keys))
    return marked.filter(F.col("_batch").eqNullSafe(F.col("_newest"))).select(*df.columns)


def fold_lines(df: DataFrame, keys: Sequence[str], add: Sequence[str], last: Sequence[str], seq: str) -> DataFrame:
    """One row per key: ``add`` columns are summed, ``last`` columns come from the row with the highest ``seq``."""
    return df.groupBy(*keys).agg(
        *[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in add],
        *[F.max_by(c, seq).alias(c) for c in last],
    )


def number_repeats(
    df: DataFrame, keys: Sequence[str], spread_by: str, number: str = "line_number", spread: int = 64,
    many: int = MANY,
) -> DataFrame:
    """Number the rows of each key 1, 2, ... in the order of their other columns.

    Rows equal in every column are interchangeable, so the numbering repeats exactly on a reload. ``spread_by`` names a
    column that differs between equal rows (such as their place in the file) and is no value itself.

    A key of up to about ``many`` rows is numbered where it lies after one shuffle by key; others in ranges (see
    ``_numbered_in_ranges``). Both ways number alike, so it is enough to tell the keys of many rows by a part of the
    places, whose rows alone are read as far as their keys; places that do not differ cost time, not rows.
    """
    step = max(1, min(spread, many // 1000))
    place = F.pmod(F.xxhash64(spread_by), F.lit(step))
    hot = (df.filter(place == 0).groupBy(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)])
           .agg(F.count(F.lit(1)).alias("_many")).filter(F.col("_many") > many // step).drop("_many"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    hot = F.broadcast(hot)  # at most one key in ``many`` rows
    values = [c for c in df.columns if c != spread_by]
    within = Window.partitionBy(*keys).orderBy(*([c for c in values if c not in keys] or keys))
    few = df.join(hot, same, "left_anti").select(*values, F.row_number().over(within).cast("bigint").alias(number))
    return few.unionByName(_numbered_in_ranges(df.join(hot, same, "left_semi"), keys, spread_by, number, spread, many))


def _numbered_in_ranges(
    df: DataFrame, keys: Sequence[str], spread_by: str, number: str, spread: int, many: int,
) -> DataFrame:
    """``number_repeats`` of keys of very many rows.

    Equal rows are counted first and told apart only at the end: the window sees one row per distinct value and not one
    per line. The equal rows of one value are divided by ``spread_by`` into ``spread`` counts, so that no task writes all
    of them. A key of very many values is numbered in two steps: its values are cut into ranges by sampled quantiles of
    the first other column, numbered within a range, and the counts of the ranges before are added (see ``_range_of``).
    """
    values = [c for c in df.columns if c != spread_by]
    others = [c for c in values if c not in keys]
    part = F.pmod(F.xxhash64(spread_by), F.lit(spread)).alias("_part")
    counts = _range_of(df.groupBy(*values, part).agg(F.count(F.lit(1)).alias("_n")), keys, others[0] if others else None, many)
    within = Window.partitionBy(*keys, "_range")
    before = within.orderBy(*others, "_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_all"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    past = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                       F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_past")).filter("_past > 0")
    here = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        here = here & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    offset = (counts.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(past, here, "left")
              .withColumn("_from", F.col("_in") + F.coalesce("_past", F.lit(0))))
    numbered = offset.repartition(*values, "_part").withColumn(
        number, F.explode(F.sequence(F.col("_from") + 1, F.col("_from") + F.col("_n")))
    )
    return numbered.select(*values, number)


def _range_of(counts: DataFrame, keys: Sequence[str], first: str | None, many: int) -> DataFrame:
    """``counts`` with ``_range``: 0 but for keys of more than ``many`` rows, whose rows are cut into ranges of ``first``.

    The cuts are approximate quantiles, at most ``RANGES`` a key; a value of ``first`` lies in one range, and ranges follow
    the order of values, NULL being the first. Only columns that are numbers or times are cut.
    """
    kind = None if first is None else counts.schema[first].dataType
    if not isinstance(kind, (T.NumericType, T.TimestampType, T.DateType)):
        return counts.withColumn("_range", F.lit(0))
    shares = [k / RANGES for k in range(1, RANGES)]
    names = [f"_h{i}" for i in range(len(keys))]
    hot = (counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_many"), F.percentile_approx(first, shares, 1000).alias("_cuts"))
           .filter(F.col("_many") > many).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_cuts"))
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(first)))
    return counts.join(hot, same, "left").withColumn(
        "_range", F.when(F.col("_cuts").isNull() | F.col(first).isNull(), 0).otherwise(below)).drop("_cuts", *names)


def last_match(array: Column, keep) -> Column:
    """Last element of an array that satisfies ``keep``; NULL when none does."""
    return F.try_element_at(F.filter(array, keep), F.lit(-1))


def last_element(array: Column) -> Column:
    return F.try_element_at(array, F.lit(-1))


def first_element(array: Column) -> Column:
    return F.get(array, F.lit(0))


def first_present(array: Column) -> Column:
    """First element that is not NULL."""
    return F.get(F.filter(array, lambda x: x.isNotNull()), F.lit(0))
