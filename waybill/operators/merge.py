"""Keyed merge of a batch into a table, as plain joins (Parquet tables know no MERGE statement)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OP = "_op"
INSERT, UPDATE, KEEP = "insert", "update", "keep"

# Counted rows up to which a batch is merged by looking the table's rows up in it.
SMALL_BATCH_ROWS = 200_000


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"t.{k}"), F.col(f"s.{k}")) for k in keys]
    return reduce(Column.__and__, [t.eqNullSafe(s) if null_safe else t == s for t, s in pairs])


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    *,
    defaults: Mapping[str, str] | None = None,
    missing: str = "keep",
    newer_by: str | None = None,
    null_safe: bool = True,
    small_batch: bool = False,
) -> DataFrame:
    """The target after the batch: new keys inserted, ``update`` columns of known keys overwritten, the rest kept.

    The result has the target's columns and ``_op`` (``insert`` / ``update`` / ``keep``). The batch holds a key once
    (see ``latest_per_key`` and ``repeated_keys``).

    * ``defaults``: SQL value per column, for columns the batch lacks on insert.
    * ``missing``: an ``update`` column the batch lacks is kept (``keep``) or set to its default (``default``).
    * ``newer_by``: update only where the batch is at least as new by this column.
    * ``null_safe``: NULL keys match each other, so a reload updates them instead of inserting them again.
    * ``small_batch``: the plan for a batch known to be small. Target rows look their key up in the batch, and new keys
      are found among the few that matched. Spark broadcasts the batch if its measured size allows, and then the
      target is not shuffled at all. Otherwise both sides are shuffled once, in one full outer join.
    """
    if missing not in ("keep", "default"):
        raise ValueError(f"missing must be keep or default, not {missing!r}")
    wanted = set(update if update is not None else [c for c in target.columns if c not in keys])
    defaults = defaults or {}
    carried = [c for c in target.columns if c in batch.columns]
    types = {f.name: f.dataType for f in target.schema.fields}

    def default(c: str) -> Column:
        value = F.expr(defaults[c]) if c in defaults else F.lit(None)
        return value.cast(types[c])

    def on_insert(c: str) -> Column:
        return F.col(f"s.{c}").cast(types[c]) if c in carried else default(c)

    def on_update(c: str) -> Column:
        if c not in wanted or c in keys:
            return F.col(f"t.{c}")
        if c in carried:
            return F.col(f"s.{c}").cast(types[c])
        return default(c) if missing == "default" else F.col(f"t.{c}")

    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = batch.select(*carried).withColumn("_new", F.lit(True)).alias("s")
    fresh = F.lit(True) if newer_by is None else F.coalesce(
        F.col(f"s.{newer_by}") >= F.col(f"t.{newer_by}"), F.col(f"t.{newer_by}").isNull()
    )
    old, new = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    hit = old & new & fresh
    op = F.when(hit, UPDATE).when(old, KEEP).otherwise(INSERT)
    on = _match(keys, null_safe)

    def merged(c: str, with_inserts: bool) -> Column:
        value = F.when(hit, on_update(c))
        if with_inserts:
            return value.when(old, F.col(f"t.{c}")).otherwise(on_insert(c)).alias(c)
        return value.otherwise(F.col(f"t.{c}")).alias(c)

    if not small_batch:
        return t.join(s, on, "full_outer").select(*[merged(c, True) for c in target.columns], op.alias(OP))

    changed = t.join(s, on, "left").select(*[merged(c, False) for c in target.columns], op.alias(OP))
    known = target.select(*keys).alias("t").join(batch.select(*keys).alias("s"), on, "left_semi")
    new_rows = s.join(known.alias("t"), on, "left_anti").select(
        *[on_insert(c).alias(c) for c in target.columns], F.lit(INSERT).alias(OP)
    )
    return changed.unionByName(new_rows)


def op_counts(merged: DataFrame) -> DataFrame:
    """Rows per operation."""
    return merged.groupBy(F.col(OP).alias("op")).agg(F.count(F.lit(1)).alias("n"))


def repeated_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys a batch holds more than once, with their count; a merge needs this to be empty."""
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def update_only(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], columns: Sequence[str], *, null_safe: bool = False
) -> DataFrame:
    """Overwrite ``columns`` of known keys and never insert; ``_op`` tells ``update`` from ``keep``."""
    s = batch.select(*keys, *columns).withColumn("_new", F.lit(True)).alias("s")
    hit = F.col("s._new").isNotNull()
    kinds = {f.name: f.dataType for f in target.schema.fields}
    out = [
        F.when(hit, F.col(f"s.{c}").cast(kinds[c])).otherwise(F.col(f"t.{c}")).alias(c)
        if c in columns else F.col(f"t.{c}")
        for c in target.columns
    ]
    joined = target.alias("t").join(s, _match(keys, null_safe), "left")
    return joined.select(*out, F.when(hit, UPDATE).otherwise(KEEP).alias(OP))


def unmatched(batch: DataFrame, target: DataFrame, keys: Sequence[str], *, null_safe: bool = False) -> DataFrame:
    """Batch rows whose key the target lacks."""
    t = target.select(*keys).alias("t")
    return batch.alias("s").join(t, _match(keys, null_safe), "left_anti")


def still_present(target: DataFrame, batch: DataFrame, keys: Sequence[str], *, null_safe: bool = False) -> DataFrame:
    """Target rows whose key the (full) batch still has; the others have vanished at the source."""
    s = batch.select(*keys).alias("s")
    return target.alias("t").join(s, _match(keys, null_safe), "left_semi")
