"""Changes of keyed rows, resolved to the rows they leave: the read side of a table that is only ever appended to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a change is: a whole row, some columns of a known row, or the end of a row.
ROW, PATCH, GONE = "row", "patch", "gone"


def resolved(
    changes: DataFrame, keys: Sequence[str], columns: Mapping[str, str], frozen: Sequence[str] = (),
    *, order: Sequence[str] = ("_at", "_run"), defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """The rows that changes leave: ``keys`` and ``columns``.

    ``_kind`` tells what a change is, ``_set`` names the columns it carries, ``order`` puts the changes of a key in order.
    A column has the value of the last change that carries it, a ``frozen`` one that of the row's first. A row that is gone
    and comes back starts anew. A patch of a key without a row leaves nothing.

    All is one aggregate with a map-side step, so a key changed very often is reduced before the shuffle; only keys that
    were gone once are looked up first.
    """
    at = F.struct(*order)
    given = {c: F.expr(v) for c, v in (defaults or {}).items()}
    ends = changes.filter(F.col("_kind") == GONE).groupBy(*keys).agg(F.max(at).alias("_end"))
    names = [F.col(k).alias(f"_{k}") for k in keys]
    ends = ends.select(*names, "_end")
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    for m in match[1:]:
        match[0] = match[0] & m
    live = (changes.filter(F.col("_kind") != GONE).join(ends, match[0], "left")
            .filter(F.col("_end").isNull() | (at > F.col("_end"))))
    first = F.when(F.col("_kind") == ROW, at)

    def value(c: str):
        carried = F.when(F.array_contains("_set", c), at)
        picked = F.min_by(c, first) if c in frozen else F.max_by(c, carried)
        if c not in given:
            return picked.alias(c)
        there = F.min_by(F.array_contains("_set", c), first) if c in frozen else F.count(carried) > 0
        return F.when(there, picked).otherwise(given[c].cast(columns[c])).alias(c)

    others = [c for c in columns if c not in keys]
    return (live.groupBy(*keys).agg(*[value(c) for c in others], F.count(first).alias("_rows"))
            .filter("_rows > 0").select(*columns))
