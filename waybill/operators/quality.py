"""Row rules: what makes a record unusable or doubtful, and where such records go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.schemas import Table


@dataclass(frozen=True)
class Rule:
    """``broken`` is a SQL condition that is true for a record that violates the rule."""

    name: str
    broken: str
    severity: str = "error"


class InvalidBatch(ValueError):
    """A batch with broken rules, in the mode that refuses the whole batch."""


def required(column: str, kind: str = "string", severity: str = "error") -> Rule:
    blank = f"`{column}` IS NULL OR trim(`{column}`) = ''" if kind == "string" else f"`{column}` IS NULL"
    return Rule(f"missing {column}", blank, severity)


def not_negative(column: str, nullable: bool = False) -> Rule:
    broken = f"`{column}` < 0" if nullable else f"`{column}` IS NULL OR `{column}` < 0"
    return Rule(f"invalid {column}", broken)


def table_rules(table: Table) -> list[Rule]:
    """Rules that follow from a table's declaration: its required columns are there, its counts are not negative, and
    columns that may be missing are reported where they are."""
    rules = [required(c, table.columns[c]) for c in table.required]
    rules += [required(c, table.columns[c], "warning") for c in table.wanted]
    counted = [c for c in table.columns if c in ("qty", "orders_count")]
    return rules + [not_negative(c, nullable=c not in table.required) for c in counted]


def _broken(rules: Sequence[Rule], severity: str) -> Column:
    hits = [F.when(F.expr(r.broken), F.lit(r.name)) for r in rules if r.severity == severity]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def checked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The records with the names of the rules they break: ``errors`` and ``warnings`` arrays."""
    return df.withColumns({"errors": _broken(rules, "error"), "warnings": _broken(rules, "warning")})


def valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Records that break no error rule."""
    for rule in rules:
        if rule.severity == "error":
            df = df.filter(~F.coalesce(F.expr(rule.broken), F.lit(False)))
    return df


def quarantined(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Records that break an error rule, with the reasons."""
    return checked(df, rules).filter(F.size("errors") > 0).drop("warnings")


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Broken records per rule (``rule``, ``severity``, ``broken``), in one pass over the data."""
    counts = df.agg(*[F.count(F.when(F.expr(r.broken), 1)).alias(f"r{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"r{i}").alias("broken"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


@dataclass(frozen=True)
class Reference:
    """What a record says about a second frame: ``on`` are its columns there, ``take`` further columns its rules need."""

    frame: DataFrame
    on: tuple[str, ...]
    take: Mapping[str, str]


def beside(df: DataFrame, reference: Reference) -> DataFrame:
    """The records with the columns a rule needs of the frame they refer to; NULL where that has no such row.

    The second frame holds a key once; it is joined once, whatever the number of rules over it.
    """
    keys = [F.col(c).alias(f"_at{i}") for i, c in enumerate(reference.on)]
    other = reference.frame.select(*keys, *[F.col(c).alias(name) for name, c in reference.take.items()])
    same = F.lit(True)
    for i, c in enumerate(reference.on):
        same = same & F.col(c).eqNullSafe(F.col(f"_at{i}"))
    return df.join(other, same, "left").drop(*[f"_at{i}" for i in range(len(reference.on))])


def refuse_broken(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Raise ``InvalidBatch`` if any record breaks an error rule, else return the frame unchanged."""
    broken = rule_counts(df, rules).filter("severity = 'error' AND broken > 0").collect()
    if broken:
        raise InvalidBatch("; ".join(f"{r.rule}: {r.broken}" for r in broken))
    return df
