"""Numbers out of loosely typed payload fields. Payload scalars arrive as text, so nothing is lost before the cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGER = r"^\s*[+-]?\d+\s*$"
_FRACTION = r"^\s*[+-]?(?:\d+\.\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def coerce_int(value: Column) -> Column:
    """Whole number of a text: ``"95.0"`` -> 95, ``"45.7"`` -> 45 (toward zero), anything else NULL."""
    text = value.cast("string")
    # A failing cast costs an exception per row, so the pattern decides first which cast will succeed.
    return (
        F.when(text.rlike(_INTEGER), F.trim(text).try_cast("bigint"))
        .when(text.rlike(_FRACTION), F.trim(text).try_cast("double").try_cast("bigint"))
    )


def coerce_int_or_zero(value: Column) -> Column:
    """Like ``coerce_int``, but an unreadable value counts as 0 while a missing one stays NULL."""
    return F.when(value.isNotNull(), F.coalesce(coerce_int(value), F.lit(0).cast("bigint")))


def money(value: Column, precision: int = 12, scale: int = 2) -> Column:
    """Decimal of a text; blank, malformed or too large a value is NULL."""
    return F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast(f"decimal({precision},{scale})")


def clamp_zero(value: Column) -> Column:
    """Negative numbers become 0; NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL when ``whole`` is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` as double, NULL when ``whole`` is 0."""
    return part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0))
