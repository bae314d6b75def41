"""Time stamps. The session time zone is UTC, so a time without an offset means UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings; Spark's own cast is laxer (it reads "2024" and "10:30" too).
_ACCEPTED = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?$"
    r"|^\d{4}-\d{1,2}-\d{1,2}(?: \d{1,2}:\d{1,2}:\d{1,2})?$"
)


def parse_date(text: Column) -> Column:
    """Timestamp of an ISO text (``Z`` or offset), a plain date, or ``date time``; anything else NULL."""
    # The cast wants seconds before an offset; only texts it cannot read are respelled.
    with_seconds = F.regexp_replace(text, r"^(\S{10}T\d{2}:\d{2})(Z|[+-].*)$", "$1:00$2")
    return F.when(
        text.rlike(_ACCEPTED), F.coalesce(text.try_cast("timestamp"), with_seconds.try_cast("timestamp"))
    )


def iso_text(ts: Column) -> Column:
    """ISO 8601 text in UTC with ``Z``; microseconds appear only when they are not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(exact)


def align(ts: Column, unit: str) -> Column:
    """Start of the ``minute``, ``hour`` or ``day`` the time falls in."""
    if unit not in ("minute", "hour", "day"):
        raise ValueError(f"unit must be minute, hour or day, not {unit!r}")
    return F.date_trunc(unit, ts)


def _div(number: Column, by: int) -> Column:
    """Whole-number division, cut toward zero."""
    return F.call_function("div", number, F.lit(by))


def duration_text(seconds: Column) -> Column:
    """Seconds as ``45s``, ``5m3s``, ``2h5m`` or ``3d4h``: the two largest units."""
    s = seconds.cast("bigint")

    def two(big: str, big_size: int, small: str, small_size: int) -> Column:
        return F.concat(
            _div(s, big_size).cast("string"), F.lit(big), _div(s % big_size, small_size).cast("string"), F.lit(small)
        )

    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, two("m", 60, "s", 1))
        .when(s < 86400, two("h", 3600, "m", 60))
        .otherwise(two("d", 86400, "h", 3600))
    )


def hours_between(start: Column, end: Column) -> Column:
    """Hours from ``start`` to ``end`` as double, with the fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)).cast("double") / F.lit(3_600_000_000.0)


def whole_days(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``, cut toward zero."""
    return _div(F.unix_micros(end) - F.unix_micros(start), 86_400_000_000)


def day_difference(day: Column, as_of: Column) -> Column:
    """Calendar days from ``day`` to ``as_of`` (positive when ``day`` has passed)."""
    return F.datediff(as_of, day)
