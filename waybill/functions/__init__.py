"""Scalar expressions, ``Column -> Column``; all stay inside the JVM."""

from waybill.functions.ids import id_from_url, optional_id_from_url
from waybill.functions.numbers import clamp_zero, coerce_int, coerce_int_or_zero, money, percent, ratio
from waybill.functions.texts import (
    blank_to_null,
    bool_text,
    json_text,
    order_status,
    split_tags,
    tags_to_json,
    text_or_blank,
)
from waybill.functions.times import (
    align,
    day_difference,
    duration_text,
    hours_between,
    iso_text,
    parse_date,
    whole_days,
)

__all__ = [
    "align", "blank_to_null", "bool_text", "clamp_zero", "coerce_int", "coerce_int_or_zero", "day_difference",
    "duration_text", "hours_between", "id_from_url", "iso_text", "json_text", "money", "optional_id_from_url",
    "order_status", "parse_date", "percent", "ratio", "split_tags", "tags_to_json", "text_or_blank", "whole_days",
]
