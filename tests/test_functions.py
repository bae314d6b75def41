from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill import functions as fn


def apply(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", f(F.col("v")).alias("r")).orderBy("i").collect()]


def test_id_from_url(spark):
    cases = {
        "https://api.example.com/v2/contacts/123": "123", "": "", None: "", "not-a-url": "not-a-url",
        "https://api.example.com/v2/": "v2", "/admin/api/2024-07/products/6789.json": "6789",
        "https://h/a/12?x=1/2#f/3": "12", "https://h/a/b.c.d": "a", "https://h": "", "https://h/x/12;p=1": "12",
        "https://h/a b/": "",
    }
    assert apply(spark, fn.id_from_url, list(cases)) == list(cases.values())
    assert apply(spark, fn.optional_id_from_url, ["", "/a/1"]) == [None, "1"]


def test_parse_date(spark):
    cases = {
        "2024-01-15T10:30:00Z": datetime(2024, 1, 15, 10, 30), "2024-01-15": datetime(2024, 1, 15),
        "2024-01-15 1:2:3": datetime(2024, 1, 15, 1, 2, 3), "2024-01-15T10:30:00+0530": datetime(2024, 1, 15, 5),
        "2024-01-15T10:30:00.5-05:00": datetime(2024, 1, 15, 15, 30, 0, 500000),
        "2024-01-15T10:30": datetime(2024, 1, 15, 10, 30),
        "invalid-date": None, "": None, None: None, "2024": None, "10:30": None, "2024-13-99T99:99:99Z": None,
        "2024-02-30": None,
    }
    assert apply(spark, fn.parse_date, list(cases)) == list(cases.values())


def test_numbers(spark):
    assert apply(spark, fn.coerce_int, ["95.0", "123", "45.7", "invalid", "-3.9", None, "1e3", "95.0d"]) == [
        95, 123, 45, None, -3, None, None, None]
    assert apply(spark, fn.coerce_int_or_zero, ["x", None, "7"]) == [0, None, 7]
    assert [str(v) for v in apply(spark, fn.money, ["1.005", "", "abc", None, " 2 ", "99999999999"])] == [
        "1.01", "None", "None", "None", "2.00", "None"]
    assert apply(spark, fn.clamp_zero, [-1, 2, None], "int") == [0, 2, None]
    assert apply(spark, lambda v: fn.percent(v, F.lit(0)), [1], "int") == [None]


def test_texts(spark):
    assert apply(spark, fn.bool_text, [True, False, None], "boolean") == ["True", "False", None]
    assert apply(spark, lambda v: fn.bool_text(v, "lower"), [True], "boolean") == ["true"]
    assert apply(spark, fn.json_text, ['{"a": null}', "{}", "[ ]", "null", None]) == ['{"a": null}', None, None, None, None]
    assert apply(spark, fn.split_tags, ["a, b,,", "", None]) == [["a", "b"], [], []]
    assert apply(spark, fn.tags_to_json, [["a"], [], None], "array<string>") == ['["a"]', None, None]
    assert apply(spark, lambda v: fn.order_status(v, F.lit("Lost")), ["Complete", "x", None]) == [
        "delivered", "unknown", "unknown"]
    with pytest.raises(ValueError):
        fn.bool_text(F.lit(True), "upper")


def test_times(spark):
    assert apply(spark, fn.duration_text, [5, 303, 7500, 273600, -5], "bigint") == [
        "5s", "5m3s", "2h5m", "3d4h", "-5s"]
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 5)]
    assert apply(spark, fn.iso_text, stamps, "timestamp") == ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.000005Z"]
    moment = F.lit("2024-01-03 12:00:00").cast("timestamp")
    assert apply(spark, lambda v: fn.whole_days(v, moment), stamps[:1], "timestamp") == [2]
    assert apply(spark, lambda v: fn.whole_days(moment, v), stamps[:1], "timestamp") == [-2]
    with pytest.raises(ValueError):
        fn.align(F.lit(None), "week")
