from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from waybill.plans import health
from waybill.schemas import TABLES
from waybill.streaming import state, windows

NOW = datetime(2024, 1, 10, 12, 30, 45, tzinfo=UTC)


def at(*parts):
    return datetime(*parts, tzinfo=UTC)


def test_lookback_window():
    assert windows.lookback_window(NOW) == (at(2024, 1, 9, 12, 30), at(2024, 1, 10, 12, 30))
    assert windows.lookback_window(NOW, at(2024, 1, 10, 11, 0, 30), timedelta(hours=6))[0] == at(2024, 1, 10, 10, 55)
    assert windows.lookback_window(NOW, at(2023, 1, 1), timedelta(days=2))[0] == at(2024, 1, 8, 12, 30)
    assert windows.lookback_window(NOW, at(2023, 1, 1))[0] == at(2022, 12, 31, 23, 55)
    assert windows.lookback_window(NOW, align=False)[1] == NOW


def test_other_windows():
    assert windows.settlement_window(NOW, 14) == (at(2023, 12, 26), at(2024, 1, 9, 23, 59, 59))
    assert windows.accounting_window(NOW) == (at(2023, 12, 11), at(2024, 1, 10))
    assert windows.accounting_window(NOW, full=True) == (None, None)
    assert windows.accounting_window(NOW, start=at(2024, 1, 1)) == (at(2024, 1, 1), None)


def test_batch_windows_tile_the_range(spark):
    got = windows.batch_windows(spark, at(2024, 1, 1), at(2024, 1, 8)).orderBy("batch_start").collect()
    assert len(got) == 7 and all(a["batch_end"] == b["batch_start"] for a, b in zip(got, got[1:]))
    short = windows.batch_windows(spark, at(2024, 1, 1), at(2024, 1, 2, 12), 24).orderBy("batch_start").collect()
    assert short[-1]["batch_end"] == datetime(2024, 1, 2, 12) and len(short) == 2
    assert windows.batch_windows(spark, at(2024, 1, 2), at(2024, 1, 1)).count() == 0


def states(spark, *rows):
    full = [(d, s, n, a, None, None, None, a, a) for d, s, n, a in rows]
    return spark.createDataFrame(
        full, "domain string, status string, error_count int, last_synced_at timestamp, last_sync_key string,"
        " error_message string, sync_metadata string, created_at timestamp, updated_at timestamp"
    ).select(*TABLES["sync_state"].columns)


def test_state_put(spark):
    before = states(spark, ("a", "error", 2, at(2024, 1, 1)), ("b", "success", 0, at(2024, 1, 1)))
    changes = spark.createDataFrame(
        [("a", "success", NOW, NOW), ("b", "error", NOW, NOW), ("c", "running", NOW, NOW)],
        "domain string, status string, last_synced_at timestamp, updated_at timestamp")
    out = {r["domain"]: r for r in state.put(before, changes).collect()}
    assert [out[d]["error_count"] for d in "abc"] == [0, 1, 1]
    assert out["a"]["last_synced_at"] == NOW.replace(tzinfo=None) and out["c"]["last_synced_at"] is None
    assert out["b"]["last_synced_at"] == datetime(2024, 1, 1)  # a failure does not move the mark
    assert out["a"]["created_at"] == datetime(2024, 1, 1)
    after = state.put(before, changes)
    assert state.last_sync(after, "a") == NOW.replace(tzinfo=None)
    assert state.last_sync(after, "b") == datetime(2024, 1, 1) and state.last_sync(after, "c") is None


def test_health(spark):
    df = states(spark, ("a", "success", 0, NOW), ("b", "success", 0, NOW - timedelta(hours=26)),
                ("c", "error", 1, NOW - timedelta(days=8)))
    feeds = health.feed_health(df, F.lit(NOW))
    assert {r["domain"]: r["healthy"] for r in feeds.collect()} == {"a": True, "b": False, "c": False}
    assert tuple(health.overall_health(feeds).first()) == (False, 3, 2)
    assert {r["domain"] for r in state.without_old_errors(df, F.lit(NOW)).collect()} == {"a", "b"}
    assert tuple(state.old_error_count(df, F.lit(NOW)).first()) == (1, 2)
