"""Loading feeds: read, check, set bad rows aside, drop orphans, merge, publish, and note the outcome."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from waybill.operators import links, picks, quality
from waybill.operators.merge import repeated_keys
from waybill.operators.reshape import flat_tracking
from waybill.operators.rollups import settlement_headers
from waybill.schemas import TABLES, WAITING
from waybill.sources import accounting, fulfilment, marketplace
from waybill.sources.feeds import FEEDS, Feed
from waybill.sources.landing import SEQ, read_lines, read_report, rejected, without_repeated_pages
from waybill.sources.pulls import PULL, WHOLE, with_pulls
from waybill.streaming import state
from waybill.streaming.windows import accounting_window, lookback_window, settlement_window
from waybill.warehouse import Change, Conflict, Warehouse

log = logging.getLogger(__name__)

#: How often a load is tried while others change the same rows.
ATTEMPTS = 5

TRACKING = ["status", "tracking_number", "carrier", "tracking_url", "tracking_updated_at"]


@dataclass
class Stats:
    """What a load did to one table."""

    table: str
    processed: int = 0
    inserted: int = 0
    updated: int = 0
    quarantined: int = 0
    orphans: int = 0
    waiting: int = 0


@dataclass
class Outcome:
    """What a load did."""

    run: str
    tables: list[Stats] = field(default_factory=list)

    def total(self, measure: str) -> int:
        return sum(getattr(t, measure) for t in self.tables)


def _moment(at: datetime) -> Column:
    return F.lit(at if at.tzinfo else at.replace(tzinfo=UTC))


class Loader:
    """Loads into one warehouse.

    ``mode`` is ``quarantine`` (bad rows are set aside) or ``refuse`` (a bad row fails the whole load). Rows that hang on a
    row of another feed which is not there are dropped; with ``wait`` they are kept aside so long, loaded as soon as it is
    there, and set aside as bad after that.
    """

    def __init__(self, warehouse: Warehouse, mode: str = "quarantine", wait: timedelta | None = None):
        if mode not in ("quarantine", "refuse"):
            raise ValueError(f"mode must be quarantine or refuse, not {mode!r}")
        self.warehouse, self.spark, self.mode, self.wait = warehouse, warehouse.spark, mode, wait

    # --- one load --------------------------------------------------------------------------------------------------
    def load(
        self, feed: Feed, landing: str, as_of: datetime, start: datetime | None = None, end: datetime | None = None,
        *, enabled: bool = True, page_per_file: bool = False, delete_missing: bool = False, newer_by: str | None = None,
        only: Mapping[str, Sequence[str]] | None = None, once: bool = False,
    ) -> Outcome:
        """Load a feed and its children from the landing folder.

        ``only`` keeps rows of the feed that have one of the given values in a column: some skus, one bank account, one
        nominal code. Children whose parents it leaves out are orphans. ``once`` parses a page that landed several times,
        as whole histories do, one time.
        """
        path = f"{landing.rstrip('/')}/{feed.folder}"
        lines = read_lines(self.spark, path, page_per_file=page_per_file, enabled=enabled)
        lines = without_repeated_pages(lines) if once else lines
        return self.load_lines(
            feed, lines, as_of, start, end, delete_missing=delete_missing, newer_by=newer_by, only=only)

    def load_landed(
        self, feed: Feed, landing: str, now: datetime, *, late: timedelta = timedelta(hours=1), sweep: bool = False,
        enabled: bool = True, page_per_file: bool = False, **how,
    ) -> Outcome:
        """Load the files that landed since the last such load, whatever the change times in them; open no others.

        The files a load has taken are listed in ``landed_files``, published with its rows, so a file is loaded once or,
        after a failure, again. Files older than the newest listed by more than ``late`` are not looked at; ``sweep``
        looks at all, for files that arrived with an old time. The files of a pull that is not whole yet are taken by the
        load that finds its last page, or a later pull.
        """
        taken = self.warehouse.read("landed_files").filter(F.col("feed") == feed.name)
        newest = taken.agg(F.max("landed_at").alias("at")).first()["at"]
        after = None if newest is None or sweep else newest.replace(tzinfo=UTC) - late
        path = f"{landing.rstrip('/')}/{feed.folder}"
        lines = read_lines(self.spark, path, page_per_file=page_per_file, enabled=enabled, after=after)
        known = taken if after is None else taken.filter(F.col("landed_at") > _moment(after))
        known = known.select(F.col("file").alias("_file"), F.col("landed_at").alias("_landed"))
        return self.load_lines(feed, lines.join(known, ["_file", "_landed"], "left_anti"), now, track=True, **how)

    def load_new(
        self, feed: Feed, landing: str, now: datetime, lookback: timedelta | None = None, **how,
    ) -> Outcome:
        """Load what changed since the feed's last successful load, with a small overlap; all that landed if there was
        none. The load goes no further back than ``lookback`` only where that is given."""
        start, end = self._window(feed.name, now, lookback)
        return self.load(feed, landing, end, start, end, **how)

    def _window(self, name: str, now: datetime, lookback: timedelta | None) -> tuple[datetime | None, datetime]:
        mark = state.last_sync(self.warehouse.read("sync_state"), name)
        mark = mark.replace(tzinfo=UTC) if mark else None
        start, end = lookback_window(now, mark, lookback)
        since_mark = lookback_window(now, mark)[0] if mark else None
        if not lookback:
            return since_mark, end
        if since_mark is None or since_mark < start:
            log.warning("%s: not loaded, by the given lookback: %s to %s", name, since_mark or "the beginning", start)
        return start, end

    def load_lines(
        self, feed: Feed, lines: DataFrame, as_of: datetime, start: datetime | None = None,
        end: datetime | None = None, *, sync_key: str | None = None, delete_missing: bool = False,
        newer_by: str | None = None, only: Mapping[str, Sequence[str]] | None = None, track: bool = False,
        name: str | None = None,
    ) -> Outcome:
        """Load a feed and its children from landed lines, in one commit; the lines are read and parsed once.

        ``track`` lists their files in ``landed_files``; ``name`` notes the load under another name than the feed's.
        """

        def work(run: str) -> tuple[list[Change], list[Stats]]:
            pages, unread = self._parsed(run, feed, lines)
            records = feed.records_of(pages)
            bounds = [None if b is None else _moment(b) for b in (start, end)]
            parents: DataFrame | None = None
            changes, stats = [], []
            for part in (feed, *feed.children):
                rows = part.in_range(part.rows(records, _moment(as_of)), *bounds, undated=True)
                for column, values in (only or {}).items() if part is feed else ():
                    rows = rows.filter(F.col(column).isin(list(values)))
                change, stat, kept = self._merge_part(
                    run, part, rows, as_of, parents if part is not feed else None,
                    delete_missing=delete_missing, newer_by=newer_by)
                parents = kept if part is feed else parents
                changes += change
                stats.append(stat)
            if track:
                changes.append(self._listed(run, feed, pages))
            stats[0].quarantined += unread
            return changes, stats

        return self._recorded(name or feed.name, as_of, work, sync_key)

    def load_waiting(self, feed: Feed, as_of: datetime) -> Outcome:
        """Load what waits in a feed for rows of another one that are there by now."""
        nothing = read_lines(self.spark, "", enabled=False)
        return self.load_lines(feed, nothing, as_of, name=f"{feed.name}_waiting")

    def _parsed(self, run: str, feed: Feed, lines: DataFrame) -> tuple[DataFrame, int]:
        """The pages of a feed, parsed and staged in one reading; quarantine what is no record, and count it."""
        seen = Observation(f"{run} {feed.name} parsed")
        found = feed.pages(lines).observe(seen, F.count("_reason").alias("bad"))
        pages = self.warehouse.stage(run, f"{feed.name}_pages", found).frame
        count = seen.get["bad"]
        if count:
            if self.mode == "refuse":
                raise quality.InvalidBatch(f"{count} unreadable pages or records")
            rejected(pages).select(F.array("reason").alias("errors"), F.col("value").alias("record"), "_file").write.mode(
                "overwrite").json(f"{self.warehouse.root}/_quarantine/run={run}/feed={feed.name}_pages")
            log.warning("%s: %d unreadable pages or records quarantined", feed.name, count)
        if feed.lost is not None:
            lost = self.warehouse.stage(run, f"{feed.name}_lost", feed.lost(feed.records_of(pages)))
            count += lost.rows
            if lost.rows:
                if self.mode == "refuse":
                    raise quality.InvalidBatch(f"{lost.rows} records with unreadable values")
                lost.frame.select(F.array("reason").alias("errors"), F.col("value").alias("record")).write.mode(
                    "overwrite").json(f"{self.warehouse.root}/_quarantine/run={run}/feed={feed.name}_lost")
                log.warning("%s: %d records with unreadable values quarantined", feed.name, lost.rows)
        return pages, count

    def _listed(self, run: str, feed: Feed, pages: DataFrame) -> Change:
        """Note the files of parsed pages as loaded; not those of the newest pull while it is not whole."""
        place = [F.col(f"{SEQ}._file").alias("file"), F.col(f"{SEQ}._landed").alias("landed_at")]
        if feed.more:
            marked = with_pulls(pages)
            newest = marked.agg(F.max(F.struct(PULL, WHOLE))).first()[0]
            done = F.col(PULL) < newest[PULL] if newest and not newest[WHOLE] else F.lit(True)
            pages = marked.filter(done)
        files = pages.select(*place).distinct().select(F.lit(feed.name).alias("feed"), "file", "landed_at", F.lit(run).alias("run_id"))
        batch = self.warehouse.stage(run, "landed_files", files)
        return self.warehouse.merge(run, "landed_files", batch.frame, rows=batch.rows)

    def _merge_part(
        self, run: str, feed: Feed, rows: DataFrame, as_of: datetime, parents: DataFrame | None, **how,
    ) -> tuple[list[Change], Stats, DataFrame]:
        """Check, reduce to one row per key, drop orphans or let them wait, and merge the rows of one feed."""
        table = TABLES[feed.table]
        orphans = waiting = 0
        changes = []
        good, quarantined = self._checked(run, feed.name, rows, quality.table_rules(table))
        one = feed.fold(good) if feed.fold else _newest(good, feed, table.key)
        if self.wait is not None and table.parent and parents is None:
            change, one, orphans, waiting = self._without_waiting(run, feed, one, as_of)
            changes.append(change)
        elif table.parent:
            parent_table, column = table.parent
            known = self.warehouse.read(parent_table) if parents is None else parents
            one = self.warehouse.stage(run, f"{feed.name}_reduced", one).frame  # read three times below
            orphans, one = self._without_orphans(run, feed, one, known, column)
        batch = self.warehouse.stage(run, feed.table, one.select(*[c for c in one.columns if c in table.columns]))
        change = self.warehouse.merge(run, feed.table, batch.frame, rows=batch.rows, as_of=_moment(as_of), **how)
        return [*changes, change], Stats(
            feed.table, batch.rows, change.inserted, change.updated, quarantined, orphans, waiting), batch.frame

    def _without_waiting(
        self, run: str, feed: Feed, rows: DataFrame, as_of: datetime
    ) -> tuple[Change, DataFrame, int, int]:
        """Rows whose parent is there, of those that came and those that waited; the others wait from now on.

        A row that came replaces one of its key that waited, and waits from when that one began. Rows whose parent has
        not come within the time to wait go to quarantine. Returns the change of the waiting rows, the rows to load, and
        how many gave up and how many wait.
        """
        table, waiting = TABLES[feed.table], WAITING[feed.table]
        parent_table, column = table.parent
        now = _moment(as_of)
        given = [c for c in rows.columns if c in table.columns]
        held = self.warehouse.read(waiting.name).withColumn("_came", F.lit(0)).unionByName(
            rows.select(*given).withColumns({"waiting_since": now, "_came": F.lit(1)}), allowMissingColumns=True)
        held = self.warehouse.stage(run, f"{feed.name}_held", held).frame
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in table.key]
        first = held.groupBy(*[F.col(c).alias(f"_{c}") for c in table.key]).agg(F.min("waiting_since").alias("_since"))
        newest = picks.latest_per_key(held, list(table.key), ["_came"]).join(first, reduce(Column.__and__, same)).drop(
            *[f"_{c}" for c in table.key]).withColumn("waiting_since", F.col("_since")).drop("_since", "_came")
        keys = held.select(column).distinct()
        known = self.warehouse.stage(
            run, f"{feed.name}_known", self.warehouse.read(parent_table).select(column).join(keys, column, "left_semi")).frame
        newest = self.warehouse.stage(run, f"{feed.name}_newest", newest).frame
        there = links.drop_orphans(newest, known, column)
        missing = newest.join(known, column, "left_anti")
        late = F.col("waiting_since") + F.make_dt_interval(secs=F.lit(self.wait.total_seconds()).cast("decimal(18,6)")) < now
        still = self.warehouse.stage(run, waiting.name, missing.filter(~late).select(*waiting.columns))
        gone = self.warehouse.stage(run, f"{feed.name}_given_up", missing.filter(late))
        if gone.rows:
            record = F.to_json(F.struct(*[c for c in gone.frame.columns if c in table.columns])).alias("record")
            gone.frame.select(F.array(F.lit(f"no {column} in {parent_table}")).alias("errors"), record).write.mode(
                "overwrite").json(f"{self.warehouse.root}/_quarantine/run={run}/feed={feed.name}_waiting")
            log.warning("%s: %d rows given up: what they hang on did not come", feed.name, gone.rows)
        change = self.warehouse.merge(run, waiting.name, still.frame, rows=still.rows, delete_missing=True)
        return change, there.select(*given), gone.rows, still.rows

    def _checked(self, run: str, name: str, rows: DataFrame, rules: list[quality.Rule]) -> tuple[DataFrame, int]:
        """Stage the rows with their broken rules; return the good ones and how many were set aside."""
        seen = Observation(f"{run} {name} checked")
        marked = quality.checked(rows, rules).observe(
            seen, F.count(F.when(F.size("errors") > 0, 1)).alias("bad"),
            F.count(F.when(F.size("warnings") > 0, 1)).alias("doubtful"))
        staged = self.warehouse.stage(run, f"{name}_checked", marked).frame
        counts = seen.get
        if counts["doubtful"]:
            log.warning("%s: %d doubtful rows", name, counts["doubtful"])
        if counts["bad"]:
            bad = staged.filter(F.size("errors") > 0)
            if self.mode == "refuse":
                reasons = bad.select(F.explode("errors").alias("r")).groupBy("r").count().collect()  # one per rule
                raise quality.InvalidBatch("; ".join(f"{r['r']}: {r['count']}" for r in reasons))
            record = F.to_json(F.struct(*[c for c in rows.columns if c != SEQ])).alias("record")
            bad.select("errors", record).write.mode("overwrite").json(
                f"{self.warehouse.root}/_quarantine/run={run}/feed={name}")
            log.warning("%s: %d rows quarantined", name, counts["bad"])
        return staged.filter(F.size("errors") == 0).drop("errors", "warnings"), counts["bad"]

    def _without_orphans(
        self, run: str, feed: Feed, rows: DataFrame, parents: DataFrame, column: str
    ) -> tuple[int, DataFrame]:
        """Rows whose parent is there. The parents are first cut down to the keys the rows name, so that a large parent
        table meets a small batch without being shuffled."""
        keys = rows.select(column).distinct()
        known = parents.select(column).join(keys, column, "left_semi")
        staged = self.warehouse.stage(run, f"{feed.name}_known", known)
        missing = links.orphan_keys(rows, staged.frame, column).count()
        if missing:
            log.warning("%s: rows of %d missing parents dropped", feed.name, missing)
        return missing, links.drop_orphans(rows, staged.frame, column)

    # --- special loads ---------------------------------------------------------------------------------------------
    def load_accounting(
        self, kind: str, landing: str, now: datetime, start: datetime | None = None, end: datetime | None = None, *,
        full: bool = False, view: str | None = None, **how,
    ) -> Outcome:
        """Load one kind of accounting record in a range: as given, or the last days of its feed up to midnight; all of
        it if ``full``, or if the kind has no date. ``view`` takes only some users (see ``accounting.users_in_view``)."""
        feed = FEEDS[f"accounting_{kind}"]
        if feed.changed is not None:
            start, end = accounting_window(now, start, end, full=full, days=feed.lookback_hours // 24)
        elif start is not None or end is not None:
            raise ValueError(f"{feed.name} has no dates to take a range of")
        if view is not None:
            if kind != "users":
                raise ValueError(f"{feed.name} has no views")
            feed = replace(feed, rows=lambda df, as_of: FEEDS[feed.name].rows(accounting.users_in_view(df, view), as_of))
        return self.load(feed, landing, now, start, end, **how)

    def load_recent_settlements(self, landing: str, now: datetime, days: int = 14, **how) -> Outcome:
        """Load the settlement reports that landed from ``days`` before yesterday to the end of yesterday."""
        start, end = settlement_window(now, days)
        return self.load_settlements(landing, now, start, end, **how)

    def load_settlements(
        self, landing: str, as_of: datetime, start: datetime | None = None, end: datetime | None = None, *,
        enabled: bool = True,
    ) -> Outcome:
        """Load settlement reports: a header per settlement and its numbered lines, together.

        A range opens only the files that landed in it, both of its seconds included.
        """

        def work(run: str) -> tuple[list[Change], list[Stats]]:
            report = read_report(
                self.spark, f"{landing.rstrip('/')}/marketplace/settlements", enabled=enabled, start=start, end=end)
            rules = [quality.required("settlement_id"), quality.required("amount", "decimal"), marketplace.OF_ITS_REPORT]
            found = marketplace.settlement_lines(report)
            found = quality.beside(found, quality.Reference(
                marketplace.report_headers(found), ("report",), {"report_settlement_id": "settlement_id"}))
            lines, bad = self._checked(run, "settlement_lines", found, rules)
            # A settlement lands again and again while its range is asked for: its newest report counts, alone.
            lines = picks.latest_batch(lines, ["settlement_id"], [F.col(f"{SEQ}._landed"), F.col("report")])
            headers = settlement_headers(lines, SEQ).drop("line_count")
            header_rules = [quality.required("settlement_id"), quality.required("currency")]
            headers, bad_headers = self._checked(run, "settlements", headers, header_rules)
            key = [c for c in TABLES["settlement_lines"].key if c != "line_number"]
            numbered = picks.number_repeats(
                links.drop_orphans(lines, headers, "settlement_id").select(*key, "amount", SEQ), key, spread_by=SEQ)
            out = []
            for name, rows in (("settlements", headers), ("settlement_lines", numbered)):
                batch = self.warehouse.stage(run, name, rows)
                out.append((self.warehouse.merge(
                    run, name, batch.frame, rows=batch.rows, as_of=_moment(as_of)), batch.rows))
            return [c for c, _ in out], [
                Stats(c.table, n, c.inserted, c.updated, bad_headers if c.table == "settlements" else bad)
                for c, n in out]

        return self._recorded("marketplace_settlements", as_of, work)

    def load_order_status(
        self, landing: str, as_of: datetime, since: datetime, table: str = "shopify_orders", *, enabled: bool = True
    ) -> Outcome:
        """Write status and tracking of warehouse orders into the store orders they refer to; none is inserted."""

        def work(run: str) -> tuple[list[Change], list[Stats]]:
            feed = FEEDS["warehouse_orders"]
            lines = read_lines(self.spark, f"{landing.rstrip('/')}/{feed.folder}", enabled=enabled)
            pages, unread = self._parsed(run, feed, lines)
            updates = flat_tracking(fulfilment.order_statuses(feed.records_of(pages), _moment(since)))
            newest = picks.latest_per_key(updates, ["order_id"], ["updated_at", SEQ])
            batch = self.warehouse.stage(run, "order_status", newest.select("order_id", *TRACKING))
            change = self.warehouse.update(run, table, batch.frame, TRACKING)
            return [change], [Stats(table, batch.rows, 0, change.updated, unread)]

        return self._recorded("warehouse_order_status", as_of, work)

    def load_status_since_last(
        self, landing: str, now: datetime, lookback: timedelta | None = None, **how,
    ) -> Outcome:
        """Write what changed in the warehouse's orders since the last such load, or ever if there was none."""
        start, end = self._window("warehouse_order_status", now, lookback)
        return self.load_order_status(landing, end, start or datetime(1970, 1, 1, tzinfo=UTC), **how)

    # --- bookkeeping -----------------------------------------------------------------------------------------------
    def _recorded(
        self, name: str, as_of: datetime, work: Callable[[str], tuple[list[Change], list[Stats]]],
        sync_key: str | None = None,
    ) -> Outcome:
        """Run a load and publish its tables, its sync state and its log entry in one commit; on failure publish the
        failure alone, and raise."""
        started = datetime.now(UTC)
        for attempt in range(ATTEMPTS):
            run = f"{name}-{uuid.uuid4().hex[:12]}"
            try:
                changes, stats = work(run)
                self._publish(run, name, as_of, started, state.SUCCESS, changes, stats, None, sync_key)
                return Outcome(run, stats)
            except Conflict as conflict:  # another load changed the same rows meanwhile: merge into what it left
                log.warning("%s: %s", name, conflict)
                error: Exception = conflict
            except Exception as failure:
                error = failure
                break
        self._publish(f"{run}-failed", name, as_of, started, state.ERROR, [], [], str(error), None)
        raise error

    def _publish(
        self, run: str, name: str, as_of: datetime, started: datetime, status: str, changes: list[Change],
        stats: list[Stats], error: str | None, sync_key: str | None,
    ) -> None:
        """Commit the changes of a load with its sync state and its log entry."""
        finished = datetime.now(UTC)
        details = json.dumps([asdict(s) for s in stats])
        mark = self.spark.createDataFrame(
            [(name, as_of, status, finished, sync_key, error, details)],
            "domain string, last_synced_at timestamp, status string, updated_at timestamp, last_sync_key string,"
            " error_message string, sync_metadata string")
        job = {
            "run_id": run, "job_name": name, "status": "success" if status == state.SUCCESS else "failed",
            "started_at": started.isoformat(), "completed_at": finished.isoformat(),
            "duration_seconds": f"{(finished - started).total_seconds():.2f}",
            "records_processed": sum(s.processed for s in stats),
            "records_inserted": sum(s.inserted for s in stats),
            "records_updated": sum(s.updated for s in stats),
            "error_message": error, "metadata": details, "created_at": finished.isoformat(),
        }
        for attempt in range(ATTEMPTS):
            now = self.warehouse.state()
            states = self.warehouse.replace(
                f"{run}-{attempt}", "sync_state", state.put(self.warehouse.read("sync_state", now), mark), now)
            try:
                self.warehouse.commit(run, [*changes, states], job)
                return
            except Conflict as conflict:
                # Only the states, which every load writes, are written again; a conflict over rows is the caller's.
                if conflict.table not in (None, "sync_state") or attempt == ATTEMPTS - 1:
                    raise


def _newest(rows: DataFrame, feed: Feed, key: tuple[str, ...]) -> DataFrame:
    """The newest row per key: by the feed's change time, then by arrival."""
    order = [c for c in (feed.changed, SEQ) if c and c in rows.columns]
    return picks.latest_per_key(rows, list(key), order)


def check_unique(batch: DataFrame, key: list[str]) -> DataFrame:
    """Raise if a batch holds a key more than once, else return it."""
    found = repeated_keys(batch, key).limit(5).collect()
    if found:
        raise quality.InvalidBatch(f"repeated keys, among them {[tuple(r[k] for k in key) for r in found]}")
    return batch
