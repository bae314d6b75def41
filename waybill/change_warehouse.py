"""A warehouse of tables kept as their changes (see ``changes``): loads append to it, and none of them waits or retries.

It takes the place of ``Warehouse`` in a ``Loader`` and in the questions. A load writes its tables, its sync state and its
log entry under its run; one appended file publishes them together. Of two loads that set a column of the same row the
one published last holds; ``newer_by`` is judged against what was published when the load read.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.changes import RUNS, ChangeTable, Written, new_run
from waybill.schemas import TABLES, Table
from waybill.schemas import table as declared
from waybill.warehouse import Change, Warehouse

#: Columns whose month gives the part a new row goes to; a table takes the first it has, one without any has one part.
DATED = ("purchase_date", "dated_on", "posted_date", "created_date", "insert_date", "period_start", "landed_at", "started_at")


def by_month(table: Table) -> str:
    """The clustering expression of a table."""
    dated = [c for c in DATED if table.columns.get(c) == "timestamp"]
    return f"date_format({dated[0]}, 'yyyy-MM')" if dated else "'all'"


class ChangeWarehouse(Warehouse):
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> ChangeTable:
        of = declared(name)
        return ChangeTable(self.spark, self.root, of, by_month(of))

    # --- state -----------------------------------------------------------------------------------------------------
    def state(self) -> DataFrame:
        """What is published by now, the same for all tables."""
        return self.table("sync_state").published_now()

    def commit(self, run: str, changes: Sequence[Change], job: dict | None = None) -> int:
        """Publish all changes of a run at once, with its entry in the job log; returns how many runs that were."""
        if job:
            log = declared("job_executions")
            entry = self.spark.range(1).select(F.from_json(F.lit(json.dumps(job)), log.ddl).alias("job")).select("job.*")
            self.table("job_executions").upsert(run, entry)
        runs = sorted({run, *(r for c in changes for r in c.runs.values())})
        now = datetime.now(UTC)
        frame = self.spark.createDataFrame([(r, now, []) for r in runs], RUNS)
        frame.coalesce(1).write.mode("append").json(f"{self.root}/_published")
        return len(runs)

    def obsolete(self) -> list[str]:
        """Folders that compactions have replaced. Remove them when no earlier reader is left."""
        return [folder for name in TABLES for folder in self.table(name).obsolete()]

    def compact(self, name: str, parts: Sequence[str]) -> str:
        """Write the rows of some parts of a table anew."""
        return self.table(name).compact(parts)

    # --- reading ---------------------------------------------------------------------------------------------------
    def read(self, name: str, now: DataFrame | None = None) -> DataFrame:
        """A table as of a ``state`` (the newest by default); empty if it was never written."""
        return self.table(name).read(now)

    # --- writing ---------------------------------------------------------------------------------------------------
    def merge(
        self, run: str, name: str, batch: DataFrame, *, rows: int | None = None, as_of: Column | None = None,
        missing: str = "keep", newer_by: str | None = None, delete_missing: bool = False,
    ) -> Change:
        """Append a staged batch (each key once); nothing is visible before ``commit``. Options as in ``Warehouse``."""
        if missing not in ("keep", "default"):
            raise ValueError(f"missing must be keep or default, not {missing!r}")
        of, kept = declared(name), self.table(name)
        if as_of is not None and "created_at" in of.columns and "created_at" not in batch.columns:
            batch = batch.withColumn("created_at", as_of)
        if missing == "default":
            batch = batch.withColumns({
                c: F.expr(of.defaults.get(c, "NULL")).cast(of.columns[c]) for c in of.update if c not in batch.columns})
        whole = batch
        if newer_by:
            there = kept.of_keys(batch, newer_by).select(
                *[F.col(k).alias(f"_{k}") for k in of.key], F.col(newer_by).alias("_newest"))
            fresh = F.coalesce(F.col(newer_by).cast(of.columns[newer_by]) >= F.col("_newest"), F.col("_newest").isNull())
            batch = batch.join(there, kept.matched(), "left").filter(fresh).select(*batch.columns)
        done = kept.upsert(run, batch)
        if delete_missing:
            named = whole.select(*[F.col(k).cast(of.columns[k]).alias(f"_{k}") for k in of.key])
            kept.delete(run, kept.read().select(*of.key).join(named, kept.matched(), "left_anti"))
        return self._change(name, run, done)

    def update(self, run: str, name: str, batch: DataFrame, columns: Sequence[str]) -> Change:
        """Set columns of known keys; unknown keys are left out."""
        return self._change(name, run, self.table(name).update(run, batch.select(*declared(name).key, *columns)))

    def replace(self, run: str, name: str, rows: DataFrame, now: DataFrame) -> Change:
        """Set the rows that differ from those of ``now``, so that rows others have set meanwhile stay as they are."""
        columns = list(declared(name).columns)
        run = new_run(run)
        return self._change(name, run, self.table(name).upsert(
            run, rows.select(*columns).exceptAll(self.read(name, now).select(*columns))))

    @staticmethod
    def _change(name: str, run: str, done: Written) -> Change:
        return Change(name, 1, {0: run}, done.inserted, done.updated)
