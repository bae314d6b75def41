"""The warehouse: keyed Parquet tables that change together or not at all.

A table is split into a fixed number of buckets by the hash of its key. A merge rewrites only the buckets its batch
touches, each run into a folder of its own (``<table>/run=<run>/_bucket=<n>``); nothing published is ever overwritten.
A commit is one small file that names, for every table, the run that holds each bucket. It appears under the next number
or fails if another writer took that number, so a reader sees all tables of a run or none, and a run that dies leaves the
warehouse as it was. Runs no commit names any more are listed by ``obsolete`` for removal. A commit also carries the log
entry of its job, so the commits together are the job log.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybill.operators import merge as ops
from waybill.schemas import TABLES, Table
from waybill.schemas import table as declared
from waybill.session import shared_folder

_KEY, _BUCKET = "_key", "_bucket"


def key_text(keys: Sequence[str]) -> Column:
    """The key of a row as one text that is never NULL; NULL parts equal each other and nothing else."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys])


class Conflict(Exception):
    """Another writer published between a merge's reading and its commit; ``table`` is the table both changed."""

    def __init__(self, table: str | None, what: str):
        super().__init__(what)
        self.table = table


@dataclass(frozen=True)
class Change:
    """A table's next state: the run per touched bucket, what happened to the rows, and which runs were merged into."""

    table: str
    buckets: int
    runs: dict[int, str]
    inserted: int = 0
    updated: int = 0
    gone: frozenset[int] = field(default_factory=frozenset)
    base: dict[int, str | None] = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """A batch written to the shared folder, with its counted rows."""

    frame: DataFrame
    rows: int


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._log(0, {"seq": 0, "run": None, "job": None, "tables": {}}, "ignore")

    # --- state -----------------------------------------------------------------------------------------------------
    def _log(self, seq: int, entry: dict, mode: str) -> None:
        frame = self.spark.createDataFrame([(json.dumps(entry),)], "value string")
        frame.coalesce(1).write.mode(mode).text(f"{self.root}/_commits/seq={seq:012d}")

    def _commits(self) -> DataFrame:
        return self.spark.read.schema("value string").text(f"{self.root}/_commits")

    def state(self) -> dict:
        """The newest commit: its number, and per table the bucket count and the run of every bucket.

        Commit files are listed by name and only the newest is read.
        """
        newest = max(self._commits().inputFiles())
        return json.loads(self.spark.read.text(newest).first()["value"])

    def commit(self, run: str, changes: Sequence[Change], job: dict | None = None) -> int:
        """Publish all changes of a run at once; raises ``Conflict`` if another writer was faster, or has changed a
        bucket since the merge read it."""
        now = self.state()
        tables = dict(now["tables"])
        for change in changes:
            old = tables.get(change.table, {"buckets": change.buckets, "runs": {}})
            moved = [b for b, run_read in change.base.items() if old["runs"].get(str(b)) != run_read]
            if moved:
                raise Conflict(change.table, f"{change.table}: {len(moved)} buckets have changed since they were read")
            runs = {b: r for b, r in old["runs"].items() if int(b) not in change.gone}
            runs.update({str(b): r for b, r in change.runs.items()})
            tables[change.table] = {"buckets": old["buckets"], "runs": runs}
        seq = now["seq"] + 1
        try:
            self._log(seq, {"seq": seq, "run": run, "job": job, "tables": tables}, "error")
        except AnalysisException as error:
            if "PATH_ALREADY_EXISTS" not in (error.getCondition() or ""):
                raise
            raise Conflict(None, f"commit {seq} exists: another writer was faster") from error
        return seq

    @staticmethod
    def _base(now: dict, name: str, touched: Sequence[int]) -> dict[int, str | None]:
        runs = now["tables"].get(name, {"runs": {}})["runs"]
        return {b: runs.get(str(b)) for b in touched}

    def obsolete(self) -> list[str]:
        """Run folders that hold no current bucket. Remove them when no reader of an older commit is left."""
        named = self._commits().select(F.explode(F.from_json(
            F.get_json_object("value", "$.tables"), "map<string, struct<runs: map<string, string>>>")).alias("t", "s"))
        folders = named.select("t", F.explode(F.map_values("s.runs")).alias("run")).distinct()
        live = {(t, r) for t, s in self.state()["tables"].items() for r in s["runs"].values()}
        return sorted(f"{self.root}/{t}/run={r}" for t, r in folders.collect() if (t, r) not in live)

    # --- reading ---------------------------------------------------------------------------------------------------
    def read(self, name: str, now: dict | None = None) -> DataFrame:
        """A table as of a commit (the newest by default); empty if it was never written. ``job_executions`` is the
        job log."""
        table = declared(name)
        if name == "job_executions":
            entry = F.from_json(F.get_json_object("value", "$.job"), table.ddl)
            return self._commits().select(entry.alias("job")).filter("job IS NOT NULL").select("job.*")
        return self._read(table, now or self.state(), None).drop(_BUCKET)

    def snapshot(self) -> Callable[[str], DataFrame]:
        """A reader of all tables as of the newest commit, for questions over several tables."""
        now = self.state()
        return lambda name: self.read(name, now)

    def views(self, json_text: bool = False) -> list[str]:
        """Register every table as a temporary view of its name, for SQL; nested columns as JSON text on request."""
        read = self.snapshot()
        for name in TABLES:
            df = read(name)
            nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")]
            if json_text:
                df = df.withColumns({c: F.to_json(c) for c in nested})
            df.createOrReplaceTempView(name)
        return list(TABLES)

    def _read(self, table: Table, now: dict, buckets: Sequence[int] | None) -> DataFrame:
        runs = now["tables"].get(table.name, {"runs": {}})["runs"]
        wanted = {b: r for b, r in runs.items() if buckets is None or int(b) in set(buckets)}
        if not wanted:
            return self.spark.createDataFrame([], f"{table.ddl}, {_BUCKET} int")
        paths = [f"{self.root}/{table.name}/run={r}/{_BUCKET}={b}" for b, r in wanted.items()]
        return (
            self.spark.read.schema(f"{table.ddl}, {_BUCKET} int")
            .option("basePath", f"{self.root}/{table.name}")
            .parquet(*paths)
            .select(*table.columns, _BUCKET)
        )

    # --- writing ---------------------------------------------------------------------------------------------------
    def _bucket_count(self, table: Table, now: dict) -> int:
        return now["tables"].get(table.name, {"buckets": self.buckets})["buckets"]

    def stage(self, run: str, name: str, df: DataFrame) -> Staged:
        """Write a batch to the shared folder once, so that checks and merges do not compute it again."""
        folder = shared_folder(self.spark, f"{self.root}/_staging")
        path = f"{folder}/waybill/run={run}/{name}"
        seen = Observation(f"{run} {name}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return Staged(self.spark.read.schema(df.schema).parquet(path), seen.get["rows"])

    def _keyed(self, df: DataFrame, table: Table, buckets: int) -> DataFrame:
        keyed = df.withColumn(_KEY, key_text(table.key))
        # The same hash Spark partitions by: repartition(buckets, _key) puts every bucket into one task.
        return keyed.withColumn(_BUCKET, F.pmod(F.hash(_KEY), F.lit(buckets)))

    def _write(
        self, run: str, table: Table, rows: DataFrame, buckets: int, touched: Sequence[int], may_empty: bool, now: dict
    ) -> Change:
        """Write merged rows of the touched buckets as the run's version, counting operations on the way."""
        path = f"{self.root}/{table.name}/run={run}"
        seen = Observation(f"{run} {table.name} written")
        counted = rows.observe(
            seen,
            F.count(F.when(F.col(ops.OP) == ops.INSERT, 1)).alias("inserted"),
            F.count(F.when(F.col(ops.OP) == ops.UPDATE, 1)).alias("updated"),
        )
        counted.drop(ops.OP).write.mode("error").partitionBy(_BUCKET).parquet(path)
        counts, written = seen.get, set(touched)
        if may_empty:
            written = set(self._touched(self.spark.read.schema(f"{table.ddl}, {_BUCKET} int").parquet(path)))
        return Change(
            table.name, buckets, dict.fromkeys(sorted(written), run), counts["inserted"], counts["updated"],
            frozenset(set(touched) - written), self._base(now, table.name, touched))

    def _touched(self, batch: DataFrame) -> list[int]:
        return [row[_BUCKET] for row in batch.select(_BUCKET).distinct().collect()]  # at most one row per bucket

    def merge(
        self, run: str, name: str, batch: DataFrame, *, rows: int | None = None, as_of: Column | None = None,
        missing: str = "keep", newer_by: str | None = None, delete_missing: bool = False,
    ) -> Change:
        """Merge a staged batch (each key once) into a table; nothing is visible before ``commit``.

        ``rows`` is the counted size of the batch. With a small one the table is not shuffled; a large one is shuffled
        together with the touched buckets, one task per bucket. ``delete_missing`` treats the batch as the whole table
        and drops other keys.
        """
        table, now = declared(name), self.state()
        buckets = self._bucket_count(table, now)
        stamped = batch if as_of is None or "created_at" in batch.columns or "created_at" not in table.columns else (
            batch.withColumn("created_at", as_of))
        source = self._keyed(stamped, table, buckets)
        touched = list(range(buckets)) if delete_missing else self._touched(source)
        if not touched:
            return Change(name, buckets, {})
        target = self._keyed(self._read(table, now, touched), table, buckets)
        small = rows is not None and rows <= ops.SMALL_BATCH_ROWS
        if not small:
            source, target = source.repartition(buckets, _KEY), target.repartition(buckets, _KEY)
        if delete_missing:
            target = ops.still_present(target, source, [_KEY])
        merged = ops.merge(
            target, source, [_KEY], table.update, defaults=table.defaults, missing=missing, newer_by=newer_by,
            null_safe=False, small_batch=small,
        )
        return self._write(run, table, merged.drop(_KEY), buckets, touched, delete_missing, now)

    def update(self, run: str, name: str, batch: DataFrame, columns: Sequence[str]) -> Change:
        """Overwrite columns of known keys; unknown keys are not inserted."""
        table, now = declared(name), self.state()
        buckets = self._bucket_count(table, now)
        source = self._keyed(batch, table, buckets)
        touched = self._touched(source)
        if not touched:
            return Change(name, buckets, {})
        target = self._keyed(self._read(table, now, touched), table, buckets)
        changed = ops.update_only(target, source.select(_KEY, *columns), [_KEY], columns)
        return self._write(run, table, changed.drop(_KEY), buckets, touched, True, now)

    def replace(self, run: str, name: str, rows: DataFrame, now: dict) -> Change:
        """Write a small table anew, as one bucket, in place of its state in ``now``."""
        table = declared(name)
        one = rows.select(*table.columns).withColumn(_BUCKET, F.lit(0)).coalesce(1)
        one.write.mode("error").partitionBy(_BUCKET).parquet(f"{self.root}/{table.name}/run={run}")
        return Change(name, 1, {0: run}, base=self._base(now, name, [0]))
