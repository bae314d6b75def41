"""A keyed table kept as its changes: writing appends, reading resolves, compaction folds.

Changes lie in ``_part=<part>/_run=<run>``: a part is a value of the table's clustering expression (a month, a source),
and a key stays in the part it was first written to. A batch so touches the parts of its keys and rewrites nothing;
an update carries only the columns it sets. A run counts once it is published: one row appended to ``_published``, which
may speak for several tables, makes all its changes visible together. Everything is written by Spark's own writers into
folders of its own, nothing is overwritten, and no writer waits for another: of two runs the one published last wins,
column by column.

Compaction writes the rows of some parts anew as a run of its own; readers then take those parts from it, and what was
published for them later. ``obsolete`` names the folders it has replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybill.operators.changes import GONE, PATCH, ROW, resolved
from waybill.schemas import Table

_META = "_kind string, _set array<string>, _part string, _run string"
RUNS = "run string, at timestamp, folded array<string>"


@dataclass(frozen=True)
class Written:
    """What a run appended to one table."""

    run: str
    inserted: int
    updated: int


def new_run(name: str = "run") -> str:
    return f"{name}-{uuid.uuid4().hex[:12]}"


class ChangeTable:
    """One table below ``root``. ``cluster`` is a SQL expression over a row that gives its part; NULL gives ``none``."""

    def __init__(self, spark: SparkSession, root: str, table: Table, cluster: str = "'all'"):
        self.spark, self.table, self.cluster = spark, table, cluster
        self.path, self.published = f"{root.rstrip('/')}/{table.name}", f"{root.rstrip('/')}/_published"

    # --- runs ------------------------------------------------------------------------------------------------------
    def _or_nothing(self, path: str, ddl: str, form: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).format(form).load(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return self.spark.createDataFrame([], ddl)

    def publish(self, run: str, at: datetime | None = None, folded: Sequence[str] = ()) -> None:
        """Make all that a run has written visible, in every table below the root."""
        row = [(run, at or datetime.now(UTC), [f"{self.table.name}/{p}" for p in folded])]
        self.spark.createDataFrame(row, RUNS).coalesce(1).write.mode("append").json(self.published)

    def published_now(self) -> DataFrame:
        """What has been published by now; the files are listed once, so later ones are not in it."""
        return self._or_nothing(self.published, RUNS, "json")

    def runs(self, published: DataFrame | None = None) -> DataFrame:
        """Published runs; one published twice counts at its first time."""
        rows = self.published_now() if published is None else published
        return rows.groupBy("run").agg(F.min("at").alias("at"), F.min_by("folded", "at").alias("folded"))

    # --- reading ---------------------------------------------------------------------------------------------------
    def _visible(self, published: DataFrame | None = None) -> DataFrame:
        """Changes of published runs with their time, without those a later compaction of their part has folded."""
        stored = self._or_nothing(self.path, f"{self.table.ddl}, {_META}", "parquet")
        runs = self.runs(published)
        floors = (runs.select(F.explode("folded").alias("of"), "at").filter(F.col("of").startswith(f"{self.table.name}/"))
                  .groupBy(F.substring("of", len(self.table.name) + 2, 1 << 20).alias("_floor_of")).agg(F.max("at").alias("_floor")))
        dated = stored.join(runs.select(F.col("run").alias("_of"), F.col("at").alias("_at")), F.col("_run") == F.col("_of")).drop("_of")
        return (dated.join(floors, F.col("_part") == F.col("_floor_of"), "left")
                .filter(F.col("_floor").isNull() | (F.col("_at") >= F.col("_floor"))).drop("_floor", "_floor_of"))

    def read(self, published: DataFrame | None = None) -> DataFrame:
        """The rows of the table, as of ``published_now`` of some moment if that is given. Filters on the clustering
        expression do not prune parts; ``read_parts`` does."""
        return resolved(self._visible(published), self.table.key, self.table.columns, self.table.frozen, defaults=self.table.defaults)

    def read_parts(self, parts: Sequence[str]) -> DataFrame:
        """The rows of some parts, reading their folders only: a key is in one part."""
        return resolved(self._visible().filter(F.col("_part").isin(list(parts))), self.table.key, self.table.columns,
                        self.table.frozen, defaults=self.table.defaults)

    def matched(self) -> Column:
        return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.table.key])

    def of_keys(self, batch: DataFrame, column: str, carried: Column | None = None) -> DataFrame:
        """Key and one column (``_part`` too) of the rows whose keys a batch has, from these columns alone.

        Changes meet the keys of the batch before they are resolved: a batch that Spark broadcasts leaves the table
        unshuffled but for its own keys.
        """
        keys = {k: self.table.columns[k] for k in self.table.key}
        wanted = batch.select(*[F.col(k).cast(t).alias(f"_{k}") for k, t in keys.items()])
        carried = F.col("_set") if carried is None else carried
        stored = self._visible().select(*keys, column, "_kind", carried.alias("_set"), "_at", "_run")
        return resolved(stored.join(wanted, self.matched(), "left_semi"), self.table.key,
                        {**keys, column: self.table.columns.get(column, "string")})

    # --- writing ---------------------------------------------------------------------------------------------------
    def _append(self, run: str, batch: DataFrame, kind: str, only_known: bool) -> Written:
        carried = [c for c in batch.columns if c in self.table.columns]
        lost = [k for k in self.table.key if k not in carried]
        if lost:
            raise ValueError(f"{self.table.name}: a batch needs {', '.join(lost)}")
        types = self.table.columns
        rows = batch.select(*[F.col(c).cast(types[c]).alias(c) if c in carried else F.lit(None).cast(t).alias(c) for c, t in types.items()])
        known = self.of_keys(rows, "_part", F.array(F.lit("_part")))
        known = known.select(*[F.col(k).alias(f"_{k}") for k in self.table.key], F.col("_part").alias("_old"))
        joined = rows.join(known, self.matched(), "inner" if only_known else "left")
        seen = Observation(f"{run} {self.table.name}")
        parts = F.coalesce("_old", F.expr(f"cast({self.cluster} as string)"), F.lit("none"))
        out = joined.withColumns({"_kind": F.lit(kind), "_set": F.array(*map(F.lit, carried)).cast("array<string>"), "_part": parts,
                                  "_run": F.lit(run)}).observe(
            seen, F.count(F.when(F.col("_old").isNull(), 1)).alias("inserted"), F.count("_old").alias("updated"))
        (out.select(*types, "_kind", "_set", "_part", "_run").repartition("_part").write.mode("append")
         .partitionBy("_part", "_run").parquet(self.path))
        counts = seen.get
        return Written(run, counts["inserted"], counts["updated"])

    def upsert(self, run: str, batch: DataFrame) -> Written:
        """Append whole rows, each key once: new keys are inserted; of known ones the columns the batch has are set."""
        return self._append(run, batch, ROW, False)

    def update(self, run: str, batch: DataFrame) -> Written:
        """Append columns of known keys; unknown keys are left out."""
        return self._append(run, batch, PATCH, True)

    def delete(self, run: str, keys: DataFrame) -> Written:
        """Append the end of known keys."""
        return self._append(run, keys.select(*self.table.key), GONE, True)

    def compact(self, parts: Sequence[str], at: datetime | None = None) -> str:
        """Write the rows of some parts anew and publish them in place of what these parts hold.

        Runs that are published between the reading and the publishing are not lost: the compaction counts from the time
        at which it was begun.
        """
        begun = at or datetime.now(UTC)
        run = new_run("compact")
        seen = self._visible().filter(F.col("_part").isin(list(parts)) & (F.col("_at") <= F.lit(begun)))
        place = seen.groupBy(*self.table.key).agg(F.first("_part").alias("_part"))
        rows = resolved(seen, self.table.key, self.table.columns, self.table.frozen, defaults=self.table.defaults)
        place = place.select(*[F.col(k).alias(f"_{k}") for k in self.table.key], "_part")
        (rows.join(place, self.matched()).drop(*[f"_{k}" for k in self.table.key])
         .withColumns({"_kind": F.lit(ROW), "_set": F.array(*map(F.lit, self.table.columns)), "_run": F.lit(run)})
         .repartition("_part").write.mode("append").partitionBy("_part", "_run").parquet(self.path))
        self.publish(run, begun, parts)
        return run

    def obsolete(self) -> list[str]:
        """Folders that no reader takes any more; remove them when readers from before the compaction are done."""
        stored = self._or_nothing(self.path, f"{self.table.ddl}, {_META}", "parquet").select("_part", "_run").distinct()
        dead = stored.join(self.runs().select(F.col("run").alias("_run")), "_run", "left_semi").join(
            self._visible().select("_part", "_run").distinct(), ["_part", "_run"], "left_anti")
        return sorted(f"{self.path}/_part={r['_part']}/_run={r['_run']}" for r in dead.collect())
