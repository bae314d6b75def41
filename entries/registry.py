"""Registry of queries and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("merging", "scalars", "records", "quality", "incremental", "business", "alerting", "landed", "changes", "whole_rows")
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The given tables of one folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def wide(self, name: str) -> DataFrame:
        """A table dealt out to all cores, for queries that do much work per row.

        Only a table of fewer files than cores is dealt out; a large one has splits enough and is read as it lies.
        """
        df = getattr(self, name)
        cores = self._spark.sparkContext.defaultParallelism
        return df.repartition(cores) if len(df.inputFiles()) < cores else df


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: times and days as text, decimals as double."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(build(Tables(spark, folder)))

        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return build

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"entries.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def stamp(expression: str) -> str:
    """SQL text of a timestamp, as ``portable`` prints it."""
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
