"""Vectors of whole numbers, and queries meeting all rows block by block: what the searches over vectors share.

Queries are dealt to blocks of at most about ``ASKED`` numbers, rows to slices; every block meets every slice in a group
of its own. A group's queries stay in memory, its rows stream past them in blocks of at most ``BLOCK`` numbers, so memory
depends on neither table. Blocks and slices are dealt by a hash of the row's number, so no key, label or group of copies
gathers in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.common import bounded, stage

#: Numbers (rows times dimensions) of the queries of a group, and of the rows that meet them at a time.
ASKED = 1 << 22
BLOCK = 1 << 18
#: Rows of a slice: at most, and at least where there are tasks for more slices.
SLICE = 1 << 18
LEAST = 1 << 10
TASKS = 10_000
#: Components are below this in magnitude, so that inner products fit 64 bits.
LARGEST = 1 << 24


def scaled(vector: Column, scale: float) -> Column:
    """Components times ``scale``, rounded down; null for a null vector or one with a null or non-finite component."""
    fit = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    small = F.forall(whole, lambda x: F.abs(x) < LARGEST)
    return F.when(fit, F.when(small, whole.cast("array<int>"))
                  .otherwise(F.raise_error(F.lit(f"a component is {LARGEST} or more in magnitude")).cast("array<int>")))


def numbered(vectors: DataFrame, folder: str, scale: float, vector: str, **columns: Column) -> DataFrame:
    """``(place, dim, v, *columns)`` of the rows whose vector takes part, written: ``place`` numbers the rows."""
    named = vectors.select(scaled(F.col(f"`{vector}`"), scale).alias("v"), *[c.alias(n) for n, c in columns.items()])
    return stage(named.where(F.col("v").isNotNull())
                 .select(F.monotonically_increasing_id().alias("place"), F.size("v").alias("dim"), "*"), folder, "vectors")


class Block:
    """Rows of a group as arrays: ``x`` (rows by dimensions), ``place``, and the other columns as Arrow arrays."""

    def __init__(self, batches: list[pa.RecordBatch], dim: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.columns = {n: table[n].combine_chunks() if table[n].num_chunks else pa.array([], table[n].type) for n in table.column_names}
        self.x = self.columns["v"].flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim).astype(np.int64)
        self.place = self.columns["place"].to_numpy(zero_copy_only=False)

    def __len__(self) -> int:
        return len(self.x)


def meet(asking: DataFrame, rows: DataFrame, search, out: str, key: str) -> DataFrame:
    """Let every row of ``asking`` meet every row of ``rows`` of as many dimensions.

    Both hold ``place``, ``dim``, ``v`` and the same further columns. ``search(queries)`` is called with the Block of a
    group's queries; then ``.feed(block)`` with the group's rows by ascending ``key`` (null last, then ``place``), and
    ``.answers()`` returns arrays for the columns ``out``.
    """
    spark = rows.sparkSession
    bounded(spark)
    n, dim = rows.agg(F.count("*"), F.max("dim")).first()
    asked = asking.count()
    blocks = max(1, -(-asked * max(dim or 1, 1) // ASKED))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(1, -(-n // SLICE), min(-(-2 * tasks // blocks), -(-n // LEAST)))
    by = lambda count: F.pmod(F.xxhash64("place"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = (asking.select(by(blocks).alias("b"), every(slices).alias("s"), F.lit(0).cast("byte").alias("side"), "*")
             .unionByName(rows.select(every(blocks).alias("b"), by(slices).alias("s"), F.lit(1).cast("byte").alias("side"), "*")))
    order = ["dim", "b", "s", "side", F.col(key).asc_nulls_last(), "place"]
    kind = T._parse_datatype_string(out)
    names, types = kind.names, [f.dataType for f in kind.fields]

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = [to_arrow_type(t) for t in types]
        held = {"group": None, "asked": [], "search": None, "rows": [], "many": 0}

        def fed():
            if held["rows"]:
                if held["search"] is None and held["asked"]:
                    held["search"] = search(Block(held["asked"], held["group"][0]))
                    held["asked"] = []
                if held["search"] is not None:
                    held["search"].feed(Block(held["rows"], held["group"][0]))
            held["rows"], held["many"] = [], 0

        def over():
            fed()
            found, held["search"], held["asked"] = held["search"], None, []
            if found is not None:
                cols = found.answers()
                for at in range(0, len(cols[0]), 8192):
                    yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 8192], t) if isinstance(c, np.ndarray) else c.slice(at, 8192)
                                                      for c, t in zip(cols, arrow)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "b", "s", "side")])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                group, side = tuple(marks[:3, a].tolist()), marks[3, a]
                if group != held["group"]:
                    yield from over()
                    held["group"] = group
                if side == 0:
                    held["asked"].append(batch.slice(a, z - a))
                    continue
                fits = max(1, BLOCK // max(group[0], 1))
                while a < z:
                    take = min(z - a, fits - held["many"])
                    held["rows"].append(batch.slice(a, take))
                    held["many"] += take
                    a += take
                    if held["many"] >= fits:
                        fed()
        yield from over()

    parts = min(blocks * slices, TASKS)
    return (dealt.repartitionById(parts, F.pmod(F.col("b") * F.lit(slices) + F.col("s"), F.lit(parts)).cast("int"))
            .sortWithinPartitions(*order).mapInArrow(work, out))


class Best:
    """The ``k`` best hits of each of ``n`` lists, ties to the earlier place in the stream; kept as flat arrays."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.seen = n, k, 0
        self.list = self.score = self.pos = np.empty(0, np.int64)
        self.keys: pa.Array | None = None
        #: A later hit must score this at least to enter.
        self.need = np.full(n, np.iinfo(np.int64).min)

    def add(self, lists: np.ndarray, scores: np.ndarray, at: np.ndarray, keys: pa.Array) -> None:
        """Hits of one block: ``at`` is the row in the block, whose keys are ``keys``."""
        old = len(self.list)
        where, score, pos = np.r_[self.list, lists], np.r_[self.score, scores], np.r_[self.pos, at + self.seen]
        self.seen += len(keys)
        order = np.lexsort((pos, -score, where))
        where = where[order]
        first = np.r_[True, where[1:] != where[:-1]] if len(where) else np.empty(0, bool)
        starts = np.flatnonzero(first)
        rank = np.arange(len(where)) - starts[np.cumsum(first) - 1] if len(where) else where
        stay = order[rank < self.k]
        new = keys.take(pa.array(at[stay[stay >= old] - old]))
        both = new if self.keys is None else pa.concat_arrays([self.keys.take(pa.array(stay[stay < old])), new])
        # Kept hits of before stand first, then those of the block; put them back in order.
        self.list, self.score, self.pos = (np.r_[x[stay[stay < old]], y[stay[stay >= old] - old]] for x, y in (
            (self.list, lists), (self.score, scores), (self.pos, at + self.seen - len(keys))))
        self.keys = both
        full = np.bincount(self.list, minlength=self.n) >= self.k
        least = np.full(self.n, np.iinfo(np.int64).max)
        np.minimum.at(least, self.list, self.score)
        self.need = np.where(full, least + 1, np.iinfo(np.int64).min)


def first_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, ties to the earlier; in no order."""
    if len(scores) <= k:
        return np.arange(len(scores))
    edge = np.partition(scores, -k)[-k]
    above = np.flatnonzero(scores > edge)
    return np.r_[above, np.flatnonzero(scores == edge)[:k - len(above)]]


def exact_form(x: np.ndarray, other: int) -> np.ndarray:
    """``x`` as float64 if its inner products with numbers up to ``other`` are exact that way (and fast), else as int64."""
    most = int(np.abs(x).max(initial=0)) * max(other, 1) * max(x.shape[1], 1)
    return x.astype(np.float64) if most < 1 << 53 else x
