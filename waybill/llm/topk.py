"""Exact top-k by inner product from an impact-ordered index, processed a score at a time.

Every component of a block of rows is rounded to one of ``2 * LEVELS + 1`` levels of its dimension; its level is its
impact, and the rows of a dimension and level form a posting segment. A query takes segments by descending impact on its
scores (its component times the level), adding them up per row. After each round of segments every row has an upper
bound: what has been added, the most that the segments left can still add, and the length of query times the length of
what rounding took from the row (Cauchy-Schwarz). Rows whose bound is below the k-th best exact score so far are proved
no members. The query leaves the index once that holds for all but ``POSSIBLE`` of the rows, or no segment is left, and
takes its answer from the exact scores of the possible members. Level 0 has no postings: its impact is nil.

Defined cases: vectors that are null, or hold a null or non-finite component, take no part; only vectors of as many
dimensions meet, and vectors without components score 0 with each other; a component of ``vectors.LARGEST`` or more after
scaling stops the job with a message; a null key comes last among equal scores, and asks nothing; repeated rows and
repeated keys are rows of their own (a row is a candidate of its twin, not of itself); equal scores go to the smaller
key, then, for equal keys, to either row; an empty table gives no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import work_folder
from waybill.llm.vectors import Best, Block, exact_form, first_best, meet, numbered

LEVELS = 8
#: Shares of a query's postings after which the bounds are looked at.
ROUNDS = (0.5, 0.7, 0.8, 0.9, 0.95, 1.0)
#: Share of a block's rows that may be left to exact scores while segments are left.
POSSIBLE = 1 / 16


class Index:
    """Posting segments of the rows of ``x``, by dimension and level."""

    def __init__(self, x: np.ndarray):
        n, dims = x.shape
        self.n, self.dims = n, dims
        most = np.abs(x).max(0, initial=0)
        step = np.maximum(1, -(-2 * most // (2 * LEVELS + 1)))
        level = np.rint(x / step).astype(np.int8)
        self.lost = np.sqrt(((x - level * step) ** 2).sum(1).astype(np.float64))
        #: Rows of all segments, one after the other; a segment's dimension, impact and bounds.
        order = np.argsort(level, axis=0, kind="stable")
        self.rows = np.ascontiguousarray(order.T).reshape(-1).astype(np.int32)
        counts = np.stack([(level == k).sum(0) for k in range(-LEVELS, LEVELS + 1)], axis=1)
        ends = np.cumsum(counts.reshape(-1))
        dim, k = np.divmod(np.arange(counts.size), 2 * LEVELS + 1)
        real = (counts.reshape(-1) > 0) & (k != LEVELS)
        self.dim, self.impact = dim[real], ((k - LEVELS) * step[dim])[real]
        self.starts, self.ends = (ends - counts.reshape(-1))[real], ends[real]
        self.sizes = self.ends - self.starts

    def by_impact(self, query: np.ndarray):
        """Segments of the query by descending impact: their indices, signed impacts, and postings up to each."""
        impact = query[self.dim] * self.impact
        order = np.argsort(-np.abs(impact), kind="stable")
        order = order[:np.count_nonzero(impact)]
        return order, impact[order], np.cumsum(self.sizes[order])


def members(index: Index, x: np.ndarray, query: np.ndarray, own: int, need: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows that are among the ``k`` best of the block with a score of ``need`` or more: rows, exact scores, postings read.

    ``x`` are the rows in the form exact scores are taken in; ``own`` is a row to leave out, or -1.
    """
    order, impact, reach = index.by_impact(query)
    total = int(reach[-1]) if len(reach) else 0
    acc = np.zeros(index.n)
    if own >= 0:
        acc[own] = -np.inf
    length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
    slack = length * index.lost * (1 + 1e-9) + 1
    asked = query.astype(x.dtype)
    done = 0
    for share in (0.0, *ROUNDS):
        upto = int(np.searchsorted(reach, share * total, side="right")) if share < 1 else len(order)
        if upto > done:
            some = order[done:upto]
            spans = [index.rows[a:z] for a, z in zip(index.starts[some].tolist(), index.ends[some].tolist())]
            acc += np.bincount(np.concatenate(spans), weights=np.repeat(impact[done:upto], index.sizes[some]), minlength=index.n)
            done = upto
            # A sure threshold: the exact scores of the best so far.
            if index.n > k:
                ahead = np.argpartition(acc, index.n - k)[index.n - k:]
                ahead = ahead[ahead != own]
                if len(ahead) == k:
                    need = max(need, float((x[ahead] @ asked).min()))
        # The most that a dimension's segments left can add: later ones are weaker, so the first left holds.
        left = np.zeros(index.dims)
        up = impact[done:] > 0
        left[index.dim[order[done:][up]][::-1]] = impact[done:][up][::-1]
        possible = np.flatnonzero(acc + slack + left.sum() * (1 + 1e-9) >= need)
        if done == len(order) or len(possible) <= POSSIBLE * index.n:
            break
    possible = possible[possible != own]
    scores = (x[possible] @ asked).astype(np.int64)
    enough = scores >= need
    possible, scores = possible[enough], scores[enough]
    stay = first_best(scores, k)
    return possible[stay], scores[stay], int(reach[done - 1]) if done else 0


class Search:
    def __init__(self, asked: Block, k: int):
        self.asked, self.best, self.k = asked, Best(len(asked), k), k
        self.most = int(np.abs(asked.x).max(initial=0))

    def feed(self, block: Block) -> None:
        index, x = Index(block.x), exact_form(block.x, self.most)
        where = np.argsort(block.place)
        at = np.searchsorted(block.place[where], self.asked.place)
        own = np.where((at < len(block)), where[np.minimum(at, len(block) - 1)], -1)
        own = np.where(block.place[own] == self.asked.place, own, -1)
        hits = [members(index, x, q, o, n, self.k)[:2] for q, o, n in zip(self.asked.x, own.tolist(), self.best.need.tolist())]
        lists = np.repeat(np.arange(len(hits)), [len(h[0]) for h in hits])
        self.best.add(lists, np.concatenate([h[1] for h in hits]), np.concatenate([h[0] for h in hits]), block.columns["key"])

    def answers(self) -> list:
        best = self.best
        at = pa.array(best.list)
        return [self.asked.columns["place"].take(at), self.asked.columns["key"].take(at),
                best.keys if best.keys is not None else self.asked.columns["key"].slice(0, 0), best.score]


def top_k(vectors: DataFrame, asks: Column, k: int = 5, scale: float = 256.0, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(query_id, rank, key, score)``: the ``k`` best rows by inner product for every row where ``asks`` holds."""
    folder = work_folder(vectors.sparkSession)
    rows = numbered(vectors, folder, scale, vector, key=F.col(f"`{key}`"), asks=F.coalesce(asks, F.lit(False)))
    kind = rows.schema["key"].dataType.simpleString()
    found = meet(rows.where("asks and key is not null").drop("asks"), rows.drop("asks"), lambda asked: Search(asked, k),
                 f"place long, query_id {kind}, key {kind}, score long", "key")
    order = Window.partitionBy("place").orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("key").alias(key), "score"))
