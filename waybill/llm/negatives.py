"""Hard negatives: for an anchor and one of its positives, the best rows of another label in a window of scores.

Rows gain one component, ``sqrt(M * M - |x| * |x|)``, so that all have length M and inner products with a query (whose
further component is 0) follow from distances. A cover tree stands over the distinct vectors of a block: a node's
children lie within its radius, each covers what lies within half of it, and no child's vector lies within another's
cover. From a node's own score and its covering radius follow bounds of the scores below it (triangle inequality and
Cauchy-Schwarz, whichever is tighter). An anchor descends best-first: of the open nodes those with the highest upper
bounds are opened next; nodes outside all of its windows, or below what every window already holds, are skipped. Every
vector reached is verified by its exact score, and equal vectors are one node with many rows.

Defined cases: rows with a null label or vector, or a null or non-finite component, take no part; only vectors of as many
dimensions meet; a component of ``vectors.LARGEST`` or more after scaling stops the job with a message; a null key is no
anchor, and comes last among equal scores; repeated rows and keys are rows of their own, a row being no positive of
itself; equal scores go to the smaller key; a positive score below 0 has an empty window; an anchor without positives, and
an empty table, give no rows; other columns play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.common import stage, work_folder
from waybill.llm.vectors import Best, Block, exact_form, meet, numbered

#: Open nodes taken at a time, and vectors that become children at a time.
BEAM = 64


class CoverTree:
    """Over the distinct rows of ``x``: nodes as arrays, children of a node side by side."""

    def __init__(self, x: np.ndarray, most: int):
        distinct, which = np.unique(x, axis=0, return_inverse=True)
        which = which.reshape(-1)
        #: Rows of every distinct vector, ascending.
        self.rows = np.argsort(which, kind="stable")
        self.starts = np.r_[0, np.cumsum(np.bincount(which, minlength=len(distinct)))]
        self.x = exact_form(distinct, most)
        square = (distinct.astype(np.float64) ** 2).sum(1)
        self.top = float(square.max())
        self.wide = np.hstack([distinct.astype(np.float64), np.sqrt(np.maximum(self.top - square, 0))[:, None]])
        self.slack = 1e-6 * np.sqrt(self.top) + 1e-9
        point, radius, first, last, fresh = [0], [0.0], [0], [0], [True]
        far = self._apart(np.array([0]), np.arange(1, len(distinct)))[0]
        queue = [(0, np.arange(1, len(distinct)), far)]
        for node, below, far in queue:  # grows as it goes
            if not len(below):
                continue
            radius[node], first[node] = float(far.max()) + self.slack, len(point)
            for p, own, d in self._children(point[node], below, far):
                queue.append((len(point), own, d))
                fresh.append(p != point[node])
                point.append(p)
                radius.append(0.0)
                first.append(0)
                last.append(0)
            last[node] = len(point)
        self.point, self.radius, self.first, self.last, self.fresh = map(np.array, (point, radius, first, last, fresh))

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.top - 2 * (self.wide[a] @ self.wide[b].T), 0))

    def _children(self, p: int, below: np.ndarray, far: np.ndarray):
        """Vectors that cover all of ``below`` within half the radius, each with what it covers: ``p`` itself first."""
        half = far.max() / 2
        near = far <= half
        if near.any():
            yield p, below[near], far[near]
        rest = below[~near]
        while len(rest):
            apart = self._apart(rest[:BEAM], rest)
            free = np.ones(len(rest), bool)
            for j, d in enumerate(apart):
                if free[j]:
                    free[j] = False
                    own = free & (d <= half)
                    free &= ~own
                    yield int(rest[j]), rest[own], d[own]
            rest = rest[free]

    def members(self, points: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of some distinct vectors, with the vectors' scores."""
        sizes = self.starts[points + 1] - self.starts[points]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) - np.repeat(ends - sizes - self.starts[points], sizes)
        return self.rows[at], np.repeat(scores, sizes)

    def bounds(self, nodes: np.ndarray, scores: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and most that a row below each node can score, whose own scores are given."""
        r, both = self.radius[nodes], length * length + self.top
        d = np.sqrt(np.maximum(both - 2 * scores, 0))
        least = np.maximum((both - (d + r) ** 2) / 2, scores - length * r)
        most = np.minimum((both - np.maximum(d - r, 0) ** 2) / 2, scores + length * r)
        give = 1e-6 * both + 1
        return least - give, most + give


class Windows:
    """The best ``k`` rows of one anchor in each of its windows, within one block."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, need: np.ndarray, k: int):
        self.lows, self.highs, self.need, self.k = lows, highs, need.astype(np.float64), k
        self.rows = [np.empty(0, np.int64)] * len(lows)
        self.scores = [np.empty(0, np.int64)] * len(lows)

    def open(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which ranges of scores may still hold a row that a window takes."""
        return ((100 * most >= self.lows[:, None]) & (100 * least <= self.highs[:, None]) & (most >= self.need[:, None])).any(0)

    def offer(self, tree: CoverTree, points: np.ndarray, scores: np.ndarray, fits: np.ndarray) -> None:
        hundred = 100 * scores
        for w in range(len(self.lows)):
            at = np.flatnonzero((hundred >= self.lows[w]) & (hundred <= self.highs[w]) & (scores >= self.need[w]))
            if not len(at):
                continue
            rows, score = tree.members(points[at], scores[at])
            stay = fits[rows]
            rows, score = np.r_[self.rows[w], rows[stay]], np.r_[self.scores[w], score[stay]]
            best = np.lexsort((rows, -score))[:self.k]
            self.rows[w], self.scores[w] = rows[best], score[best]
            if len(best) == self.k:
                self.need[w] = max(self.need[w], score[best[-1]])


def descend(tree: CoverTree, query: np.ndarray, windows: Windows, fits: np.ndarray) -> int:
    """Fill the windows with the rows for which ``fits`` holds, best-first; how many vectors were scored."""
    asked = query.astype(tree.x.dtype)
    length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
    scored = 0

    def reach(nodes):
        nonlocal scored
        scores = (tree.x[tree.point[nodes]] @ asked).astype(np.int64)
        new = tree.fresh[nodes]
        scored += int(new.sum())
        windows.offer(tree, tree.point[nodes[new]], scores[new], fits)
        inner = tree.last[nodes] > 0
        return (nodes[inner], *tree.bounds(nodes[inner], scores[inner], length))

    nodes, least, most = reach(np.array([0]))
    while len(nodes):
        stay = windows.open(least, most)
        nodes, least, most = nodes[stay], least[stay], most[stay]
        order = np.argsort(-most, kind="stable")
        now, later = order[:BEAM], order[BEAM:]
        if not len(now):
            break
        found = reach(np.concatenate([np.arange(a, z) for a, z in zip(tree.first[nodes[now]], tree.last[nodes[now]])]))
        nodes, least, most = (np.r_[a[later], b] for a, b in zip((nodes, least, most), found))
    return scored


class Search:
    """Anchors of a group: ``scores`` are those of their positives; without, the positives themselves are looked for."""

    def __init__(self, asked: Block, k: int, span: tuple[int, int] | None):
        import pyarrow.compute as pc

        self.asked, self.k, self.span = asked, k, span
        self.most = int(np.abs(asked.x).max(initial=0))
        scores = asked.columns["scores"].to_pylist() if span else [None] * len(asked)
        self.lows, self.highs = [], []
        for own in scores:
            p = np.array(own if span else [], np.int64)
            self.lows.append(p * span[0] if span else np.array([-np.inf]))
            self.highs.append(p * span[1] if span else np.array([np.inf]))
        self.sizes = np.array([len(x) for x in self.lows])
        self.base = np.cumsum(self.sizes) - self.sizes
        self.best = Best(int(self.sizes.sum()), k)
        self.labels = pc.unique(asked.columns["label"])
        self.label = pc.index_in(asked.columns["label"], self.labels).to_numpy(zero_copy_only=False)

    def feed(self, block: Block) -> None:
        import pyarrow.compute as pc

        tree = CoverTree(block.x, self.most)
        label = pc.fill_null(pc.index_in(block.columns["label"], self.labels), -1).to_numpy(zero_copy_only=False)
        hits = []
        for i, query in enumerate(self.asked.x):
            a, z = self.base[i], self.base[i] + self.sizes[i]
            own = Windows(self.lows[i], self.highs[i], self.best.need[a:z], self.k)
            fits = label != self.label[i] if self.span else (label == self.label[i]) & (block.place != self.asked.place[i])
            if z > a and fits.any():
                descend(tree, query, own, fits)
            hits += [(a + w, own.rows[w], own.scores[w]) for w in range(z - a)]
        some = [h for h in hits if len(h[1])]
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.best.add(np.repeat(np.array([h[0] for h in some], np.int64), [len(h[1]) for h in some]),
                      join([h[2] for h in some]), join([h[1] for h in some]), block.columns["key"])

    def answers(self) -> list:
        who = np.repeat(np.arange(len(self.asked)), self.sizes)[self.best.list]
        keys = self.best.keys if self.best.keys is not None else self.asked.columns["key"].slice(0, 0)
        return [self.asked.place[who], (self.best.list - self.base[who]).astype(np.int32) if len(who) else np.empty(0, np.int32),
                keys, self.best.score]


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column, positives: int = 5, k: int = 10, lowest: int = 30,
                   highest: int = 90, scale: float = 256.0, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows where ``anchors`` holds; positives their best rows of the same label; negatives the ``k`` best
    rows of other labels whose score is ``lowest`` to ``highest`` hundredths of the positive's.
    """
    folder = work_folder(vectors.sparkSession)
    rows = numbered(vectors.where(label.isNotNull()), folder, scale, vector, key=F.col(f"`{key}`"), label=label,
                    anchor=F.coalesce(anchors, F.lit(False)))
    kind = rows.schema["key"].dataType.simpleString()
    out = f"place long, n int, key {kind}, score long"
    asking = rows.where("anchor and key is not null").drop("anchor")
    plain = rows.drop("anchor")

    def best(found: DataFrame, most: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("key").asc_nulls_last())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    near = best(meet(asking, plain, lambda asked: Search(asked, positives, None), out, "key"), positives, "place")
    near = stage(near.select("place", (F.col("rank") - 1).cast("int").alias("n"), F.col("key").alias("positive_id"),
                             F.col("score").alias("positive_score")), folder, "positives")
    scores = (near.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("n", "positive_score"))).alias("p"))
              .select("place", F.col("p.positive_score").alias("scores")))
    far = meet(asking.join(scores, "place"), plain.withColumn("scores", F.lit(None).cast("array<bigint>")),
               lambda asked: Search(asked, k, (lowest, highest)), out, "key")
    named = asking.select("place", F.col("key").alias("anchor_id"))
    return (best(far, k, "place", "n").join(near, ["place", "n"]).join(named, "place")
            .select("anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
