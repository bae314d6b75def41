"""Toxicity by a classifier chain.

Categories are predicted one after the other by sparse linear models over words, told apart by 64-bit hashes; each also
sees the probabilities of the categories before it. Every stretch of a text is judged, and the text is as toxic as its
worst stretch: evidence does not add up over a long text, and is not thinned by it. While training, those are out-of-fold: the probability of a row comes from a
model that was not fitted on it, as it will at prediction. The models are fitted on a bounded sample of labelled rows.

The given labels hold one flag, so the chain of ``report`` is two degrees of it, ``repeated`` and ``dense`` toxicity, told by
how often words occur that mark toxic rows of the sample, and then the flag, which sees both and gives the verdict.

Defined cases: null, empty and wordless texts have no words and are judged by the biases alone; several labels of an id
count by their mean (a tie is toxic); labels without a document are passed over; with no labels, or labels of one kind,
nothing is toxic; rows that share an id share its label, and the sample is one of rows, not of ids; repeated rows are judged
alike and enter the sample once; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.common import bounded, stage, unit, work_folder
from waybill.llm.langid import Leader, sample

#: Labelled rows the models are fitted on (at most), folds, rounds, and the penalties.
SAMPLE, FOLDS, ROUNDS = 4000, 5, 2
ALPHA, L1, L2 = 0.3, 0.1, 1e-2
#: Standard errors by which a word's log rate ratio must be beyond 0.
CHANCE = 2.0
#: Words of half a stretch; each two neighbouring halves are judged together.
HALF = 128
#: Lengths (in bytes) of word beginnings that count beside whole words.
BEGINNINGS = (4, 5, 6)
#: A marker is a word in this share of the toxic rows at least, and this many times more often there than elsewhere.
MARKER_SHARE, MARKER_RATE = 0.01, 10
#: Markers per text from which toxicity is repeated, and per word from which it is dense.
REPEATED, DENSE = 3, 0.01
CATEGORIES = ("repeated", "dense", "toxic")
#: Words (of so many bytes at most) whose places a worker remembers.
REMEMBER, LONG = 400_000, 64
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def parts(word: bytes) -> list[bytes]:
    """A word and its beginnings; the sign after a beginning is in no word."""
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]


def hashed(names) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(x, digest_size=8).digest() for x in names]), "<u8")


def features(words: list[bytes]) -> list[np.ndarray]:
    """The distinct hashed words and word beginnings of each half stretch, in order."""
    names = {x: k for k, x in enumerate({x for w in set(words) for x in parts(w)})}
    codes, of = hashed(names), {w: [names[x] for x in parts(w)] for w in set(words)}
    return [np.unique(codes[[k for w in set(words[i:i + HALF]) for k in of[w]]]) for i in range(0, len(words), HALF)]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def stretches(halves: list) -> list[list]:
    """Neighbouring halves of a text, two by two; a text of one half or less is one stretch."""
    return [halves[i:i + 2] for i in range(max(len(halves) - 1, 1))]


class Link:
    """One category's linear model over words and the probabilities of earlier categories.

    A word enters with the part of its log rate ratio between the two kinds of rows that is beyond chance, if it is more
    often in rows of the category, so the thousands of words of a long text that tell nothing enter with 0. Rates count
    rows; weights are learned from the stretch of each row that tells most, as it is the one that is judged.
    """

    def __init__(self, words: np.ndarray, before: np.ndarray, bias: float):
        self.words, self.before, self.bias = words, before, bias

    @classmethod
    def fitted(cls, rows: list[list[np.ndarray]], before: np.ndarray, labels: np.ndarray, dims: int) -> Link:
        labels = np.asarray(labels, bool)
        whole = [np.unique(np.concatenate([*r, np.empty(0, np.int64)])) for r in rows]
        seen = [np.bincount(np.concatenate([r for r, y in zip(whole, labels) if y == k] + [np.empty(0, np.int64)]),
                            minlength=dims) + 0.5 for k in (False, True)]
        ratio = np.log(seen[1] / (labels.sum() + 1)) - np.log(seen[0] / ((~labels).sum() + 1))
        chance = CHANCE * np.sqrt(1 / seen[0] + 1 / seen[1])
        value = np.maximum(ratio - chance, 0)
        leader = Leader(dims + before.shape[1], 2, ALPHA, L1, L2)
        places = dims + np.arange(before.shape[1])
        told = [max(cls._told(r, value), key=lambda w: value[w].sum()) for r in rows]
        for _ in range(ROUNDS):
            for words, p, y in zip(told, before, labels):
                leader.learn(np.concatenate([words, places]), np.concatenate([value[words], p]), int(y))
        w = leader.weights(np.arange(len(leader.z)))
        w = w[:, 1] - w[:, 0]
        return cls(w[:dims] * value, w[dims:-1], w[-1])

    @staticmethod
    def _told(halves: list[np.ndarray], value: np.ndarray) -> list[np.ndarray]:
        """The words of each stretch that have a value."""
        halves = [h[value[h] != 0] for h in halves] or [np.empty(0, np.int64)]
        return [np.unique(np.concatenate(s)) if len(s) > 1 else s[0] for s in stretches(halves)]

    def probability(self, halves: list[np.ndarray], before: list[float]) -> float:
        """That of the stretch with the most evidence."""
        most = max(self.words[s].sum() for s in self._told(halves, self.words))
        return float(sigmoid(most + np.dot(self.before, before) + self.bias))


class Sample:
    """Rows to learn from, given by the hashes of each half stretch, or by one array if they are no longer than that."""

    def __init__(self, rows: list, folds: np.ndarray):
        rows = [[r] if isinstance(r, np.ndarray) else r for r in rows]
        self.names = np.unique(np.concatenate([h for r in rows for h in r] + [np.empty(0, np.uint64)]).astype(np.uint64))
        self.rows = [[np.searchsorted(self.names, h.astype(np.uint64)) for h in r] for r in rows]
        self.folds = folds

    def fold(self, before: np.ndarray, labels: np.ndarray, fold: int) -> tuple:
        """One link fitted on all rows but a fold's: its weights other than 0 with their places, those of the links before,
        its bias, and the probabilities of the rows kept out. Fold ``FOLDS`` holds no rows."""
        fit, rest = np.flatnonzero(self.folds != fold), np.flatnonzero(self.folds == fold)
        link = Link.fitted([self.rows[i] for i in fit], before[fit], labels[fit], len(self.names))
        at = np.flatnonzero(link.words)
        return at, link.words[at], link.before, link.bias, [link.probability(self.rows[i], before[i]) for i in rest]


Fits = Callable[[np.ndarray, np.ndarray], list[tuple]]


def in_tasks(spark: SparkSession, given: Sample) -> Fits:
    """Fit a link on all folds at once, a task each; the bounded sample is broadcast once, and weights come back."""
    shared = spark.sparkContext.broadcast(given)

    def fits(before: np.ndarray, labels: np.ndarray) -> list[tuple]:
        def run(batches):
            for batch in batches:
                folds = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                    [pickle.dumps(shared.value.fold(before, labels, f)) for f in folds], pa.binary())], ["fold", "found"])

        found = spark.range(0, FOLDS + 1, 1, FOLDS + 1).mapInArrow(run, "fold long, found binary").collect()
        return [pickle.loads(r.found) for r in sorted(found)]

    return fits


class Chain:
    """The links in order, and the probability of the last category from which a text is rejected.

    Links are fitted one after the other, the folds of each side by side where ``fits`` says how. Of the sample's words
    only those with a weight are kept.
    """

    def __init__(self, rows: list | Sample, labels: np.ndarray, folds: np.ndarray, weights: np.ndarray, fits: Fits | None = None):
        given = rows if isinstance(rows, Sample) else Sample(rows, folds)
        fits = fits or (lambda *link: [given.fold(*link, f) for f in range(FOLDS + 1)])
        found, before = [], np.zeros((len(folds), 0))
        for k in range(labels.shape[1]):
            y = labels[:, k]
            out = np.zeros(len(folds))
            *kept_out, whole = fits(before, y)
            for f, link in enumerate(kept_out):
                out[folds == f] = link[-1]
            found.append(whole)
            before = np.column_stack([before, out])
        self.threshold = cut(out, y, weights)
        kept = np.unique(np.concatenate([at for at, *_ in found]))
        self.links = []
        for at, w, earlier, bias, _ in found:
            words = np.zeros(len(kept))
            words[np.searchsorted(kept, at)] = w
            self.links.append(Link(words, earlier, bias))
        self.places = {name: k for k, name in enumerate(given.names[kept].tolist())}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def _places(self, word: bytes) -> tuple[int, ...]:
        found = tuple(self.places[h] for h in hashed(parts(word)).tolist() if h in self.places)
        if len(word) <= LONG:
            if len(self.known) >= REMEMBER:
                self.known.clear()
            self.known[word] = found
        return found

    def probabilities(self, text: str | None) -> list[float]:
        words, known, out = word_list(text), self.known, []
        told = {w: p for w in set(words) if (p := known[w] if w in known else self._places(w))}
        halves = [np.array(sorted({k for w in words[i:i + HALF] if w in told for k in told[w]}), np.int64)
                  for i in range(0, len(words), HALF)]
        for link in self.links:
            out.append(link.probability(halves, out))
        return out


def cut(p: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    """The threshold of fewest weighted errors; of several such, the middle of the widest gap in log-odds."""
    odds = np.log(np.clip(p, 1e-12, 1 - 1e-12) / np.clip(1 - p, 1e-12, 1))
    order = np.argsort(odds, kind="stable")
    odds, y, weights = odds[order], y[order].astype(bool), weights[order]
    missed = np.r_[0, np.cumsum(np.where(y, weights, 0))]
    wrong = np.where(~y, weights, 0).sum() - np.r_[0, np.cumsum(np.where(~y, weights, 0))]
    errors = missed + wrong
    edges = np.r_[odds[0] - 1, odds, odds[-1] + 1]
    best = np.flatnonzero(errors <= errors.min() + 1e-9)
    k = best[np.argmax(edges[best + 1] - edges[best])]
    return float(sigmoid((edges[k] + edges[k + 1]) / 2))


def counted(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed words, and how often each occurs."""
    codes, counts = np.unique(hashed(words), return_counts=True)
    return codes, counts


def degrees(rows: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray) -> np.ndarray:
    """Labels of the chain: whether markers of toxicity are repeated and dense, and toxic. Rows are counted words."""
    names = np.unique(np.concatenate([codes for codes, _ in rows] + [np.empty(0, np.uint64)]))
    at = [np.searchsorted(names, codes) for codes, _ in rows]
    n = [np.bincount(np.concatenate([x for x, y in zip(at, toxic) if y == k] + [np.empty(0, np.int64)]),
                     minlength=len(names)) for k in (False, True)]
    yes, no = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    marker = (n[1] >= max(3, MARKER_SHARE * yes)) & (n[1] / yes >= MARKER_RATE * n[0] / no)
    marked = np.array([counts[marker[x]].sum() for x, (_, counts) in zip(at, rows)])
    total = np.array([max(counts.sum(), 1) for _, counts in rows])
    return np.column_stack([toxic & (marked >= REPEATED), toxic & (marked >= DENSE * total), toxic])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", text: str = "text", key: str = "doc_id") -> Chain | None:
    """Fit the chain on at most ``SAMPLE`` labelled rows, shared equally by the two labels; None without both.

    The sample is drawn by hashes of id and text, so an id that stands on many rows counts as often; what comes to the
    driver are hashes of the sample's words. Texts are not shuffled.
    """
    spark = docs.sparkSession
    bounded(spark)
    votes = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k"))
             .agg((F.avg(F.col(label).cast("double")) >= 0.5).alias("y")))
    u = unit(F.col(key).cast("string"), F.col(text), F.lit(9))
    hashes = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), u.alias("u")).distinct()
    known = stage(hashes.join(votes, "k").select("y", "u"), work_folder(spark), "labelled")
    sizes = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return None
    chosen = {r.u: r.y for r in sample(known, "y", SAMPLE, []).collect()}
    picked = (docs.where(u.isin(list(chosen))).select(u.alias("u"), F.col(text).alias("t"))
              .mapInArrow(_packed, "u double, halves array<binary>, codes binary, counts binary").dropDuplicates(["u"]).collect())
    picked.sort(key=lambda r: r.u)
    toxic = np.array([chosen[r.u] for r in picked], bool)
    weights = np.array([sizes[bool(y)] / (toxic == y).sum() for y in toxic])
    counts = [(np.frombuffer(r.codes, "<u8"), np.frombuffer(r.counts, "<i8")) for r in picked]
    given = Sample([[np.frombuffer(h, "<u8") for h in r.halves] for r in picked], np.arange(len(picked)) % FOLDS)
    return Chain(given, degrees(counts, toxic), given.folds, weights, in_tasks(spark, given))


def _packed(batches):
    for batch in batches:
        rows = [word_list(t) for t in batch.column(1).to_pylist()]
        told = [counted(w) for w in rows]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([[h.tobytes() for h in features(w)] for w in rows], pa.list_(pa.binary())),
            pa.array([c.astype("<u8").tobytes() for c, _ in told], pa.binary()),
            pa.array([n.astype("<i8").tobytes() for _, n in told], pa.binary())], ["u", "halves", "codes", "counts"])


def probabilities(chain: Chain | None, docs: DataFrame) -> Column:
    """Probabilities of the categories as a function of a text column, and whether the text is rejected."""
    bounded(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # weights of the few words that tell something
    shape = T.StructType([*(T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES), T.StructField("toxic", T.BooleanType())])

    @F.pandas_udf(shape)
    def judge(texts):
        import pandas as pd

        model = shared.value
        p = [model.probabilities(t) if model else [0.0] * len(CATEGORIES) for t in texts.tolist()]
        out = pd.DataFrame(p, columns=[f"p_{c}" for c in CATEGORIES], dtype=float)
        return out.assign(toxic=out.p_toxic >= model.threshold if model else False)

    return judge


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic, score, p_repeated, p_dense)`` of every document."""
    judge = probabilities(fit(docs, labels), docs)
    return docs.select("doc_id", judge(F.col("text")).alias("j")).select(
        "doc_id", "j.toxic", F.col("j.p_toxic").alias("score"), "j.p_repeated", "j.p_dense")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    judge = probabilities(fit(docs, labels), docs)
    return docs.where(~judge(F.col("text"))["toxic"])
