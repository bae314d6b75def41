"""Language identification: sparse multinomial regression on TF-IDF of character n-grams.

Whole texts are cut into hashed character n-grams. Document frequencies count all training texts; the weights are fitted
by follow-the-regularised-leader with L1 and L2 penalties on a bounded sample of them, and a temperature fitted on the part
of the sample kept out makes the probabilities calibrated.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text when nothing could be
learned; rows without id are neither held out nor learned from; rows without language are not learned from; repeated rows
enter the sample once; of languages equally probable the first by name wins; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import bounded, least_hashes_by, remainder, unit

#: Hashed n-grams (a power of two), and lengths of n-grams.
BITS, ORDERS = 16, (1, 2, 3)
#: Rows the weights are fitted on, at most, shared equally by the languages; rounds; one row in so many calibrates.
SAMPLE, ROUNDS, CALIBRATE = 4000, 3, 5
#: Learning rate, its offset, and the penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """The hashed n-grams at all places of a text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    out = []
    for n in ORDERS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(n):
                h = (h ^ codes[k:len(codes) - n + 1 + k]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            out.append(h >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and how often each occurs."""
    found = grams(text or "")
    if len(found) < 1 << BITS - 4:
        return np.unique(found, return_counts=True)
    counts = np.bincount(found, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at.astype(np.uint32), counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1, with damped frequencies."""
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt(x @ x), 1e-12)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader for several classes; feature ``dims`` is the bias, which no penalty holds."""

    def __init__(self, dims: int, classes: int, alpha: float = ALPHA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros((dims + 1, classes)), np.zeros((dims + 1, classes))
        self.alpha, self.l1, self.l2 = alpha, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0
        w[-1] = -self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / self.alpha)
        return w

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at.astype(np.int64), len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = np.outer(x, p)
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(softmax(scores / np.exp(t))[np.arange(len(labels)), labels], 1e-300)).mean()

    lo, hi, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


class Model:
    """Languages, weights (n-grams and bias, by language), inverse document frequencies and temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, idf: np.ndarray, heat: float):
        self.languages, self.weights, self.idf, self.heat = languages, weights, idf, heat

    def scores(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(at, counts, self.idf) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.scores(*counted(text)) / self.heat)
        k = int(p.argmax())
        return self.languages[k], float(p[k])


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many texts of column ``t`` hold each n-gram, and how many texts there are. One row per n-gram is collected."""

    def count(batches):
        found, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found[counted(t)[0]] += 1
                n += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], n))], ["gram", "n"])

    out, total = np.zeros(1 << BITS, np.int64), 0
    for gram, n in texts.select("t").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect():
        if gram < 0:
            total = n
        else:
            out[gram] = n
    return out, total


def sample(rows: DataFrame, label: str, size: int, columns: list[str]) -> DataFrame:
    """At most ``size`` distinct rows shared equally by the labels: those of least hash ``u`` of each label.

    Only labels and hashes are shuffled, and no label's rows meet in one task: hashes are counted by steps of their height,
    and rows picked by the step that ends each label's share.
    """
    least = least_hashes_by(rows.select(label, "u").distinct(), label, "u", size)
    if not least:
        return rows.where("false").select(label, "u", *columns)
    most = F.create_map(*[F.lit(v) for pair in least.items() for v in pair])
    return rows.where(F.col("u") <= F.element_at(most, F.col(label))).select(label, "u", *columns)


def fit(docs: DataFrame, learnable: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    bounded(docs.sparkSession)
    rows = docs.where(learnable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("t"), F.col(lang).cast("string").alias("lang"),
        unit(F.col(key).cast("string"), F.col(text), F.lit(3)).alias("u"))
    found, total = frequencies(rows)
    idf = np.log((1 + total) / (1 + found)) + 1

    def vectors(batches):
        for batch in batches:
            parts = [counted(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [a.astype("<u4").tobytes() + c.astype("<u4").tobytes() for a, c in parts], pa.binary())], ["lang", "u", "v"])

    picked = (sample(rows, "lang", SAMPLE, ["t"]).mapInArrow(vectors, "lang string, u double, v binary")
              .dropDuplicates(["lang", "u"]).collect())
    picked.sort(key=lambda r: (r.u, r.lang))
    languages = sorted({r.lang for r in picked})
    halves = [np.frombuffer(r.v, "<u4").reshape(2, -1) for r in picked]
    x = [(at, weighted(at, c, idf)) for at, c in halves]
    y = np.array([languages.index(r.lang) for r in picked], np.int64)
    held = np.arange(len(x)) % CALIBRATE == CALIBRATE - 1
    leader = Leader(1 << BITS, max(len(languages), 1))
    for _ in range(ROUNDS):
        for k in np.flatnonzero(~held).tolist():
            leader.learn(*x[k], y[k])
    weights = leader.weights(np.arange(len(leader.z))).astype(np.float32)
    model = Model(languages, weights, idf, 1.0)
    scores = [model.scores(*halves[k]) for k in np.flatnonzero(held)]
    model.heat = temperature(np.array(scores).reshape(len(scores), len(languages)), y[held])
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, lang_pred, score)`` of every row, from its text alone."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many weights as n-grams times languages

    def run(batches):
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], ["id", "lang_pred", "score"])

    return (docs.select(F.col(key).alias("id"), F.col(text).alias("t"))
            .mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", key))


def report(docs: DataFrame, of: int = 4, fold: int = 2) -> DataFrame:
    """Predictions for all documents, learned from those outside one fold of their ids."""
    fold_of = remainder(F.col("doc_id"), of)
    model = fit(docs, fold_of != fold)
    return identify(docs, model).select("doc_id", F.coalesce(fold_of == fold, F.lit(False)).alias("held_out"),
                                        "lang_pred", "score")
