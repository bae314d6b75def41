"""Quality rules as a learned decision list.

Counts of each text come from DataFrame functions. On labelled documents, sequential covering grows one conjunction of
thresholds after the other (each condition the one of highest information gain), prunes it on labelled rows it was not
grown on, keeps it only if it is right often enough there, and goes on with the rows it leaves. The list becomes one
ordered conditional expression over the counts.

Defined cases: a null, empty or wordless text has no words and fails the base; ids without label are judged like all
others; several labels of an id count by their mean (a tie is bad); without labels, or with labels of one kind, the list
is empty and the base alone decides; repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import least_hashes, stage, unit, words, work_folder

#: Labelled rows the list is learned from, at most: those of least hash. Quantiles for cut points, conditions per rule, rules.
SAMPLE, CUTS, CONDITIONS, RULES = 20_000, 48, 4, 24
#: Share of rows a rule must be right about, and rows it must cover, among rows kept for pruning.
RIGHT, COVER = 0.9, 3
WINDOW, FEWEST, REPEATS = 8, 20, 30

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What thresholds are set on.
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / n_words",
    "symbols": "n_symbols / n_words",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "capitals": "n_capitals / word_chars",
    "marks": "n_marks / n_words",
    "words_per_line": "n_words / n_lines",
}


def counts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks)``, all long.

    A text stays one row: its windows are hashed in place, and only a text with a repeated hash sorts them by hash to
    find the starts of repeated windows and the words they cover.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    cut = docs.select(F.col(key).alias("id"), words(F.col(text)).alias("w"),
                      F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
                      F.regexp_count(t, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
                      F.regexp_count(t, F.lit(r"\p{Lu}")).alias("n_capitals"),
                      F.regexp_count(t, F.lit("[!?]")).alias("n_marks"))
    starts = F.expr(f"sequence(1, size(w) - {WINDOW - 1})")
    hashed = cut.select(
        "id", F.size("w").alias("n_words"), F.char_length(F.array_join("w", "")).alias("word_chars"), "n_symbols",
        "n_capitals", "n_marks", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("w", i, WINDOW)))).alias("h"))
    numbered = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    ordered = hashed.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), numbered)).drop("h")
    again = F.filter("s", lambda e, k: (e["h"] == F.get("s", k - 1)["h"]) | (e["h"] == F.get("s", k + 1)["h"]))
    at = F.sort_array(F.transform(again, lambda e: e["i"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, zero, lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    out = ordered.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return out.select(F.col("id").alias(key), *[F.col(c).cast("long").alias(c) for c in (
        *COUNTS, "n_lines", "n_capitals", "n_marks")])


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATS * F.col("n_words"))


def feature(name: str) -> Column:
    """A feature as double; a ratio of nothing is 0."""
    over, _, under = FEATURES[name].partition(" / ")
    value = F.col(over).cast("double")
    return value if not under else F.when(F.col(under) > 0, value / F.col(under)).otherwise(0.0)


def _covers(x: np.ndarray, rule: list[tuple[int, bool, float]]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for f, above, cut in rule:
        hit &= (x[:, f] >= cut) == above
    return hit


def _cuts(values: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Cut points between neighbouring values, around quantiles of all rows, of good and of bad ones, ends included."""
    seen, at = np.unique(values), np.linspace(0, 1, CUTS)
    near = np.concatenate([np.quantile(part, at, method="nearest") for part in (values, values[bad], values[~bad]) if len(part)])
    k = np.searchsorted(seen, np.unique(near))
    k = np.unique(np.r_[k, k + 1])
    k = k[(k > 0) & (k < len(seen))]
    return (seen[k - 1] + seen[k]) / 2


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, bool, float]]:
    """Add the condition of highest gain (bad rows kept times the rise of their log share) until no good row is covered."""
    rule, inside = [], np.ones(len(x), bool)
    cuts = [_cuts(x[:, f], bad) for f in range(x.shape[1])]
    while len(rule) < CONDITIONS and (~bad[inside]).any():
        p, n = bad[inside].sum(), inside.sum()
        best = (1e-9, None)
        for f, points in enumerate(cuts):
            place = np.searchsorted(points, x[inside, f], "right")  # how many cuts are at or below the value
            bads = np.bincount(place[bad[inside]], minlength=len(points) + 1)
            alls = np.bincount(place, minlength=len(points) + 1)
            for above in (True, False):
                pk = bads[::-1].cumsum()[::-1][1:] if above else bads.cumsum()[:-1]
                nk = alls[::-1].cumsum()[::-1][1:] if above else alls.cumsum()[:-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pk > 0, pk * (np.log2(pk / np.maximum(nk, 1)) - np.log2(p / n)), 0)
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (float(gain[k]), (f, above, float(points[k])))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers(x, [best[1]])
    return rule


def _prune(rule: list, x: np.ndarray, bad: np.ndarray) -> list:
    """The leading conditions that are worth most on rows the rule was not grown on."""
    def worth(r):
        hit = _covers(x, r)
        return (bad[hit].sum() - (~bad[hit]).sum()) / max(hit.sum(), 1)

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))


def learn(x: np.ndarray, bad: np.ndarray, kept_out: np.ndarray) -> list[list[tuple[int, bool, float]]]:
    """Rules in order. ``kept_out`` marks the rows that prune and judge.

    A rule that is not right often enough is left out, and the rows it covers are set aside for the rest of the learning.
    """
    rules, left = [], np.ones(len(x), bool)
    for _ in range(RULES):
        if not bad[left & ~kept_out].any():
            break
        grown = _grow(x[left & ~kept_out], bad[left & ~kept_out])
        if not grown:
            break
        rule = _prune(grown, x[left & kept_out], bad[left & kept_out])
        judged = left & kept_out & _covers(x, rule)
        if judged.sum() >= COVER and bad[judged].mean() >= RIGHT:
            rules.append(rule)
        left &= ~_covers(x, rule)
    return rules


def as_expression(rules: list) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    names, out = list(FEATURES), None
    for k, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for f, above, cut in rule:
            holds = holds & ((feature(names[f]) >= cut) if above else (feature(names[f]) < cut))
        out = F.when(holds, k) if out is None else out.when(holds, k)
    return F.lit(0) if out is None else out.otherwise(0)


def as_text(rules: list) -> list[str]:
    names = list(FEATURES)
    return [" and ".join(f"{names[f]} {'>=' if above else '<'} {cut:.6g}" for f, above, cut in rule) for rule in rules]


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id") -> list:
    """Learn the list from labelled rows of ``counts``, at most ``SAMPLE`` of them, those of least hash.

    Rows that are equal in id, label and counts share a hash: they are taken or left together.
    """
    good = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.avg(label).alias("good"))
    rows = (stats.join(good, F.col(key) == F.col("k")).where(~base_failed())
            .select(*[feature(n).alias(n) for n in FEATURES], "good", unit(F.col(key).cast("string"), *map(F.col, COUNTS), F.lit(4)).alias("u")))
    rows = sorted(rows.where(F.col("u") <= least_hashes(rows, "u", SAMPLE)).collect(), key=lambda r: (r.u, *r[:-1]))
    x = np.array([[r[n] for n in FEATURES] for r in rows], float).reshape(len(rows), len(FEATURES))
    bad = np.array([r.good <= 0.5 for r in rows], bool)
    return learn(x, bad, np.array([int(r.u * 1e9) % 3 == 0 for r in rows], bool))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts, ``base_failed``, the number of the ``rule`` that rejects (0: none) and ``kept``, per document."""
    stats = stage(counts(docs, text, key), work_folder(docs.sparkSession), "counts")
    rule = as_expression(fit(stats, labels, key=key))
    return stats.select(key, *COUNTS, base_failed().alias("base_failed"), rule.alias("rule")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))
