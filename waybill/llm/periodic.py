"""Periodic runs of words, found by minimizers at several scales.

A run is a longest stretch of words that repeats with smallest period q and holds at least ``least`` words and ``times``
(three or more) whole periods. Periods up to ``SHORT`` are looked for by lag: words q apart are compared at places so
close together that no run falls between them. Longer periods fall into scales: scale (low, high] hashes every stretch
of ``high`` words, and keeps a stretch whose hash is least in some window of ``2 * low + 3 - high`` stretches. Within a
run of a period of this scale, a window and the one a period later both lie inside it and keep the same stretch, and
stretches of ``high`` words are equal only at whole periods; so two neighbouring kept stretches of one hash lie exactly
one period apart. Such a pair is a seed. Every seed is grown on the words themselves, so a hash only ever proposes, and
a stretch found at several periods counts at its smallest.

All texts of an Arrow batch stand in one sequence with a word of its own between any two, which no run can cross. Words
are numbered by exact comparison.

Defined cases: a null, empty or blank text has no words and no run; repeated rows and repeated ids are rows of their own;
a null key stays null; an empty table gives no rows; other columns of the table play no part, whatever their names. One
text is worked on whole by one task, in memory of some 60 bytes a word.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import bounded

#: Periods up to this one are looked for by lag.
SHORT = 16
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xD6E8FEB86659FD93)


def words_of(texts: pa.Array) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of a batch of texts, and how many each text has: cut at the six white-space bytes, no copy per word."""
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    ends = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends.astype(np.int64) - ends[0]
    solid = (data != 32) & ((data < 9) | (data > 13))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    if len(data):
        inner = ends[1:-1][ends[1:-1] < len(data)]
        first[inner] = solid[inner]  # a text begins a word of its own
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, ends))
    place = np.cumsum(solid) - solid
    offsets = np.append(place[starts], solid.sum()).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]), counts


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some window of ``width`` neighbours that holds them; equal hashes all count."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    low = _least(hashes, width)
    # The largest of the minima of the windows that hold a place; windows past either end do not exist.
    edge = np.zeros(width - 1, hashes.dtype)
    top = ~_least(~np.concatenate([edge, low, edge]), width)
    return np.flatnonzero(top == hashes)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * MIX + b
    x = (x ^ (x >> np.uint64(32))) * MIX2
    return x ^ (x >> np.uint64(31))


def scales(longest: int):
    """``(low, high, window)`` of the scales for periods above ``SHORT`` up to ``longest``, rising by a third."""
    low = SHORT
    while low < longest:
        high = max(low + 1, 4 * low // 3)
        yield low, high, 2 * low + 3 - high
        low = high


def _grown(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` in which words equal those ``lag`` later: first place and end."""
    def reach(x, y, end):
        done, step = 0, 64
        while done < end:
            size = min(step, end - done)
            apart = x(done, size) != y(done, size)
            k = int(apart.argmax())
            if apart[k]:
                return done + k
            done, step = done + size, step * 4
        return end

    ahead = reach(lambda d, s: codes[at + d:at + d + s], lambda d, s: codes[at + lag + d:at + lag + d + s], len(codes) - at - lag)
    behind = reach(lambda d, s: codes[at - d - s:at - d][::-1], lambda d, s: codes[at + lag - d - s:at + lag - d][::-1], at)
    return at - behind, at + ahead


def find_runs(codes: np.ndarray, counts: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of the runs of texts that follow each other, none across two texts; sorted.

    ``codes`` numbers the words from 0; equal words have equal numbers.
    """
    if times < 3:
        raise ValueError("minimizers find runs of three periods and more")
    found: dict[tuple[int, int], int] = {}
    # A word of its own after every text.
    base = np.cumsum(counts) - counts
    where = np.arange(len(codes)) + np.repeat(np.arange(len(counts)), counts)
    line = np.empty(len(codes) + len(counts), np.int64)
    line[where] = codes
    line[np.cumsum(counts + 1) - 1] = -1 - np.arange(len(counts))

    def grow(seq, places, back, lag):
        """Grow the seeds of one lag, in order of place; ``back`` gives a place of the whole line."""
        done = -1
        for at in places:
            if at < done:
                continue
            start, done = _grown(seq, at, lag)
            if done - start + lag >= max(least, times * lag):
                span = (back(start), back(start) + done - start + lag)
                found[span] = min(lag, found.get(span, lag))

    for lag in range(1, SHORT + 1):
        if len(line) <= lag:
            break
        # Equal words follow each other this often at least; two probes in a row fall into them.
        step = max(least - lag, (times - 1) * lag) // 2
        probes = np.arange(0, len(line) - lag, step)
        same = line[probes] == line[probes + lag]
        if step > 1:
            same[:-1] &= same[1:]
            same[-1:] = False
        grow(line, probes[same].tolist(), lambda p: p, lag)
    keep, origin, level, hashes = np.ones(len(counts), bool), None, 0, None
    seq = line
    for low, high, window in scales(int(counts.max(initial=0)) // times):
        stay = counts >= max(least, times * (low + 1))
        if origin is None or (counts[stay] + 1).sum() < 0.7 * len(seq):  # texts too short for this scale go
            keep = stay
            origin = np.flatnonzero(np.repeat(keep, counts + 1))
            seq = line[origin]
            level, hashes = 1, _joined(seq.view(np.uint64), MIX)
        while 2 * level <= high:
            hashes = _joined(hashes[:-level], hashes[level:])
            level *= 2
        if len(seq) < times * high // 2 or len(hashes) <= high - level:
            continue
        grams = _joined(hashes[:len(hashes) - (high - level)], hashes[high - level:]) if high > level else hashes
        places = minimizers(grams, window)
        order = places[np.argsort(grams[places], kind="stable")]
        apart = np.diff(order)
        pair = (grams[order[1:]] == grams[order[:-1]]) & (apart > low) & (apart <= high)
        seeds, lags = order[:-1][pair], apart[pair]
        by = np.lexsort((seeds, lags))
        seeds, lags = seeds[by], lags[by]
        cuts = np.flatnonzero(np.diff(lags)) + 1
        for some, lag in zip(np.split(seeds, cuts), lags[np.r_[0, cuts]] if len(lags) else ()):
            grow(seq, some.tolist(), lambda p: int(origin[p]), int(lag))
    text = np.repeat(np.arange(len(counts)), counts + 1)
    return sorted((s - int(text[s]), e - int(text[s]), q) for (s, e), q in found.items())


def _reports(texts: pa.Array, least: int, times: int):
    """For every text: words, runs as (start, length, period), kept words joined by a space."""
    flat, counts = words_of(texts)
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    runs = find_runs(codes, counts, least, times)
    stay = np.ones(len(codes), bool)
    for start, end, period in runs:
        stay[start + period:end] = False
    sizes = np.diff(np.frombuffer(flat.buffers()[1], np.int32, len(flat) + 1)).astype(np.int64) + 1
    spaced = np.full(int(sizes.sum()), 32, np.uint8)
    solid = np.ones(len(spaced), bool)
    solid[np.cumsum(sizes) - 1] = False
    spaced[solid] = np.frombuffer(flat.buffers()[2] or b"", np.uint8)
    kept = spaced[np.repeat(stay, sizes)].tobytes()
    edges = np.r_[0, np.cumsum(sizes * stay)]
    ends = np.cumsum(counts)
    at = 0
    for end, n in zip(ends.tolist(), counts.tolist()):
        own = []
        while at < len(runs) and runs[at][0] < end:
            s, e, q = runs[at]
            own.append((s - (end - n), e - s, q))
            at += 1
        yield n, own, kept[edges[end - n]:max(edges[end - n], edges[end] - 1)]


def runs(docs: DataFrame, least: int = 24, times: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_words, runs, collapsed)`` of every row: the runs by start and period, and the words without repeats.

    A word is left out of ``collapsed`` if a run holds it after that run's first period.
    """
    kind = docs.schema[key].dataType.simpleString()
    bounded(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out = [(n, [dict(zip(("start", "length", "period"), r)) for r in own], kept.decode(errors="replace"))
                   for n, own, kept in _reports(batch.column(1), least, times)]
            n, own, kept = zip(*out) if out else ((), (), ())
            parts = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(own, parts), pa.array(kept, pa.string())],
                                             ["key", "n_words", "runs", "collapsed"])

    return (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t"))
            .mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
            .withColumnRenamed("key", key))


def report(docs: DataFrame, least: int = 24, times: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` of every row.

    The run that is named has the most periods (ties: smallest start, then period).
    """
    kind = docs.schema[key].dataType.simpleString()
    bounded(docs.sparkSession)
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]

    def run(batches):
        for batch in batches:
            rows = []
            for _, own, kept in _reports(batch.column(1), least, times):
                best = min(own, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)
                rows.append((len(own), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                             hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest(),
                             hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.string()) for c in cols[5:])],
                                             ["key", *longs, "runs_sha256", "collapsed_sha256"])

    return (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t"))
            .mapInArrow(run, f"key {kind}, {', '.join(f'{c} long' for c in longs)}, runs_sha256 string, collapsed_sha256 string")
            .withColumnRenamed("key", key))


def with_cycles(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with some texts made periodic, as a test of the search: which and how follows from crc32 of the key.

    With h that checksum and g = h / 10: if h ends in 0, the words from a = g % n on repeat the p words from there, with
    p = 1 + (n - a) / (3 + g % 8). Texts without words and null keys stay.
    """
    words = F.filter(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    g = F.floor(h / 10)
    parts = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text), F.when(h % 10 == 0, words).alias("w"), g.alias("g"))
    n = F.coalesce(F.size("w"), F.lit(0))
    parts = parts.withColumn("n", n).withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    parts = parts.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    cycle = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("cast((n - a) div p + 1 as int)")))
    cycled = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), F.col("n") - F.col("a"))), " ")
    return parts.select(F.col(f"`{key}`"), F.when(F.col("n") > 0, cycled).otherwise(F.col(f"`{text}`")).alias(text))
