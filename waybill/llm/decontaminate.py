"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the word windows of the test items, texts are scanned as bytes. For patterns of one length class, a shift
table says for every block of bytes how far the end of a window may move on without passing an occurrence; where it says
zero, the bucket of patterns that end their common prefix in that block is looked up, their first bytes are compared, and
then the pattern itself. All stretches of a batch are scanned in step, a vector of window ends at a time.

Defined cases: null, empty and wordless texts have no words and no hits; an item without words has no window; an item
without id marks words but is not listed; items that repeat an id count once; an item of any length is cut into pieces
that share no window and lose none; repeated documents are rows of their own; empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.common import bounded, stage, work_folder

#: Bytes that are no part of a word become blanks, A-Z lower case.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Bytes of patterns searched for at a time; a larger benchmark is searched for block by block, each in a job of its own.
PATTERN_BYTES = 64 << 20
BITS = 20
STRIDE = 2048
TEXT_BYTES = 16 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


def _hash(block: np.ndarray, size: int) -> np.ndarray:
    """Table slots of blocks of ``size`` bytes, given as eight bytes each, the first byte lowest."""
    return (block << np.uint64(64 - 8 * size)) * MIX >> np.uint64(64 - BITS)


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes from each position on."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))


class Search:
    """Shift tables and suffix buckets of a set of patterns, and the scan for them."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], width: int):
        found: dict[bytes, set] = {}
        for item, text in items:
            words = normal(text)
            for at in range(max(1, len(words) - width + 1) if words else 0):
                found.setdefault(b" " + b" ".join(words[at:at + width]) + b" ", set()).add(item)
        self.patterns = sorted(found)
        self.items = [sorted(i for i in found[p] if i is not None) for p in self.patterns]
        self.words = [p.count(b" ") - 1 for p in self.patterns]
        classes: dict[int, list[int]] = {}
        for k, p in enumerate(self.patterns):
            classes.setdefault(min(max(len(p).bit_length(), 3), 6), []).append(k)
        self.tables = [self._table(np.array(ks)) for ks in classes.values()]

    def _table(self, ks: np.ndarray):
        short = min(len(self.patterns[k]) for k in ks)
        size = min(8, max(2, short // 2))
        heads = np.frombuffer(b"".join(self.patterns[k][:short] + b"\0" * 8 for k in ks), np.uint8).reshape(len(ks), -1)
        shift = np.full(1 << BITS, min(short - size + 1, 255), np.uint8)
        slots = None
        for end in range(size, short + 1):
            block = np.ascontiguousarray(heads[:, end - size:end - size + 8]).view("<u8")[:, 0]
            slots = _hash(block, size)
            shift[slots] = np.minimum(shift[slots], min(short - end, 255))
        order = np.argsort(slots, kind="stable")
        first = np.ascontiguousarray(heads[:, :8]).view("<u8")[:, 0]
        return short, size, shift, slots[order], ks[order], first[order]

    def occurrences(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern) of every occurrence in normalized text."""
        for short, size, shift, slots, ks, first in self.tables:
            eights = _eights(data + b"\0" * 8)
            last = len(data) + 1
            at = np.arange(short, last, STRIDE)
            stop = np.minimum(at + STRIDE, last)
            mask = np.uint64((1 << 8 * min(8, short)) - 1)
            while len(at):
                slot = _hash(eights[at - size], size)
                step = shift[slot]
                hit = np.flatnonzero(step == 0)
                if len(hit):
                    lo = np.searchsorted(slots, slot[hit], "left")
                    many = np.searchsorted(slots, slot[hit], "right") - lo
                    one = np.repeat(np.arange(len(hit)), many)
                    k = np.arange(len(one)) - np.repeat(np.cumsum(many) - many, many) + lo[one]
                    start = at[hit[one]] - short
                    same = eights[start] & mask == first[k] & mask
                    for s, p in zip(start[same].tolist(), ks[k[same]].tolist()):
                        if data.startswith(self.patterns[p], s):
                            yield s, p
                at = at + np.maximum(step, 1)
                go = at < stop
                at, stop = at[go], stop[go]

    def documents(self, texts: list[str | None]) -> Iterator[tuple[int, list[int], list[str]]]:
        """For each text its word count, its hit words as ranges ``[from, to, from, to ...]``, and the items that occur."""
        lo = 0
        while lo < len(texts):
            hi, size, parts, counts = lo, 0, [], []
            while hi < len(texts) and size < TEXT_BYTES:
                words = normal(texts[hi])
                parts.append(b" " + b" ".join(words) + b" ")
                counts.append(len(words))
                size += len(parts[-1]) + 1
                hi += 1
            yield from self._batch(parts, counts)
            lo = hi

    def _batch(self, parts, counts):
        data = b"\n".join(parts)
        offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
        found: dict[int, list[tuple[int, int]]] = {}
        hits = list(self.occurrences(data))
        for (start, p), d in zip(hits, (np.searchsorted(offsets, [s for s, _ in hits], "right") - 1).tolist()):
            found.setdefault(d, []).append((start, p))
        for d, n in enumerate(counts):
            if d not in found:
                yield n, [], []
                continue
            blanks = np.flatnonzero(np.frombuffer(parts[d], np.uint8) == 32)
            change = np.zeros(n + 1, np.int64)
            begin = np.searchsorted(blanks, np.array([s for s, _ in found[d]]) - offsets[d])
            np.add.at(change, begin, 1)
            np.add.at(change, begin + np.array([self.words[p] for _, p in found[d]]), -1)
            inside = np.r_[False, np.cumsum(change[:-1]) > 0, False]
            yield n, np.flatnonzero(inside[1:] != inside[:-1]).tolist(), sorted(
                {i for _, p in found[d] for i in self.items[p]})


def pieces(text: str | None, width: int, most: int) -> Iterator[tuple[str, int]]:
    """Stretches of an item, each of at most ``most`` bytes or of one window, and their bytes.

    Neighbours overlap by ``width - 1`` words, so every window of the item lies in exactly one of them.
    """
    words, at = normal(text), 0
    while at < len(words):
        end, size = at, 0
        while end < len(words) and (end - at < width or size + len(words[end]) < most):
            size += len(words[end]) + 1
            end += 1
        yield b" ".join(words[at:end]).decode(), size
        at = end if end == len(words) else end - width + 1


def searches(benchmark: DataFrame, width: int, text: str = "text", key: str = "item_id") -> Iterator[Search]:
    """One search per block of items or pieces of items; its patterns take at most ``PATTERN_BYTES``, or are one window."""
    block, size = [], 0
    rows = benchmark.select(F.col(key).cast("string"), F.col(text))
    for item, whole in rows.toLocalIterator():
        for piece, n in pieces(whole, width, PATTERN_BYTES // width):
            if block and size + width * n > PATTERN_BYTES:
                yield Search(block, width)
                block, size = [], 0
            block.append((item, piece))
            size += width * n
    yield Search(block, width)


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_words, spans, items)`` of every document: ``spans`` are ranges of hit words, ``items`` sorted ids.

    The benchmark is a stated set of test texts: it is read in blocks of bounded size, and every document meets every
    block. Documents are not shuffled.
    """
    spark = docs.sparkSession
    bounded(spark)
    kind = docs.schema[key].dataType.simpleString()
    current = docs.select(F.col(key).alias("id"), F.col(text).alias("t"), F.lit(0).cast("long").alias("n"),
                          F.array().cast("array<long>").alias("spans"), F.array().cast("array<string>").alias("items"))
    folder, shared, shape = None, None, f"id {kind}, t string, n long, spans array<long>, items array<string>"
    for turn, search in enumerate(searches(benchmark, width)):
        if turn:
            folder = folder or work_folder(spark)
            current = stage(current, folder, f"block{turn}")
            shared.destroy()  # what it found is written
        shared = spark.sparkContext.broadcast(search)

        def run(batches, shared=shared):
            for batch in batches:
                rows = list(shared.value.documents(batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([a + b[1] for a, b in zip(batch.column(3).to_pylist(), rows)], pa.list_(pa.int64())),
                    pa.array([a + b[2] for a, b in zip(batch.column(4).to_pylist(), rows)], pa.list_(pa.string()))],
                    ["id", "t", "n", "spans", "items"])

        current = current.mapInArrow(run, shape)
    return current.select(F.col("id").alias(key), F.col("n").alias("n_words"), F.expr(UNITED).alias("spans"),
                          F.array_sort(F.array_distinct("items")).alias("items"))


#: Ranges of all blocks, sorted and merged: a range that starts at or before the end of the last one extends it.
UNITED = """
aggregate(
  array_sort(transform(sequence(0, size(spans) - 2, 2), i -> struct(spans[i] AS a, spans[i + 1] AS b))),
  cast(array() AS array<struct<a: bigint, b: bigint>>),
  (done, s) -> if(size(done) > 0 AND s.a <= done[size(done) - 1].b,
    concat(slice(done, 1, size(done) - 1),
           array(named_struct('a', done[size(done) - 1].a, 'b', greatest(s.b, done[size(done) - 1].b)))),
    concat(done, array(named_struct('a', s.a, 'b', s.b)))))
"""
UNITED = f"if(size(spans) = 0, cast(array() AS array<struct<a: bigint, b: bigint>>), {UNITED})"


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns.

    Of a benchmark of several blocks, each is searched for in what the blocks before it left, written in between.
    """
    spark = docs.sparkSession
    bounded(spark)
    folder, shared = None, None
    for turn, search in enumerate(searches(benchmark, width)):
        if turn:
            folder = folder or work_folder(spark)
            docs = stage(docs, folder, f"left{turn}")
            shared.destroy()  # what it found is written
        shared = spark.sparkContext.broadcast(search)  # at most PATTERN_BYTES of patterns

        @F.pandas_udf(T.BooleanType())
        def free(texts, shared=shared):
            import pandas as pd

            return pd.Series([not spans for _, spans, _ in shared.value.documents(texts.tolist())], dtype=bool)

        docs = docs.where(free(F.col(text)))
    return docs


def report(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Counts and digests of ``hits`` per document."""
    found = hits(docs, benchmark, width)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))
