"""Removal of repeated passages, with a count-min prefilter.

A first pass counts hashed windows of words in a count-min sketch, which never counts too low. Each task sends its cells
as sorted differences, cut into segments that are merged one by one; what is kept of a cell is whether it holds two or
more. A second pass takes only windows whose every cell does, and groups those exactly, by 96 bits of hash: a window that
starts in two documents is never lost, and one that does not is never removed.

Within a task a window's first document speaks for all: later documents of the task are known to repeat it. So however
common a window is, each task sends one row for it.

Defined cases: null, empty and wordless texts have no words; a text shorter than a window loses nothing; a row without
id has no smaller and no larger, so it loses nothing and takes nothing; rows that share an id are documents of their own
and do not count against each other; ids may be texts, whose order then decides; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.llm.common import bounded, long_keys, stage, work_folder
from waybill.llm.common import named as named_again

#: Rows of the sketch; cells of a row as a power of two, from and to; cells of a segment. At the upper end the merged
#: sketch is ROWS * 2**29 bits, 128 MB, which is all that is broadcast. Past it the prefilter lets more through and the
#: exact pass does more: results stay the same.
ROWS, LEAST_BITS, MOST_BITS, SEGMENT_BITS = 2, 20, 29, 19
#: Cells per word of text, and bytes a word takes on average, for the sketch's width.
ROOM, WORD_BYTES = 2, 6
#: Words handled at a time, and windows a task holds before it sends them on: in the first pass, and in the second, where
#: the sketch lies in memory beside them.
SLICE, HOLD, HOLD_FOUND = 200_000, 3_000_000, 400_000
BASE = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def batches_of_words(texts: list[str | None]):
    """Stretches of texts of about ``SLICE`` words: (index of the first, words per text, the words of all)."""
    first, counts, words = 0, [], []
    for t in texts:
        found = (t or "").encode().split()
        counts.append(len(found))
        words += found
        if len(words) >= SLICE:
            yield first, np.array(counts), words
            first, counts, words = first + len(counts), [], []
    if counts:
        yield first, np.array(counts), words


def windows(words: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hashes (n, 2) of all windows within texts, the text each is in, and its start there.

    A window's hash is a polynomial in the hashes of its words, taken from prefix sums modulo 2**64.
    """
    import xxhash

    n = len(words)
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    start = np.flatnonzero(text[:n - width + 1] == text[width - 1:]) if n >= width else np.empty(0, np.int64)
    if not len(start):
        return np.empty((0, 2), np.uint64), start, start
    each = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(n, 2)
    out = np.empty((len(start), 2), np.uint64)
    for k in range(2):
        power = np.cumprod(np.full(n, BASE[k]))
        back = np.cumprod(np.full(n, np.uint64(pow(int(BASE[k]), -1, 1 << 64))))
        sums = np.cumsum(np.r_[np.zeros(1, np.uint64), each[:, k] * power])
        value = (sums[start + width] - sums[start]) * back[start]
        out[:, k] = (value ^ value >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD)
    return out, text[start], start - first[text[start]]


def cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes[:, k] >> np.uint64(64 - bits)).astype(np.int64) for k in range(ROWS)]


def _packed(sorted_cells: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte plane by byte plane, compressed."""
    steps = np.diff(sorted_cells, prepend=sorted_cells.dtype.type(0)).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.cumsum(planes.reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64))


def sketch(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """``(row, segment, bits)``: of each segment of each row of cells, which hold two windows or more."""
    segment_bits = min(SEGMENT_BITS, bits)

    def count(batches):
        held, size = [[] for _ in range(ROWS)], 0
        for batch in batches:
            for _, counts, words in batches_of_words(batch.column(1).to_pylist()):
                hashes, _, _ = windows(words, counts, width)
                for row, cell in enumerate(cells(hashes, bits)):
                    held[row].append(cell.astype(np.uint32))
                size += len(hashes)
                if size > HOLD:
                    yield from send(held)
                    size = 0
        if size:
            yield from send(held)

    def send(held):
        """A row of the sketch at a time: its cells in order, and those met more than once, by segment."""
        for row, parts in enumerate(held):
            cell = np.concatenate(parts)
            parts.clear()
            cell.sort()
            new = np.r_[True, cell[1:] != cell[:-1]]
            again = np.r_[new[1:], True][new]  # the next cell is another one: met once
            cell = cell[new]
            many = cell[~again]
            edges = np.arange(1 << bits - segment_bits, dtype=np.int64) << segment_bits
            once, more = np.searchsorted(cell, edges), np.searchsorted(many, edges)
            out = []
            for segment, (a, b, c, d) in enumerate(zip(once, np.r_[once[1:], len(cell)], more, np.r_[more[1:], len(many)])):
                if a < b:
                    base = segment << segment_bits
                    out.append((row, segment, _packed(cell[a:b] - np.uint32(base)), _packed(many[c:d] - np.uint32(base))))
            kinds = pa.int32(), pa.int32(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["row", "segment", "once", "more"])

    def merge(batches):
        at, once, more = None, None, None
        for batch in batches:
            for row, segment, some, several in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (row, segment):
                    if at:
                        yield merged(at, more)
                    at, once, more = (row, segment), *(np.zeros(1 << segment_bits, bool) for _ in range(2))
                found = _unpacked(some)
                more[found] |= once[found]
                once[found] = True
                more[_unpacked(several)] = True
        if at:
            yield merged(at, more)

    def merged(at, more):
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array(
            [zstandard.compress(np.packbits(more, bitorder="little").tobytes(), 1)], pa.binary())], ["row", "segment", "bits"])

    sent = docs.mapInArrow(count, "row int, segment int, once binary, more binary")
    return (sent.repartition("row", "segment").sortWithinPartitions("row", "segment")
            .mapInArrow(merge, "row int, segment int, bits binary"))


def _shared(spark: SparkSession, merged: DataFrame, bits: int):
    """The merged sketch, at most ``ROWS * 2**MOST_BITS`` bits, for all tasks."""
    segment_bits = min(SEGMENT_BITS, bits)
    whole = np.zeros((ROWS, 1 << bits - segment_bits, max(1, 1 << segment_bits >> 3)), np.uint8)
    for row, segment, data in merged.toLocalIterator():
        whole[row, segment] = np.frombuffer(zstandard.decompress(bytes(data)), np.uint8)
    return spark.sparkContext.broadcast([row.tobytes() for row in whole])  # bytes, which workers load without a copy


def candidates(docs: DataFrame, width: int, bits: int, shared) -> DataFrame:
    """Windows the sketch counts twice: ``(h1, h2, id, spot, more)``.

    ``spot`` is the start of the window, below 32 bits of the text's hash; ``more`` holds further starts of the same window
    in the same document. Rows of ``spot`` -1 - k are not windows: their ``more`` lists starts that a smaller document of
    the same task is known to repeat, k being the bits of the text's hash.
    """

    def find(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            marks = batch.column(2).to_numpy()
            for first, counts, words in batches_of_words(batch.column(1).to_pylist()):
                hashes, text, start = windows(words, counts, width)
                keep = np.ones(len(hashes), bool)
                for row, cell in enumerate(cells(hashes, bits)):
                    kept = np.flatnonzero(keep)
                    cell = cell[kept]
                    keep[kept] = np.frombuffer(shared.value[row], np.uint8)[cell >> 3] >> (cell & 7).astype(np.uint8) & 1
                text = text[keep] + first
                kept = hashes[keep]
                held.append((kept[:, 0], kept[:, 1] & np.uint64(0xFFFFFFFF), ids[text], marks[text], start[keep]))
                size += len(text)
                if size > HOLD_FOUND:
                    yield from send(held)
                    size = 0
        if size:
            yield from send(held)

    def send(held):
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        order = np.lexsort(columns[::-1])
        for k, column in enumerate(columns):
            columns[k] = column[order]
        h1, h2, ids, marks, start = columns
        window = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        of = np.cumsum(window) - 1
        known = ids > ids[np.flatnonzero(window)][of]
        # Rows of the window's first document; starts of the same text go together.
        here = np.flatnonzero(~known)
        lead = np.r_[True, (of[here][1:] != of[here][:-1]) | (marks[here][1:] != marks[here][:-1])]
        starts = np.flatnonzero(lead)
        many = np.diff(np.r_[starts, len(here)])
        one = here[starts]
        more = [None] * len(one)
        for k in np.flatnonzero(many > 1).tolist():
            more[k] = start[here[starts[k] + 1:starts[k] + many[k]]].astype("<u4").tobytes()
        yield rows(h1[one], h2[one], ids[one], marks[one] << 32 | start[one], more)
        known = np.flatnonzero(known)
        known = known[np.lexsort((start[known], marks[known], ids[known]))]
        if len(known):
            same = (ids[known][1:] == ids[known][:-1]) & (marks[known][1:] == marks[known][:-1])
            cuts = np.flatnonzero(np.r_[True, ~same])
            lists = [start[known[a:b]].astype("<u4").tobytes() for a, b in zip(cuts, np.r_[cuts[1:], len(known)])]
            one = known[cuts]
            yield rows(h1[one], h2[one], ids[one], -1 - marks[one], lists)

    def rows(h1, h2, ids, spot, more):
        return pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(ids, pa.int64()),
                                           pa.array(spot, pa.int64()), pa.array(more, pa.binary())],
                                          ["h1", "h2", "id", "spot", "more"])

    return docs.mapInArrow(find, "h1 long, h2 long, id long, spot long, more binary")


def removed_starts(found: DataFrame) -> DataFrame:
    """``(id, mark, starts, lists)`` of windows that also start in a smaller document."""
    first = F.min(F.when(F.col("spot") >= 0, F.col("id"))).over(Window.partitionBy("h1", "h2"))
    hit = found.withColumn("first", first).where("spot < 0 OR first < id")
    return hit.groupBy("id", F.when(F.col("spot") < 0, -1 - F.col("spot")).otherwise(F.shiftright("spot", 32)).alias("mark")).agg(
        F.collect_list(F.when(F.col("spot") >= 0, F.col("spot").bitwiseAND(0xFFFFFFFF).cast("int"))).alias("starts"),
        F.collect_list("more").alias("lists"))


def kept_words(words: list[bytes], starts: np.ndarray, width: int) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def without_repeats(docs: DataFrame, width: int = 13, text: str = "text", key: str = "doc_id", texts: bool = True) -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` of every document, and ``kept``, the words left, if ``texts``."""
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession)
    bounded(spark)
    ids, names = long_keys(docs.select(F.col(key).alias("id"), F.col(text).alias("t")), "id", folder)
    # Texts are told apart by a hash only where ids repeat; a constant takes no room in the shuffles.
    repeated = ids.groupBy("id").count().where("id IS NOT NULL AND count > 1").limit(1).count()
    rows = ids.withColumn("mark", F.xxhash64("t").bitwiseAND(0x7FFFFFFF) if repeated else F.lit(0).cast("long"))
    named = rows.where("id IS NOT NULL")
    size = named.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    bits = min(max((size * ROOM // WORD_BYTES).bit_length(), LEAST_BITS), MOST_BITS)
    shared = _shared(spark, stage(sketch(named, width, bits), folder, "sketch"), bits)
    starts = removed_starts(candidates(named, width, bits, shared))

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=4)
        for batch in batches:
            packed = [packer.compress(b" ".join((t or "").encode().split())) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["id", "z", "mark"])

    def cut(batches):
        for batch in batches:
            out = []
            for z, some, lists in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                words = kept = zstandard.decompress(z).split()
                if some or lists:
                    at = np.concatenate([np.array(some or [], np.int64), *(np.frombuffer(x, "<u4") for x in lists or [])])
                    kept = kept_words(words, at.astype(np.int64), width)
                whole = b" ".join(kept)
                out.append((len(words), len(words) - len(kept), hashlib.sha256(whole).hexdigest(), whole.decode()))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string())))]
                [:5 if texts else 4], ["id", "n_words", "n_removed", "kept_sha256", "kept"][:5 if texts else 4])

    shape = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    packed = rows.mapInArrow(pack, "id long, z binary, mark long")
    out = packed.join(starts, ["id", "mark"], "left").select("id", "z", "starts", "lists").mapInArrow(cut, shape)
    return named_again(out, "id", names).withColumnRenamed("id", key)
