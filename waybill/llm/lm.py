"""Language-model scores by deleted interpolation.

A token's probability mixes the maximum-likelihood estimates of its bigram, its unigram and a uniform one, with weights
that depend on how often its context was seen. Some training documents are held out: expectation-maximisation finds the
weights under which estimates from the other training documents predict them best. All counts then come from all of them.

Counts cover every token, without any vocabulary or table on one machine. Documents are coded into chunks; a chunk asks for
the counts of its distinct n-grams (and brings its own) in one sorted list per range of hashes; a range's task adds up what
all chunks bring and answers each chunk in the order it asked. However common an n-gram, a chunk sends it once. N-grams are
told apart by 64 bits of hash.

Defined cases: a null, empty or wordless text is its end token alone; rows without id are scored but not learned from;
repeated rows are rows of their own; ids may be texts; without training documents every token has the uniform probability; an empty table
gives no rows.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import LOWER, bounded, long_keys, named, remainder, stage, work_folder

#: Text of a chunk, tokens per range of hashes, and ranges at most.
CHUNK, RANGE, MOST_RANGES = 8 << 20, 2_000_000, 1 << 14
#: The end token and the context of a first token; words cannot look like these.
END, START = b" ", b"\n"
ROUNDS, FLOOR = 60, 1e-6
#: Steps per octave to which probabilities are rounded while the weights are learned.
STEPS = 8
#: What a document is to the model: counted, counted and held out for the weights, or only scored.
COUNTED, DELETED, SCORED = 0, 1, 2


def hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), "<u8")


def bigrams(tokens: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bigram that ends at each token, and which tokens are the first of their document."""
    first = np.zeros(len(tokens), bool)
    first[np.cumsum(lens) - lens] = True
    before = np.where(first, hashes([START])[0], np.roll(tokens, 1))
    out = (before * np.uint64(0x9E3779B97F4A7C15) + tokens) * np.uint64(0xD6E8FEB86659FD93)
    return (out ^ out >> np.uint64(32)) * np.uint64(0xFF51AFD7ED558CCD), first


def packed(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane, compressed, behind their length."""
    kind = "<u8" if values.dtype.itemsize == 8 else "<u4"
    planes = values.astype(kind).view(np.uint8).reshape(len(values), int(kind[2])).T.tobytes()
    data = zstandard.compress(planes, 1)
    return struct.pack("<IB", len(data), values.dtype.itemsize) + data


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where they fit, else in 64."""
    return counts.astype(np.uint32 if int(counts.max(initial=0)) < 1 << 32 else np.uint64)


def added(places: np.ndarray, counts: np.ndarray, which: np.ndarray, size: int) -> np.ndarray:
    """Sums of some counts by place, exact in 64 bits."""
    out = np.zeros(size, np.int64)
    np.add.at(out, places[which], counts[which].astype(np.int64))
    return out


def unpacked(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The integers packed at a place, and the place behind them."""
    size, width = struct.unpack_from("<IB", data, at)
    planes = np.frombuffer(zstandard.decompress(data[at + 5:at + 5 + size]), np.uint8)
    return planes.reshape(width, -1).T.copy().view(f"<u{width}").reshape(-1), at + 5 + size


def all_unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        values, at = unpacked(data, at)
        out.append(values)
    return out


class Chunk:
    """Coded documents: ids, tokens per document, tokens as places in a list of the chunk's token hashes."""

    def __init__(self, data: bytes):
        self.ids, nulls, self.lens, index, vocabulary = all_unpacked(data)
        self.ids, self.nulls, self.lens = self.ids.view(np.int64), nulls.astype(bool), self.lens.astype(np.int64)
        self.tokens = vocabulary[index]
        self.grams, self.first = bigrams(self.tokens, self.lens)

    @staticmethod
    def pack(ids: list[int | None], texts: list[np.ndarray]) -> bytes:
        vocabulary, index, many = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
        order = np.argsort(-many, kind="stable")  # frequent tokens get small numbers, which pack well
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        return b"".join(packed(x) for x in (
            np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint32),
            np.array([len(tokens) for tokens in texts], np.uint32), place[index], vocabulary[order]))

    def types(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Distinct hashes, inverse and counts of tokens and of bigrams."""
        return [np.unique(x, return_inverse=True, return_counts=True) for x in (self.tokens, self.grams)]


def chunks(docs: DataFrame) -> DataFrame:
    """``(chunk, role, tokens, data)`` of ``(id, t, r)``: documents of one role each, coded about ``CHUNK`` bytes at a time."""

    def run(batches):
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held = {r: ([], [], 0) for r in (COUNTED, DELETED, SCORED)}
        for batch in batches:
            for doc, t, r in zip(*(c.to_pylist() for c in batch.columns)):
                ids, texts, size = held[r]
                ids.append(doc)
                texts.append(hashes([*(t or "").encode().translate(LOWER).split(), END]))
                held[r] = (ids, texts, size + len(t or "") + 1)
                if held[r][2] >= CHUNK:
                    yield row(task << 32 | made, r, ids, texts)
                    held[r], made = ([], [], 0), made + 1
        for r, (ids, texts, _) in held.items():
            if ids:
                yield row(task << 32 | made, r, ids, texts)
                made += 1

    def row(number, r, ids, texts):
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([r], pa.int32()), pa.array([sum(map(len, texts))], pa.int64()),
            pa.array([Chunk.pack(ids, texts)], pa.binary())], ["chunk", "role", "tokens", "data"])

    return docs.select("id", "t", "r").mapInArrow(run, "chunk long, role int, tokens long, data binary")


def counts(coded: DataFrame, ranges: int) -> DataFrame:
    """``(chunk, range, data, n, deleted, v)``: for each chunk and range of hashes, the counts of the chunk's n-grams.

    ``data`` holds, for tokens and for bigrams, counts over all training documents and over the deleted ones. On one row
    of each range, ``n`` is the number of training tokens in it, ``deleted`` of those held out, ``v`` of distinct ones.
    """
    shift = np.uint64(64 - (ranges.bit_length() - 1))

    def ask(batches):
        for batch in batches:
            for chunk, role, data in zip(*(c.to_pylist() for c in batch.columns)):
                parts = []
                for found, _, many in Chunk(data).types():
                    cuts = np.searchsorted((found >> shift).astype(np.int64) if ranges > 1 else np.zeros(len(found)),
                                           np.arange(ranges + 1))
                    parts.append([packed(np.diff(found[a:b], prepend=np.uint64(0))) + packed(narrow(many[a:b]))
                                  for a, b in zip(cuts, cuts[1:])])
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(ranges), pa.int32()), pa.array([chunk] * ranges, pa.int64()),
                    pa.array([role] * ranges, pa.int32()), pa.array([a + b for a, b in zip(*parts)], pa.binary())],
                    ["range", "chunk", "role", "data"])

    def answer(batches):
        at, held = None, []
        for batch in batches:
            for r, chunk, role, data in zip(*(c.to_pylist() for c in batch.columns)):
                if r != at and held:
                    yield from answers(at, held)
                    held = []
                at = r
                held.append((chunk, role, data))
        if held:
            yield from answers(at, held)

    def answers(r, held):
        lists = [all_unpacked(data) for _, _, data in held]
        role = np.array([x[1] for x in held])
        out, sums = [[] for _ in held], []
        for k in (0, 2):
            sizes = np.array([len(x[k]) for x in lists])
            asked = np.concatenate([np.cumsum(x[k], dtype=np.uint64) for x in lists])
            many = np.concatenate([x[k + 1] for x in lists])
            of = np.repeat(role, sizes)
            types, inverse = np.unique(asked, return_inverse=True)
            seen, gone = added(inverse, many, of != SCORED, len(types)), added(inverse, many, of == DELETED, len(types))
            if not k:
                sums = [int(seen.sum()), int(gone.sum()), int((seen > 0).sum())]
            ends = np.cumsum(sizes)
            for j, (a, b) in enumerate(zip(ends - sizes, ends)):
                out[j].append(packed(narrow(seen[inverse[a:b]])) + packed(narrow(gone[inverse[a:b]])))
        for j, (chunk, _, _) in enumerate(held):
            total = sums if not j else [None] * 3
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([r], pa.int32()), pa.array([b"".join(out[j])], pa.binary()),
                *(pa.array([x], pa.int64()) for x in total)], ["chunk", "range", "data", "n", "deleted", "v"])

    return (coded.select("chunk", "role", "data").mapInArrow(ask, "range int, chunk long, role int, data binary")
            .repartition(ranges, "range").sortWithinPartitions("range", "chunk")
            .mapInArrow(answer, "chunk long, range int, data binary, n long, deleted long, v long"))


class Counts:
    """Counts at each token of a chunk: of the token, its bigram and its context, over all training or the part kept."""

    def __init__(self, chunk: Chunk, answers: list[tuple[int, bytes]], kept: bool):
        lists = [all_unpacked(data) for _, data in sorted(answers)]
        found = []
        for k, (_, inverse, _) in zip((0, 2), chunk.types()):
            seen = np.concatenate([x[k] for x in lists]).astype(np.int64)
            if kept:
                seen = seen - np.concatenate([x[k + 1] for x in lists])
            found.append(seen[inverse])
        self.token, self.bigram = found
        # Every document is one start and one end, so the start was seen as often as the end.
        end = self.token[np.cumsum(chunk.lens)[0] - 1]
        self.context = np.where(chunk.first, end, np.roll(self.token, 1))


def bucket(context: np.ndarray) -> np.ndarray:
    """Contexts by how often they were seen: 0, 1, 2-3, 4-7, ..."""
    return np.ceil(np.log2(context + 1)).astype(np.int64)


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return a / np.maximum(b, 1)


def cells(coded: DataFrame, n: int) -> DataFrame:
    """``(bucket, p2, p1, tokens)`` of held-out tokens: rounded logarithms of their bigram and unigram estimates."""

    def run(batches):
        for batch in batches:
            for data, answers in zip(*(c.to_pylist() for c in batch.columns)):
                c = Counts(Chunk(data), [(a["range"], a["data"]) for a in answers], kept=True)
                with np.errstate(divide="ignore"):
                    logs = [np.maximum(np.round(np.log2(p) * STEPS), -2000).astype(np.int64)
                            for p in (_ratio(c.bigram, c.context), _ratio(c.token, n))]
                rows, many = np.unique(np.stack([bucket(c.context), *logs]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(many)], ["bucket", "p2", "p1", "tokens"])

    return (coded.select("data", "answers").mapInArrow(run, "bucket long, p2 long, p1 long, tokens long")
            .groupBy("bucket", "p2", "p1").agg(F.sum("tokens").alias("tokens")))


def weights(rows: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) by bucket, from cells of held-out tokens, by expectation-maximisation.

    A bucket without held-out tokens takes the weights of all of them together.
    """
    def fit(part):
        p = np.stack([*(np.where(part[:, k] <= -2000, 0, np.exp2(part[:, k] / STEPS)) for k in (1, 2)),
                      np.full(len(part), uniform)])
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = w[:, None] * p
            share *= part[:, 3] / np.maximum(share.sum(0), 1e-300)
            w = share.sum(1) / part[:, 3].sum()
        w = np.maximum(w, FLOOR)
        return w / w.sum()

    table = np.array(rows, float).reshape(-1, 4)
    out = np.tile(fit(table) if len(table) else np.full(3, 1 / 3), (66, 1))
    for b in np.unique(table[:, 0]).astype(int):
        out[b] = fit(table[table[:, 0] == b])
    return out


def score(docs: DataFrame, learnable: Column, deleted: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_tokens, n_known, train_tokens, base_score, score)`` of every document.

    ``learnable`` rows are counted; those of them that are ``deleted`` also teach the weights.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession)
    bounded(spark)
    role = F.when(F.coalesce(learnable & F.col(key).isNotNull(), F.lit(False)), F.when(deleted, DELETED).otherwise(COUNTED)
                  ).otherwise(SCORED)
    texts, names = long_keys(docs.select(F.col(key).alias("id"), F.col(text).alias("t"), role.alias("r")), "id", folder)
    coded = stage(chunks(texts), folder, "chunks")
    tokens = coded.agg(F.sum("tokens")).first()[0] or 0
    ranges = 1 << min(max((tokens // RANGE).bit_length(), 3), MOST_RANGES.bit_length() - 1)
    answered = stage(counts(coded, ranges), folder, "answers")
    n, gone, v = (x or 0 for x in answered.agg(F.sum("n"), F.sum("deleted"), F.sum("v")).first())
    lists = answered.groupBy("chunk").agg(F.collect_list(F.struct("range", "data")).alias("answers"))
    joined = coded.join(lists, "chunk")
    uniform = 1 / (v + 1)
    # As many cells as buckets times rounded probabilities, whatever the corpus.
    mixture = weights([tuple(r) for r in cells(joined.where(F.col("role") == DELETED), n - gone).collect()], uniform)
    shape = "id long, n_tokens long, n_known long, base_score double, score double"

    def run(batches):
        for batch in batches:
            for data, answers in zip(*(c.to_pylist() for c in batch.columns)):
                chunk = Chunk(data)
                c = Counts(chunk, [(a["range"], a["data"]) for a in answers], kept=False)
                w = mixture[bucket(c.context)]
                p = w[:, 0] * _ratio(c.bigram, c.context) + w[:, 1] * _ratio(c.token, n) + w[:, 2] * uniform
                base = np.log10((c.token + 0.1) / (n + 0.1 * (v + 1)))
                starts = np.cumsum(chunk.lens) - chunk.lens
                known, base, own = (np.add.reduceat(x, starts) for x in ((c.token > 0).astype(np.int64), base, np.log10(p)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.ids, pa.int64(), mask=chunk.nulls), pa.array(chunk.lens), pa.array(known), pa.array(base),
                    pa.array(own)], ["id", "n_tokens", "n_known", "base_score", "score"])

    return named(joined.select("data", "answers").mapInArrow(run, shape), "id", names).select(
        F.col("id").alias(key), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def report(docs: DataFrame, of: int = 10, fold: int = 0, deleted: int = 1) -> DataFrame:
    """Scores of all documents, learned from those outside one fold of their ids; one other fold teaches the weights."""
    fold_of = remainder(F.col("doc_id"), of)
    out = score(docs, fold_of != fold, fold_of == deleted)
    return out.select("doc_id", F.coalesce(fold_of == fold, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")
