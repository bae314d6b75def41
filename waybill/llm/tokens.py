"""Token-ID output: texts to token ids in Simple-8b files, and back.

A file holds the ids of consecutive documents in key order: a magic, the words of its blocks, then an index (document
keys and lengths, words per block, wide values) and a fixed-size trailer. Files are written to a name of the attempt and
renamed when whole, so a lost or repeated task leaves one whole file.

Defined cases: a null or empty text is the end id alone; repeated keys and rows are documents of their own, next to each
other; a null key sorts first; an empty table writes no file. Files hold whole numbers for keys; ``round_trip`` takes texts
too, and numbers them in order.
"""

from __future__ import annotations

import struct
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import simple8b
from waybill.llm.common import bounded, long_keys, named, stage, work_folder

MAGIC = b"WAYTOK01"
#: Documents, ids, blocks, words, wide values.
TRAILER = "<5Q8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
#: Ids packed at a time, a multiple of the block.
PACK = 2048 * simple8b.BLOCK
#: Pieces of text whose ids a worker remembers.
REMEMBER = 1_000_000
#: Before a piece that no blank precedes; pieces between blanks never hold one.
HEAD = " "
#: Signs that follow a word, and pieces made of both; the tokenizer parts them. Its endings behind an apostrophe are not.
TAIL = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
SIGNED = r"^ ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+[!-&(-/:-@\[-`{-~]+$"
#: Lines that end and begin within a piece; the tokenizer parts a single line end from what stands around it.
LINES = r"^[!-~À-ÖØ-öø-ɏ]+(\n[!-~À-ÖØ-öø-ɏ]+)+$"
SLICE = 4 << 20
CALL = 1 << 16


class Places(dict):
    """Numbers strings in the order they first turn up, and lists those that are new."""

    def __init__(self, at: int):
        self.next, self.new = at, []

    def __missing__(self, piece: str) -> int:
        self[piece] = k = self.next
        self.next += 1
        self.new.append(piece)
        return k


def strings(column: pa.Array) -> list[str]:
    """A column of texts as a list, made as a whole: ``to_pylist`` makes an object per element on the way."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts by a tokenizer file with byte-level pieces, encoding each piece between blanks once.

    The tokenizer cuts before every blank that no white space follows, whatever stands around it, so ids of the pieces
    joined are the ids of the text. A text with any other blank is encoded in one go, and so is one that holds a token added
    to the file, which has an id of its own. Lines and signs, which the tokenizer parts too, are encoded by themselves.
    """

    def __init__(self, path: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = np.array([len(self.tokenizer.id_to_token(k) or "") for k in range(self.tokenizer.get_vocab_size())])
        # Place 0 is the end of a text. Places are those of pieces behind a blank; of others, with HEAD before them.
        self.known = Places(1)
        self.flat, self.size = np.array([end_id], np.uint32), 1
        self.starts, self.lens = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.used, self.odd = np.zeros(1, np.int64), np.zeros(1, bool)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _behind_blank(self, pieces: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of pieces that follow a blank, many to a call, and how many each has, told by their bytes."""
        import pyarrow.compute as pc

        sizes = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        calls = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // CALL, prepend=-1))
        bounds = np.r_[calls, len(pieces)]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces), " ")
        found, lens = self._whole([" " + t for t in strings(texts)]), []
        for a, b, ids in zip(bounds, bounds[1:], found):
            ends = np.cumsum(sizes[a:b])
            lens.append(np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends) + 1, prepend=0))
        return found, np.concatenate([*lens, np.empty(0, np.int64)])

    def _learn(self) -> None:
        """Encode what is new and put its ids where its places say.

        Pieces of several lines are made of their lines, words with signs of the word and the signs; these parts are new
        pieces themselves unless they are known.
        """
        import pyarrow.compute as pc

        first, known, new = len(self.lens), self.known, self.known.new

        def found(pieces: pa.Array, pattern: str) -> np.ndarray:
            return np.flatnonzero(pc.match_substring_regex(pieces, pattern).to_numpy(zero_copy_only=False))

        lined = found(pa.array(new, pa.string()), LINES)
        lines = [new[k].split("\n") for k in lined.tolist()]
        lines = [[known[some[0]], *(x for line in some[1:] for x in (known[HEAD + "\n"], known[HEAD + line]))] for some in lines]
        pieces = pa.array(new, pa.string())
        signed = found(pieces, SIGNED)
        words = strings(pc.utf8_rtrim(pieces.take(pa.array(signed)), TAIL))
        word = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        signs = np.fromiter((known[HEAD + new[k][len(w):]] for k, w in zip(signed.tolist(), words)), np.int64, len(words))
        pieces = pa.array(new, pa.string())
        whole = np.ones(len(new), bool)
        whole[signed] = whole[lined] = False
        head = pc.starts_with(pieces, HEAD).to_numpy(zero_copy_only=False)
        odd = ~pc.utf8_is_printable(pc.utf8_slice_codeunits(pieces, 0, 1)).to_numpy(zero_copy_only=False) | (
            pc.binary_length(pieces).to_numpy(zero_copy_only=False) == 0)
        plain, heads = np.flatnonzero(whole & ~head & ~odd), np.flatnonzero(whole & head)
        self._room(known.next)
        self.odd[first:] = odd & whole & ~head
        ids, lens = self._behind_blank(pieces.take(pa.array(plain)))
        others = self._whole(strings(pc.utf8_slice_codeunits(pieces.take(pa.array(heads)), 1)))
        self._put(first + np.r_[plain, heads], np.r_[lens, np.array([len(x) for x in others], np.int64)], [*ids, *others])
        self._made_of(first + signed, np.stack([word, signs], 1).reshape(-1), np.full(len(signed), 2))
        self._made_of(first + lined, np.array([x for line in lines for x in line], np.int64), np.array([len(x) for x in lines], np.int64))
        new.clear()

    def _made_of(self, at: np.ndarray, parts: np.ndarray, many: np.ndarray) -> None:
        """Give places the ids of other places, so ``many`` of ``parts`` each."""
        if len(at):
            ids, lens = self._joined(parts)
            self._put(at, np.add.reduceat(lens, np.cumsum(many) - many), [ids])

    def _room(self, count: int) -> None:
        """Make the columns of places reach to ``count``."""
        def grown(x):
            return np.concatenate([x, np.zeros(count - len(x), x.dtype)])

        self.starts, self.lens, self.used, self.odd = map(grown, (self.starts, self.lens, self.used, self.odd))

    def _put(self, at: np.ndarray, lens: np.ndarray, ids: list[np.ndarray]) -> None:
        """Give places their ids, which lie one after the other; the store of ids doubles when it is full."""
        self.lens[at] = lens
        self.starts[at] = self.size + np.cumsum(lens) - lens
        need = self.size + int(lens.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.size], np.empty(2 * need - self.size, np.uint32)])
        for some in ids:
            self.flat[self.size:self.size + len(some)] = some
            self.size += len(some)

    def _thin(self) -> None:
        """Forget the pieces that were used once; all of them if that is not enough."""
        keep = [] if (self.used > 1).sum() > REMEMBER // 2 else [p for p, k in self.known.items() if self.used[k] > 1]
        old = np.array([0, *(self.known[p] for p in keep)])
        self.flat, self.lens = self._joined(old)
        self.size = len(self.flat)
        self.starts, self.odd, self.used = np.cumsum(self.lens) - self.lens, self.odd[old], self.used[old]
        self.known = Places(1)
        for p in keep:
            self.known[p]  # numbers it
        self.known.new.clear()

    def _joined(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of places one after the other, and how many each has."""
        lens = self.lens[order]
        past = np.cumsum(lens)
        return self.flat[np.repeat(self.starts[order] - (past - lens), lens) + np.arange(lens.sum())], lens

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and the ids per text.

        Every distinct piece of the texts is looked up once, whatever its number.
        """
        import pyarrow.compute as pc

        if len(self.known) > REMEMBER:
            self._thin()
        place = self.known.__getitem__
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        pieces = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        lens = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        # A text without blanks is its head; one that is null or to be encoded in one go has an empty head.
        coded = pc.dictionary_encode(pieces.flatten())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        ends = np.cumsum(lens + 1)
        order = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        own = np.ones(len(order), bool)
        own[ends - 1] = False
        index = coded.indices.to_numpy(zero_copy_only=False)
        heads = np.cumsum(lens) - lens
        inner = np.ones(len(index), bool)
        inner[heads] = False
        distinct = coded.dictionary
        wanted = np.zeros(len(distinct), bool)
        wanted[index[inner]] = True
        at = np.zeros(len(distinct), np.int64)
        names = strings(distinct.filter(pa.array(wanted)))
        at[wanted] = np.fromiter(map(place, names), np.int64, len(names))
        order[own] = at[index]
        first = strings(distinct.take(pa.array(index[heads])))
        starts = ends - lens - 1
        order[starts] = np.fromiter((place(HEAD + h) for h in first), np.int64, len(first))
        for k in np.flatnonzero(whole).tolist():
            order[starts[k]] = place(HEAD + texts[k].as_py())
        self._learn()
        if self.odd[order].any():  # encode those texts whole
            parts = [order[a:b] for a, b in zip(starts, ends)]
            for k in np.unique(np.searchsorted(ends, np.flatnonzero(self.odd[order]), "right")).tolist():
                parts[k] = np.array([place(HEAD + texts[k].as_py()), 0])
            self._learn()
            order, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        self.used += np.bincount(order, minlength=len(self.used))
        ids, lens = self._joined(order)
        return ids, np.diff(np.cumsum(lens)[ends - 1], prepend=0)


def encoder(path: str, end_id: int) -> Encoder:
    """The encoder of this worker process. Functions come by value, so what outlives a task is kept outside this module."""
    kept = sys.modules.setdefault("_waybill_encoders", types.ModuleType("_waybill_encoders")).__dict__
    if (path, end_id) not in kept:
        kept[path, end_id] = Encoder(path, end_id)
    return kept[path, end_id]


def slices(texts: pa.Array):
    """Stretches of a column of texts of about ``SLICE`` bytes."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, "right")))
        yield lo, hi
        lo = hi


class Writer:
    """One file of ids."""

    def __init__(self, folder: str, name: str, attempt: str):
        from pyarrow import fs

        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.temporary, self.path = f"{root}/.{name}.{attempt}", f"{root}/{name}"
        self.out = self.files.open_output_stream(self.temporary)
        self.out.write(MAGIC)
        self.rest = np.empty(0, np.uint64)
        self.keys, self.nulls, self.lens, self.per_block, self.wide = [], [], [], [], np.empty(0, np.uint64)
        self.ids = self.words = 0

    def add(self, keys: list[int | None], ids: np.ndarray, lens: np.ndarray) -> None:
        self.keys.append(np.array([k or 0 for k in keys], np.int64))
        self.nulls.append(np.array([k is None for k in keys], np.uint8))
        self.lens.append(lens.astype(np.uint64))
        self.rest = np.concatenate([self.rest, ids.astype(np.uint64)])
        while len(self.rest) >= PACK:
            self._pack(self.rest[:PACK])
            self.rest = self.rest[PACK:]

    def _pack(self, ids: np.ndarray) -> None:
        words, per_block, wide = simple8b.encode(ids, len(self.wide))
        self.out.write(words.astype("<u8").tobytes())
        self.per_block.append(per_block.astype(np.uint32))
        self.wide = np.concatenate([self.wide, wide])
        self.ids, self.words = self.ids + len(ids), self.words + len(words)

    def close(self) -> dict:
        self._pack(self.rest)
        keys, nulls, lens, per_block = (np.concatenate(x) for x in (self.keys, self.nulls, self.lens, self.per_block))
        for part, kind in ((keys, "<i8"), (nulls, "u1"), (lens, "<u8"), (per_block, "<u4"), (self.wide, "<u8")):
            self.out.write(part.astype(kind).tobytes())
        self.out.write(struct.pack(TRAILER, len(keys), self.ids, len(per_block), self.words, len(self.wide), MAGIC))
        self.out.close()
        self.files.move(self.temporary, self.path)
        return {"n_docs": len(keys), "n_ids": self.ids}


class Reader:
    """One file of ids, read a stretch of blocks at a time."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        self.file = files.open_input_file(f"{root}/{name}")
        size = self.file.size()
        docs, self.ids, blocks, words, wide, magic = struct.unpack(
            TRAILER, self.file.read_at(TRAILER_BYTES, size - TRAILER_BYTES))
        if magic != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{name} is no whole file of token ids")
        at, found = 8 + 8 * words, []
        for n, kind in ((docs, "<i8"), (docs, "u1"), (docs, "<u8"), (blocks, "<u4"), (wide, "<u8")):
            kind = np.dtype(kind)
            found.append(np.frombuffer(self.file.read_at(n * kind.itemsize, at), kind))
            at += n * kind.itemsize
        self.keys, self.nulls, lens, per_block, self.wide = found
        self.lens, self.per_block = lens.astype(np.int64), per_block.astype(np.int64)
        self.offsets = np.r_[0, np.cumsum(self.per_block)]

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """The ids of blocks ``lo`` to ``hi`` (exclusive), found by their word offsets."""
        hi = min(hi, len(self.per_block))
        a, b = int(self.offsets[lo]), int(self.offsets[hi])
        words = np.frombuffer(self.file.read_at(8 * (b - a), 8 + 8 * a), "<u8")
        count = min(self.ids, hi * simple8b.BLOCK) - lo * simple8b.BLOCK
        return simple8b.decode(words, self.per_block[lo:hi], count, self.wide)

    def documents(self, at_a_time: int = 1024):
        """(key, start in the file, ids, crc32 of the ids as little-endian 32-bit integers) of each document."""
        ends = np.cumsum(self.lens).tolist()
        held, base, block = np.empty(0, "<u4"), 0, 0
        for k, (key, null, n, end) in enumerate(zip(self.keys.tolist(), self.nulls.tolist(), self.lens.tolist(), ends)):
            at, crc = end - n, 0
            while at < end:
                if at >= base + len(held):
                    base, held = block * simple8b.BLOCK, self.blocks(block, block + at_a_time).astype("<u4")
                    block += at_a_time
                stop = min(end, base + len(held))
                crc = zlib.crc32(memoryview(held[at - base:stop - base]), crc)
                at = stop
            yield None if null else key, end - n, n, crc


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text and write files of ids in key order; one row ``(part, name, n_docs, n_ids)`` per file.

    Documents are ranged by key and, among equal keys, by place, so that no key has to fit one file. ``folder`` is a URI
    all executors reach.
    """
    order = [F.col("id").asc_nulls_first(), F.col("place")]
    bounded(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.ids"
        writer = None
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in slices(texts):
                ids, lens = encoder(tokenizer, end_id).encode(texts.slice(lo, hi - lo))
                writer = writer or Writer(folder, name, str(task.taskAttemptId()))
                writer.add(keys[lo:hi], ids, lens)
        if writer:
            done = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [task.partitionId()], "name": [name]} | {k: [v] for k, v in done.items()},
                pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ranged = (docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
              .withColumn("place", F.monotonically_increasing_id())
              .repartitionByRange(*order).sortWithinPartitions(*order).select("id", "t"))
    return ranged.mapInArrow(run, "part int, name string, n_docs long, n_ids long")


def read(files: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """``(key, start, n_tokens, ids_crc32)`` of every document of the files ``write`` listed."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    listed = files.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                rows: list[tuple] = []
                for doc, start, n, crc in Reader(folder, name).documents():
                    rows.append((doc, base + start, n, crc))
                    if len(rows) == 50_000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                          ["doc", "start", "n_tokens", "ids_crc32"])

    out = listed.repartition(max(1, files.count())).mapInArrow(run, "doc long, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("doc", key)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the ids of all documents to files in the shared folder and report what the files hold."""
    folder = work_folder(docs.sparkSession)
    docs, names = long_keys(docs.select("doc_id", "text"), "doc_id", folder)
    files = stage(write(docs, f"{folder}/ids", tokenizer, end_id), folder, "files")
    return named(read(files, f"{folder}/ids"), "doc_id", names)
