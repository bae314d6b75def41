"""Simple-8b round trips, and token files against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waybill.llm import simple8b, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("case", range(12))
def test_code_round_trip(case):
    rng = np.random.default_rng(case)
    n = [0, 1, 1023, 1024, 1025, 5000, 3000, 10_000, 4096, 700, 2500, 9999][case]
    values = rng.integers(0, 1 << rng.integers(1, 62), n, dtype=np.uint64) >> rng.integers(0, 62, n, dtype=np.uint64)
    if case % 3 == 0:
        values[: n // 2] = 0
    if case % 4 == 1:
        values[::7] = np.uint64((1 << 64) - 1 - case)
    words, per_block, wide = simple8b.encode(values)
    assert len(per_block) == -(-n // simple8b.BLOCK) and per_block.sum() == len(words)
    assert (simple8b.decode(words, per_block, n, wide) == values).all()
    if n > simple8b.BLOCK:  # the second block alone
        a, b = per_block[0], per_block[0] + per_block[1]
        part = values[simple8b.BLOCK:2 * simple8b.BLOCK]
        assert (simple8b.decode(words[a:b], per_block[1:2], len(part), wide) == part).all()


def test_code_is_dense():
    assert len(simple8b.encode(np.zeros(240 * 4, np.uint64))[0]) == 4
    assert len(simple8b.encode(np.full(60, 1, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(30, 50_000, np.uint64))[0]) == 10
    assert len(simple8b.encode(np.full(40, 30_000, np.uint64))[0]) == 10


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab '\n\t.,1é　\x1c 🙂", max_size=40), max_size=5))
def test_pieces_give_the_ids_of_the_text(plain, texts):
    encoder = tokens.Encoder(PATH, 2)
    ids, lens = encoder.encode(pa.array(texts, pa.string()))
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["word", "Été", "$$$", "&&", "'s", "don't", "\n", "\n\n", "x1", "12", ".", ",\n", "-", "_a", "é", "Ж"]),
                         max_size=7).map("".join), max_size=30).map(" ".join))
def test_lines_and_signs_within_pieces(plain, text):
    ids, _ = tokens.Encoder(PATH, 2).encode(pa.array([text, text + "\n" + text], pa.string()))
    want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in (text, text + "\n" + text)]
    assert ids.tolist() == want[0] + want[1]


def test_pieces_go_to_the_tokenizer_in_stretches(plain, monkeypatch):
    words = [w * (k % 5 + 1) for k in range(40) for w in (f"w{k}", f"Ж{k}é", "🙂", "ß,")]
    text = " ".join(words)
    for call in (1, 16, 100, 1 << 16):
        monkeypatch.setattr(tokens, "CALL", call)
        encoder = tokens.Encoder(PATH, 2)
        found, lens = encoder._behind_blank(pa.array(words, pa.string()))
        want = [plain.encode(" " + w, add_special_tokens=False).ids for w in words]
        assert np.concatenate(found).tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]
        assert encoder.encode(pa.array([text]))[0].tolist() == plain.encode(text, add_special_tokens=False).ids + [2]
        assert encoder._behind_blank(pa.array([], pa.string()))[1].tolist() == []


END = "<|endoftext|>"
NAMED = [f"foo {END} bar{END}", END, f"a b  {END}  c", f"a\n {END}{END}.", f"same {END}", f"same {END}", f" {END} ", "<|endoftext |>",
         "foo bar", f"wörd,{END}!", f"{END[:-1]} {END[1:]}", f"\x1c {END}"]


def test_added_tokens_keep_their_id(plain):
    encoder = tokens.Encoder(PATH, 2)
    for texts in (NAMED, NAMED[::-1]):
        ids, lens = encoder.encode(pa.array(texts, pa.string()))
        want = [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert ids.tolist() == [i for w in want for i in w] and lens.tolist() == [len(w) for w in want]
    assert ids.tolist().count(50256) == sum(t.count(END) for t in NAMED)


def test_documents_with_added_tokens(spark, plain):
    check(spark, plain, list(enumerate(NAMED * 3)))


def expected(plain, rows):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def check(spark, plain, rows, columns="doc_id long, text string"):
    got = tokens.round_trip(spark.createDataFrame(rows, columns), PATH).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(plain, [r[:2] for r in rows])


def test_documents(spark, plain):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()]
    check(spark, plain, [(1000 - 3 * i, t) for i, t in enumerate(texts)])


def test_odd_rows(spark, plain, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 5)
    monkeypatch.setattr(tokens, "SLICE", 100)
    check(spark, plain, [(3, None), (1, ""), (2, "  two  blanks "), (7, "same"), (7, "same"), (None, "no id"),
                         (5, "word " * 60_000), (4, "a\n \nb"), (-9, "negative id")])
    check(spark, plain, [])
    check(spark, plain, [(1, "a b", "x", 5)], "doc_id long, text string, start string, n_tokens int")


def test_retried_task_replaces_its_file(tmp_path):
    folder = f"file://{tmp_path}"
    for attempt in "12":
        writer = tokens.Writer(folder, "part-0.ids", attempt)
        writer.add([1, None], np.array([5, 1 << 20, 2], np.uint32), np.array([2, 1]))
        writer.close()
    assert [p.name for p in tmp_path.iterdir()] == ["part-0.ids"]
    assert [r[:3] for r in tokens.Reader(folder, "part-0.ids").documents()] == [(1, 0, 2), (None, 2, 1)]
