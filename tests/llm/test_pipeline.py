"""The pipeline: each stage on its own input against brute force, and the whole chain."""

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm import test_decontaminate, test_simhash, test_tokens
from waybill.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("steps")
    found = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, step in corpus_pipeline.STAGES:
        step(spark, found[-1], FOLDER).write.parquet(str(root / name))
        found.append(spark.read.parquet(str(root / name)))
    return found


def test_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    assert steps[-1].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_toxicity_stage(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    toxic = {r.doc_id for r in toxicity.report(steps[0], labels).collect() if r.toxic}
    assert {r.doc_id for r in steps[1].collect()} == {r.doc_id for r in steps[0].collect()} - toxic


def test_near_dedup_stage(steps):
    rows = steps[1].collect()
    fps = [test_simhash.brute_fingerprint(r.text) for r in rows]
    ids = [r.doc_id for r in rows]
    assert {r.doc_id for r in steps[2].collect()} == set(test_simhash.brute_components(fps, ids, 4)) and len(set(ids)) == len(ids)


def test_decontamination_stage(spark, steps):
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in steps[2].collect()], bench) if not r[-1]}
    assert {r.doc_id for r in steps[3].collect()} == want and len(want) < steps[2].count()


def test_mixing_stage(steps):
    want = {r.doc_id: r.copies for r in mixing.mix(steps[3]).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in steps[4].groupBy("doc_id").count().collect()} == want


def test_token_stage(steps):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = test_tokens.expected(plain, [(r.doc_id, r.text) for r in steps[4].collect()])
    assert sorted(map(tuple, steps[5].collect()), key=lambda r: r[1]) == want


def test_run_is_the_registered_query(spark, steps):
    got = __spark_entry__.queries()["pipeline"](spark, FOLDER)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[5].collect()))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()


def test_odd_documents(spark, tmp_path):
    rows = [(1, None, "en", None, 0), (2, "", "en", "a", 0), (None, "some text here", None, "a", 5), (3, "x " * 9000, "de", "b", 9),
            (3, "x " * 9000, "de", "b", 9), (4, "other words", "en", "b", None)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    for some in (rows, []):
        docs = spark.createDataFrame(some, shape)
        for name, step in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}{len(some)}")
            step(spark, docs, FOLDER).write.parquet(path)
            docs = spark.read.parquet(path)
        assert len(docs.collect()) <= 3 * len(some)
