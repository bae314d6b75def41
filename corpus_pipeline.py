"""The corpus pipeline: from raw documents to files of token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; what it returns is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waybill.llm import decontaminate, mixing, simhash, tokens, toxicity
from waybill.llm.common import drop, noted, stage, work_folder

#: Trained models and random rounding have no SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go."""
    return toxicity.clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within 4 bits of SimHash stays, that of the smallest id."""
    return simhash.keep_one(docs, width=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"), width=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources weigh 5, 2, 1 in turn, none over 3 times its size."""
    return mixing.copied(docs, weights=(5, 2, 1), cap=3)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Files of token ids in order of doc_id, read back: place, length and checksum of every document taken."""
    return tokens.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix),
    ("token_id_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again; what a stage has staged goes once its result is written."""
    folder, docs = work_folder(spark), _table(spark, sf_dir, "documents")
    for name, step in STAGES:
        with noted() as made:
            docs = stage(step(spark, docs, sf_dir), folder, name)
        for used in made:
            drop(spark, used)
    return docs
