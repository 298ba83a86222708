"""Corpus pipeline: from ``documents`` to a tokenized training mix, in five stages.

Each stage calls one operator of ``civicmart.llm`` on all that the stage before it kept. Between
stages the documents are written as Parquet to the shared checkpoint folder and read again, so a
lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civicmart.llm import lines, mixing, pieces, quality, simhash
from civicmart.llm.common import saved
from civicmart.llm.queries import MODEL, bounded_batches


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.kept(docs, quality.CURRENT)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has already are cut out."""
    bounded_batches(spark)
    return lines.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document is there as often as the mix takes it."""
    return mixing.mixed(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text of the mix."""
    bounded_batches(spark)
    return pieces.digests(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: Fingerprints, rounding draws and encodings are beyond SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
