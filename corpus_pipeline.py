"""A corpus from raw documents: rules, language, near-duplicates, mixture, sequences."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimload.llm import language_id, mixing, packing, quality_rules, simhash
from dimload.sources import files
from dimload.sources.scratch import scratch_dir


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that a host repeats."""
    return quality_rules.clean_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents themselves are marked with."""
    return language_id.in_a_language(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: three-word shingles, two bits."""
    return simhash.one_of_each(docs, shingle=3, max_bits=2)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix of sources takes."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, and their places in sequences of one length."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)


STAGES = [
    ("quality rules", rules),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]

#: Language models, fingerprints and token ids are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again.

    A stage's rows are deleted once the next one's are written; the last one's stay for the caller."""
    folder = f"{scratch_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            files.delete(spark, f"{folder}/{k - 1}")
    return docs
