"""Corpus pipeline: documents to be trained on, from ``documents`` to token digests.

Each stage works on all that the one before kept and applies one operator of
``pulsegraph.llm``; all but the last return the columns of ``documents``.
Between stages the documents are written as Parquet under the shared
checkpoint folder and read again, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegraph.llm import dedup, mixing, ngram_join, toxicity
from pulsegraph.llm.common import documents, materialise
from pulsegraph.llm.registry import bpe_round_trip

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest id stays."""
    return dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, in whole times."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return bpe_round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("source mix", mix_sources),
    ("bpe", tokenize),
]

#: trained dictionaries and BPE have no SQL; the tests hold run() against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "-"))
    return docs
