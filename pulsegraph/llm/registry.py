"""The ``opN_*`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegraph.llm import (bpe, conversations, dedup, html_text, licenses, mixing, ngram_join, quality, secrets, sharding,
                            simhash, spelling, toxicity)
from pulsegraph.llm.common import documents

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SHARDS = 40


def bpe_round_trip(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Digests of the token ids and of the text they decode to."""
    return bpe.round_trip(docs, tokenizer).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(documents(spark, sf_dir))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("places")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(documents(spark, sf_dir))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(documents(spark, sf_dir))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir), SHARDS)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.classify(documents(spark, sf_dir), labels)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_digest(documents(spark, sf_dir))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered text of every page, its length and digest."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return html_text.extract(pages).select(
        "page_id", F.length("text").cast("long").alias("n_chars"), "text", F.sha2("text", 256).alias("text_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_forms(spelling.damaged_runs(documents(spark, sf_dir)))


def op12_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and their cheapest repair, as counts, edits and a digest."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return conversations.repair_digest(conversations.damaged(rows), rows.select("conv_id"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.quality_verdicts(documents(spark, sf_dir), labels)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_mix": op3_mix,
    "op4_simhash": op4_simhash,
    "op5_ngram_join": op5_ngram_join,
    "op6_secrets": op6_secrets,
    "op7_shard": op7_shard,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_html_text": op10_html_text,
    "op11_spelling": op11_spelling,
    "op12_conversation": op12_conversation,
    "op13_quality": op13_quality,
}

ORACLE_SQL: dict[str, str] = {"op2_exact_dedup": OP2_SQL, "op11_spelling": spelling.VARIANT_SQL,
                              "op12_conversation": conversations.repair_sql(), "op13_quality": quality.verdict_sql()}
