"""Exact dedup with a heavy-hitter split (DataFrame functions only).

1. Every text becomes its SHA-256; the (id, digest) table is written once and
   whole texts are never shuffled.
2. A frequent-items sketch (the mergeable Misra-Gries family, Spark's
   ``approx_top_k_*``) over the digests' first 60 bits names at most
   ``counters`` candidates.  Sketches merge in two levels, so no task receives
   one sketch per input split.
3. The candidates are verified by an exact count per full digest.  Verified
   winners (at most ``counters`` rows, one per candidate) are broadcast; their
   losing copies are decided on the map side and never shuffled.
4. What remains - one row or few per heavy digest, and every other digest - is
   decided by an ordinary shuffle on the digest.

Defined results: null text counts as empty; of equal texts the largest id
stays, null ids rank below all others; of rows that repeat both id and text
one stays; an empty table gives no rows.  Extra columns are ignored, whatever
they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegraph.llm.common import fresh, materialise, row_key, text_or_empty

#: sketches of the first level; the second level merges as many
FAN_IN = 64


def heavy_digests(digests: DataFrame, counters: int) -> DataFrame:
    """Verified frequent digests: ``digest, winner_id, winner_rows`` (at most ``counters`` rows)."""
    sketches = (
        digests.select("prefix", F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part"))
        .groupBy("part")
        .agg(F.expr(f"approx_top_k_accumulate(prefix, {counters})").alias("sketch"))
    )
    candidates = (
        # grouped, since a global combine fails on partitions without any sketch
        sketches.groupBy((F.col("part") * 0).alias("all"))
        .agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"))
        .select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {counters})")).alias("top"))
        .where(F.col("top.item").isNotNull() & (F.col("top.count") > 1))
        .select(F.col("top.item").alias("prefix"))
    )
    exact = (
        digests.join(F.broadcast(candidates), "prefix")
        .groupBy("prefix", "digest")
        .agg(F.count(F.lit(1)).alias("winner_rows"), F.max("doc_id").alias("winner_id"))
        .where("winner_rows > 1")
    )
    # one digest per candidate keeps the broadcast within its bound
    return (
        exact.groupBy("prefix")
        .agg(F.max(F.struct("winner_rows", "digest", "winner_id")).alias("w"))
        .select("w.digest", "w.winner_id", "w.winner_rows")
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = 10_000) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per input row."""
    digests = materialise(
        docs.select(F.col(id_col).alias("doc_id"),
                    F.sha2(text_or_empty(text_col), 256).alias("sha"))
        .select("doc_id", F.unhex("sha").alias("digest"),
                F.conv(F.substring("sha", 1, 15), 16, 10).cast("long").alias("prefix")),
        "digests")
    winners = materialise(heavy_digests(digests, counters), "winners")
    marked = digests.drop("prefix").join(F.broadcast(winners), "digest", "left")
    loses = F.col("winner_rows").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("winner_id"))
    removed = marked.where(loses).select(
        "doc_id", F.col("winner_id").alias("keep_id"), F.col("winner_rows").alias("group_size"),
        F.lit(False).alias("kept"), "digest")
    same = Window.partitionBy("digest")
    rest = marked.where(~loses).select(
        "doc_id",
        F.max("doc_id").over(same).alias("keep_id"),
        F.coalesce("winner_rows", F.count(F.lit(1)).over(same)).alias("group_size"),
        (F.row_number().over(same.orderBy(F.col("doc_id").desc_nulls_last())) == 1).alias("kept"),
        "digest")
    return removed.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Texts move once, in the join with the kept ids; rows that repeat id and
    text meet in the same task and leave one.
    """
    key, sha = fresh(docs, "__key"), fresh(docs, "__sha")
    keep = exact_duplicates(docs).where("kept").select(row_key().alias(key), F.col("text_sha256").alias(sha))
    return (
        docs.withColumn(key, row_key()).withColumn(sha, F.sha2(text_or_empty(), 256))
        .join(keep, [key, sha], "left_semi")
        .dropDuplicates([key, sha])
        .drop(key, sha)
    )
