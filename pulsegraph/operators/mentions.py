"""Mentions: explode, clean, whitelist, count; mention-weighted edges; totals.

Cleaning order (matters): strip the leading character, then whitelist the
name against the account dictionary, then map the name to the account id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegraph.functions.columns import strip_first_char
from pulsegraph.operators.heat import MEASURES
from pulsegraph.operators.joins import semi_join_known, unique_dictionary


def mentions_exploded(posts_at: DataFrame, at: str = "at") -> DataFrame:
    """One row per mention (a name repeated in one post counts each time)."""
    return (
        posts_at.filter(F.size(at) > 0)
        .select("post_id", "account", F.explode(at).alias("__m"))
        .select("post_id", "account", strip_first_char("__m").alias("name"))
    )


def mentions_known(exploded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Whitelist mention names and map them to account ids (``target``).

    A name must have one id: repeated rows collapse, two ids fail the job.
    """
    d = unique_dictionary(dictionary, "name", "id").select(F.col("name").alias("__n"), F.col("id").alias("target"))
    return exploded.join(d, exploded["name"] == d["__n"], "inner").drop("__n")


def mention_counts(exploded: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Mentions received per known name."""
    known = semi_join_known(exploded, dictionary, "name", dict_key="name")
    return known.groupBy("name").agg(F.count(F.lit(1)).alias("num"))


def mention_edge_counts(known: DataFrame) -> DataFrame:
    """Directed mention weights (source account, mentioned account)."""
    return known.groupBy(F.col("account").alias("src"), F.col("target").alias("dst")).agg(
        F.count(F.lit(1)).alias("at_num")
    )


def at_edges(mentions: DataFrame, dictionary: DataFrame, min_weight_exclusive: int = 1) -> DataFrame:
    """Mention graph: (src, dst) pairs mentioned more than ``min_weight_exclusive``
    times, restricted to known targets.  Self-mentions are kept."""
    known = semi_join_known(mentions, dictionary, "dst")
    return (
        known.groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
        .filter(F.col("weight") > min_weight_exclusive)
    )


def account_totals(posts: DataFrame, known_mentions: DataFrame) -> DataFrame:
    """Σ measures of an account's posts and Σ mentions it received, zero-filled.

    A full outer join of two aggregates, written as union-then-aggregate: one
    shuffle instead of three, and the same form runs as a streaming aggregate.
    """
    zero = F.lit(0).cast("bigint")
    measures = posts.select("account", *[F.col(m).cast("bigint").alias(m) for m in MEASURES],
                            zero.alias("at_num"))
    received = known_mentions.select(
        F.col("target").alias("account"), *[zero.alias(m) for m in MEASURES],
        F.lit(1).cast("bigint").alias("at_num"),
    )
    return (
        measures.unionByName(received)
        .groupBy("account")
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in (*MEASURES, "at_num")])
    )
