"""Views that give the driver's parquet tables the shapes this package works on.

| view            | from       | meaning                                          |
| --------------- | ---------- | ------------------------------------------------ |
| posts           | lineitem   | one row per post with like / repost / comment     |
| accounts        | supplier   | account dictionary of ``posts``                   |
| posts_at        | events     | posts carrying an ``at`` array of ``@name``       |
| mentions        | events     | already-exploded (src, dst) mentions              |
| users           | events     | account dictionary of the mention graph           |
| follows         | lineitem   | follows edges: consecutive parts of an order      |
| follows_nested  | follows    | owner documents with a ``followsList`` array      |
| parts           | part       | vertex dictionary of the follows graph            |

All reads are plain parquet scans, so Catalyst prunes columns and pushes
filters into them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: (spark, folder, table) -> rows; a stream reader in place of the batch one gives a streaming view
Reader = Callable[[SparkSession, str, str], DataFrame]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str, read: Reader = read_table) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("post_id"),
        F.col("l_suppkey").alias("account"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")).alias("repost"),
        F.col("l_shipdate").cast("timestamp").alias("time"),
        F.col("l_quantity").cast("bigint").alias("like_num"),
        F.col("l_linenumber").cast("bigint").alias("repost_num"),
        (F.col("l_partkey") % 10).cast("bigint").alias("comment_num"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )


def _mention_key() -> F.Column:
    return F.get_json_object("props", "$.k")


def posts_at(spark: SparkSession, sf_dir: str, read: Reader = read_table) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("post_id"),
        F.col("user_id").alias("account"),
        F.col("ts").cast("timestamp").alias("time"),
        F.when(F.col("event_type") == "error", F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("@"), _mention_key())))
        .alias("at"),
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("src"),
        _mention_key().cast("bigint").alias("dst"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account dictionary of the mention graph: every posting user, named by id."""
    ev = read_table(spark, sf_dir, "events")
    return (
        ev.select(F.col("user_id").alias("id"))
        .distinct()
        .select("id", F.col("id").cast("string").alias("name"))
    )


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (src, dst) part pairs on consecutive lines of one order.

    Equi-join on (orderkey, linenumber) – a key with at most a handful of rows
    per value – so it shuffles evenly at any scale.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )
    a = li.select(
        F.col("l_orderkey").alias("ok"),
        (F.col("l_linenumber") + 1).alias("ln"),
        F.col("l_partkey").alias("src"),
    )
    b = li.select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("dst"),
    )
    return a.join(b, ["ok", "ln"]).select("src", "dst").distinct()


def follows_nested(spark: SparkSession, sf_dir: str, members_per_doc: int = 10_000) -> DataFrame:
    """Owner documents ``{id, followsList: [{id}]}``.

    An owner with ``c`` followers is split over ``ceil(c / members_per_doc)``
    documents by member hash, so a document holds about ``members_per_doc``
    members however popular the owner is – no single document or task
    carries a whole hot follower list.  (Counts per owner are a partial
    aggregate joined back.)
    """
    f = follows(spark, sf_dir)
    per_owner = f.groupBy("dst").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(members_per_doc)).cast("bigint").alias("chunks")
    )
    return (
        f.join(per_owner, "dst")
        .groupBy(
            F.col("dst").alias("id"),
            F.pmod(F.xxhash64("src"), F.col("chunks")).alias("chunk"),
        )
        .agg(F.collect_list(F.struct(F.col("src").alias("id"))).alias("followsList"))
        .select("id", "followsList")
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    )
