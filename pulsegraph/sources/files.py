"""Text-file sources: account dictionaries and edge lists.

Both are ``spark.read.text`` + ``split`` – split across executors like any
text input, no driver-side parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegraph.operators.joins import unique_dictionary


def read_dictionary(
    spark: SparkSession, path: str, id_type: str = "bigint", sep: str = r"\s+", unique: bool = True
) -> DataFrame:
    """``<id><blank><name>`` lines -> ``(id, name)``; the name is the rest of
    the line after the first run of blanks.  Blank lines are skipped.
    ``unique``: repeated lines collapse, an id with two names fails."""
    parts = F.split(F.trim(F.col("value")), sep, 2)
    d = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(parts.getItem(0).cast(id_type).alias("id"), parts.getItem(1).alias("name"))
    )
    return unique_dictionary(d) if unique else d


def read_vertex_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``<hash>\\t<id>\\t<name>`` lines -> ``(hash, id, name)``."""
    parts = F.split(F.col("value"), "\t", 3)
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(
            parts.getItem(0).cast("int").alias("hash"),
            parts.getItem(1).alias("id"),
            parts.getItem(2).alias("name"),
        )
    )


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """``<src> <dst>`` per line; ``#`` lines are comments.  Duplicates and
    self-loops are kept; ids may be negative."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return (
        spark.read.text(path)
        .filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
        .select(parts.getItem(0).cast("bigint").alias("src"), parts.getItem(1).cast("bigint").alias("dst"))
    )
