"""Sinks: partitioned tables, leaderboard / ranking documents, text exports.

Documents are built with ``to_json(struct(...))`` (correct escaping) on the
executors and written by the executors; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append", fmt: str = "parquet"
) -> None:
    """One pass writes every target (e.g. one folder per month).

    Rows are first rebalanced by the folder keys: AQE splits large folders over
    several tasks and merges small ones, so a task opens few folders.
    """
    df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)


def leaderboard_documents(boards: DataFrame, key_name: str = "name") -> DataFrame:
    """``(measure, month, position, name, value)`` -> ``(measure, month, doc)``,
    doc = ``{"time": month, "rankList": [{"name", "rank"}, ...]}`` in position
    order.  A group holds at most top-n rows."""
    entries = F.sort_array(
        F.collect_list(F.struct("position", F.col(key_name).alias("name"), F.col("value").alias("rank")))
    )
    return boards.groupBy("measure", "month").agg(
        F.to_json(
            F.struct(
                F.col("month").alias("time"),
                F.transform(entries, lambda e: F.struct(e["name"].alias("name"), e["rank"].alias("rank"))).alias(
                    "rankList"
                ),
            )
        ).alias("doc")
    )


def leaderboard_lines(docs: DataFrame) -> DataFrame:
    """``month<TAB>doc`` lines, per measure."""
    return docs.select("measure", "month", F.concat_ws("\t", "month", "doc").alias("line"))


def write_leaderboard_text(docs: DataFrame, path: str) -> None:
    """One text file per measure, lines in month order (months per measure are
    bounded by the calendar, so one partition per measure is small)."""
    (
        leaderboard_lines(docs)
        .repartition("measure")
        .sortWithinPartitions("measure", "month")
        .select("measure", F.col("line").alias("value"))
        .write.mode("overwrite")
        .partitionBy("measure")
        .text(path)
    )


def write_leaderboard_json(docs: DataFrame, path: str) -> None:
    """One JSON document per (measure, month): ``<path>/measure=../month=../``.

    The documents are spread over a fixed number of write tasks by their
    folder keys (explicit count, so AQE does not fold them into one task that
    would create every file alone); each task writes only its own folders.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.repartition(n, "measure", "month")
        .select("measure", "month", F.col("doc").alias("value"))
        .write.mode("overwrite")
        .partitionBy("measure", "month")
        .text(path)
    )


def ranking_document(scores: DataFrame, value: str, n: int, key: str = "id", name: str = "name") -> DataFrame:
    """``{"rankList": [{"name", "rank"}, ...]}`` of the top ``n`` by ``value``
    (ties: smaller key first).  Top-n first, so the single document stays
    small; ``write_ranking`` writes a full ranking as rows."""
    top = scores.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n)
    entries = F.sort_array(
        F.collect_list(F.struct((-F.col(value)).alias("o"), F.col(key).alias("k"),
                                F.col(name).alias("name"), F.col(value).alias("rank")))
    )
    return top.agg(
        F.to_json(
            F.struct(F.transform(entries, lambda e: F.struct(e["name"].alias("name"), e["rank"].alias("rank")))
                     .alias("rankList"))
        ).alias("doc")
    )


def write_ranking(ranking: DataFrame, path: str) -> None:
    """All rows of a ranking as JSON lines ``{"position", "id", "name", "rank"}``,
    range-partitioned by position: the files in name order hold the ranking in order."""
    n = int(ranking.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranking.repartitionByRange(n, "position").sortWithinPartitions("position").write.mode("overwrite").json(path)


def edge_list_lines(edges: DataFrame, header: str | None = None) -> DataFrame:
    lines = edges.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    if header is not None:
        lines = lines.sparkSession.createDataFrame([(f"# {header}",)], "value string").union(lines)
    return lines


def write_edge_list(edges: DataFrame, path: str, header: str | None = None) -> None:
    edge_list_lines(edges, header).write.mode("overwrite").text(path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """``<id> <name>`` lines."""
    dictionary.select(F.concat_ws(" ", F.col("id").cast("string"), "name").alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_vertex_dictionary(vd: DataFrame, path: str) -> None:
    """``<hash>\\t<id>\\t<name>`` lines."""
    vd.select(F.concat_ws("\t", F.col("hash").cast("string"), F.col("id").cast("string"), "name").alias("value")
              ).write.mode("overwrite").text(path)
