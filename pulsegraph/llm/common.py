"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegraph.session import scratch_path

#: a word is a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(name: str = "doc_id") -> Column:
    """A join key that also matches null ids with each other."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back.

    Cuts the lineage, so what follows survives lost executors without
    recomputing ``df``.  Hadoop removes the folder when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def buckets_for(rows: int) -> int:
    """Buckets per key of a running total: rows in a bucket and buckets of a
    key both grow as the square root of the rows."""
    return max(1, math.isqrt(rows) // 4)


def running_total(df: DataFrame, keys: list[str], bucket: str, order: list[str],
                  value: Column, out: str) -> DataFrame:
    """Exclusive running sum of ``value`` per ``keys`` in (bucket, order) order.

    A key that holds a third of all rows is no single task: rows are summed
    within (keys, bucket) and each bucket starts at the sum of the buckets
    before it.  Only one row per (keys, bucket) meets in a per-key window.
    ``df`` is read twice, so pass a materialised or narrow table; ``keys`` and
    ``bucket`` must not be null.
    """
    parts = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__part"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*keys, bucket,
                           F.coalesce(F.sum("__part").over(before), F.lit(0)).alias("__offset"))
    within = (Window.partitionBy(*keys, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (df.join(offsets, [*keys, bucket])
            .withColumn(out, F.col("__offset") + F.coalesce(F.sum(value).over(within), F.lit(0)))
            .drop("__offset"))


#: CTE ``crc_table`` of DuckDB SQL: one row with the 256 steps of crc32, from its polynomial
CRC32_SQL = """crc_table AS (SELECT list(crc ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x:
        CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS crc
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned crc32 of ``text`` in UTF-8, in a query that also reads ``crc_table``."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    value = "(instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1"
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), "
            f"list_transform({pairs}, lambda x: CAST({value} AS BIGINT))), "
            f"lambda c, b: xor(steps[xor(c % 256, b) + 1], c // 256)))")
