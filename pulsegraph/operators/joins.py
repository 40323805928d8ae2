"""Join helpers: dictionary lookups and membership tests.

The joins are plain: no rows are counted and no job runs while a query is
built.  AQE converts a join to a broadcast when the measured bytes of a side
are under ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed shuffle
partitions otherwise, so a dictionary that grows with the data is never
shipped to every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    dictionary: DataFrame,
    key: str,
    dict_key: str = "id",
    value: str = "name",
    out: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Attach ``dictionary[value]`` to ``df`` by ``df[key] == dictionary[dict_key]``.

    ``strict=False``: inner join, unmatched rows dropped.
    ``strict=True``: every key must be known; an unknown key fails the job
    (``raise_error``), like a map lookup that throws.
    The dictionary must be unique on ``dict_key``: repeated rows collapse, a
    key with two values fails the job.
    """
    out = out or value
    d = unique_dictionary(dictionary, dict_key, value).select(F.col(dict_key).alias("__k"), F.col(value).alias(out))
    if not strict:
        return df.join(d, df[key] == d["__k"], "inner").drop("__k")
    joined = df.join(d, df[key] == d["__k"], "left")
    checked = F.when(
        F.col("__k").isNull(),
        F.raise_error(F.concat(F.lit("unknown key in lookup: "), F.col(key).cast("string"))),
    ).otherwise(F.col(out))
    return joined.withColumn(out, checked.cast(d.schema[out].dataType)).drop("__k")


def semi_join_known(
    df: DataFrame, dictionary: DataFrame, key: str | Column, dict_key: str = "id",
) -> DataFrame:
    """Keep rows whose key is in the dictionary (membership test, no duplicates added)."""
    d = dictionary.select(F.col(dict_key).alias("__k"))
    k = F.col(key) if isinstance(key, str) else key
    return df.join(d, k == d["__k"], "left_semi")


def unique_dictionary(dictionary: DataFrame, key: str = "id", value: str = "name") -> DataFrame:
    """One row per key.  Identical duplicate rows collapse; a key mapped to two
    different values fails the job (a map built in arbitrary order would keep
    an arbitrary one).  Lazy and distributed: one partial aggregate, no extra job."""
    agg = dictionary.groupBy(key).agg(
        F.min(value).alias("__lo"), F.max(value).alias("__hi")
    )
    return agg.select(
        key,
        F.when(
            F.col("__lo") != F.col("__hi"),
            F.raise_error(F.concat(F.lit("conflicting dictionary entries for key "), F.col(key).cast("string"))),
        ).otherwise(F.col("__lo")).cast(dictionary.schema[value].dataType).alias(value),
    )
