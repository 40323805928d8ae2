"""Sharding by jump consistent hashing (DataFrame functions only).

A key jumps through the shard counts 1, 2, 3, ... at which it would move; the
last jump below the number of shards is its shard.  The jumps come from a hash
of (key, step), so no ring table exists, every executor computes the same
shard, and appending a shard moves only the rows that the new shard takes -
one in ``shards + 1`` of them.

Slots within a shard are numbered from 0 without gaps by a two-level running
count (``common.running_total``): a shard is never one task.

Defined results: null text has size 16 and checksum 0; all rows with a null
id share one shard (they have one key); rows that repeat get slots of their
own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegraph.llm.common import buckets_for, materialise, row_key, running_total, text_or_empty

ROW_OVERHEAD = 16


def jump_hash(key: Column, shards: int) -> Column:
    """Shard of ``key`` (a string column) among ``shards``.

    Step i draws r in (0, 1] from hash(key, i) and jumps from b to
    floor((b + 1) / r).  Every jump goes up by one at least, so ``shards``
    steps always suffice.
    """
    def step(at: Column, i: Column) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key, i), 33) + F.lit(1)
        jump = F.floor((at["jump"] + 1) * (F.lit(float(1 << 31)) / draw))
        return F.when(at["jump"] < shards, F.struct(at["jump"].alias("shard"), jump.alias("jump"))
                      ).otherwise(at)

    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("jump"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step,
                       lambda at: at["shard"].cast("int"))


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: one row per input row."""
    key = row_key(id_col)
    rows = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long")
             + ROW_OVERHEAD).alias("size"),
            F.crc32(text_or_empty(text_col)).alias("text_crc32"),
            jump_hash(key, shards).alias("shard"),
            jump_hash(key, shards + 1).alias("grown_shard"),
            F.xxhash64(F.lit("slot"), key).alias("__order")),
        "shards")
    count = rows.count()
    rows = rows.withColumn("__bucket", F.pmod("__order", F.lit(buckets_for(count))))
    slotted = running_total(rows, ["shard"], "__bucket",
                            ["__order", "doc_id", "text_crc32", "size"], F.lit(1), "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                          F.col("slot").cast("long").alias("slot"), "grown_shard")
