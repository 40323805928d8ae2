"""Collections by entity: one bucketed table instead of a collection per account.

The rows of an entity lie in one of ``buckets`` buckets, sorted by entity.  The
number of buckets follows from the bytes of the input and is stored, with the
schema, in a manifest beside the data, so that any session can open the table
with its layout:

* reading one entity opens one bucket's files, and its row groups' bounds skip
  the other entities in them;
* tables of the same key and bucket count join and aggregate by entity without
  an exchange;
* an entity with very many rows makes its bucket large, so a bucket may be
  written by several tasks, each into a file of its own.

An append keeps the stored count; rewrite the table when it has outgrown it.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_entities.json"
#: bytes of input that a bucket should hold
BUCKET_BYTES = 256 * 1024 * 1024
#: one entity's read should touch a small part even of a small table
LEAST_BUCKETS, MOST_BUCKETS = 128, 100_000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, from their listing; nothing is scanned."""
    total = 0
    for file in df.inputFiles():
        p, fs = _fs(df.sparkSession, file)
        total += fs.getFileStatus(p).getLen()
    return total


def bucket_count(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, math.ceil(size / bucket_bytes)))


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    p, fs = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)  # Spark's readers skip names that begin with an underscore
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    p, fs = _fs(spark, f"{path}/{MANIFEST}")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(manifest), "utf-8"))
    out.close()


def write_entities(df: DataFrame, path: str, key: str, buckets: int | None = None, mode: str = "overwrite") -> int:
    """Write ``df`` bucketed by ``key`` and return the bucket count; the manifest is written last.

    ``mode="append"`` takes the count and checks the key of the table that is there.
    """
    spark, size = df.sparkSession, input_bytes(df)
    known = read_manifest(spark, path) if mode == "append" else None
    if known:
        if known["key"] != key:
            raise ValueError(f"the table is bucketed by {known['key']}, not by {key}")
        buckets, size = known["buckets"], known["bytes"] + size
    n = buckets or bucket_count(size)
    # the bucket of a row, as Spark's bucketed writer computes it
    bucketed = df.withColumn("__bucket", F.pmod(F.hash(F.col(key)), F.lit(n)))
    table = f"entities_{uuid.uuid4().hex}"
    rows = bucketed.hint("rebalance", F.col("__bucket")).drop("__bucket")
    if known:
        _register(spark, table, path, known)
        rows.write.mode("append").bucketBy(n, key).sortBy(key).format("parquet").saveAsTable(table)
    else:
        rows.write.mode("overwrite").bucketBy(n, key).sortBy(key).format("parquet").option("path", path).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: the data lie at ``path``
    _write_manifest(spark, path, {"key": key, "buckets": n, "bytes": size, "schema": df.schema.jsonValue()})
    return n


def _register(spark: SparkSession, table: str, path: str, manifest: dict) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                        for f in T.StructType.fromJson(manifest["schema"]).fields)
    key = manifest["key"]
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {manifest['buckets']} BUCKETS LOCATION '{path}'")


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """The whole table with its layout, from its manifest; filter it by the key to read one entity."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        raise FileNotFoundError(f"no {MANIFEST} in {path}")
    table = f"entities_{uuid.uuid4().hex}"
    _register(spark, table, path, manifest)
    df = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return df
