"""Raw post documents: JSON lines with all fields, the broken ones set aside.

Documents are read with the declared schema (nothing is inferred, no extra
pass).  A line that is no JSON object, or whose fields have other shapes, keeps
its text in ``_line``.  ``judged`` names what is wrong with a document; good
ones are typed, bad ones go to a side table with their reason, and no document
is lost or fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegraph.functions.columns import parse_post_time
from pulsegraph.sources.schemas import RAW_POST_SCHEMA

LINE, REASON = "_line", "_reason"
NUMBERS = {"imgNum": "img_num", "likeNum": "like_num", "repostNum": "repost_num", "commentNum": "comment_num"}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a line, all fields as stored (numbers are text, ``tag`` and ``at`` arrays)."""
    schema = T.StructType([*RAW_POST_SCHEMA.fields, T.StructField(LINE, T.StringType())])
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE).json(path))


def _number(c: str) -> Column:
    return F.trim(c).try_cast("bigint")


def judged(documents: DataFrame) -> DataFrame:
    """``documents`` with the first thing that is wrong with each, null for good ones.

    ``malformed``: no JSON object of this shape.  ``no id``, ``no account``:
    missing or no whole number.  ``<field>``: a measure that is there but is no
    whole number; a missing measure is 0.  A time that cannot be read is not
    wrong: the post is in no time bucket.
    """
    reason = F.when(F.col(LINE).isNotNull(), "malformed").when(_number("id").isNull(), "no id").when(
        _number("account").isNull(), "no account")
    for c in NUMBERS:
        reason = reason.when(F.col(c).isNotNull() & _number(c).isNull(), c)
    return documents.withColumn(REASON, reason)


def typed_documents(good: DataFrame) -> DataFrame:
    """All fields of good documents, typed: eleven columns, ``tags`` and ``mentions`` as arrays (null: empty)."""
    array = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    return good.select(
        _number("id").alias("post_id"), _number("account").alias("account"), "repost", "content",
        array("tag").alias("tags"), array("at").alias("mentions"),
        *[F.coalesce(_number(c), F.lit(0)).alias(out) for c, out in NUMBERS.items()],
        parse_post_time("time").alias("time"))


def load_documents(spark: SparkSession, path: str, quarantine: str) -> DataFrame:
    """The typed good documents of ``path``; the others are written to ``quarantine`` as ``reason, line``.

    A document that could be read, but not used, is written as JSON again.
    """
    all_ = judged(read_documents(spark, path))
    raw = F.to_json(F.struct(*RAW_POST_SCHEMA.names))
    (all_.where(F.col(REASON).isNotNull())
     .select(F.col(REASON).alias("reason"), F.coalesce(LINE, raw).alias("line"))
     .write.parquet(quarantine))
    return typed_documents(all_.where(F.col(REASON).isNull()))
