"""Explicit schemas: nothing is inferred at read time."""

from pyspark.sql import types as T

# A post document as the upstream crawler stores it: every measure is text.
RAW_POST_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("repost", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("tag", T.ArrayType(T.StringType())),
        T.StructField("at", T.ArrayType(T.StringType())),
        T.StructField("imgNum", T.StringType()),
        T.StructField("likeNum", T.StringType()),
        T.StructField("repostNum", T.StringType()),
        T.StructField("commentNum", T.StringType()),
        T.StructField("time", T.StringType()),
    ]
)

# The typed post used by every operator in this package.
POST_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("account", T.LongType()),
        T.StructField("repost", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("like_num", T.LongType()),
        T.StructField("repost_num", T.LongType()),
        T.StructField("comment_num", T.LongType()),
    ]
)

ACCOUNT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)

FOLLOWS_DOC_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField(
            "followsList", T.ArrayType(T.StructType([T.StructField("id", T.LongType())]))
        ),
    ]
)

EDGE_SCHEMA = T.StructType(
    [T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())]
)

# Post time format of the upstream documents.
POST_TIME_FORMAT = "yyyy-MM-dd HH:mm"
