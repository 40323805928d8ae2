"""Registered queries over mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegraph.operators import mentions as M
from pulsegraph.operators import posts as P
from pulsegraph.plans.registry import query
from pulsegraph.plans.sqlviews import with_views
from pulsegraph.sources import tables as T

EXPLODED_SQL = """exploded AS (
    SELECT post_id, account, substr(m, 2) AS name
    FROM (SELECT post_id, account, unnest("at") AS m FROM posts_at WHERE len("at") > 0) x)"""
KNOWN_SQL = """known AS (
    SELECT e.post_id, e.account, e.name, u.id AS target FROM exploded e JOIN users u ON u.name = e.name)"""


def _exploded(spark, d):
    return M.mentions_exploded(T.posts_at(spark, d))


def _known(spark, d):
    return M.mentions_known(_exploded(spark, d), T.users(spark, d))


@query("posts_with_mentions", operators=("P-7", "F-1", "E-15"), sql=with_views("posts_at") + """
SELECT post_id, account, array_to_string("at", ',') AS mentions FROM posts_at WHERE len("at") > 0""")
def posts_with_mentions(spark, d):
    p = P.posts_with_mentions(T.posts_at(spark, d))
    return p.select("post_id", "account", F.concat_ws(",", "at").alias("mentions"))


@query("mentions_exploded", operators=("X-1", "E-1"),
       sql=with_views("posts_at", extra=EXPLODED_SQL) + "SELECT * FROM exploded")
def mentions_exploded(spark, d):
    return _exploded(spark, d)


@query("mentions_known", operators=("F-2", "J-3", "E-5"),
       sql=with_views("posts_at", "users", extra=EXPLODED_SQL + ",\n" + KNOWN_SQL)
       + "SELECT * FROM known")
def mentions_known(spark, d):
    return _known(spark, d)


@query("mention_counts", operators=("A-1",),
       sql=with_views("posts_at", "users", extra=EXPLODED_SQL) + """
SELECT name, count(*) AS num FROM exploded WHERE name IN (SELECT name FROM users) GROUP BY name""")
def mention_counts(spark, d):
    return M.mention_counts(_exploded(spark, d), T.users(spark, d))


@query("mention_edge_counts", operators=("A-2",),
       sql=with_views("posts_at", "users", extra=EXPLODED_SQL + ",\n" + KNOWN_SQL) + """
SELECT account AS src, target AS dst, count(*) AS at_num FROM known GROUP BY ALL""")
def mention_edge_counts(spark, d):
    return M.mention_edge_counts(_known(spark, d))


@query("at_edges", operators=("A-4", "F-5", "V-3"),
       sql=with_views("at_edges") + "SELECT src, dst, weight FROM at_edges")
def at_edges(spark, d):
    return M.at_edges(T.mentions(spark, d), T.users(spark, d))


@query("account_totals", operators=("A-10", "J-4", "E-13"),
       sql=with_views("posts", "posts_at", "users", extra=EXPLODED_SQL + ",\n" + KNOWN_SQL) + """
SELECT coalesce(a.account, b.account) AS account,
       coalesce(a.like_num, 0) AS like_num, coalesce(a.repost_num, 0) AS repost_num,
       coalesce(a.comment_num, 0) AS comment_num, coalesce(b.at_num, 0) AS at_num
FROM (SELECT account, CAST(sum(like_num) AS BIGINT) AS like_num,
             CAST(sum(repost_num) AS BIGINT) AS repost_num,
             CAST(sum(comment_num) AS BIGINT) AS comment_num
      FROM posts GROUP BY account) a
FULL OUTER JOIN (SELECT target AS account, count(*) AS at_num FROM known GROUP BY target) b
  ON a.account = b.account""")
def account_totals(spark, d):
    return M.account_totals(T.posts(spark, d), _known(spark, d))
