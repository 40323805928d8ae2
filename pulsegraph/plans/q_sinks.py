"""Registered sink / file-source round trips: write with the sink, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegraph.functions.columns import month_of_text
from pulsegraph.operators import graph as G
from pulsegraph.operators import heat as H
from pulsegraph.operators.joins import lookup
from pulsegraph.plans import q_graph, q_posts  # noqa: F401  (oracles reused)
from pulsegraph.plans.registry import REGISTRY, query
from pulsegraph.plans.sqlviews import with_views
from pulsegraph.session import scratch_path
from pulsegraph.sinks import entities as E
from pulsegraph.sinks import writers as W
from pulsegraph.sources import files as FS
from pulsegraph.sources import tables as T
from pulsegraph.operators import posts as P

#: the features of these queries are the read of one account and of one month
ONE_ACCOUNT, ONE_MONTH = 7, "1996-03"

_BOARDS_SQL = """boards AS (
    SELECT measure, month, account, value,
           row_number() OVER (PARTITION BY measure, month ORDER BY value DESC, account ASC) AS position
    FROM (SELECT month, account, 'like' AS measure, like_heat AS value FROM SERIES
          UNION ALL SELECT month, account, 'repost', repost_heat FROM SERIES
          UNION ALL SELECT month, account, 'comment', comment_heat FROM SERIES
          UNION ALL SELECT month, account, 'total', total_heat FROM SERIES) s),
docs AS (
    SELECT b.measure, b.month,
           CAST(to_json(struct_pack(time := b.month,
                rankList := list(struct_pack(name := a.name, rank := b.value) ORDER BY b.position))) AS VARCHAR) AS doc
    FROM boards b JOIN accounts a ON a.id = b.account
    WHERE b.position <= 5 GROUP BY b.measure, b.month)"""


def _docs(spark, d, cumulative=False):
    """Leaderboard documents on the half-life series (what the upstream code
    computes) or on the plain running total (what its published files show)."""
    monthly = H.monthly_measures(T.posts(spark, d))
    series = H.heat_cumulative_series(monthly) if cumulative else H.heat_decay_series(monthly)
    boards = H.leaderboards(H.heat_total(series), n=5)
    return W.leaderboard_documents(lookup(boards, T.accounts(spark, d), "account", strict=True))


@query("leaderboard_text", operators=("K-3", "O-2", "E-10", "E-11"),
       sql=with_views("decay_total", "accounts", extra=_BOARDS_SQL.replace("SERIES", "decay_total")) + """
SELECT measure, month || chr(9) || doc AS line FROM docs""")
def leaderboard_text(spark, d, cumulative=False):
    path = scratch_path(spark, "leaderboard-text")
    W.write_leaderboard_text(_docs(spark, d, cumulative), path)
    return spark.read.schema("value string, measure string").text(path).select(
        "measure", F.col("value").alias("line")
    )


query("leaderboard_text_cumulative", operators=("K-3", "A-6"),
      sql=with_views("cumulative_total", "accounts", extra=_BOARDS_SQL.replace("SERIES", "cumulative_total")) + """
SELECT measure, month || chr(9) || doc AS line FROM docs""")(
    lambda spark, d: leaderboard_text(spark, d, cumulative=True)
)


@query("leaderboard_json", operators=("K-4", "E-10"),
       sql=with_views("decay_total", "accounts", extra=_BOARDS_SQL.replace("SERIES", "decay_total")) + """
SELECT measure, month, doc FROM docs""")
def leaderboard_json(spark, d):
    path = scratch_path(spark, "leaderboard-json")
    W.write_leaderboard_json(_docs(spark, d), path)
    return spark.read.schema("value string, measure string, month string").text(path).select(
        "measure", "month", F.col("value").alias("doc")
    )


@query("ranking_json", operators=("K-5", "O-1"), sql=with_views("follows", "parts") + """
SELECT CAST(to_json(struct_pack(rankList := list(struct_pack(name := name, rank := degree)
                                                ORDER BY degree DESC, id ASC))) AS VARCHAR) AS doc
FROM (SELECT d.id, p.name, d.degree
      FROM (SELECT dst AS id, count(*) AS degree FROM follows GROUP BY dst) d JOIN parts p ON p.id = d.id
      ORDER BY d.degree DESC, d.id ASC LIMIT 10) t""")
def ranking_json(spark, d):
    scores = G.named(G.in_degree(T.follows(spark, d)), T.parts(spark, d))
    return W.ranking_document(scores, "degree", 10)


@query("ranking_rows", operators=("K-5", "O-1"), sql=REGISTRY["ranking_in_degree_follows"].sql)
def ranking_rows(spark, d):
    """The whole in-degree ranking, written as ordered JSON lines and read back."""
    path = scratch_path(spark, "ranking")
    W.write_ranking(REGISTRY["ranking_in_degree_follows"].fn(spark, d), path)
    return spark.read.schema("position bigint, id bigint, name string, value bigint").json(path)


@query("edge_list", operators=("S-6", "K-6"), sql=with_views("follows") + "SELECT src, dst FROM follows")
def edge_list(spark, d):
    path = scratch_path(spark, "edge-list")
    W.write_edge_list(T.follows(spark, d), path, header="src dst")
    return FS.read_edge_list(spark, path)


@query("dict_file", operators=("S-5", "E-4", "A-8"), sql="SELECT s_suppkey AS id, s_name AS name FROM supplier")
def dict_file(spark, d):
    path = scratch_path(spark, "dictionary")
    W.write_dictionary(T.accounts(spark, d), path)
    return FS.read_dictionary(spark, path)


@query("vertex_dictionary_file", operators=("K-6", "V-1"), sql=REGISTRY["vertex_dictionary"].sql)
def vertex_dictionary_file(spark, d):
    path = scratch_path(spark, "vertex-dictionary")
    vd = G.vertex_dictionary(G.vertices_of(T.follows(spark, d)), T.parts(spark, d))
    W.write_vertex_dictionary(vd, path)
    return FS.read_vertex_dictionary(spark, path).withColumn("id", F.col("id").cast("bigint"))


@query("sink_by_month", operators=("K-1", "S-3"), sql=with_views("posts") + """
SELECT strftime(time, '%Y-%m') AS month, count(*) AS n_posts, CAST(sum(like_num) AS BIGINT) AS like_num
FROM posts GROUP BY 1""")
def sink_by_month(spark, d):
    path = scratch_path(spark, "posts-by-month")
    p = T.posts(spark, d)
    W.write_partitioned(P.posts_by_month(p, P.calendar_of(p)), path, ["month"])
    back = spark.read.schema(
        "post_id bigint, account bigint, repost string, time timestamp, like_num bigint, "
        "repost_num bigint, comment_num bigint, month string"
    ).parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("n_posts"), F.sum("like_num").alias("like_num"))


@query("sink_by_period", operators=("K-1", "P-2", "J-6"),
       sql=with_views("posts", extra=q_posts.PERIODS_SQL) + """
SELECT q.period, count(*) AS n_records, count(*) FILTER (WHERE p.repost IS NULL) AS n_originals
FROM posts p JOIN periods q ON p.time > q.s AND p.time < q.e GROUP BY q.period""")
def sink_by_period(spark, d):
    """Period export records written in one pass, one folder per period."""
    path = scratch_path(spark, "records-by-period")
    records = P.period_records(P.period_membership(T.posts(spark, d)))
    W.write_partitioned(records, path, ["period"], fmt="json")
    back = spark.read.schema(
        "id string, forward string, like_num string, forward_num string, comment_num string, period string"
    ).json(path)
    return back.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum((F.col("forward") == "null").cast("bigint")).alias("n_originals"),
    )


@query("scan_one_account", operators=("S-2", "K-1", "P-4"), sql=with_views("posts") + """
SELECT post_id, account, like_num, repost_num, comment_num FROM posts""")
def scan_one_account(spark, d):
    """Every account's collection, written once as a table bucketed by account and scanned back."""
    path = scratch_path(spark, "posts-by-account")
    E.write_entities(T.posts(spark, d), path, "account")
    return E.read_entities(spark, path).select("post_id", "account", "like_num", "repost_num", "comment_num")


@query("scan_one_month", operators=("S-3", "W-5", "P-4"), sql=with_views("posts") + """
SELECT strftime(time, '%Y-%m') AS month, post_id, account, like_num FROM posts""")
def scan_one_month(spark, d):
    """Every month's collection, written once as ``month=`` folders; the month
    comes back from the folder name (the one-month read is ``posts.scan_month``)."""
    path = scratch_path(spark, "posts-month-folders")
    p = T.posts(spark, d)
    W.write_partitioned(P.posts_by_month(p, P.calendar_of(p)), path, ["month"], mode="overwrite")
    back = spark.read.option("basePath", path).schema(
        "post_id bigint, account bigint, like_num bigint, month string").parquet(path)
    return back.select("month", "post_id", "account", "like_num")


@query("read_one_account", operators=("S-2",), sql=with_views("posts") + f"""
SELECT post_id, account, like_num, repost_num, comment_num FROM posts WHERE account = {ONE_ACCOUNT}""")
def read_one_account(spark, d):
    """One account's collection out of all: one bucket is read."""
    path = scratch_path(spark, "posts-by-account")
    E.write_entities(T.posts(spark, d), path, "account")
    return P.scan_account(E.read_entities(spark, path), ONE_ACCOUNT).select(
        "post_id", "account", "like_num", "repost_num", "comment_num")


@query("accounts_with_totals", operators=("S-2", "K-1", "J-2"), sql=with_views("posts") + """
SELECT p.post_id, p.account, p.like_num, t.like_num AS account_likes
FROM posts p JOIN (SELECT account, CAST(sum(like_num) AS BIGINT) AS like_num FROM posts GROUP BY account) t
  ON t.account = p.account""")
def accounts_with_totals(spark, d):
    """Each post beside its account's total: on the bucketed table, neither the sum nor the join moves a row."""
    path = scratch_path(spark, "posts-by-account")
    E.write_entities(T.posts(spark, d), path, "account")
    posts = E.read_entities(spark, path)
    totals = posts.groupBy("account").agg(F.sum("like_num").cast("bigint").alias("account_likes"))
    return posts.join(totals.hint("merge"), "account").select("post_id", "account", "like_num", "account_likes")


@query("read_one_month", operators=("S-3", "E-2"), sql=with_views("posts") + f"""
SELECT strftime(time, '%Y-%m') AS month, post_id, account, like_num FROM posts
WHERE strftime(time, '%Y-%m') = '{ONE_MONTH}'""")
def read_one_month(spark, d):
    """One month's collection out of all: one month folder is read."""
    path = scratch_path(spark, "posts-month-folders")
    W.write_partitioned(P.with_month(T.posts(spark, d)), path, ["month"], mode="overwrite")
    return P.scan_month(spark.read.option("basePath", path).schema(
        "post_id bigint, account bigint, like_num bigint, month string").parquet(path), ONE_MONTH).select(
        "month", "post_id", "account", "like_num")


@query("posts_in_month_text", operators=("E-2", "E-3", "F-3"), sql=with_views("posts") + f"""
SELECT strftime(time, '%Y-%m') AS month, post_id, account FROM posts
WHERE strftime(time, '%Y-%m-%d %H:%M') LIKE '{ONE_MONTH}%'""")
def posts_in_month_text(spark, d):
    """Raw documents whose time text starts with the month."""
    raw = q_posts.raw_post_documents(spark, d)
    return P.posts_in_month(raw, ONE_MONTH).select(
        month_of_text("time").alias("month"), F.col("id").cast("bigint").alias("post_id"),
        F.col("account").cast("bigint").alias("account"))
