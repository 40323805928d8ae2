"""Registered queries over posts: roll-ups, heat series, leaderboards, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegraph.functions.columns import format_post_time, quarter_label
from pulsegraph.operators import heat as H
from pulsegraph.operators import posts as P
from pulsegraph.plans.registry import query
from pulsegraph.plans.sqlviews import with_views
from pulsegraph.session import scratch_path
from pulsegraph.sources import documents as D
from pulsegraph.sources import tables as T

PERIODS_SQL = """periods AS (
    SELECT CAST(y AS VARCHAR) || '_' || CAST(m AS VARCHAR) AS period,
           make_timestamp(y, m, 1, 0, 0, 0) AS s,
           CASE WHEN m = 10 THEN make_timestamp(y + 1, 1, 1, 0, 0, 0)
                ELSE make_timestamp(y, m + 4, 1, 0, 0, 0) END AS e
    FROM range((SELECT min(year(time)) FROM posts), (SELECT max(year(time)) + 1 FROM posts)) yy(y), (VALUES (1), (4), (7), (10)) mm(m))"""


def _posts(spark, d):
    return T.posts(spark, d)


@query("scan_accounts", operators=("S-1",),
       sql="SELECT s_suppkey AS id, s_name AS name FROM supplier")
def scan_accounts(spark, d):
    return T.accounts(spark, d)


def raw_post_documents(spark, d):
    """Posts as the crawler stores them: every field text, time as 'yyyy-MM-dd HH:mm'."""
    p = _posts(spark, d)
    return p.select(
        F.col("post_id").cast("string").alias("id"),
        F.col("account").cast("string").alias("account"),
        "repost",
        format_post_time("time").alias("time"),
        F.col("like_num").cast("string").alias("likeNum"),
        F.col("repost_num").cast("string").alias("repostNum"),
        F.col("comment_num").cast("string").alias("commentNum"),
    )


@query("typed_posts", operators=("S-4", "P-3", "E-6", "E-8"), sql=with_views("posts") + """
SELECT post_id, account, repost, strftime(time, '%Y-%m-%d %H:%M') AS time,
       like_num, repost_num, comment_num FROM posts""")
def typed_posts(spark, d):
    return P.export_time(P.typed_posts(raw_post_documents(spark, d)))


@query("monthly_measures", operators=("A-3", "W-1", "E-2"),
       sql=with_views("monthly") + "SELECT * FROM monthly")
def monthly_measures(spark, d):
    return H.monthly_measures(_posts(spark, d))


@query("heat_decay_series", operators=("A-5", "X-3", "O-3", "E-9"),
       sql=with_views("decay") + "SELECT * FROM decay")
def heat_decay_series(spark, d):
    return H.heat_decay_series(H.monthly_measures(_posts(spark, d)))


@query("heat_cumulative_series", operators=("A-6",),
       sql=with_views("cumulative") + "SELECT * FROM cumulative")
def heat_cumulative_series(spark, d):
    return H.heat_cumulative_series(H.monthly_measures(_posts(spark, d)))


@query("heat_total", operators=("A-7",),
       sql=with_views("decay_total") + "SELECT * FROM decay_total")
def heat_total(spark, d):
    return H.heat_total(H.heat_decay_series(H.monthly_measures(_posts(spark, d))))


def _top5_sql(series_view: str, col: str) -> str:
    return with_views(series_view, "accounts") + f"""
SELECT t.month, t.account, t.value, t.position, a.name
FROM (SELECT month, account, {col} AS value,
             row_number() OVER (PARTITION BY month ORDER BY {col} DESC, account ASC) AS position
      FROM {series_view}) t
JOIN accounts a ON a.id = t.account
WHERE t.position <= 5"""


def _top5(spark, d, col, cumulative=False):
    monthly = H.monthly_measures(_posts(spark, d))
    series = H.heat_cumulative_series(monthly) if cumulative else H.heat_decay_series(monthly)
    top = H.top_n_per_month(H.heat_total(series), col, n=5, names=T.accounts(spark, d))
    return top.withColumn("position", F.col("position").cast("bigint"))


for _name, _col in (("like", "like_heat"), ("repost", "repost_heat"),
                    ("comment", "comment_heat"), ("total", "total_heat")):
    query(f"top5_{_name}", operators=("W-6", "O-4", "J-2"), sql=_top5_sql("decay_total", _col))(
        lambda spark, d, _c=_col: _top5(spark, d, _c)
    )

query("top5_total_cumulative", operators=("W-6", "A-6"),
      sql=_top5_sql("cumulative_total", "total_heat"))(
    lambda spark, d: _top5(spark, d, "total_heat", cumulative=True)
)


def _global_top_sql(value_expr: str, originals_only: bool) -> str:
    where = "WHERE repost IS NULL" if originals_only else ""
    return with_views("posts", "accounts") + f"""
SELECT t.account, t.value, t.position, a.name
FROM (SELECT account, value, row_number() OVER (ORDER BY value DESC, account ASC) AS position
      FROM (SELECT account, CAST({value_expr} AS BIGINT) AS value FROM posts {where} GROUP BY account) s) t
JOIN accounts a ON a.id = t.account
WHERE t.position <= 10"""


def _global_top(spark, d, measure, originals_only):
    top = H.global_top(_posts(spark, d), measure, n=10, originals_only=originals_only,
                       names=T.accounts(spark, d))
    return top.withColumn("position", F.col("position").cast("bigint"))


for _name, _measure, _orig, _expr in (
    ("top_repost", "repost_num", False, "sum(repost_num)"),
    ("top_like", "like_num", False, "sum(like_num)"),
    ("top_original_repost", "repost_num", True, "sum(repost_num)"),
    ("top_original_like", "like_num", True, "sum(like_num)"),
    ("top_influence", "influence", False, "sum(like_num) + 3 * sum(repost_num) + 2 * sum(comment_num)"),
):
    query(_name, operators=("O-5", "O-6", "F-6"), sql=_global_top_sql(_expr, _orig))(
        lambda spark, d, _m=_measure, _o=_orig: _global_top(spark, d, _m, _o)
    )


@query("quarter_label", operators=("W-2",), sql=with_views("posts") + """
SELECT CAST(year(time) AS VARCHAR) || '_' || CAST((quarter(time) - 1) * 3 + 1 AS VARCHAR) AS quarter,
       count(*) AS n_posts
FROM posts GROUP BY 1""")
def quarter_label_counts(spark, d):
    return _posts(spark, d).groupBy(quarter_label("time").alias("quarter")).agg(
        F.count(F.lit(1)).alias("n_posts")
    )


@query("period_membership", operators=("J-6", "W-3", "F-4", "E-7"),
       sql=with_views("posts", extra=PERIODS_SQL) + """
SELECT p.post_id, p.account, strftime(p.time, '%Y-%m-%d %H:%M') AS time, q.period
FROM posts p JOIN periods q ON p.time > q.s AND p.time < q.e""")
def period_membership(spark, d):
    return P.export_time(
        P.period_membership(_posts(spark, d)).select(
            "post_id", "account", "time", "period"
        )
    )


@query("period_records", operators=("P-2", "J-6"),
       sql=with_views("posts", extra=PERIODS_SQL) + """
SELECT q.period, CAST(p.post_id AS VARCHAR) AS id, coalesce(p.repost, 'null') AS forward,
       CAST(p.like_num AS VARCHAR) AS like_num, CAST(p.repost_num AS VARCHAR) AS forward_num,
       CAST(p.comment_num AS VARCHAR) AS comment_num
FROM posts p JOIN periods q ON p.time > q.s AND p.time < q.e""")
def period_records(spark, d):
    return P.period_records(P.period_membership(_posts(spark, d)))


@query("month_calendar", operators=("W-4", "E-12"), sql=with_views("posts") + """
SELECT strftime(d, '%Y-%m') AS month
FROM (SELECT unnest(generate_series(make_date(min(year(time)), 1, 1),
                                    make_date(max(year(time)), 12, 1), INTERVAL 1 MONTH)) AS d
      FROM posts) c""")
def month_calendar(spark, d):
    return P.calendar_of(_posts(spark, d))


@query("posts_by_month", operators=("W-5", "F-3"), sql=with_views("posts") + """
SELECT strftime(time, '%Y-%m') AS month, post_id, account, like_num, repost_num, comment_num
FROM posts""")
def posts_by_month(spark, d):
    p = _posts(spark, d)
    return P.posts_by_month(p, P.calendar_of(p)).select(
        "month", "post_id", "account", "like_num", "repost_num", "comment_num"
    )


FIRST_YEAR, LAST_YEAR = 1996, 1998


@query("posts_by_month_bounded", operators=("W-5", "F-3"), sql=with_views("posts") + f"""
SELECT strftime(time, '%Y-%m') AS month, post_id, account, like_num, repost_num, comment_num
FROM posts WHERE year(time) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}""")
def posts_by_month_bounded(spark, d):
    """A calendar that drops months, as a range of times that the scan gets."""
    return P.posts_between(_posts(spark, d), FIRST_YEAR, LAST_YEAR).select(
        "month", "post_id", "account", "like_num", "repost_num", "comment_num")


#: times that a lenient calendar rolls over, and two that it cannot read
ODD_TIMES = ("13-{d} 09:41", "02-30 25:61:07", "0-00 7:5", "12-31 24:00", "1/5 10:00", "")


def document_lines(spark, d):
    """``value``: the posts as a crawler's JSON lines, all fields; every 23rd kind of line is odd or broken."""
    kind = F.col("kind")
    time = format_post_time("time")
    for k, odd in enumerate(ODD_TIMES):
        before, _, after = odd.partition("{d}")
        text = F.concat(F.lit(before), F.day("time").cast("string"), F.lit(after)) if "{d}" in odd else F.lit(odd)
        time = F.when(kind == k, F.concat(F.year("time").cast("string"), F.lit("-"), text)).otherwise(time)
    tag = F.when(F.col("repost_num") % 3 == 0, F.array(F.concat(F.lit("t"), F.col("like_num").cast("string"))))
    at = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("repost_num")), lambda i: F.concat(F.lit("@"), i.cast("string")))
    text = lambda c: F.col(c).cast("string")
    whole = F.to_json(F.struct(
        F.when(kind != 6, text("post_id")).alias("id"), F.when(kind != 7, text("account")).alias("account"), "repost",
        F.concat(F.lit('"quoted", ü\n'), text("post_id")).alias("content"), tag.alias("tag"), at.alias("at"),
        F.when(kind == 8, F.lit("many")).when(kind != 9, text("comment_num")).alias("imgNum"),
        F.when(kind == 10, F.lit("1.5")).otherwise(text("like_num")).alias("likeNum"),
        text("repost_num").alias("repostNum"), text("comment_num").alias("commentNum"), time.alias("time")))
    line = (F.when(kind == 11, F.substring(whole, 1, 30)).when(kind == 12, F.lit("not a document"))
            .when(kind == 13, F.regexp_replace(whole, r'"at":\[[^\]]*\]', '"at":{"name":"x"}')).otherwise(whole))
    return T.posts(spark, d).withColumn("kind", (F.col("post_id") * 7 + F.col("repost_num")) % 23).select(line.alias("value"))


def _load(spark, d):
    path, aside = scratch_path(spark, "documents"), scratch_path(spark, "quarantine")
    document_lines(spark, d).write.text(path)
    return D.load_documents(spark, path, aside), spark.read.parquet(aside)


_KINDS = "k AS (SELECT *, (post_id * 7 + repost_num) % 23 AS kind FROM posts)"


@query("typed_documents", operators=("S-4", "P-3", "E-6", "E-8"), sql=with_views("posts", extra=_KINDS) + """
SELECT post_id, account, repost, '"quoted", ü' || chr(10) || post_id AS content,
       CASE WHEN repost_num % 3 = 0 THEN 't' || like_num ELSE '' END AS tags,
       array_to_string(list_transform(range(1, repost_num + 1), lambda i: '@' || i), ',') AS mentions,
       CASE WHEN kind = 9 THEN 0 ELSE comment_num END AS img_num, like_num, repost_num, comment_num,
       strftime(CASE kind WHEN 0 THEN make_date(year(time) + 1, 1, 1) + to_days(CAST(day(time) - 1 AS INTEGER)) + INTERVAL 581 MINUTE
                          WHEN 1 THEN make_date(year(time), 2, 1) + INTERVAL 30 DAY + INTERVAL 121 MINUTE
                          WHEN 2 THEN make_date(year(time) - 1, 11, 30) + INTERVAL 425 MINUTE
                          WHEN 3 THEN CAST(make_date(year(time) + 1, 1, 1) AS TIMESTAMP)
                          WHEN 4 THEN NULL WHEN 5 THEN NULL ELSE time END, '%Y-%m-%d %H:%M') AS time
FROM k WHERE kind NOT IN (6, 7, 8, 10, 11, 12, 13)""")
def typed_documents(spark, d):
    docs, _ = _load(spark, d)
    joined = lambda c: F.array_join(c, ",").alias(c)
    return P.export_time(docs).select("post_id", "account", "repost", "content", joined("tags"), joined("mentions"),
                                      "img_num", "like_num", "repost_num", "comment_num", "time")


@query("document_quarantine", operators=("S-4",), sql=with_views("posts", extra=_KINDS) + """
SELECT CASE kind WHEN 6 THEN 'no id' WHEN 7 THEN 'no account' WHEN 8 THEN 'imgNum' WHEN 10 THEN 'likeNum' ELSE 'malformed' END AS reason,
       kind = 12 AS is_no_json, count(*) AS n
FROM k WHERE kind IN (6, 7, 8, 10, 11, 12, 13) GROUP BY ALL""")
def document_quarantine(spark, d):
    _, aside = _load(spark, d)
    return aside.groupBy("reason", (F.col("line") == "not a document").alias("is_no_json")).agg(F.count(F.lit(1)).alias("n"))


@query("union_all_inputs", operators=("U-1",), sql=with_views("posts", "posts_at") + """
SELECT post_id, account, like_num, repost_num, comment_num, CAST(NULL AS BIGINT) AS n_mentions,
       'posts' AS source FROM posts
UNION ALL
SELECT post_id, account, NULL, NULL, NULL, CAST(len("at") AS BIGINT), 'posts_at' FROM posts_at""")
def union_all_inputs(spark, d):
    a = _posts(spark, d).select(
        "post_id", "account", "like_num", "repost_num", "comment_num", F.lit("posts").alias("source")
    )
    b = T.posts_at(spark, d).select(
        "post_id", "account", F.size("at").cast("bigint").alias("n_mentions"),
        F.lit("posts_at").alias("source"),
    )
    return P.union_all([a, b])
