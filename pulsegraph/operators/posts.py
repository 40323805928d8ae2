"""Post-level operators: typing, filters, month / quarter / period bucketing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegraph.functions.columns import (
    QUARTER_START_MONTHS,
    format_post_time,
    month_of,
    parse_post_time,
)


def typed_posts(raw: DataFrame) -> DataFrame:
    """Text-typed post documents -> typed posts.

    Measures are cast with ANSI semantics (a malformed number fails the job);
    an unparsable time becomes null and drops out of every time bucket.
    """
    return raw.select(
        F.col("id").cast("bigint").alias("post_id"),
        F.col("account").cast("bigint").alias("account"),
        F.col("repost"),
        parse_post_time("time").alias("time"),
        F.col("likeNum").cast("bigint").alias("like_num"),
        F.col("repostNum").cast("bigint").alias("repost_num"),
        F.col("commentNum").cast("bigint").alias("comment_num"),
    )


def originals(posts: DataFrame) -> DataFrame:
    """Posts that are not reposts."""
    return posts.filter(F.col("repost").isNull())


def scan_account(posts: DataFrame, account) -> DataFrame:
    """One account's posts; a plain predicate, pushed into the parquet scan."""
    return posts.filter(F.col("account") == F.lit(account))


def scan_month(posts_by_month_table: DataFrame, month: str) -> DataFrame:
    """One month's posts from a ``month``-partitioned table (partition pruning)."""
    return posts_by_month_table.filter(F.col("month") == F.lit(month))


def with_month(posts: DataFrame, time: str = "time", out: str = "month") -> DataFrame:
    return posts.withColumn(out, month_of(time))


def month_calendar(spark, first_year: int, last_year: int) -> DataFrame:
    """Every ``yyyy-MM`` from January of ``first_year`` to December of ``last_year``."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                F.make_date(F.lit(last_year), F.lit(12), F.lit(1)),
                F.expr("interval 1 month"),
            )
        ).alias("d")
    ).select(F.date_format("d", "yyyy-MM").alias("month"))


def calendar_of(posts: DataFrame, time: str = "time") -> DataFrame:
    """The month calendar spanning the whole years the posts touch."""
    bounds = posts.agg(F.min(F.year(time)).alias("y0"), F.max(F.year(time)).alias("y1"))
    return bounds.select(
        F.explode(
            F.sequence(
                F.make_date("y0", F.lit(1), F.lit(1)),
                F.make_date("y1", F.lit(12), F.lit(1)),
                F.expr("interval 1 month"),
            )
        ).alias("d")
    ).select(F.date_format("d", "yyyy-MM").alias("month"))


def posts_by_month(posts: DataFrame, calendar: DataFrame, time: str = "time") -> DataFrame:
    """Posts with their month bucket; months outside the calendar are dropped.

    The calendar has 12 rows per year whatever the posts, so it is broadcast
    and the join never shuffles the posts.
    """
    return with_month(posts, time).join(F.broadcast(calendar), "month", "left_semi")


def posts_between(posts: DataFrame, first_year: int, last_year: int, time: str = "time") -> DataFrame:
    """Posts of the years ``first_year`` to ``last_year`` with their ``month``: the calendar as a range of times.

    A plain range on the time column, so it reaches the scan and whole files
    or row groups outside the calendar are skipped; nothing is joined.
    """
    t = F.col(time)
    start = lambda year: F.make_timestamp(*[F.lit(x) for x in (year, 1, 1, 0, 0, 0)])
    return with_month(posts.filter((t >= start(first_year)) & (t < start(last_year + 1))), time)


def scan_months(posts_by_month_table: DataFrame, months: DataFrame) -> DataFrame:
    """The posts of ``months`` (``month``) from a ``month``-partitioned table.

    A semi-join on the partition column: Spark evaluates ``months`` first and
    lists and reads only the partitions in it (dynamic partition pruning).  A
    calendar has 12 rows a year, so it is broadcast.
    """
    return posts_by_month_table.join(F.broadcast(months.select("month")), "month", "left_semi")


def posts_in_month(posts: DataFrame, month: str, time_text: str = "time") -> DataFrame:
    """Text-time prefix test: posts whose time text starts with ``month``."""
    return posts.filter(F.col(time_text).startswith(month))


def period_membership(
    posts: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    time: str = "time",
    strict_quarters: bool = False,
    out: str = "period",
) -> DataFrame:
    """Assign each post to the reporting periods that contain it.

    All years of the data, unless ``first_year`` or ``last_year`` bound them.

    Default periods start on the 1st of months 1, 4, 7 (and run four months)
    and 10 (running to the next 1 January); both ends are exclusive, so April,
    July and October posts land in two periods and a post at the exact start
    instant lands in the earlier period only.  ``strict_quarters=True`` gives
    clean ``[start, start + 3 months)`` quarters.

    No join: the at most two candidate periods of a post are the quarter it
    falls in and the one before, computed arithmetically and exploded, then
    tested.  Nothing is broadcast and nothing shuffles.
    """
    t = F.col(time)
    q = F.date_trunc("quarter", t)
    cands = F.array(q) if strict_quarters else F.array(q, F.add_months(q, -3).cast("timestamp"))
    s = F.col("__start")
    start_month = F.month(s)
    if strict_quarters:
        end = F.add_months(s, 3).cast("timestamp")
        inside = (s <= t) & (t < end)
    else:
        end = F.when(start_month == 10, F.add_months(s, 3)).otherwise(F.add_months(s, 4)).cast(
            "timestamp"
        )
        inside = (s < t) & (t < end)
    if first_year is not None:
        inside &= F.year(s) >= first_year
    if last_year is not None:
        inside &= F.year(s) <= last_year
    return (
        posts.withColumn("__start", F.explode(cands))
        .filter(inside & start_month.isin(*QUARTER_START_MONTHS))
        .withColumn(out, F.concat_ws("_", F.year(s).cast("string"), start_month.cast("string")))
        .drop("__start")
    )


def period_records(periods: DataFrame, period: str = "period") -> DataFrame:
    """Export shape of a period's posts: text fields, ``repost`` renamed ``forward``."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    return periods.select(
        F.col(period),
        text("post_id").alias("id"),
        text("repost").alias("forward"),
        text("like_num").alias("like_num"),
        text("repost_num").alias("forward_num"),
        text("comment_num").alias("comment_num"),
    )


def posts_with_mentions(posts_at: DataFrame, at: str = "at") -> DataFrame:
    """(post, mentions) for posts that mention at least one account."""
    return posts_at.filter(F.size(at) > 0).select("post_id", "account", at)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL of inputs by column name; columns missing on one side are null."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def export_time(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn(time, format_post_time(time))
