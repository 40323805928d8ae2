import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegraph.operators import heat as H
from pulsegraph.operators import posts as P
from pulsegraph.sources import tables as T


def _posts(spark, rows):
    return spark.createDataFrame(
        rows, "post_id long, account long, repost string, time timestamp, like_num long, repost_num long, comment_num long"
    )


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M")


def test_decay_gap_month_is_not_a_step(spark):
    p = _posts(spark, [
        (1, 9, None, ts("2020-01-10 10:00"), 7, 0, 0),
        (2, 9, None, ts("2020-03-10 10:00"), 3, 0, 0),
        (3, 9, None, ts("2020-04-10 10:00"), 0, 0, 0),
    ])
    got = H.heat_decay_series(H.monthly_measures(p)).orderBy("month").collect()
    assert [(r.month, r.like_heat) for r in got] == [("2020-01", 7), ("2020-03", 6), ("2020-04", 3)]
    cum = H.heat_cumulative_series(H.monthly_measures(p)).orderBy("month").collect()
    assert [r.like_heat for r in cum] == [7, 10, 10]


def test_total_formed_after_decay(spark):
    p = _posts(spark, [(1, 1, None, ts("2020-01-01 10:00"), 1, 3, 5), (2, 1, None, ts("2020-02-01 10:00"), 1, 1, 1)])
    rows = H.heat_total(H.heat_decay_series(H.monthly_measures(p))).orderBy("month").collect()
    assert [r.total_heat for r in rows] == [1 + 9 + 10, (1 + 0) + 3 * (1 + 1) + 2 * (1 + 2)]


@pytest.mark.parametrize("when,want", [
    ("2001-01-01 00:00", []),
    ("2001-04-01 00:00", ["2001_1"]),
    ("2001-04-15 12:00", ["2001_1", "2001_4"]),
    ("2001-07-20 00:00", ["2001_4", "2001_7"]),
    ("2001-10-01 00:00", ["2001_7"]),
    ("2001-11-15 00:00", ["2001_10"]),
    ("2001-12-31 23:59", ["2001_10"]),
    ("1994-12-31 23:59", []),
])
def test_period_boundaries(spark, when, want):
    p = _posts(spark, [(1, 1, None, ts(when), 0, 0, 0)])
    got = sorted(r.period for r in P.period_membership(p, 1995, 2001).collect())
    assert got == want


def test_strict_quarters(spark):
    p = _posts(spark, [(1, 1, None, ts("2001-04-01 00:00"), 0, 0, 0), (2, 1, None, ts("2001-04-15 00:00"), 0, 0, 0)])
    got = sorted(r.period for r in P.period_membership(p, 1995, 2001, strict_quarters=True).collect())
    assert got == ["2001_4", "2001_4"]


def test_unparsable_time_drops_out(spark):
    raw = spark.createDataFrame(
        [("1", "5", None, "not a time", "1", "2", "3"), ("2", "5", "x", "2001-04-15 12:00", "1", "2", "3")],
        "id string, account string, repost string, time string, likeNum string, repostNum string, commentNum string",
    )
    typed = P.typed_posts(raw)
    assert typed.filter(F.col("time").isNull()).count() == 1
    assert P.period_membership(typed, 1995, 2001).count() == 2


def test_bad_measure_fails_fast(spark):
    raw = spark.createDataFrame(
        [("1", "5", None, "2001-04-15 12:00", "lots", "2", "3")],
        "id string, account string, repost string, time string, likeNum string, repostNum string, commentNum string",
    )
    with pytest.raises(Exception):
        P.typed_posts(raw).collect()


def test_top5_ties_and_month_presence(spark):
    rows = [(i, a, None, ts("2020-01-05 00:00"), v, 0, 0) for i, (a, v) in enumerate(
        [(1, 5), (2, 5), (3, 9), (4, 1), (5, 5), (6, 5), (7, 0)])]
    rows.append((99, 8, None, ts("2020-02-05 00:00"), 1, 0, 0))
    series = H.heat_total(H.heat_decay_series(H.monthly_measures(_posts(spark, rows))))
    top = H.top_n_per_month(series, "like_heat", n=5).orderBy("month", "position").collect()
    assert [(r.month, r.account) for r in top] == [
        ("2020-01", 3), ("2020-01", 1), ("2020-01", 2), ("2020-01", 5), ("2020-01", 6), ("2020-02", 8)]


def test_leaderboards_all_measures_one_pass(spark, sf):
    series = H.heat_total(H.heat_decay_series(H.monthly_measures(T.posts(spark, sf))))
    boards = H.leaderboards(series)
    counts = {r.measure: r.n for r in boards.groupBy("measure").agg(F.count("*").alias("n")).collect()}
    assert counts == {"like": 415, "repost": 415, "comment": 415, "total": 415}


def test_fixture_sizes_sf0001(spark, sf):
    p = T.posts(spark, sf)
    assert p.count() == 6000
    assert P.originals(p).count() == 4032
    assert H.monthly_measures(p).count() == 826
    periods = P.period_membership(p, 1995, 2001)
    assert periods.count() == 7568
    assert periods.select("period").distinct().count() == 28
    new_year = p.filter((F.month("time") == 1) & (F.dayofmonth("time") == 1))
    assert new_year.count() == 15
    assert P.period_membership(new_year, 1995, 2001).count() == 0


def test_calendar_bounds_posts_by_month(spark):
    p = _posts(spark, [(1, 1, None, ts("2012-12-31 10:00"), 0, 0, 0), (2, 1, None, ts("2013-01-01 10:00"), 0, 0, 0)])
    cal = P.month_calendar(spark, 2013, 2019)
    assert cal.count() == 84
    assert [r.month for r in P.posts_by_month(p, cal).collect()] == ["2013-01"]


def test_quarter_label(spark):
    from pulsegraph.functions.columns import quarter_label
    p = _posts(spark, [(i, 1, None, ts(f"2018-{m:02d}-06 09:41"), 0, 0, 0) for i, m in enumerate([2, 4, 9, 12])])
    assert [r.q for r in p.orderBy("post_id").select(quarter_label("time").alias("q")).collect()] == [
        "2018_1", "2018_4", "2018_7", "2018_10"]


def test_scan_account_pushes_filter(spark, sf):
    plan = P.scan_account(T.posts(spark, sf), 7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_suppkey), EqualTo(l_suppkey,7)]" in plan


def test_lenient_times_and_null_times(spark):
    from pulsegraph.functions.columns import parse_post_time, quarter_label
    from pulsegraph.operators.heat import monthly_measures
    rows = spark.createDataFrame([("2001-04-15 12:00:30",), ("2001-4-5 9:05",), ("junk",), (None,)], "t string")
    got = [str(r.x) for r in rows.select(parse_post_time("t").alias("x")).collect()]
    assert got == ["2001-04-15 12:00:00", "2001-04-05 09:05:00", "None", "None"]
    posts = rows.select(F.lit(1).alias("account"), parse_post_time("t").alias("time"), F.lit(1).alias("like_num"),
                        F.lit(1).alias("repost_num"), F.lit(1).alias("comment_num"))
    assert [r.month for r in monthly_measures(posts).collect()] == ["2001-04"]
    assert posts.select(quarter_label("time").alias("q")).where("q is null").count() == 2
