from pyspark.sql import functions as F

from pulsegraph.operators import mentions as M
from pulsegraph.sources import tables as T


def test_cleaning_order_and_repeats(spark):
    posts_at = spark.createDataFrame(
        [(1, 10, ["@a", "@a", "@zz"]), (2, 11, []), (3, 12, ["#a"])],
        "post_id long, account long, at array<string>",
    )
    names = spark.createDataFrame([(100, "a"), (101, "b")], "id long, name string")
    ex = M.mentions_exploded(posts_at)
    assert sorted(r.name for r in ex.collect()) == ["a", "a", "a", "zz"]  # first char dropped, whatever it is
    known = M.mentions_known(ex, names)
    assert sorted((r.post_id, r.target) for r in known.collect()) == [(1, 100), (1, 100), (3, 100)]
    assert {r.name: r.num for r in M.mention_counts(ex, names).collect()} == {"a": 3}


def test_at_edges_threshold_is_strict_and_keeps_self_loops(spark):
    m = spark.createDataFrame([(1, 2), (1, 2), (1, 3), (4, 4), (4, 4), (5, 9), (5, 9)], "src long, dst long")
    users = spark.createDataFrame([(1, "1"), (2, "2"), (3, "3"), (4, "4")], "id long, name string")
    got = {(r.src, r.dst): r.weight for r in M.at_edges(m, users).collect()}
    assert got == {(1, 2): 2, (4, 4): 2}


def test_account_totals_zero_fill(spark):
    posts = spark.createDataFrame([(1, 5, 1, 2), (1, 6, 0, 0), (2, 1, 1, 1)],
                                  "account long, like_num long, repost_num long, comment_num long")
    known = spark.createDataFrame([(9, 2), (9, 3), (9, 3)], "post_id long, target long")
    got = {r.account: tuple(r)[1:] for r in M.account_totals(posts, known).collect()}
    assert got == {1: (11, 1, 2, 0), 2: (1, 1, 1, 1), 3: (0, 0, 0, 2)}


def test_fixture_sizes_sf0001(spark, sf):
    from pulsegraph.operators.joins import semi_join_known
    users = T.users(spark, sf)
    m = T.mentions(spark, sf)
    assert m.count() == 1000
    assert semi_join_known(m, users, "dst").count() == 148
    e = M.at_edges(m, users)
    s = e.agg(F.count("*").alias("n"), F.sum("weight").alias("w"),
              F.countDistinct("src").alias("s"), F.countDistinct("dst").alias("t"),
              F.sum((F.col("src") == F.col("dst")).cast("int")).alias("loops")).first()
    assert (s.n, s.w, s.s, s.t, s.loops) == (31, 68, 13, 14, 2)
