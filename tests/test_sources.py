import pathlib

import pytest
from pyspark.sql import functions as F

from pulsegraph.sources import tables as T
from pulsegraph.session import scratch_path
from pulsegraph.sinks import writers as W
from pulsegraph.sources import files as FS


def _write_lines(spark, lines):
    path = scratch_path(spark, "src")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_dictionary_file(spark):
    path = _write_lines(spark, ["1 Alpha University", "", "2   Beta  College", "  3 Gamma"])
    got = sorted(tuple(r) for r in FS.read_dictionary(spark, path).collect())
    assert got == [(1, "Alpha University"), (2, "Beta  College"), (3, "Gamma")]


def test_edge_list_file(spark):
    path = _write_lines(spark, ["# a comment", "1 2", "1 2", "3 3", "-5 7", ""])
    got = sorted(tuple(r) for r in FS.read_edge_list(spark, path).collect())
    assert got == [(-5, 7), (1, 2), (1, 2), (3, 3)]


def test_edge_list_round_trip_with_header(spark):
    e = spark.createDataFrame([(1, 2), (-3, 4)], "src long, dst long")
    path = scratch_path(spark, "el")
    W.write_edge_list(e, path, header="src dst")
    assert sorted(tuple(r) for r in FS.read_edge_list(spark, path).collect()) == [(-3, 4), (1, 2)]


def test_leaderboard_document_format(spark):
    boards = spark.createDataFrame(
        [("like", "2019-01", 2, "B \"q\"", 5), ("like", "2019-01", 1, "A", 9)],
        "measure string, month string, position int, name string, value long")
    doc = W.leaderboard_documents(boards).first()["doc"]
    assert doc == '{"time":"2019-01","rankList":[{"name":"A","rank":9},{"name":"B \\"q\\"","rank":5}]}'


def test_dictionary_duplicates_collapse_or_fail(spark):
    import pytest
    ok = _write_lines(spark, ["1 A", "1 A", "2 B"])
    assert sorted(tuple(r) for r in FS.read_dictionary(spark, ok).collect()) == [(1, "A"), (2, "B")]
    bad = _write_lines(spark, ["1 A", "1 Z"])
    with pytest.raises(Exception):
        FS.read_dictionary(spark, bad).collect()


def test_month_partition_pruning_and_text_prefix(spark, sf):
    from pyspark.sql import functions as F
    from pulsegraph.operators import posts as P
    from pulsegraph.sources import tables as T
    p = T.posts(spark, sf)
    path = scratch_path(spark, "bymonth")
    W.write_partitioned(P.posts_by_month(p, P.calendar_of(p)), path, ["month"])
    table = spark.read.parquet(path)
    one = P.scan_month(table, "1996-03")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "1996-03" in plan
    want = p.filter(F.date_format("time", "yyyy-MM") == "1996-03").count()
    assert one.count() == want > 0
    text = p.select(F.date_format("time", "yyyy-MM-dd HH:mm").alias("time"))
    assert P.posts_in_month(text, "1996-03").count() == want


def test_follows_documents_are_chunked(spark, sf):
    from pyspark.sql import functions as F
    from pulsegraph.operators import graph as G
    from pulsegraph.sources import tables as T
    docs = T.follows_nested(spark, sf, members_per_doc=2)
    assert docs.agg(F.max(F.size("followsList"))).first()[0] <= 12  # ~2 per doc, hash spread
    back = G.follows_from_nested(docs, T.parts(spark, sf))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in T.follows(spark, sf).collect())


def test_one_account_reads_one_bucket(spark, sf):
    from pulsegraph.operators import posts as P
    from pulsegraph.sinks import entities as E
    p = T.posts(spark, sf)
    path = scratch_path(spark, "by-account")
    n = E.write_entities(p, path, "account")
    assert n == E.LEAST_BUCKETS and E.read_manifest(spark, path)["bytes"] == E.input_bytes(p) > 0
    assert E.bucket_count(10**13) == -(-10**13 // E.BUCKET_BYTES)
    E.write_entities(p.limit(10), path, "account", mode="append")
    assert E.read_entities(spark, path).count() == p.count() + 10
    with pytest.raises(ValueError):
        E.write_entities(p.limit(10), path, "post_id", mode="append")
    one = P.scan_account(E.read_entities(spark, path), 7)
    plan = one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(account,7)" in plan
    want = one.count()
    assert want >= p.filter("account = 7").count() > 0
    mine = {r[0].rsplit("_", 1)[1] for r in one.select(F.input_file_name()).distinct().collect()}
    assert len(mine) == 1
    others = [f for f in pathlib.Path(path.replace("file:", "")).glob("part-*") if f.name.rsplit("_", 1)[1] not in mine]
    assert len(others) > 5
    for f in others:  # whatever lies in the other buckets is not looked at
        f.write_text("broken")
    assert P.scan_account(E.read_entities(spark, path), 7).count() == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("entities_")]


def test_account_joins_on_buckets_exchange_nothing(spark, sf):
    from pulsegraph.plans import queries
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        out = queries()["accounts_with_totals"](spark, sf)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert out.count() == T.posts(spark, sf).count()
    finally:
        spark.conf.unset(threshold)


def test_a_hot_account_is_written_by_several_tasks(spark):
    from pulsegraph.sinks import entities as E
    rows = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("account"),
                                       F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path, size = scratch_path(spark, "hot-account"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "500k")
    try:
        E.write_entities(rows, path, "account", buckets=8)
    finally:
        spark.conf.unset(size)
    hot = E.read_entities(spark, path).filter("account = 0")
    assert hot.count() == 100_000
    assert hot.select(F.input_file_name()).distinct().count() > 1


def test_leaderboard_text_files_are_in_month_order(spark, sf):
    import glob
    import os

    from pulsegraph.plans import q_sinks
    path = scratch_path(spark, "lb-text")
    W.write_leaderboard_text(q_sinks._docs(spark, sf), path)
    local = path.replace("file:", "")
    for measure in ("like", "repost", "comment", "total"):
        files = [f for f in glob.glob(os.path.join(local, f"measure={measure}", "part-*")) if not f.endswith(".crc")]
        assert len(files) == 1  # one file per measure
        months = [line.split("\t", 1)[0] for line in open(files[0]).read().splitlines()]
        assert months == sorted(months) and len(months) == 83


def test_documents_keep_all_fields_and_set_the_broken_aside(spark):
    from pulsegraph.session import scratch_path
    from pulsegraph.sources import documents as D
    lines = [
        '{"id":"1","account":"7","repost":"x","content":"a \\"b\\"\\n","tag":["t","u"],"at":["@n"],"imgNum":"2","likeNum":" 3 ",'
        '"repostNum":"4","commentNum":"5","time":"2001-02-30 10:00","extra":1}',
        '{"id":"2","account":"7"}',
        '{"id":"3","account":"7","time":"soon"}',
        '{"id":"4","account":"7","likeNum":"lots"}',
        '{"account":"7"}', '{"id":"5"}', '{"id":"six","account":"7"}',
        '{"id":"8","account":"7","at":"@n"}', '{"id":"9","acc', "junk", "[1, 2]", "",
    ]
    path, aside = scratch_path(spark, "docs"), scratch_path(spark, "aside")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    good = {r.post_id: r for r in D.load_documents(spark, path, aside).collect()}
    assert set(good) == {1, 2, 3}
    one = good[1]
    assert (one.account, one.repost, one.content, one.tags, one.mentions) == (7, "x", 'a "b"\n', ["t", "u"], ["@n"])
    assert (one.img_num, one.like_num, one.repost_num, one.comment_num, str(one.time)) == (2, 3, 4, 5, "2001-03-02 10:00:00")
    assert (good[2].tags, good[2].mentions, good[2].like_num, good[2].time) == ([], [], 0, None)
    assert good[3].time is None
    bad = sorted((r.reason, r.line) for r in spark.read.parquet(aside).collect())
    assert [b[0] for b in bad] == ["likeNum"] + ["malformed"] * 4 + ["no account"] + ["no id"] * 2
    assert {'{"id":"9","acc', "junk", "[1, 2]"} <= {b[1] for b in bad}


def test_calendar_bounds_reach_the_scan(spark, sf):
    from pulsegraph.operators import posts as P
    posts = T.posts(spark, sf)
    some = P.posts_between(posts, 1996, 1998)
    plan = some._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(l_shipdate,1996" in plan and "LessThan(l_shipdate,1999" in plan
    assert 0 < some.count() < posts.count()
    assert {m[:4] for (m,) in some.select("month").distinct().collect()} == {"1996", "1997", "1998"}


def test_months_prune_partitions_at_run_time(spark, sf):
    from pulsegraph.operators import posts as P
    from pulsegraph.session import scratch_path
    path = scratch_path(spark, "months")
    P.with_month(T.posts(spark, sf)).write.partitionBy("month").parquet(path)
    table = spark.read.parquet(path)
    months = P.month_calendar(spark, 1990, 2000).where("month like '1995-0%'")
    out = P.scan_months(table, months)
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    assert {r.month for r in out.select("month").distinct().collect()} == {f"1995-0{i}" for i in range(1, 10)}
    assert out.count() == table.where("month >= '1995-01' and month < '1995-10'").count()
