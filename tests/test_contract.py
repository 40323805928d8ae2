"""Driver contract and plan-shape checks."""

import __spark_entry__ as E
from pulsegraph import plans
from pulsegraph.sources import tables as T
from pulsegraph.operators import heat as H

# queries whose correctness is checked by rows only: none at the moment
NO_ORACLE: set[str] = set()


def test_every_query_has_an_oracle():
    assert set(plans.queries()) - set(plans.oracle_sql()) == NO_ORACLE
    assert set(plans.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert sorted(df.columns) == ["account", "month", "name", "position", "value"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark, sf):
    df = E.queries()["top5_total"](spark, sf)
    plan = _plan(df)
    assert "Python" not in plan  # no Python UDF anywhere
    txt = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "WindowGroupLimit" in txt and "Partial" in txt  # top-5 limited before the exchange
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in txt


def test_no_python_in_query_plans(spark, sf):
    qs = E.queries()
    for name in ("monthly_measures", "heat_decay_series", "period_membership", "account_totals",
                 "at_edges", "mention_counts", "triangle_count", "vertex_dictionary"):
        assert "Python" not in _plan(qs[name](spark, sf)), name


def test_monthly_aggregate_is_partial_before_exchange(spark, sf):
    txt = H.monthly_measures(T.posts(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in txt


def test_dictionary_joins_are_planned_by_size(spark, sf):
    from pulsegraph.operators.joins import lookup
    joined = lookup(T.posts(spark, sf).select("account"), T.accounts(spark, sf), "account")
    assert "BroadcastHashJoin" in _plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(T.posts(spark, sf).select("account"), T.accounts(spark, sf), "account")
        assert "SortMergeJoin" in _plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_building_a_query_runs_no_job(spark, sf, monkeypatch):
    """But for the one that each read of a parquet schema takes."""
    reader, reads = type(spark.read), []
    plain = reader.parquet
    monkeypatch.setattr(reader, "parquet", lambda self, *paths, **o: reads.append(paths) or plain(self, *paths, **o))
    sc = spark.sparkContext
    for name in ("degree_in_at", "mention_counts", "top5_total", "posts_by_month", "account_totals",
                 "mentions_known", "vertex_dictionary", "at_edges", "degree_in_named"):
        reads.clear()
        sc.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, sf)
        assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) == len(reads) > 0, name
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_lookup_refuses_a_key_with_two_values(spark):
    import pytest

    from pulsegraph.operators.joins import lookup
    left = spark.createDataFrame([(1,), (2,)], "k long")
    same = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, name string")
    assert sorted(tuple(r) for r in lookup(left, same, "k").collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception):
        lookup(left, spark.createDataFrame([(1, "a"), (1, "z")], "id long, name string"), "k").collect()
