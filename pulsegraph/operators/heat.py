"""Monthly roll-ups, heat series and leaderboards.

Shuffle plan of the flagship (posts -> monthly -> decay -> top-5):
  1. ``groupBy(account, month)`` with partial (map-side) aggregation, so a hot
     account is pre-aggregated before the exchange;
  2. ``groupBy(account)`` over at most one row per (account, month): a group
     is bounded by the calendar, never by the number of posts;
  3. ``row_number() <= n`` per month, planned as ``WindowGroupLimit``: each
     map task keeps only its local top-n per month before the exchange, so a
     month holding every account never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegraph.functions.columns import heat_score, month_of
from pulsegraph.operators.joins import lookup
from pulsegraph.operators.posts import originals

MEASURES = ("like_num", "repost_num", "comment_num")
HEAT = ("like_heat", "repost_heat", "comment_heat")


def monthly_measures(posts: DataFrame, key: str = "account", time: str = "time") -> DataFrame:
    """Σ like / repost / comment per (account, month); posts without a time are in no month."""
    return posts.filter(F.col(time).isNotNull()).groupBy(F.col(key), month_of(time).alias("month")).agg(
        *[F.sum(m).cast("bigint").alias(m) for m in MEASURES]
    )


#: months in a block: x * 2^60 for any bigint x, summed over a block, stays within decimal(38)
BLOCK_MONTHS = 60


def heat_decay_series(monthly: DataFrame, key: str = "account") -> DataFrame:
    """Half-life heat per account over its months in ascending order.

    ``v1 = x1``, ``vn = xn + v(n-1) div 2`` for each measure separately; only
    months present for the account are steps (a gap does not halve again).

    Steps compose: ``(x + v div 2) div 2 = (2x + v) div 4`` for counts, so n
    steps are the one map ``v -> (v + S) div 2^n`` with ``S = Σ x_i 2^i``.  An
    account's months are cut in blocks of 60; inside a block S is a running
    sum, and only the blocks' own maps are chained.  Exact, and linear in the
    months: no array of an account's months is built.  Missing counts are 0;
    negative ones fail the job.
    """
    order = Window.partitionBy(key).orderBy("month")
    inside = Window.partitionBy(key, "__block").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)

    def count(m: str) -> Column:
        x = F.coalesce(F.col(m), F.lit(0))
        return F.when(x < 0, F.raise_error(F.lit(f"{m} is negative"))).otherwise(x).cast("decimal(20,0)")

    power = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__step")).cast("decimal(20,0)")
    n = F.row_number().over(order) - 1
    rows = (
        monthly.select(key, "month", *MEASURES, n.alias("__n"))
        .withColumn("__block", F.floor(F.col("__n") / BLOCK_MONTHS).cast("int"))
        .withColumn("__step", (F.col("__n") % BLOCK_MONTHS + 1).cast("int"))
        .withColumns({f"__{h}": F.sum(count(m) * power).over(inside) for m, h in zip(MEASURES, HEAT)})
    )
    # a block's map stands at its last row; a row needs those of the blocks before its own
    ends = Window.partitionBy(key)
    last = (F.col("__step") == BLOCK_MONTHS)
    rows = rows.withColumn("__ends", F.array_sort(F.collect_list(
        F.when(last, F.struct("__block", *[F.col(f"__{h}").alias(h) for h in HEAT]))).over(ends)))

    def value(h: str) -> Column:
        before = F.expr(
            f"aggregate(slice(__ends, 1, __block), cast(0 as decimal(38,0)), "
            f"(v, e) -> cast((v + e.{h}) div shiftleft(1L, {BLOCK_MONTHS}) as decimal(38,0)))")
        return F.call_function("div", before + F.col(f"__{h}"), power).cast("bigint").alias(h)

    return rows.select(key, "month", *[value(h) for h in HEAT])


def heat_cumulative_series(monthly: DataFrame, key: str = "account") -> DataFrame:
    """Plain running total per account in month order (what the published
    leaderboards show)."""
    w = Window.partitionBy(key).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        key, "month", *[F.sum(m).over(w).cast("bigint").alias(h) for m, h in zip(MEASURES, HEAT)]
    )


def heat_total(series: DataFrame) -> DataFrame:
    """Adds ``total_heat = like + 3·repost + 2·comment`` (formed after decay)."""
    return series.withColumn("total_heat", heat_score(*HEAT).cast("bigint"))


def top_n_per_month(
    series: DataFrame,
    value: str,
    n: int = 5,
    key: str = "account",
    names: DataFrame | None = None,
) -> DataFrame:
    """Top ``n`` accounts per month by ``value`` (ties: smaller account first).

    Only accounts with a row in that month compete.
    """
    w = Window.partitionBy("month").orderBy(F.col("value").desc(), F.col(key).asc())
    top = (
        series.select("month", key, F.col(value).alias("value"))
        .withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= n)
    )
    if names is not None:
        top = lookup(top, names, key, strict=True)
    return top


def leaderboards(series_with_total: DataFrame, n: int = 5, key: str = "account") -> DataFrame:
    """All four leaderboards in one pass: (measure, month, position, account, value)."""
    stacked = series_with_total.select(
        "month",
        key,
        F.expr(
            "stack(4, 'like', like_heat, 'repost', repost_heat, "
            "'comment', comment_heat, 'total', total_heat) as (measure, value)"
        ),
    )
    w = Window.partitionBy("measure", "month").orderBy(F.col("value").desc(), F.col(key).asc())
    return stacked.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def account_measure_totals(posts: DataFrame, key: str = "account") -> DataFrame:
    return posts.groupBy(key).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])


def global_top(
    posts: DataFrame,
    measure: str,
    n: int = 10,
    originals_only: bool = False,
    key: str = "account",
    names: DataFrame | None = None,
) -> DataFrame:
    """Top ``n`` accounts over all time by Σ ``measure`` (``influence`` = heat score).

    Partial aggregation per account, then ``orderBy().limit()`` which plans as
    ``TakeOrderedAndProject``: every task keeps its local top ``n``.
    """
    src = originals(posts) if originals_only else posts
    totals = account_measure_totals(src, key)
    value = heat_score(*MEASURES) if measure == "influence" else F.col(measure)
    ranked = totals.select(key, value.cast("bigint").alias("value")).orderBy(
        F.col("value").desc(), F.col(key).asc()
    ).limit(n)
    w = Window.orderBy(F.col("value").desc(), F.col(key).asc())
    ranked = ranked.withColumn("position", F.row_number().over(w))
    if names is not None:
        ranked = lookup(ranked, names, key, strict=True)
    return ranked
