"""Brute-force cross-checks on random inputs (one Spark job per property)."""

import datetime as dt
import random

from pulsegraph.operators import heat as H
from pulsegraph.operators import posts as P

SCHEMA = "post_id long, account long, repost string, time timestamp, like_num long, repost_num long, comment_num long"


def _random_posts(seed, n_accounts=40, max_posts=60):
    rnd = random.Random(seed)
    rows, pid = [], 0
    for acc in range(n_accounts):
        for _ in range(rnd.randint(1, max_posts)):
            t = dt.datetime(rnd.randint(2013, 2016), rnd.randint(1, 12), rnd.randint(1, 28),
                            rnd.choice([0, 0, 13]), rnd.choice([0, 30]))
            if rnd.random() < 0.05:  # exact period starts
                t = dt.datetime(rnd.randint(2013, 2016), rnd.choice([1, 4, 7, 10]), 1, 0, 0)
            rows.append((pid, acc, None, t, rnd.randint(0, 10**6), rnd.randint(0, 50), rnd.randint(0, 9)))
            pid += 1
    return rows


def test_decay_matches_python_fold(spark):
    rows = _random_posts(7)
    got = {(r.account, r.month): (r.like_heat, r.repost_heat, r.comment_heat)
           for r in H.heat_decay_series(H.monthly_measures(spark.createDataFrame(rows, SCHEMA))).collect()}
    sums = {}
    for _, acc, _, t, lk, rp, cm in rows:
        k = (acc, t.strftime("%Y-%m"))
        a = sums.setdefault(k, [0, 0, 0])
        a[0] += lk; a[1] += rp; a[2] += cm
    want = {}
    for acc in {k[0] for k in sums}:
        prev = [0, 0, 0]
        for month in sorted(m for a, m in sums if a == acc):
            x = sums[(acc, month)]
            prev = [x[i] + prev[i] // 2 for i in range(3)]
            want[(acc, month)] = tuple(prev)
    assert got == want


def test_periods_match_brute_force(spark):
    rows = _random_posts(11, n_accounts=20)
    got = sorted((r.post_id, r.period) for r in
                 P.period_membership(spark.createDataFrame(rows, SCHEMA), 2013, 2015).collect())
    periods = []
    for y in range(2013, 2016):
        for m in (1, 4, 7, 10):
            start = dt.datetime(y, m, 1)
            end = dt.datetime(y + 1, 1, 1) if m == 10 else dt.datetime(y, m + 4, 1)
            periods.append((f"{y}_{m}", start, end))
    want = sorted((pid, label) for pid, _, _, t, *_ in rows for label, s, e in periods if s < t < e)
    assert got == want


def test_cumulative_and_top5_match_python(spark):
    rows = _random_posts(3, n_accounts=30, max_posts=20)
    series = H.heat_total(H.heat_cumulative_series(H.monthly_measures(spark.createDataFrame(rows, SCHEMA))))
    got = {(r.month, r.position): (r.account, r.value)
           for r in H.top_n_per_month(series, "total_heat", n=5).collect()}
    totals = {}
    monthly = {}
    for _, acc, _, t, lk, rp, cm in rows:
        a = monthly.setdefault((acc, t.strftime("%Y-%m")), [0, 0, 0])
        a[0] += lk; a[1] += rp; a[2] += cm
    for acc in {a for a, _ in monthly}:
        c = [0, 0, 0]
        for month in sorted(m for a, m in monthly if a == acc):
            c = [c[i] + monthly[(acc, month)][i] for i in range(3)]
            totals[(acc, month)] = c[0] + 3 * c[1] + 2 * c[2]
    want = {}
    for month in {m for _, m in totals}:
        ranked = sorted(((-v, a) for (a, m), v in totals.items() if m == month))[:5]
        for pos, (nv, a) in enumerate(ranked, 1):
            want[(month, pos)] = (a, -nv)
    assert got == want


def test_triangles_on_a_hub_graph_match_brute_force(spark):
    """One hub holds a third of all edges; the degree orientation keeps its
    adjacency small and the counts must still be exact."""
    from itertools import combinations

    from pulsegraph.operators import graph as G

    rnd = random.Random(5)
    n = 120
    edges = [(0, v) for v in range(1, n)] + [(v, 0) for v in range(1, n, 7)]
    edges += [(rnd.randrange(1, n), rnd.randrange(1, n)) for _ in range(2 * n)]
    got = {r.id: r.triangles for r in G.triangle_count(spark.createDataFrame(edges, "src long, dst long")).collect()}
    und = {(min(a, b), max(a, b)) for a, b in edges if a != b}
    adj = {}
    for a, b in und:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    want = {v: 0 for e in edges for v in e}
    for v, nb in adj.items():
        want[v] = sum(1 for x, y in combinations(sorted(nb), 2) if y in adj.get(x, ()))
    assert got == want


def test_string_hash_on_random_bmp_text(spark):
    from pulsegraph.functions.columns import java_string_hash

    rnd = random.Random(9)
    alphabet = [chr(c) for c in list(range(32, 127)) + list(range(0xA0, 0x2FF)) + list(range(0x4E00, 0x4E80))]
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(300)]

    def jvm_hash(s):
        h = 0
        for ch in s:  # BMP only: one UTF-16 unit per character
            h = (h * 31 + ord(ch)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= (1 << 31) else h

    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, s string")
    got = {r.i: r.h for r in df.select("i", java_string_hash("s").alias("h")).collect()}
    assert got == {i: jvm_hash(w) for i, w in enumerate(words)}


def test_decay_of_long_series_is_exact(spark):
    """5,000 months, so 84 blocks, with counts up to the largest bigint a sum allows."""
    rnd = random.Random(12)
    rows, want = [], {}
    for acc, n, top in ((1, 5_000, 10**6), (2, 61, 2**62), (3, 60, 2**62), (4, 1, 5), (None, 130, 9)):
        prev = [0, 0, 0]
        for i in range(n):
            x = [rnd.choice([0, 1, rnd.randrange(top)]) for _ in range(3)]
            prev = [x[k] + prev[k] // 2 for k in range(3)]
            if max(prev) >= 2**63:  # a heat that no bigint holds
                x, prev = [0, 0, 0], [p - y for p, y in zip(prev, x)]
            month = f"{1000 + i // 12:04d}-{i % 12 + 1:02d}"
            rows.append((acc, month, *x))
            want[(acc, month)] = tuple(prev)
    monthly = spark.createDataFrame(rows, "account long, month string, like_num long, repost_num long, comment_num long")
    got = {(r.account, r.month): (r.like_heat, r.repost_heat, r.comment_heat)
           for r in H.heat_decay_series(monthly.repartition(5)).collect()}
    assert got == want


def test_lenient_times_roll_over_like_a_calendar(spark):
    rnd = random.Random(3)

    def calendar(y, mo, d, h, mi):
        months = y * 12 + mo - 1
        first = dt.datetime(months // 12, months % 12 + 1, 1)
        return first + dt.timedelta(days=d - 1, hours=h, minutes=mi)

    from pulsegraph.functions.columns import parse_post_time
    rows = []
    for _ in range(300):
        y, mo, d, h, mi = rnd.randint(1900, 2100), rnd.randint(0, 40), rnd.randint(0, 99), rnd.randint(0, 99), rnd.randint(0, 500)
        text = f"{rnd.choice(['', ' '])}{y}-{mo:0{rnd.choice([1, 2])}d}-{d} {rnd.choice(['', ' '])}{h}:{mi}{rnd.choice(['', ':59', ' x'])}"
        rows.append((text, calendar(y, mo, d, h, mi)))
    rows += [(t, None) for t in ("", "none", "2001/01/02 03:04", "2001-01-02", "2001-01-02T03:04", "x2001-01-02 03:04",
                                 "0-01-02 03:04", "9999-13-01 00:00", "2001-1234567-01 00:00", "2001--1-02 03:04")]
    rows += [("2001-02-30 10:00", dt.datetime(2001, 3, 2, 10)), ("2001-13-05 10:00", dt.datetime(2002, 1, 5, 10)),
             ("2001-04-05 25:10", dt.datetime(2001, 4, 6, 1, 10)), (None, None)]
    df = spark.createDataFrame(rows, "text string, want timestamp")
    wrong = df.select("text", "want", parse_post_time("text").alias("got")).where("not (want <=> got)").collect()
    assert wrong == []
