"""DuckDB definitions of the fixture views, for the oracle SQL.

The oracle sees only the raw driver tables, so each statement carries the
views it needs as CTEs.  Same intent as ``pulsegraph.sources.tables``.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "posts": (
        """SELECT l_orderkey AS post_id, l_suppkey AS account,
                  CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS repost,
                  l_shipdate AS time,
                  CAST(l_quantity AS BIGINT) AS like_num,
                  CAST(l_linenumber AS BIGINT) AS repost_num,
                  CAST(l_partkey % 10 AS BIGINT) AS comment_num
           FROM lineitem""",
        (),
    ),
    "accounts": ("SELECT s_suppkey AS id, s_name AS name FROM supplier", ()),
    "posts_at": (
        """SELECT event_id AS post_id, user_id AS account, ts AS time,
                  CASE WHEN event_type = 'error' THEN CAST([] AS VARCHAR[])
                       ELSE ['@' || json_extract_string(props, '$.k')] END AS "at"
           FROM events""",
        (),
    ),
    "mentions": (
        """SELECT user_id AS src, CAST(json_extract_string(props, '$.k') AS BIGINT) AS dst, ts
           FROM events""",
        (),
    ),
    "users": (
        "SELECT DISTINCT user_id AS id, CAST(user_id AS VARCHAR) AS name FROM events",
        (),
    ),
    "at_edges": (
        """SELECT src, dst, CAST(count(*) AS BIGINT) AS weight
           FROM mentions WHERE dst IN (SELECT id FROM users)
           GROUP BY src, dst HAVING count(*) > 1""",
        ("mentions", "users"),
    ),
    "follows": (
        """SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
           FROM lineitem a JOIN lineitem b
             ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1""",
        (),
    ),
    "parts": ("SELECT p_partkey AS id, p_name AS name FROM part", ()),
    "monthly": (
        """SELECT account, strftime(time, '%Y-%m') AS month,
                  CAST(sum(like_num) AS BIGINT) AS like_num,
                  CAST(sum(repost_num) AS BIGINT) AS repost_num,
                  CAST(sum(comment_num) AS BIGINT) AS comment_num
           FROM posts GROUP BY ALL""",
        ("posts",),
    ),
    "decay": (
        # exact integer half-life fold, one recursion step per present month
        """SELECT account, month, like_heat, repost_heat, comment_heat FROM decay_rec""",
        ("decay_rec",),
    ),
    "decay_rec": (
        None,  # recursive, defined in with_views
        ("monthly",),
    ),
    "decay_total": (
        """SELECT *, like_heat + 3 * repost_heat + 2 * comment_heat AS total_heat FROM decay""",
        ("decay",),
    ),
    "cumulative": (
        """SELECT account, month,
                  CAST(sum(like_num) OVER w AS BIGINT) AS like_heat,
                  CAST(sum(repost_num) OVER w AS BIGINT) AS repost_heat,
                  CAST(sum(comment_num) OVER w AS BIGINT) AS comment_heat
           FROM monthly
           WINDOW w AS (PARTITION BY account ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        ("monthly",),
    ),
    "cumulative_total": (
        """SELECT *, like_heat + 3 * repost_heat + 2 * comment_heat AS total_heat FROM cumulative""",
        ("cumulative",),
    ),
}

DECAY_REC = """decay_rec(account, month, rn, like_heat, repost_heat, comment_heat) AS (
    SELECT account, month, rn, like_num, repost_num, comment_num
    FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY month) AS rn FROM monthly) m0
    WHERE rn = 1
    UNION ALL
    SELECT m.account, m.month, m.rn,
           m.like_num + r.like_heat // 2,
           m.repost_num + r.repost_heat // 2,
           m.comment_num + r.comment_heat // 2
    FROM decay_rec r
    JOIN (SELECT *, row_number() OVER (PARTITION BY account ORDER BY month) AS rn FROM monthly) m
      ON m.account = r.account AND m.rn = r.rn + 1
)"""


def _order(names: tuple[str, ...], seen: list[str]) -> None:
    for n in names:
        if n in seen:
            continue
        _order(VIEWS[n][1], seen)
        seen.append(n)


def with_views(*names: str, extra: str = "") -> str:
    """``WITH RECURSIVE`` prefix defining ``names`` (and what they need)."""
    seen: list[str] = []
    _order(names, seen)
    parts = []
    for n in seen:
        body = VIEWS[n][0]
        parts.append(DECAY_REC if n == "decay_rec" else f"{n} AS ({body})")
    if extra:
        parts.append(extra)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"
