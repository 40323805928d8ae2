"""Registered graph queries: follows graph (parts) and mention graph (users)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegraph.operators import graph as G
from pulsegraph.operators import mentions as M
from pulsegraph.operators.joins import unique_dictionary
from pulsegraph.plans.registry import query
from pulsegraph.plans.sqlviews import with_views
from pulsegraph.sources import tables as T

# Fixed iteration count of the oracle's plain PageRank: far past convergence
# (0.85^300 ~ 1e-21), so it equals the tolerance-driven Spark result.
ORACLE_PR_ITERS = 300
ORACLE_WPR_ITERS = 200


def _follows(spark, d):
    return T.follows(spark, d)


def _at(spark, d):
    return M.at_edges(T.mentions(spark, d), T.users(spark, d))


GRAPHS = {
    # name suffix: (spark edges, spark dictionary, sql edge view, sql dict view)
    "": (_follows, T.parts, "follows", "parts"),
    "_at": (_at, T.users, "at_edges", "users"),
}


def _verts_sql(g: str) -> str:
    return f"verts AS (SELECT src AS id FROM {g} UNION SELECT dst FROM {g})"


def _tri_cte(gv: str, dv: str) -> str:
    return with_views(gv, dv, extra=_verts_sql(gv) + f""",
und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM {gv} WHERE src <> dst),
tri AS (SELECT x.a AS u, x.b AS v, y.b AS w
        FROM und x JOIN und y ON x.a = y.a AND x.b < y.b JOIN und z ON z.a = x.b AND z.b = y.b),
cnt AS (SELECT id, count(*) AS t FROM (SELECT u AS id FROM tri UNION ALL SELECT v FROM tri
                                      UNION ALL SELECT w FROM tri) c GROUP BY id)""")


def _pr_cte(gv: str, *more_views: str) -> str:
    return with_views(gv, *more_views, extra=_verts_sql(gv) + f""",
od AS (SELECT src, count(*) AS od FROM {gv} GROUP BY src),
w AS (SELECT f.src, f.dst, CAST(count(*) AS DOUBLE) / any_value(od.od) AS w
      FROM {gv} f JOIN od ON od.src = f.src GROUP BY f.src, f.dst
      UNION ALL SELECT id, id, 0.0 FROM verts),
pr(it, id, rank) AS (
  SELECT 0, id, CAST(1.0 AS DOUBLE) FROM verts
  UNION ALL
  SELECT pr.it + 1, w.dst, 0.15 + 0.85 * sum(pr.rank * w.w)
  FROM pr JOIN w ON w.src = pr.id WHERE pr.it < {ORACLE_PR_ITERS} GROUP BY pr.it, w.dst)""")


_PR_SCALED = (f"round(rank * (SELECT count(*) FROM verts) "
              f"/ (SELECT sum(rank) FROM pr WHERE it = {ORACLE_PR_ITERS}), 6)")


for suffix, (edges_fn, dict_fn, gv, dv) in GRAPHS.items():
    for kind, col in (("in", "dst"), ("out", "src")):
        name = f"degree_{kind}_named" if not suffix else f"degree_{kind}{suffix}"
        sql = with_views(gv, dv) + f"""
SELECT d.id, p.name, d.degree
FROM (SELECT {col} AS id, count(*) AS degree FROM {gv} GROUP BY {col}) d JOIN {dv} p ON p.id = d.id"""
        deg = G.in_degree if kind == "in" else G.out_degree
        query(name, sql=sql, operators=("V-4", "V-5", "J-2"))(
            lambda spark, d, _e=edges_fn, _n=dict_fn, _g=deg: G.named(_g(_e(spark, d)), _n(spark, d))
        )

    tri_sql = _tri_cte(gv, dv) + f"""
SELECT v.id, p.name, CAST(coalesce(c.t, 0) AS BIGINT) AS triangles
FROM verts v LEFT JOIN cnt c ON c.id = v.id JOIN {dv} p ON p.id = v.id"""
    query(f"triangle_count{suffix}", sql=tri_sql, operators=("V-6",))(
        lambda spark, d, _e=edges_fn, _n=dict_fn: G.named(G.triangle_count(_e(spark, d)), _n(spark, d))
    )

    pr_sql = _pr_cte(gv) + f"""
SELECT id, {_PR_SCALED} AS pagerank FROM pr WHERE it = {ORACLE_PR_ITERS}"""
    query(f"pagerank{suffix}", sql=pr_sql, operators=("V-7", "V-8"))(
        lambda spark, d, _e=edges_fn: G.pagerank(_e(spark, d)).select(
            "id", F.round("pagerank", 6).alias("pagerank")
        )
    )


# --------------------------------------------------------------------------- full rankings


def _ranking_sql(ctes: str, scores: str, names: str) -> str:
    return ctes + f"""
SELECT row_number() OVER (ORDER BY s.value DESC, s.id ASC) AS position, s.id, n.name, s.value
FROM ({scores}) s LEFT JOIN {names} n ON n.id = s.id"""


def _ranking(scores, value, dictionary):
    """``position, id, name, value`` of every vertex; ids without a name keep their row."""
    ranked = G.full_ranking(scores.select("id", F.col(value).alias("value")), "value")
    names = unique_dictionary(dictionary)
    return ranked.join(names, "id", "left").select("position", "id", "name", "value")


def _rounded(ranks):
    return ranks.select("id", F.round("pagerank", 6).alias("pagerank"))


for suffix, (edges_fn, dict_fn, gv, dv) in GRAPHS.items():
    graph = suffix or "_follows"
    for kind, col, deg in (("in", "dst", G.in_degree), ("out", "src", G.out_degree)):
        query(f"ranking_{kind}_degree{graph}", operators=("O-1", "K-5", "V-4" if kind == "in" else "V-5"),
              sql=_ranking_sql(with_views(gv, dv), f"SELECT {col} AS id, count(*) AS value FROM {gv} GROUP BY {col}", dv))(
            lambda spark, d, _e=edges_fn, _n=dict_fn, _g=deg: _ranking(_g(_e(spark, d)), "degree", _n(spark, d))
        )
    query(f"ranking_triangles{graph}", operators=("O-1", "K-5", "V-6"),
          sql=_ranking_sql(_tri_cte(gv, dv), "SELECT v.id, CAST(coalesce(c.t, 0) AS BIGINT) AS value "
                           "FROM verts v LEFT JOIN cnt c ON c.id = v.id", dv))(
        lambda spark, d, _e=edges_fn, _n=dict_fn: _ranking(G.triangle_count(_e(spark, d)), "triangles", _n(spark, d))
    )
    query(f"ranking_pagerank{graph}", operators=("O-1", "K-5", "V-7", "V-8"),
          sql=_ranking_sql(_pr_cte(gv, dv), f"SELECT id, {_PR_SCALED} AS value FROM pr WHERE it = {ORACLE_PR_ITERS}", dv))(
        lambda spark, d, _e=edges_fn, _n=dict_fn: _ranking(_rounded(G.pagerank(_e(spark, d))), "pagerank", _n(spark, d))
    )


def _pagerank_named(spark, d):
    pr = G.pagerank(_follows(spark, d)).select("id", F.round("pagerank", 6).alias("pagerank"))
    return G.named(pr, T.parts(spark, d), strict=False)


query("pagerank_named", sql=_pr_cte("follows", "parts") + f"""
SELECT q.id, p.name, q.pagerank
FROM (SELECT id, {_PR_SCALED} AS pagerank FROM pr WHERE it = {ORACLE_PR_ITERS}) q
JOIN parts p ON p.id = q.id""", operators=("J-1", "V-7"))(_pagerank_named)


_WPR_CTE = with_views("follows", "mentions", "users", "parts", extra=_verts_sql("follows") + f""",
counts AS (SELECT src, dst, count(*) AS weight FROM mentions WHERE dst IN (SELECT id FROM users) GROUP BY src, dst),
raw AS (SELECT f.src, f.dst, count(*) * (1 + coalesce(any_value(m.weight), 0)) AS raw
        FROM follows f LEFT JOIN counts m ON m.src = f.src AND m.dst = f.dst GROUP BY f.src, f.dst),
w AS (SELECT src, dst, CAST(raw AS DOUBLE) / sum(raw) OVER (PARTITION BY src) AS w FROM raw
      UNION ALL SELECT id, id, 0.0 FROM verts),
pr(it, id, rank) AS (
  SELECT 0, id, CAST(1.0 AS DOUBLE) FROM verts
  UNION ALL
  SELECT pr.it + 1, w.dst, 0.15 + 0.85 * sum(pr.rank * w.w)
  FROM pr JOIN w ON w.src = pr.id WHERE pr.it < {ORACLE_WPR_ITERS} GROUP BY pr.it, w.dst),
delta AS (SELECT a.it, max(abs(a.rank - b.rank) / b.rank) AS d
          FROM pr a JOIN pr b ON a.id = b.id AND a.it = b.it + 1 GROUP BY a.it),
stop AS (SELECT min(it) AS it FROM delta WHERE d < 0.001)""")
_WPR_SCORES = """
SELECT id, round(rank * (SELECT count(*) FROM verts)
                 / (SELECT sum(rank) FROM pr WHERE it = (SELECT it FROM stop)), 6) AS pagerank
FROM pr WHERE it = (SELECT it FROM stop)"""


@query("pagerank_weighted", operators=("V-9",), sql=_WPR_CTE + _WPR_SCORES)
def pagerank_weighted(spark, d):
    # every mention counts here; the weight threshold belongs to the mention graph only
    counts = M.at_edges(T.mentions(spark, d), T.users(spark, d), min_weight_exclusive=0)
    return G.pagerank_weighted(_follows(spark, d), counts).select(
        "id", F.round("pagerank", 6).alias("pagerank")
    )


@query("ranking_pagerank_weighted", operators=("O-1", "K-5", "V-9"),
       sql=_ranking_sql(_WPR_CTE, _WPR_SCORES.replace("AS pagerank", "AS value"), "parts"))
def ranking_pagerank_weighted(spark, d):
    return _ranking(pagerank_weighted(spark, d), "pagerank", T.parts(spark, d))


_SCC_SQL = with_views("at_edges", extra=_verts_sql("at_edges") + """,
e AS (SELECT DISTINCT src, dst FROM at_edges WHERE src <> dst),
reach(a, b) AS (SELECT src, dst FROM e UNION SELECT r.a, e.dst FROM reach r JOIN e ON e.src = r.b),
mutual AS (SELECT r1.a AS id, r1.b AS other FROM reach r1 JOIN reach r2 ON r1.a = r2.b AND r1.b = r2.a),
scc AS (SELECT v.id, CAST(least(v.id, coalesce(min(m.other), v.id)) AS BIGINT) AS component
        FROM verts v LEFT JOIN mutual m ON m.id = v.id GROUP BY v.id)""")


@query("scc", operators=("V-10",), sql=_SCC_SQL + "SELECT id, component FROM scc")
def scc(spark, d):
    return G.strongly_connected_components(_at(spark, d))


@query("scc_members", operators=("V-11", "A-9", "J-7"), sql=_SCC_SQL + """
SELECT s.component, s.id, u.name, CAST(count(*) OVER (PARTITION BY s.component) AS BIGINT) AS size
FROM scc s JOIN users u ON u.id = s.id""")
def scc_members(spark, d):
    return G.scc_members(G.strongly_connected_components(_at(spark, d)), T.users(spark, d))


@query("vertex_dictionary", operators=("V-1", "J-5", "E-14"), sql=with_views("follows", "parts", extra=_verts_sql("follows")) + """
SELECT CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS hash, id,
       coalesce(name, 'null') AS name
FROM (SELECT v.id, p.name,
             list_reduce(list_transform(string_split(CAST(v.id AS VARCHAR), ''), lambda c: ascii(c)),
                         lambda h, c: (h * 31 + c) % 4294967296, CAST(0 AS BIGINT)) AS h
      FROM verts v LEFT JOIN parts p ON p.id = v.id) x""")
def vertex_dictionary(spark, d):
    return G.vertex_dictionary(G.vertices_of(_follows(spark, d)), T.parts(spark, d))


@query("follows_from_nested", operators=("X-2", "V-2"), sql=with_views("follows", "parts") + """
SELECT src, dst FROM follows WHERE src IN (SELECT id FROM parts)""")
def follows_from_nested(spark, d):
    return G.follows_from_nested(T.follows_nested(spark, d), T.parts(spark, d))
