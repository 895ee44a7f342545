"""

The SQL uses other methods than the operators where it can: betweenness from pair dependencies,
components by label spreading for every number of removed edges, modularity by summing pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import coterie as ct
from coterie.plans.scratch import Scratch

# The operators for training data are an optional part.
try:
    import corpus_pipeline
    from coterie.llm import queries as _llm
except ImportError:
    _llm = None

# Shared hours that make an edge, chosen so that the test tables give graphs of a useful size.
HOURS = 12
HOURS_SMALLEST = 8
PARTS = 4
CUT = 100
LATE = 150
MU = 3
ROW = 5


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return ct.coaffiliation_edges(ct.co_active_hours(spark, folder), HOURS)


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return ct.edge_betweenness(_edges(spark, folder))


def _order(spark: SparkSession, folder: str) -> DataFrame:
    return ct.removal_order(_scores(spark, folder))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def _as_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.array_join(F.col(column).cast("array<string>"), ","))


def entry(spark: SparkSession) -> DataFrame:
    """Edge betweenness of the co-activity graph on the smallest tables."""
    rows = ct.co_active_hours(spark, "/root/testdata/sf0.001")
    return ct.edge_betweenness(ct.coaffiliation_edges(rows, HOURS_SMALLEST)).orderBy("src", "dst")


def _affiliations(spark, folder):
    return ct.affiliations(ct.co_active_hours(spark, folder))


def _ratings_text(spark, folder):
    rows = ct.co_active_hours(spark, folder)
    path = Scratch(spark).folder(keep=True)
    header = spark.range(1).select(F.lit("userId,hour,kind").alias("line"))
    lines = rows.select(F.concat_ws(",", "user", "item", F.lit("event")).alias("line"))
    header.coalesce(1).write.text(f"{path}/part=0")
    lines.write.text(f"{path}/part=1")
    ratings = ct.read_ratings(spark, f"{path}/part=*")
    return ratings.groupBy("user").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.countDistinct("item").alias("n_items")
    )


def _ratings_dropped(spark, folder):
    """Lines of views name no user and those of errors have no item; both are left out."""
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id", "event_type")
    path = Scratch(spark).folder(keep=True)
    user = F.when(F.col("event_type") == "view", "nobody").otherwise(F.col("user_id").cast("string"))
    item = F.when(F.col("event_type") == "error", "").otherwise(F.col("event_id").cast("string"))
    events.select(F.concat_ws(",", user, item, "event_type").alias("line")).write.text(f"{path}/part=1")
    spark.range(1).select(F.lit("userId,event,kind").alias("line")).coalesce(1).write.text(f"{path}/part=0")
    return ct.read_ratings(spark, f"{path}/part=*", on_error="drop")


def _affiliation_sets(spark, folder):
    return _as_text(ct.affiliation_sets(ct.co_active_hours(spark, folder)), "items")


def _coaffil_edges_cust_part(spark, folder):
    return ct.coaffiliation_edges(ct.customer_parts(spark, folder), PARTS)


def _symmetric_edges(spark, folder):
    return ct.symmetrize(_edges(spark, folder))


def _adjacency(spark, folder):
    return _as_text(ct.adjacency(_edges(spark, folder)), "neighbours")


def _graph_size(spark, folder):
    return ct.graph_size(_edges(spark, folder))


def _degrees(spark, folder):
    return ct.degrees(_edges(spark, folder))


def _strongest(edges):
    """The vertices of the edges with the greatest weight: a source set that comes from the tables."""
    best = edges.agg(F.max("weight").alias("weight"))
    return ct.vertices(edges.join(best, "weight", "left_semi"))


def _repeated(spark, folder):
    """The graph with every edge in both orientations, and once more."""
    edges = _edges(spark, folder)
    both = ct.symmetrize(edges)
    return both.unionByName(both)


def _bfs_levels(spark, folder):
    edges = _edges(spark, folder)
    return ct.bfs_levels(edges, _strongest(edges))


def _path_counts(spark, folder):
    edges = _edges(spark, folder)
    return ct.shortest_path_counts(edges, _strongest(edges))


def _source_edge_credit(spark, folder):
    edges = _edges(spark, folder)
    return _rounded(ct.source_edge_credit(edges, _strongest(edges)), "credit")


def _edge_betweenness(spark, folder):
    return _rounded(_scores(spark, folder), "score")


def _removal_order(spark, folder):
    return _order(spark, folder).select("src", "dst", "rank")


def _edges_after_k(spark, folder):
    return ct.edges_after(_order(spark, folder), CUT)


def _cut_labels(spark, folder):
    order = _order(spark, folder)
    return order, ct.connected_components(ct.vertices(order), ct.edges_after(order, CUT))


def _components_after_k(spark, folder):
    return _cut_labels(spark, folder)[1]


def _reachable(spark, folder):
    edges = _edges(spark, folder)
    first = edges.agg(F.min("src")).first()[0]
    return ct.reachable(edges, first)


def _modularity_pair(spark, folder):
    return _rounded(ct.modularity(*_cut_labels(spark, folder), kind="pair"), "q")


def _modularity_standard(spark, folder):
    return _rounded(ct.modularity(*_cut_labels(spark, folder), kind="standard"), "q")


def _cut_curve(spark, folder):
    return _rounded(ct.cut_curve(_order(spark, folder)), "q")


def _cut_curve_late(spark, folder):
    return _rounded(ct.cut_curve(_order(spark, folder), min_removed=LATE), "q")


def _betweenness_of_sources(spark, folder):
    edges = _edges(spark, folder)
    return _rounded(ct.edge_betweenness(edges, _strongest(edges)), "score")


def _best_communities(spark, folder):
    return ct.best_communities(_order(spark, folder))


def _best_communities_late(spark, folder):
    return ct.best_communities(_order(spark, folder), min_removed=LATE, baseline=0.0)


def _structural_similarity(spark, folder):
    return _rounded(ct.structural_similarity(_edges(spark, folder)), "similarity")


def _structural_similarity_open(spark, folder):
    return _rounded(ct.structural_similarity(_edges(spark, folder), closed=False), "similarity")


def _similar_edges(spark, folder):
    return ct.similar_edges(_edges(spark, folder), epsilon=0.5)


def _structural_components(spark, folder):
    return ct.structural_components(_edges(spark, folder))


def _structural_components_half(spark, folder):
    return ct.structural_components(_edges(spark, folder), epsilon=0.5)


def _betweenness_lines(spark, folder):
    return ct.betweenness_lines(_scores(spark, folder), digits=6)


def _betweenness_repeated(spark, folder):
    return _rounded(ct.edge_betweenness(_repeated(spark, folder)), "score")


def _similarity_repeated(spark, folder):
    return _rounded(ct.structural_similarity(_repeated(spark, folder)), "similarity")


def _structural_components_mu(spark, folder):
    return ct.structural_components(_edges(spark, folder), epsilon=0.5, mu=MU)


def _vertices(spark, folder):
    return ct.vertices(_edges(spark, folder))


def _affiliation_sets_rows(spark, folder):
    return _as_text(ct.affiliation_sets(ct.co_active_hours(spark, folder), row_length=ROW), "items")


def _adjacency_rows(spark, folder):
    return _as_text(ct.adjacency(_edges(spark, folder), row_length=ROW), "neighbours")


def _community_lines_rows(spark, folder):
    return ct.community_lines(_best_communities(spark, folder), row_length=ROW)


def _community_lines(spark, folder):
    return ct.community_lines(_best_communities(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ratings_text": _ratings_text,
        "ratings_dropped": _ratings_dropped,
        "affiliations": _affiliations,
        "affiliation_sets": _affiliation_sets,
        "coaffil_edges": _edges,
        "coaffil_edges_cust_part": _coaffil_edges_cust_part,
        "symmetric_edges": _symmetric_edges,
        "adjacency": _adjacency,
        "graph_size": _graph_size,
        "degrees": _degrees,
        "bfs_levels": _bfs_levels,
        "path_counts": _path_counts,
        "source_edge_credit": _source_edge_credit,
        "edge_betweenness": _edge_betweenness,
        "removal_order": _removal_order,
        "edges_after_k": _edges_after_k,
        "components_after_k": _components_after_k,
        "reachable": _reachable,
        "modularity_pair": _modularity_pair,
        "modularity_standard": _modularity_standard,
        "cut_curve": _cut_curve,
        "cut_curve_late": _cut_curve_late,
        "betweenness_of_sources": _betweenness_of_sources,
        "best_communities": _best_communities,
        "best_communities_late": _best_communities_late,
        "structural_similarity": _structural_similarity,
        "structural_similarity_open": _structural_similarity_open,
        "similar_edges": _similar_edges,
        "structural_components": _structural_components,
        "structural_components_half": _structural_components_half,
        "betweenness_lines": _betweenness_lines,
        "community_lines": _community_lines,
        "betweenness_repeated": _betweenness_repeated,
        "similarity_repeated": _similarity_repeated,
        "structural_components_mu": _structural_components_mu,
        "vertices": _vertices,
        "affiliation_sets_rows": _affiliation_sets_rows,
        "adjacency_rows": _adjacency_rows,
        "community_lines_rows": _community_lines_rows,
        **({**_llm.queries(), "pipeline": corpus_pipeline.run} if _llm else {}),
    }


# Common table expressions, each building on the ones before it.
_AFF = """aff AS MATERIALIZED (
  SELECT DISTINCT user_id AS u, CAST(epoch(date_trunc('hour', ts)) / 3600 AS BIGINT) AS i FROM events)"""
_E = f"""{_AFF}, e AS MATERIALIZED (
  SELECT x.u AS src, y.u AS dst, count(*) AS weight FROM aff x JOIN aff y ON x.i = y.i AND x.u < y.u
  GROUP BY x.u, y.u HAVING count(*) >= {HOURS})"""
_N = f"""{_E}, n AS MATERIALIZED (
  SELECT src AS s, dst AS t FROM e UNION ALL SELECT dst, src FROM e),
v AS MATERIALIZED (SELECT s AS v, count(*) AS k FROM n GROUP BY s),
g AS MATERIALIZED (SELECT count(*) AS m FROM e)"""
_B = f"""{_N}, b(s, v, d, c) USING KEY (s, v) AS (
  SELECT v, v, 0, CAST(1 AS DOUBLE) FROM v
  UNION
  SELECT f.s, n.t, f.d + 1, sum(f.c) FROM b f JOIN n ON n.s = f.v
  LEFT JOIN recurring.b r ON r.s = f.s AND r.v = n.t WHERE r.s IS NULL GROUP BY f.s, n.t, f.d)"""
_STRONGEST = """strongest AS (SELECT unnest([src, dst]) AS s FROM e WHERE weight = (SELECT max(weight) FROM e))"""
_SCORES = f"""{_B}, scores AS MATERIALIZED (
  SELECT least(n.s, n.t) AS src, greatest(n.s, n.t) AS dst, sum(x.c * y.c / z.c) / 2 AS score
  FROM n JOIN b x ON x.v = n.s JOIN b y ON y.s = n.t JOIN b z ON z.s = x.s AND z.v = y.v
  WHERE z.d = x.d + 1 + y.d GROUP BY 1, 2)"""
_RANKED = f"""{_SCORES}, o AS MATERIALIZED (
  SELECT src, dst, row_number() OVER (ORDER BY CAST(printf('%.9e', score) AS DOUBLE) DESC, src, dst) AS rank FROM scores)"""


def _labels(ks: str) -> str:
    """Labels (k, v, l) of the components left after removing k edges, for every k in ``ks``."""
    return f"""{_RANKED}, ks AS MATERIALIZED ({ks}), w AS MATERIALIZED (
  SELECT src AS s, dst AS t, rank FROM o UNION ALL SELECT dst, src, rank FROM o),
lab(k, v, l) USING KEY (k, v) AS (
  SELECT ks.k, v.v, v.v FROM ks CROSS JOIN v
  UNION
  SELECT f.k, w.t, min(f.l) FROM lab f JOIN w ON w.s = f.v AND w.rank > f.k
  JOIN recurring.lab r ON r.k = f.k AND r.v = w.t WHERE f.l < r.l GROUP BY f.k, w.t)"""


_PAIR_SUMS = """pairs AS (
  SELECT x.k, sum(CASE WHEN e.src IS NULL THEN 0 ELSE 1 END - CAST(kx.k AS DOUBLE) * ky.k / (2 * g.m)) / (2 * max(g.m)) AS q
  FROM lab x JOIN lab y ON y.k = x.k AND y.l = x.l AND x.v < y.v
  JOIN v kx ON kx.v = x.v JOIN v ky ON ky.v = y.v CROSS JOIN g
  LEFT JOIN e ON e.src = x.v AND e.dst = y.v GROUP BY x.k)"""
_CURVE = f"""{_labels("SELECT CAST(range AS BIGINT) AS k FROM range(0, (SELECT m + 1 FROM g))")}, {_PAIR_SUMS},
counts AS (SELECT k, count(DISTINCT l) AS n_components FROM lab GROUP BY k),
steps AS (SELECT k, n_components, lag(n_components) OVER (ORDER BY k) AS before FROM counts),
curve AS MATERIALIZED (SELECT k, n_components, coalesce(q, 0) AS q, before FROM steps LEFT JOIN pairs USING (k) WHERE k >= 1)"""
_BEST = f"""{_CURVE}, best AS (
  SELECT k FROM curve WHERE k = 1 OR n_components <> before ORDER BY round(q, 12) DESC, k LIMIT 1)"""


def _similarity(own: int) -> str:
    closed = "SELECT s, t FROM n UNION ALL SELECT v, v FROM v" if own else "SELECT s, t FROM n"
    return f"""{_N}, h AS MATERIALIZED ({closed}),
common AS (SELECT e.src, e.dst, count(y.t) AS both FROM e JOIN h x ON x.s = e.src
  LEFT JOIN h y ON y.s = e.dst AND y.t = x.t GROUP BY e.src, e.dst),
sim AS MATERIALIZED (SELECT c.src, c.dst, c.both / sqrt(CAST(a.k + {own} AS DOUBLE) * (z.k + {own})) AS similarity
  FROM common c JOIN v a ON a.v = c.src JOIN v z ON z.v = c.dst)"""


def _similar_components(epsilon: float) -> str:
    return f"""WITH RECURSIVE {_similarity(1)}, w AS MATERIALIZED (
  SELECT src AS s, dst AS t FROM sim WHERE similarity >= {epsilon}
  UNION ALL SELECT dst, src FROM sim WHERE similarity >= {epsilon}),
lab(v, l) USING KEY (v) AS (
  SELECT v, v FROM v
  UNION
  SELECT w.t, min(f.l) FROM lab f JOIN w ON w.s = f.v JOIN recurring.lab r ON r.v = w.t
  WHERE f.l < r.l GROUP BY w.t)
SELECT l AS community, v AS vertex FROM lab"""


def oracle_sql() -> dict[str, str]:
    """For each query the SQL that DuckDB runs on the same tables."""
    at_cut = _labels(f"SELECT CAST({CUT} AS BIGINT) AS k")
    return {
        "ratings_text": """SELECT user_id AS "user", count(*) AS n_ratings,
  count(DISTINCT date_trunc('hour', ts)) AS n_items FROM events GROUP BY user_id""",
        "ratings_dropped": """SELECT user_id AS "user", event_id AS item FROM events WHERE event_type NOT IN ('view', 'error')""",
        "affiliations": f'WITH {_AFF} SELECT u AS "user", i AS item FROM aff',
        "affiliation_sets": f"""WITH {_AFF} SELECT u AS "user", CAST(0 AS BIGINT) AS part,
  string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items FROM aff GROUP BY u""",
        "coaffil_edges": f"WITH {_E} SELECT src, dst, weight FROM e",
        "coaffil_edges_cust_part": f"""WITH aff AS (
  SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
SELECT x.u AS src, y.u AS dst, count(*) AS weight FROM aff x JOIN aff y ON x.i = y.i AND x.u < y.u
GROUP BY x.u, y.u HAVING count(*) >= {PARTS}""",
        "symmetric_edges": f"WITH {_N} SELECT s AS src, t AS dst FROM n",
        "adjacency": f"""WITH {_N} SELECT s AS vertex, CAST(0 AS BIGINT) AS part,
  string_agg(CAST(t AS VARCHAR), ',' ORDER BY t) AS neighbours FROM n GROUP BY s""",
        "graph_size": f"WITH {_N} SELECT (SELECT count(*) FROM v) AS n_vertices, m AS n_edges FROM g",
        "degrees": f"WITH {_N} SELECT v AS vertex, k AS degree FROM v",
        "bfs_levels": f"WITH RECURSIVE {_B}, {_STRONGEST} SELECT s AS source, v AS vertex, d AS depth FROM b WHERE s IN (SELECT s FROM strongest)",
        "path_counts": f"WITH RECURSIVE {_B}, {_STRONGEST} SELECT s AS source, v AS vertex, d AS depth, c AS sigma FROM b WHERE s IN (SELECT s FROM strongest)",
        "source_edge_credit": f"""WITH RECURSIVE {_B}, {_STRONGEST}
SELECT x.s AS source, least(n.s, n.t) AS src, greatest(n.s, n.t) AS dst, round(sum(x.c * y.c / z.c), 6) AS credit
FROM n JOIN b x ON x.v = n.s JOIN b y ON y.s = n.t JOIN b z ON z.s = x.s AND z.v = y.v
WHERE z.d = x.d + 1 + y.d AND x.s IN (SELECT s FROM strongest) GROUP BY 1, 2, 3""",
        "edge_betweenness": f"WITH RECURSIVE {_SCORES} SELECT src, dst, round(score, 6) AS score FROM scores",
        "removal_order": f"WITH RECURSIVE {_RANKED} SELECT src, dst, rank FROM o",
        "edges_after_k": f"WITH RECURSIVE {_RANKED} SELECT src, dst FROM o WHERE rank > {CUT}",
        "components_after_k": f"WITH RECURSIVE {at_cut} SELECT l AS community, v AS vertex FROM lab",
        "reachable": f"""WITH RECURSIVE {_N}, r(v) AS (
  SELECT min(src) FROM e UNION SELECT n.t FROM r JOIN n ON n.s = r.v) SELECT v AS vertex FROM r WHERE v IS NOT NULL""",
        "modularity_pair": f"WITH RECURSIVE {at_cut}, {_PAIR_SUMS} SELECT round(q, 6) AS q FROM pairs",
        "modularity_standard": f"""WITH RECURSIVE {at_cut}
SELECT round(sum(CASE WHEN n.s IS NULL THEN 0 ELSE 1 END - CAST(kx.k AS DOUBLE) * ky.k / (2 * g.m)) / (2 * max(g.m)), 6) AS q
FROM lab x JOIN lab y ON y.l = x.l JOIN v kx ON kx.v = x.v JOIN v ky ON ky.v = y.v CROSS JOIN g
LEFT JOIN n ON n.s = x.v AND n.t = y.v""",
        "cut_curve": f"""WITH RECURSIVE {_CURVE}
SELECT k, n_components, round(q, 6) AS q FROM curve WHERE k = 1 OR n_components <> before""",
        "cut_curve_late": f"""WITH RECURSIVE {_CURVE}
SELECT k, n_components, round(q, 6) AS q FROM curve WHERE k >= {LATE} AND (k = {LATE} OR n_components <> before)""",
        "betweenness_of_sources": f"""WITH RECURSIVE {_B}, {_STRONGEST}
SELECT least(n.s, n.t) AS src, greatest(n.s, n.t) AS dst, round(sum(x.c * y.c / z.c) / 2, 6) AS score
FROM n JOIN b x ON x.v = n.s JOIN b y ON y.s = n.t JOIN b z ON z.s = x.s AND z.v = y.v
WHERE z.d = x.d + 1 + y.d AND x.s IN (SELECT s FROM strongest) GROUP BY 1, 2""",
        "best_communities": f"""WITH RECURSIVE {_BEST}
SELECT l AS community, v AS vertex FROM lab JOIN best USING (k)""",
        "best_communities_late": f"""WITH RECURSIVE {_CURVE}, best AS (
  SELECT k FROM curve WHERE k >= {LATE} AND (k = {LATE} OR n_components <> before) AND n_components > 1 AND q > 0
  ORDER BY round(q, 12) DESC, k LIMIT 1)
SELECT l AS community, v AS vertex FROM lab WHERE k = coalesce((SELECT k FROM best), 0)""",
        "structural_similarity": f"""WITH {_similarity(1)}
SELECT src, dst, round(similarity, 6) AS similarity FROM sim""",
        "structural_similarity_open": f"""WITH {_similarity(0)}
SELECT src, dst, round(similarity, 6) AS similarity FROM sim""",
        "similar_edges": f"WITH {_similarity(1)} SELECT src, dst FROM sim WHERE similarity >= 0.5",
        "structural_components": _similar_components(0.8305),
        "structural_components_half": _similar_components(0.5),
        "betweenness_lines": f"""WITH RECURSIVE {_SCORES} SELECT src, dst,
  '(' || src || ',' || dst || ',' || printf('%.6f', score) || ')' AS line FROM scores ORDER BY src, dst""",
        "community_lines": f"""WITH RECURSIVE {_BEST}
SELECT l AS community, CAST(0 AS BIGINT) AS part,
  '[' || string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) || ']' AS line
FROM lab JOIN best USING (k) GROUP BY l ORDER BY l""",
        "betweenness_repeated": f"WITH RECURSIVE {_SCORES} SELECT src, dst, round(score, 6) AS score FROM scores",
        "similarity_repeated": f"""WITH {_similarity(1)}
SELECT src, dst, round(similarity, 6) AS similarity FROM sim""",
        "structural_components_mu": f"""WITH RECURSIVE {_similarity(1)}, w AS MATERIALIZED (
  SELECT src AS s, dst AS t FROM sim WHERE similarity >= 0.5 UNION ALL SELECT dst, src FROM sim WHERE similarity >= 0.5),
core AS MATERIALIZED (SELECT s AS v FROM w GROUP BY s HAVING count(*) + 1 >= {MU}),
cw AS MATERIALIZED (SELECT s, t FROM w WHERE s IN (SELECT v FROM core) AND t IN (SELECT v FROM core)),
lab(v, l) USING KEY (v) AS (
  SELECT v, v FROM core
  UNION
  SELECT cw.t, min(f.l) FROM lab f JOIN cw ON cw.s = f.v JOIN recurring.lab r ON r.v = cw.t
  WHERE f.l < r.l GROUP BY cw.t),
touch AS (SELECT w.s AS v, min(x.l) AS l FROM w JOIN lab x ON x.v = w.t GROUP BY w.s),
every AS (SELECT v.v, coalesce(lab.l, touch.l, v.v) AS l FROM v LEFT JOIN lab ON lab.v = v.v LEFT JOIN touch ON touch.v = v.v)
SELECT min(v) OVER (PARTITION BY l) AS community, v AS vertex FROM every""",
        "vertices": f"WITH {_N} SELECT v AS vertex FROM v",
        "affiliation_sets_rows": f"""WITH {_AFF}, p AS (
  SELECT u, i, (row_number() OVER (PARTITION BY u ORDER BY i) - 1) // {ROW} AS part FROM aff)
SELECT u AS "user", part, string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) AS items FROM p GROUP BY u, part""",
        "adjacency_rows": f"""WITH {_N}, p AS (
  SELECT s, t, (row_number() OVER (PARTITION BY s ORDER BY t) - 1) // {ROW} AS part FROM n)
SELECT s AS vertex, part, string_agg(CAST(t AS VARCHAR), ',' ORDER BY t) AS neighbours FROM p GROUP BY s, part""",
        "community_lines_rows": f"""WITH RECURSIVE {_BEST}, p AS (
  SELECT l, v, (row_number() OVER (PARTITION BY l ORDER BY v) - 1) // {ROW} AS part FROM lab JOIN best USING (k))
SELECT l AS community, part, CASE WHEN part = 0 THEN '[' ELSE '' END || string_agg(CAST(v AS VARCHAR), ',' ORDER BY v)
  || CASE WHEN part = max(part) OVER (PARTITION BY l) THEN ']' ELSE ',' END AS line
FROM p GROUP BY l, part ORDER BY l, part""",
        **(_llm.oracle_sql() if _llm else {}),
    }
