"""Feature networks."""

from pyspark.sql import functions as F

from meadow.operators import network as nw
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.queries_h_beta import DENSE
from meadow.plans.registry import q6, query, r6

CLR = """SELECT sample_id, feature_id, LN(count + 1) - AVG(LN(count + 1)) OVER (PARTITION BY sample_id) AS c FROM x"""
PR = "SELECT u.feature_id AS a, v.feature_id AS b, VAR_SAMP(u.c - v.c) AS vlr, VAR_SAMP(u.c) AS va, VAR_SAMP(v.c) AS vb, CORR(u.c, v.c) AS r FROM c u JOIN c v ON u.sample_id = v.sample_id AND u.feature_id < v.feature_id GROUP BY 1, 2"


def base(**more):
    return cte(ab=fx.SQL["abb"], x=DENSE, c=CLR, pr=PR, **more)


@query("j01_proportionality", base() + f"SELECT a, b, {q6('vlr')} AS vlr, {q6('vlr/(va+vb)')} AS phi, {q6('1 - vlr/(va+vb)')} AS rho FROM pr")
def j01(spark, d):
    return rounded(nw.proportionality(fx.abundance_brand(spark, d)))


@query("j02_proportionality_edges", base() + f"SELECT a AS src, b AS dst, {q6('1 - vlr/(va+vb)')} AS weight FROM pr WHERE ABS(1 - vlr/(va+vb)) >= 0.05")
def j02(spark, d):
    return rounded(nw.proportionality_edges(fx.abundance_brand(spark, d), 0.05))


@query("j03_spearman_network")
def j03(spark, d):
    return nw.spearman_network(fx.abundance_kind(spark, d), 100, 0.05)


def part_graph(spark, d):
    """Undirected graph of parts: neighbours by key arithmetic, a hub every 97 parts."""
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    n = p.count()
    e = p.select(F.explode(F.array(F.struct(F.col("k").alias("src"), (F.col("k") * 3 % n).alias("dst")), F.struct(F.col("k").alias("src"), ((F.col("k") + 1) % n).alias("dst")),
                                   F.struct(F.col("k").alias("src"), (F.col("k") % 97).alias("dst")))).alias("e")).select("e.src", "e.dst").filter("src <> dst")
    return e.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


GRAPH = """SELECT DISTINCT LEAST(s, t) AS x, GREATEST(s, t) AS y FROM (SELECT p_partkey AS s, p_partkey*3 % n AS t FROM part, (SELECT COUNT(*) AS n FROM part) UNION ALL SELECT p_partkey, (p_partkey + 1) % n FROM part, (SELECT COUNT(*) AS n FROM part)
UNION ALL SELECT p_partkey, p_partkey % 97 FROM part) WHERE s <> t"""


@query("j04_network_stats", cte(e=GRAPH) + f"SELECT n AS nodes, m AS edges, CAST(CASE WHEN n = (WITH RECURSIVE r AS (SELECT MIN(x) AS v FROM e UNION SELECT CASE WHEN e.x = r.v THEN e.y ELSE e.x END FROM r JOIN e ON r.v IN (e.x, e.y)) SELECT COUNT(*) FROM r) THEN 1 END AS BIGINT) AS components, {q6('2*m/(n*(n-1))')} AS density FROM (SELECT COUNT(DISTINCT v) AS n FROM (SELECT x AS v FROM e UNION ALL SELECT y FROM e)), (SELECT COUNT(*) AS m FROM e)")
def j04(spark, d):
    return rounded(nw.network_stats(part_graph(spark, d)))


@query("j04_compare_networks", cte(e=GRAPH, t="SELECT 'a' AS m, x, y FROM e WHERE (x + y) % 2 = 0 UNION ALL SELECT 'b', x, y FROM e WHERE (x + y) % 3 = 0 UNION ALL SELECT 'c', x, y FROM e WHERE x % 5 = 0") + f"""
, p AS (SELECT * FROM (VALUES ('a', 'b'), ('a', 'c'), ('b', 'c')) v(f, s)), k AS (SELECT f, s, x, y, MAX(CASE WHEN m = f THEN 1 ELSE 0 END) AS i, MAX(CASE WHEN m = s THEN 1 ELSE 0 END) AS j FROM p, t GROUP BY 1, 2, 3, 4)
SELECT f AS first, s AS second, CAST(SUM(i*j) AS BIGINT) AS shared, {q6('SUM(i*j)/SUM(GREATEST(i, j))')} AS jaccard FROM k GROUP BY 1, 2""")
def j04b(spark, d):
    e = part_graph(spark, d)
    return rounded(nw.compare_networks({"a": e.filter("(src + dst) % 2 = 0"), "b": e.filter("(src + dst) % 3 = 0"), "c": e.filter("src % 5 = 0")}))


@query("j05_local_clustering", cte(e=GRAPH) + f""", b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e), dg AS (SELECT x, COUNT(*) AS k FROM b GROUP BY 1),
t AS (SELECT u.x AS v, COUNT(*) AS t FROM b u JOIN b w ON u.x = w.x AND u.y < w.y JOIN e ON e.x = u.y AND e.y = w.y GROUP BY 1)
SELECT dg.x AS node, k AS degree, {q6('CASE WHEN k > 1 THEN 2*COALESCE(t, 0)/(k*(k-1)) ELSE 0 END')} AS clustering FROM dg LEFT JOIN t ON t.v = dg.x""")
def j05(spark, d):
    return rounded(nw.local_clustering(part_graph(spark, d)))


STUDIES = ["0", "1", "2", "3", "4"]


@query("j06_study_feature_matrix", """SELECT l_partkey AS feature_id, """ + ", ".join(f"CAST(MAX(CASE WHEN s_nationkey % 5 = {i} THEN 1 ELSE 0 END) AS INTEGER) AS \"{i}\"" for i in range(5)) + """,
CAST(COUNT(DISTINCT s_nationkey % 5) AS INTEGER) AS n_studies FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""")
def j06(spark, d):
    s = fx.table(spark, d, "supplier")
    p = fx.table(spark, d, "lineitem").join(s, F.col("l_suppkey") == s.s_suppkey).select(F.col("l_partkey").alias("feature_id"), (F.col("s_nationkey") % 5).cast("string").alias("study"))
    return nw.study_feature_matrix(p, STUDIES)


@query("j07_clr_correlation", base() + f"SELECT a, b, {q6('r')} AS r FROM pr")
def j07(spark, d):
    return rounded(nw.clr_correlation(fx.abundance_brand(spark, d)))
