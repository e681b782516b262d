"""Distances, ordination and distance tests over nation x segment sites (125 samples at every scale)."""

from pyspark.sql import functions as F

from meadow.operators import beta as bt
from meadow.operators import stats as st
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_d_joins import hav
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import ORACLE, q6, query, r6
from meadow.sources.tables import cut_lineage

TOT = "SELECT sample_id, SUM(count) AS t, COUNT(*) AS n FROM ab GROUP BY 1"
IDS = "SELECT a.sample_id AS a, b.sample_id AS b FROM t a JOIN t b ON a.sample_id < b.sample_id"
SH = "SELECT x.sample_id AS a, y.sample_id AS b, SUM(LEAST(x.count, y.count)) AS m, COUNT(*) AS s FROM ab x JOIN ab y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2"
BC = "SELECT i.a, i.b, 1 - 2*COALESCE(m, 0)/(ta.t + tb.t) AS d, 1 - COALESCE(s, 0)/(ta.n + tb.n - COALESCE(s, 0)) AS j FROM i LEFT JOIN sh ON sh.a = i.a AND sh.b = i.b JOIN t ta ON ta.sample_id = i.a JOIN t tb ON tb.sample_id = i.b"


def base(**more):
    return cte("sites", ab=fx.SQL["abs_"], t=TOT, i=IDS, sh=SH, bc=BC, **more)


def bc(spark, d):
    return bt.bray_curtis(fx.abundance_site(spark, d))


def groups(spark, d, col="group"):
    return fx.sites(spark, d).select("sample_id", F.col(col).alias("group"))


@query("h01_bray_curtis", base() + f"SELECT a, b, {q6('d')} AS d FROM bc")
def h01(spark, d):
    return rounded(bc(spark, d))


@query("h02_jaccard", base() + f"SELECT a, b, {q6('j')} AS d FROM bc")
def h02(spark, d):
    return rounded(bt.jaccard(fx.abundance_site(spark, d)))


SITE_KIND = """SELECT CAST(c_nationkey AS VARCHAR) || ':' || c_mktsegment AS sample_id, l_partkey AS feature_id, SUM(l_quantity) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""


def site_kind(spark, d):
    """All lines by part: sparse enough to hold zeros."""
    c = fx.table(spark, d, "customer").select("c_custkey", fx.site_id().alias("sample_id"))
    return (fx.lines(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("sample_id", F.col("l_partkey").alias("feature_id")).agg(F.sum("l_quantity").alias("count")))


DENSE = """SELECT s.sample_id, f.feature_id, COALESCE(count, 0) AS count, (SELECT COUNT(DISTINCT feature_id) FROM ab) AS p FROM (SELECT DISTINCT sample_id FROM ab) s CROSS JOIN (SELECT DISTINCT feature_id FROM ab) f
LEFT JOIN ab ON ab.sample_id = s.sample_id AND ab.feature_id = f.feature_id"""


@query("h03_aitchison", cte(ab=SITE_KIND, x=DENSE) + f""", y AS (SELECT sample_id, feature_id, LN(CASE WHEN count > 0 THEN count/t * (1 - z/CAST(p*p AS DOUBLE)) ELSE 1/CAST(p*p AS DOUBLE) END) AS l FROM x
JOIN (SELECT sample_id, SUM(count) AS t, COUNT(*) FILTER (count = 0) AS z FROM x GROUP BY 1) USING (sample_id)),
c AS (SELECT sample_id, feature_id, l - AVG(l) OVER (PARTITION BY sample_id) AS c FROM y)
SELECT u.sample_id AS a, v.sample_id AS b, {q6('SQRT(SUM((u.c - v.c)*(u.c - v.c)))')} AS d FROM c u JOIN c v ON u.feature_id = v.feature_id AND u.sample_id < v.sample_id GROUP BY 1, 2""")
def h03(spark, d):
    return rounded(bt.aitchison(site_kind(spark, d)))


UF = """sb AS (SELECT sample_id, branch_id, SUM(count/t) AS p, MAX(length) AS l FROM ab JOIN t USING (sample_id) JOIN branch USING (feature_id) GROUP BY 1, 2),
w AS (SELECT sample_id, SUM(l*p) AS w, SUM(l) AS u FROM sb GROUP BY 1),
pr AS (SELECT x.sample_id AS a, y.sample_id AS b, SUM(x.l*LEAST(x.p, y.p)) AS m, SUM(x.l) AS s FROM sb x JOIN sb y ON x.branch_id = y.branch_id AND x.sample_id < y.sample_id GROUP BY 1, 2)"""


@query("h04_unifrac_weighted", cte("branch", ab=fx.SQL["abs_"], t=TOT) + f""", {UF} SELECT a, b, {q6('(wa.w + wb.w - 2*m)/(wa.w + wb.w)')} AS d FROM pr JOIN w wa ON wa.sample_id = a JOIN w wb ON wb.sample_id = b""")
def h04(spark, d):
    return rounded(bt.unifrac(fx.abundance_site(spark, d), fx.branch(spark, d)))


@query("h04_unifrac_unweighted", cte("branch", ab=fx.SQL["abs_"], t=TOT) + f""", {UF} SELECT a, b, {q6('(wa.u + wb.u - 2*s)/(wa.u + wb.u - s)')} AS d FROM pr JOIN w wa ON wa.sample_id = a JOIN w wb ON wb.sample_id = b""")
def h04b(spark, d):
    return rounded(bt.unifrac(fx.abundance_site(spark, d), fx.branch(spark, d), weighted=False))


@query("h05_geo_distance", cte("sites") + f"SELECT x.sample_id AS a, y.sample_id AS b, {q6(hav('x', 'y'))} AS d FROM sites x JOIN sites y ON x.sample_id < y.sample_id")
def h05(spark, d):
    return rounded(bt.geo_distance(fx.sites(spark, d)))


PERM = """l AS (SELECT sample_id, "group" AS g FROM sites), gs AS (SELECT g, COUNT(*) AS n FROM l GROUP BY 1),
ss AS (SELECT SUM(d*d) / (SELECT COUNT(*) FROM l) AS sst, SUM(CASE WHEN la.g = lb.g THEN d*d/n END) AS ssw FROM bc JOIN l la ON la.sample_id = a JOIN l lb ON lb.sample_id = b JOIN gs ON gs.g = la.g)"""


@query("h06_permanova", base() + f", {PERM} SELECT {q6('((sst-ssw)/((SELECT COUNT(*) FROM gs) - 1))/(ssw/((SELECT COUNT(*) FROM l) - (SELECT COUNT(*) FROM gs)))')} AS pseudo_f, {q6('1 - ssw/sst')} AS r2 FROM ss")
def h06(spark, d):
    return rounded(bt.permanova(bc(spark, d), groups(spark, d), 99).select("pseudo_f", "r2"))


@query("h06_permanova_p")
def h06b(spark, d):
    return bt.permanova(bc(spark, d), groups(spark, d, "region"), 199)


@query("h07_permdisp", base() + f""", l AS (SELECT sample_id, "group" AS g FROM sites), e AS (SELECT a AS s, b AS o, d*d AS q FROM bc UNION ALL SELECT b, a, d*d FROM bc),
p AS (SELECT e.s, x.g, SUM(q) AS s1 FROM e JOIN l x ON x.sample_id = e.s JOIN l y ON y.sample_id = e.o WHERE x.g = y.g GROUP BY 1, 2),
g AS (SELECT g, COUNT(*) AS n, SUM(s1) AS gs FROM p GROUP BY 1), c AS (SELECT g, SQRT(GREATEST(s1/n - gs/(2*n*n), 0)) AS v FROM p JOIN g USING (g)),
m AS (SELECT g, COUNT(*) AS n, AVG(v) AS m, VAR_SAMP(v) AS s2 FROM c GROUP BY 1), a AS (SELECT SUM(n*m*m) - POWER(SUM(n*m), 2)/SUM(n) AS b, SUM((n-1)*s2) AS w, SUM(n) AS n, COUNT(*) AS k FROM m)
SELECT {q6('(b/(k-1))/(w/(n-k))')} AS f FROM a""")
def h07(spark, d):
    return rounded(bt.permdisp(bc(spark, d), groups(spark, d)).select("f"))


def more_labels(spark, d):
    """Labels of the sites and of as many samples that have no distances."""
    g = groups(spark, d)
    return g.unionByName(g.select(F.concat(F.lit("none:"), "sample_id").alias("sample_id"), "group"))


@query("h06_permanova_extra_labels", base() + f", {PERM} SELECT {q6('((sst-ssw)/((SELECT COUNT(*) FROM gs) - 1))/(ssw/((SELECT COUNT(*) FROM l) - (SELECT COUNT(*) FROM gs)))')} AS pseudo_f, {q6('1 - ssw/sst')} AS r2, (SELECT COUNT(*) FROM l) AS n FROM ss")
def h06c(spark, d):
    return rounded(bt.permanova(bc(spark, d), more_labels(spark, d), 99).select("pseudo_f", "r2", F.col("n").cast("long").alias("n")))


@query("h07_permdisp_extra_labels", ORACLE["h07_permdisp"])
def h07b(spark, d):
    return rounded(bt.permdisp(bc(spark, d), more_labels(spark, d)).select("f"))


@query("h08_permanova_validity")
def h08(spark, d):
    dist = cut_lineage(bc(spark, d))
    g = groups(spark, d)
    return bt.permanova_validity(bt.permanova(dist, g, 99), bt.permdisp(dist, g))


GEO = f"SELECT x.sample_id AS a, y.sample_id AS b, {hav('x', 'y')} AS km FROM sites x JOIN sites y ON x.sample_id < y.sample_id"


@query("h09_mantel_r", base(geo=GEO) + f""", j AS (SELECT d, km FROM bc JOIN geo USING (a, b)), r AS (SELECT RANK() OVER (ORDER BY d) + (COUNT(*) OVER (PARTITION BY d) - 1)/2 AS x, RANK() OVER (ORDER BY ROUND(km, 9)) + (COUNT(*) OVER (PARTITION BY ROUND(km, 9)) - 1)/2 AS y FROM j)
SELECT FLOOR(CORR(x, y)*1e4)/1e4 AS r, COUNT(*) AS n_pairs FROM r""")
def h09(spark, d):
    geo = bt.geo_distance(fx.sites(spark, d)).withColumn("d", F.round("d", 9))
    return bt.mantel(bc(spark, d), geo, reps=0).select((F.floor(F.col("r") * 1e4) / 1e4).alias("r"), "n_pairs")


@query("h09_mantel_p")
def h09b(spark, d):
    return bt.mantel(bc(spark, d), bt.column_distance(fx.sites(spark, d), "value"), "pearson", 99)


@query("h10_distance_decay", base(geo=GEO) + f"SELECT {q6('REGR_SLOPE(d, km)*1000')} AS slope, {q6('REGR_INTERCEPT(d, km)')} AS intercept, {q6('CORR(d, km)')} AS r, COUNT(*) AS n_pairs FROM bc JOIN geo USING (a, b)")
def h10(spark, d):
    out = bt.distance_decay(bc(spark, d), fx.sites(spark, d))
    return rounded(out.withColumn("slope", F.col("slope") * 1000))


@query("h11_pcoa")
def h11(spark, d):
    coords, _ = bt.pcoa(bc(spark, d), 3)
    return coords


@query("h12_pca")
def h12(spark, d):
    scores, _ = bt.clr_pca(fx.abundance_brand(spark, d), 3)
    return scores


@query("h13_rda_variance", cte("meta", ab=fx.SQL["abb"], x=DENSE) + f""", c AS (SELECT sample_id, feature_id, LN(count + 1) - AVG(LN(count + 1)) OVER (PARTITION BY sample_id) AS c FROM x),
g AS (SELECT feature_id, "group", COUNT(*) AS n, SUM(c) AS s, SUM(c*c) AS ss FROM c JOIN meta USING (sample_id) GROUP BY 1, 2), f AS (SELECT SUM(ss) AS ss, SUM(s*s/n) AS q, SUM(s)*SUM(s)/SUM(n) AS m FROM g GROUP BY feature_id)
SELECT {q6('SUM(q - m)/SUM(ss - m)')} AS explained FROM f""")
def h13(spark, d):
    from meadow.operators.compositional import clr_dense
    return rounded(bt.rda_variance(clr_dense(fx.abundance_brand(spark, d)), st.labelled(fx.sample_meta(spark, d))))


@query("h13_rda_variance_columns")
def h13b(spark, d):
    from meadow.operators.compositional import clr_dense, encode_covariates
    m = fx.sample_meta(spark, d)
    design = encode_covariates(m, ["value", "group"])
    cols = [c for c in design.columns if c != "sample_id"]
    return bt.rda_variance_columns(clr_dense(fx.abundance_brand(spark, d)), design, cols)


def vectors(spark, d):
    return fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_id"), F.transform("embedding", lambda x: x.cast("double")).alias("axes"), "label")


@query("h14_procrustes")
def h14(spark, d):
    v = vectors(spark, d)
    first = v.select("sample_id", F.slice("axes", 1, 32).alias("axes"))
    second = v.select("sample_id", F.slice("axes", 33, 32).alias("axes"))
    return bt.procrustes(first, second, 32)


@query("h15_batch_effect_score")
def h15(spark, d):
    return bt.batch_effect_score(fx.abundance_brand(spark, d), fx.sample_meta(spark, d).select("sample_id", F.col("region").alias("group")))


@query("h16_community_types")
def h16(spark, d):
    from pyspark.ml.functions import array_to_vector
    v = vectors(spark, d).select("sample_id", array_to_vector("axes").alias("features"))
    out, _ = bt.community_types(v, 5)
    return out


@query("h17_adjusted_rand", f"""WITH c AS (SELECT c_mktsegment AS x, c_nationkey % 5 AS y, COUNT(*) AS c FROM customer GROUP BY 1, 2), s AS (SELECT SUM(c*(c-1)/2) AS s, SUM(c) AS n FROM c),
a AS (SELECT SUM(m*(m-1)/2) AS sa FROM (SELECT SUM(c) AS m FROM c GROUP BY x)), b AS (SELECT SUM(m*(m-1)/2) AS sb FROM (SELECT SUM(c) AS m FROM c GROUP BY y))
SELECT {q6('(s - sa*sb/(n*(n-1)/2))/((sa+sb)/2 - sa*sb/(n*(n-1)/2))')} AS adjusted_rand FROM s, a, b""")
def h17(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_mktsegment").alias("x"), (F.col("c_nationkey") % 5).alias("y"))
    return rounded(bt.adjusted_rand(c, "x", "y"))


@query("h18_batch_entropy", """WITH g AS (SELECT n_regionkey, CAST(COUNT(*) AS DOUBLE) AS c FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), s AS (SELECT -SUM(c/(SELECT SUM(c) FROM g)*LN(c/(SELECT SUM(c) FROM g))) AS h, COUNT(*) AS k FROM g)
""" + f"SELECT {q6('h')} AS entropy, {q6('h/LN(k)')} AS entropy_ratio FROM s")
def h18(spark, d):
    return rounded(bt.batch_entropy(fx.sample_meta(spark, d).select(F.col("region").alias("group"))))


@query("h18_batch_report")
def h18b(spark, d):
    ab = site_kind(spark, d)
    return bt.batch_report(ab, groups(spark, d, "region"), groups(spark, d), reps=99)


DIST2 = "list_sum(list_transform(range(1, 65), i -> POWER({0}[i] - {1}[i], 2)))"


@query("h19_cluster_quality", f"""WITH v AS (SELECT label, pos, CAST(embedding[pos] AS DOUBLE) AS x, vec_id FROM embeddings, range(1, 65) t(pos)), c AS (SELECT label, pos, AVG(x) AS c FROM v GROUP BY 1, 2), g AS (SELECT pos, AVG(x) AS g FROM v GROUP BY 1),
q AS (SELECT vec_id, label, SUM(POWER(x - c, 2)) AS q FROM v JOIN c USING (label, pos) GROUP BY 1, 2), w AS (SELECT label, SUM(q) AS w, AVG(SQRT(q)) AS s, COUNT(*) AS n FROM q GROUP BY 1),
b AS (SELECT SUM(n*z) AS b FROM (SELECT label, SUM(POWER(c - g, 2)) AS z FROM c JOIN g USING (pos) GROUP BY 1) JOIN w USING (label)),
p AS (SELECT x.label AS a, y.label AS o, SQRT(SUM(POWER(x.c - y.c, 2))) AS d FROM c x JOIN c y ON x.pos = y.pos AND x.label <> y.label GROUP BY 1, 2),
r AS (SELECT a, MAX((wa.s + wo.s)/d) AS r FROM p JOIN w wa ON wa.label = a JOIN w wo ON wo.label = o GROUP BY 1)
SELECT (SELECT COUNT(*) FROM w) AS k, {q6('(SELECT SUM(w) FROM w)')} AS inertia, {q6('(b/((SELECT COUNT(*) FROM w) - 1))/((SELECT SUM(w) FROM w)/((SELECT SUM(n) FROM w) - (SELECT COUNT(*) FROM w)))')} AS calinski_harabasz, {q6('(SELECT AVG(r) FROM r)')} AS davies_bouldin FROM b""")
def h19(spark, d):
    v = vectors(spark, d).select(F.col("sample_id").alias("id"), F.col("label").alias("cluster"), "axes")
    return rounded(bt.cluster_quality(v, 64))


@query("h19_choose_k")
def h19b(spark, d):
    from pyspark.ml.functions import array_to_vector
    v = vectors(spark, d).select("sample_id", array_to_vector("axes").alias("features"))
    return bt.choose_k(v, range(2, 5), 64)
