"""Feature-wise tests, effect sizes, multiple testing."""

from pyspark.sql import functions as F

from meadow.operators import stats as st
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import q6, query, r6

TWO = ("BUILDING", "MACHINERY")


def labels(spark, d):
    return st.labelled(fx.sample_meta(spark, d))


GRID = """SELECT l.sample_id, l.g, f.feature_id, COALESCE(abb.count, 0) AS v FROM (SELECT sample_id, "group" AS g FROM meta {where}) l
CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f LEFT JOIN abb ON abb.sample_id = l.sample_id AND abb.feature_id = f.feature_id"""
X2 = GRID.format(where="WHERE \"group\" IN ('BUILDING', 'MACHINERY')")
XALL = GRID.format(where="")
RANKED = """SELECT *, RANK() OVER (PARTITION BY feature_id ORDER BY v) + (COUNT(*) OVER (PARTITION BY feature_id, v) - 1)/2 AS rk FROM x"""
MOM = """SELECT feature_id, COUNT(*) FILTER (g = 'BUILDING') AS n1, COUNT(*) FILTER (g = 'MACHINERY') AS n2, AVG(v) FILTER (g = 'BUILDING') AS m1, AVG(v) FILTER (g = 'MACHINERY') AS m2,
VAR_SAMP(v) FILTER (g = 'BUILDING') AS v1, VAR_SAMP(v) FILTER (g = 'MACHINERY') AS v2 FROM x GROUP BY 1"""


@query("i01_mann_whitney", cte("abb", "meta", x=X2, r=RANKED) + f""", u AS (SELECT feature_id, SUM(rk) FILTER (g = 'BUILDING') AS r1, COUNT(*) FILTER (g = 'BUILDING') AS n1, COUNT(*) FILTER (g = 'MACHINERY') AS n2,
quantile_cont(v, 0.5) FILTER (g = 'BUILDING') AS a, quantile_cont(v, 0.5) FILTER (g = 'MACHINERY') AS b FROM r GROUP BY 1)
SELECT feature_id, {q6('r1 - n1*(n1+1)/2')} AS u, {q6('2*(r1 - n1*(n1+1)/2)/(n1*n2) - 1')} AS cliffs_delta, {q6('a')} AS median_group1, {q6('b')} AS median_group2 FROM u""")
def i01(spark, d):
    return rounded(st.mann_whitney(fx.abundance_brand(spark, d), labels(spark, d), TWO).drop("p_value"))


@query("i01_mann_whitney_clr")
def i01b(spark, d):
    from meadow.operators.compositional import clr_dense
    ab, lab = fx.abundance_brand(spark, d), labels(spark, d)
    dense = clr_dense(ab, st.prevalent(ab, lab, 0.1))
    return st.adjust_p(st.mann_whitney(dense, lab, TWO, "clr", zeros=False))


@query("i02_t_test", cte("abb", "meta", x=X2, m=MOM) + f"""SELECT feature_id, {q6('(m1-m2)/SQRT(v1/n1 + v2/n2)')} AS t, {q6('POWER(v1/n1 + v2/n2, 2)/(POWER(v1/n1, 2)/(n1-1) + POWER(v2/n2, 2)/(n2-1))')} AS df,
{q6('LOG2((m1+1)/(m2+1))')} AS log2_fc FROM m""")
def i02(spark, d):
    return rounded(st.t_test(fx.abundance_brand(spark, d), labels(spark, d), TWO).drop("p_value"))


@query("i03_kruskal", cte("abb", "meta", x=XALL, r=RANKED) + f""", s AS (SELECT feature_id, g, SUM(rk) AS rs, COUNT(*) AS ng FROM r GROUP BY 1, 2), t AS (SELECT feature_id, SUM(POWER(c, 3) - c) AS tie FROM (SELECT feature_id, v, COUNT(*) AS c FROM x GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT feature_id, SUM(rs*rs/ng) AS q, CAST(SUM(ng) AS DOUBLE) AS n, COUNT(*) AS k FROM s GROUP BY 1), h AS (SELECT *, (12/(n*(n+1))*q - 3*(n+1))/(1 - tie/(n*n*n - n)) AS h FROM k JOIN t USING (feature_id))
SELECT feature_id, {q6('h')} AS h, {q6('(h - k + 1)/(n - k)')} AS eta_squared FROM h""")
def i03(spark, d):
    return rounded(st.kruskal(fx.abundance_brand(spark, d), labels(spark, d)).drop("p_value"))


@query("i04_fisher_exact", cte("abb", "meta", x=X2) + f""", m AS (SELECT feature_id, COUNT(*) FILTER (v > 0 AND g = 'BUILDING') AS a, COUNT(*) FILTER (v = 0 AND g = 'BUILDING') AS b,
COUNT(*) FILTER (v > 0 AND g = 'MACHINERY') AS c, COUNT(*) FILTER (v = 0 AND g = 'MACHINERY') AS e FROM x GROUP BY 1)
SELECT feature_id, a AS present1, b AS absent1, c AS present2, e AS absent2, {q6('a*e/(c*b)')} AS odds_ratio FROM m WHERE a + c >= 5""")
def i04(spark, d):
    return rounded(st.fisher_exact(fx.abundance_brand(spark, d), labels(spark, d), TWO).drop("p_value"))


@query("i05_test_with_effect_size")
def i05(spark, d):
    return st.test_with_effect_size(fx.abundance_brand(spark, d), labels(spark, d), TWO)


@query("i06_spearman_features", cte("abb", "meta") + f""", y AS (SELECT sample_id, value AS y FROM meta WHERE value IS NOT NULL),
x AS (SELECT y.sample_id, y, f.feature_id, COALESCE(abb.count, 0) AS v FROM y CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f LEFT JOIN abb ON abb.sample_id = y.sample_id AND abb.feature_id = f.feature_id),
r AS (SELECT feature_id, v, RANK() OVER (PARTITION BY feature_id ORDER BY v) + (COUNT(*) OVER (PARTITION BY feature_id, v) - 1)/2 AS a, RANK() OVER (PARTITION BY feature_id ORDER BY y) + (COUNT(*) OVER (PARTITION BY feature_id, y) - 1)/2 AS b FROM x)
SELECT feature_id, {q6('CORR(a, b)')} AS rho, COUNT(*) FILTER (v > 0) AS present, COUNT(*) AS n FROM r GROUP BY 1""")
def i06(spark, d):
    return rounded(st.spearman_features(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "value").drop("p_value"))


@query("i07_permutation_test")
def i07(spark, d):
    return st.permutation_test(fx.abundance_brand(spark, d), st.only(labels(spark, d), TWO), 99)


@query("i08_anova_f", cte("abb", "meta", x=XALL) + f""", s AS (SELECT feature_id, g, AVG(v) AS m, VAR_SAMP(v) AS s2, COUNT(*) AS ng FROM x GROUP BY 1, 2),
a AS (SELECT feature_id, SUM(ng*m*m) - POWER(SUM(ng*m), 2)/SUM(ng) AS b, SUM((ng-1)*s2) AS w, SUM(ng) AS n, COUNT(*) AS k FROM s GROUP BY 1)
SELECT feature_id, {q6('(b/(k-1))/(w/(n-k))')} AS f, {q6('b/(b+w)')} AS eta_squared FROM a""")
def i08(spark, d):
    return rounded(st.anova_f(fx.abundance_brand(spark, d), labels(spark, d)).drop("p_value"))


BAND = "CASE WHEN ABS({0}) < {1} THEN 'negligible' WHEN ABS({0}) < {2} THEN 'small' WHEN ABS({0}) < {3} THEN 'medium' ELSE 'large' END"
COHEN = "(m1-m2)/SQRT(((n1-1)*v1 + (n2-1)*v2)/(n1+n2-2))"


@query("i09_effect_sizes", cte("abb", "meta", x=X2, m=MOM) + f"""SELECT feature_id, {q6(COHEN)} AS cohens_d, {q6(f'{COHEN}*(1 - 3/(4*(n1+n2) - 9))')} AS hedges_g, {q6('(m1-m2)/SQRT(v2)')} AS glass_delta,
{q6('LOG2((m1+1)/(m2+1))')} AS log2_fc, {BAND.format(COHEN, 0.2, 0.5, 0.8)} AS size FROM m""")
def i09(spark, d):
    e = st.effect_sizes(fx.abundance_brand(spark, d), labels(spark, d), TWO)
    return rounded(e.withColumn("size", st.effect_band(F.col("cohens_d"))))


@query("i10_bootstrap_ci")
def i10(spark, d):
    return st.bootstrap_ci(fx.abundance_brand(spark, d), labels(spark, d), TWO, 100)


@query("i11_maxt")
def i11(spark, d):
    return st.maxt(fx.abundance_brand(spark, d), labels(spark, d), 99)


def p_table(spark, d):
    k = F.col("p_partkey")
    return fx.table(spark, d, "part").select(k.alias("test"), "p_type", "p_brand", ((k * 7919 % 499 + 1) * (k * 31 % 97 + 1) / 48500.0).alias("raw")).select(
        "test", "p_type", "p_brand", F.when(F.col("test") % 50 != 0, F.col("raw") ** 2).alias("p_value"))


PT = """SELECT p_partkey AS test, p_type, p_brand, CASE WHEN p_partkey % 50 <> 0 THEN POWER((p_partkey*7919 % 499 + 1)*(p_partkey*31 % 97 + 1)/CAST(48500 AS DOUBLE), 2) END AS p FROM part"""


@query("i14_adjust_p", cte(pt=PT) + f""", k AS (SELECT test, p, RANK() OVER (ORDER BY p) AS lo, RANK() OVER (ORDER BY p) + COUNT(*) OVER (PARTITION BY p) - 1 AS hi, COUNT(*) OVER () AS m FROM pt WHERE p IS NOT NULL),
c AS (SELECT SUM(1.0/i) AS c FROM (SELECT UNNEST(range(1, (SELECT CAST(MAX(m) + 1 AS BIGINT) FROM k))) AS i)),
a AS (SELECT test, p*m AS bonferroni, 1 - POWER(1-p, m) AS sidak, MAX(p*(m-lo+1)) OVER (ORDER BY p) AS holm, MIN(p*m/hi) OVER (ORDER BY p DESC) AS fdr_bh, MIN(p*m*c/hi) OVER (ORDER BY p DESC) AS fdr_by FROM k, c)
SELECT pt.test, """ + ", ".join(f"{q6(f'LEAST({m}, 1)')} AS {m}" for m in st.METHODS) + " FROM pt JOIN a USING (test)")
def i14(spark, d):
    base = p_table(spark, d).filter("p_value is not null").select("test", "p_value")
    out = base.select("test")
    for m in st.METHODS:
        out = out.join(st.adjust_p(base, "p_value", m).select("test", r6("p_adj").alias(m)), "test")
    return out


@query("i14_compare_corrections", cte(pt=PT) + """, k AS (SELECT p, RANK() OVER (ORDER BY p) AS lo, RANK() OVER (ORDER BY p) + COUNT(*) OVER (PARTITION BY p) - 1 AS hi, COUNT(*) OVER () AS m FROM pt WHERE p IS NOT NULL),
c AS (SELECT SUM(1.0/i) AS c FROM (SELECT UNNEST(range(1, (SELECT CAST(MAX(m) + 1 AS BIGINT) FROM k))) AS i)),
a AS (SELECT p*m AS bonferroni, 1 - POWER(1-p, m) AS sidak, MAX(p*(m-lo+1)) OVER (ORDER BY p) AS holm, MIN(p*m/hi) OVER (ORDER BY p DESC) AS fdr_bh, MIN(p*m*c/hi) OVER (ORDER BY p DESC) AS fdr_by FROM k, c)
""" + " UNION ALL ".join(f"SELECT '{m}' AS method, COUNT(*) FILTER ({m} <= 0.05) AS rejected FROM a" for m in st.METHODS))
def i14b(spark, d):
    return st.compare_corrections(p_table(spark, d))


@query("i15_adjust_p_stratified", cte(pt=PT) + f""", k AS (SELECT test, p_type, p, RANK() OVER w + COUNT(*) OVER (PARTITION BY p_type, p) - 1 AS hi, COUNT(*) OVER (PARTITION BY p_type) AS m FROM pt WHERE p IS NOT NULL WINDOW w AS (PARTITION BY p_type ORDER BY p))
SELECT test, p_type, {q6('LEAST(MIN(p*m/hi) OVER (PARTITION BY p_type ORDER BY p DESC), 1)')} AS p_adj FROM k UNION ALL SELECT test, p_type, NULL FROM pt WHERE p IS NULL""")
def i15(spark, d):
    return rounded(st.adjust_p(p_table(spark, d), "p_value", "fdr_bh", ["p_type"]).select("test", "p_type", "p_adj"))


@query("i16_hierarchical_fdr")
def i16(spark, d):
    t = p_table(spark, d).filter("p_value is not null")
    top = t.groupBy("p_type").agg((F.min("p_value") * 5).alias("p_value")).select(F.concat(F.lit("t:"), "p_type").alias("node"), F.lit(None).cast("string").alias("parent"), F.least("p_value", F.lit(1.0)).alias("p_value"))
    mid = t.groupBy("p_type", "p_brand").agg((F.min("p_value") * 3).alias("p_value")).select(F.concat(F.lit("b:"), "p_type", "p_brand").alias("node"), F.concat(F.lit("t:"), "p_type").alias("parent"), F.least("p_value", F.lit(1.0)).alias("p_value"))
    leaf = t.select(F.col("test").cast("string").alias("node"), F.concat(F.lit("b:"), "p_type", "p_brand").alias("parent"), "p_value")
    return st.hierarchical_fdr(top.unionByName(mid).unionByName(leaf))


METHOD_RESULTS = """SELECT test, 'a' AS m FROM pt WHERE p < 0.02 UNION ALL SELECT test, 'b' FROM pt WHERE p < 0.01 AND test % 3 <> 0 UNION ALL SELECT test, 'c' FROM pt WHERE p < 0.03 AND test % 2 = 0"""


def _results(spark, d):
    t = p_table(spark, d).select(F.col("test").alias("feature_id"), F.col("p_value").alias("p_adj"))
    k, p = F.col("feature_id"), F.col("p_adj")
    return {"a": t.withColumn("p_adj", F.when(p < 0.02, 0.01).otherwise(1.0)), "b": t.withColumn("p_adj", F.when((p < 0.01) & (k % 3 != 0), 0.01).otherwise(1.0)),
            "c": t.withColumn("p_adj", F.when((p < 0.03) & (k % 2 == 0), 0.01).otherwise(1.0))}


@query("i12_compare_methods", cte(pt=PT, s=METHOD_RESULTS) + "SELECT test AS feature_id, m AS method FROM s")
def i12(spark, d):
    return st.compare_methods(_results(spark, d))


@query("i12_consensus_features", cte(pt=PT, s=METHOD_RESULTS) + """SELECT test AS feature_id, COUNT(DISTINCT m) AS n_methods, string_agg(m, ', ' ORDER BY m) AS methods FROM s GROUP BY 1 HAVING COUNT(DISTINCT m) >= 2""")
def i12b(spark, d):
    return st.consensus_features(st.compare_methods(_results(spark, d)))


@query("i13_top_features", cte(pt=PT, s="SELECT p_type AS test, p_brand AS feature_id, MIN(p) AS p, AVG(p) - 0.1 AS effect FROM pt WHERE p IS NOT NULL GROUP BY 1, 2") + f"""
SELECT feature_id, COUNT(*) AS n_significant_tests, string_agg(test, ', ' ORDER BY test) AS tests, {q6('AVG(p)')} AS mean_p_value, {q6('MIN(p)')} AS min_p_value, {q6('AVG(ABS(effect))')} AS mean_effect_size
FROM s WHERE p < 0.001 GROUP BY 1 ORDER BY COUNT(*) DESC, ROUND(AVG(p), 12), feature_id LIMIT 10""")
def i13(spark, d):
    t = p_table(spark, d).filter("p_value is not null").groupBy(F.col("p_type").alias("test"), F.col("p_brand").alias("feature_id")).agg(
        F.min("p_value").alias("p"), (F.avg("p_value") - 0.1).alias("effect")).withColumnRenamed("p", "p_value")
    return rounded(st.top_features_table(t, 10, alpha=0.001))


@query("i17_effective_tests", cte("abb", x="""SELECT s.sample_id, f.feature_id, COALESCE(count, 0) AS v FROM (SELECT DISTINCT sample_id FROM abb) s CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f
LEFT JOIN abb ON abb.sample_id = s.sample_id AND abb.feature_id = f.feature_id""") + f""", r AS (SELECT a.feature_id AS a, b.feature_id AS b, CORR(a.v, b.v) AS r FROM x a JOIN x b USING (sample_id) GROUP BY 1, 2),
k AS (SELECT CAST(COUNT(DISTINCT a) AS DOUBLE) AS p, SUM(r*r) AS rr FROM r) SELECT {q6('1 + (p-1)*(1 - (rr/p - 1)/p)')} AS effective FROM k""")
def i17(spark, d):
    from meadow.operators.network import effective_tests
    return rounded(effective_tests(fx.abundance_brand(spark, d)))


@query("i18_core_features", cte("abb", "meta", t="SELECT sample_id, SUM(count) AS t FROM abb GROUP BY 1", n='SELECT "group", COUNT(*) AS n FROM meta GROUP BY 1') + f"""
SELECT "group", feature_id, {q6('COUNT(*)/n')} AS prevalence, {q6('SUM(count/t)/n')} AS mean_abundance FROM abb JOIN t USING (sample_id) JOIN meta USING (sample_id) JOIN n USING ("group") GROUP BY "group", feature_id, n
HAVING COUNT(*)/n >= 0.75 AND SUM(count/t)/n >= 0.03""")
def i18(spark, d):
    return rounded(st.core_features(fx.abundance_brand(spark, d), labels(spark, d), 0.75, 0.03))


@query("i19_compare_tests")
def i19(spark, d):
    return st.compare_tests(fx.abundance_brand(spark, d), labels(spark, d), TWO, 99)


@query("i20_effect_summary", cte(e="SELECT (p_partkey * 37 % 1000)/CAST(1000 AS DOUBLE) - 0.3 AS v FROM part") + f""", b AS (SELECT {BAND.format('v', 0.147, 0.33, 0.474)} AS band, ABS(v) AS e FROM e)
SELECT band, COUNT(*) AS n, {q6('COUNT(*)/(SELECT COUNT(*) FROM b)')} AS share, {q6('AVG(e)')} AS mean_effect, {q6('quantile_cont(e, 0.5)')} AS median_effect FROM b GROUP BY 1""")
def i20(spark, d):
    e = fx.table(spark, d, "part").select(((F.col("p_partkey") * 37 % 1000) / 1000.0 - 0.3).alias("v"))
    return rounded(st.effect_summary(e, "v"))
