"""Feature selection and model evaluation."""

from pyspark.sql import functions as F

from meadow.operators import select as sl
from meadow.operators import stats as st
from meadow.operators.compositional import clr_dense
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.queries_i_stats import XALL, labels
from meadow.plans.registry import q6, query, r6


def dense(spark, d):
    return clr_dense(fx.abundance_brand(spark, d))


FSCORE = """s AS (SELECT feature_id, g, AVG(v) AS m, VAR_SAMP(v) AS s2, COUNT(*) AS ng, SUM(v) AS sv FROM x GROUP BY 1, 2)"""


@query("m01_select_k_best", cte("abb", "meta", x=XALL) + f""", {FSCORE}, a AS (SELECT feature_id, SUM(ng*m*m) - POWER(SUM(ng*m), 2)/SUM(ng) AS b, SUM((ng-1)*s2) AS w, SUM(ng) AS n, COUNT(*) AS k FROM s GROUP BY 1), f AS (SELECT feature_id, (b/(k-1))/(w/(n-k)) AS f FROM a)
SELECT feature_id, {q6('f')} AS score FROM f ORDER BY ROUND(f, 9) DESC, feature_id LIMIT 10""")
def m01(spark, d):
    return rounded(sl.select_k_best(fx.abundance_brand(spark, d), labels(spark, d), 10))


@query("m01_select_k_best_regression", cte("abb", "meta") + f""", x AS (SELECT m.sample_id, m.value AS y, f.feature_id, COALESCE(abb.count, 0) AS v FROM (SELECT * FROM meta WHERE value IS NOT NULL) m CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f
LEFT JOIN abb ON abb.sample_id = m.sample_id AND abb.feature_id = f.feature_id), r AS (SELECT feature_id, POWER(CORR(v, y), 2) AS r2, COUNT(*) AS n FROM x GROUP BY 1)
SELECT feature_id, {q6('r2*(n-2)/(1-r2)')} AS score FROM r ORDER BY ROUND(r2*(n-2)/(1-r2), 9) DESC, feature_id LIMIT 10""")
def m01b(spark, d):
    return rounded(sl.select_k_best(fx.abundance_brand(spark, d), fx.sample_meta(spark, d).select("sample_id", "value"), 10, "f_regression"))


@query("m01_select_k_best_chi2", cte("abb", "meta", x=XALL) + f""", {FSCORE}, t AS (SELECT feature_id, SUM(sv) AS t, SUM(ng) AS n FROM s GROUP BY 1), c AS (SELECT feature_id, SUM(POWER(sv - t*ng/n, 2)/(t*ng/n)) AS c FROM s JOIN t USING (feature_id) GROUP BY 1)
SELECT feature_id, {q6('c')} AS score FROM c ORDER BY ROUND(c, 9) DESC, feature_id LIMIT 10""")
def m01c(spark, d):
    return rounded(sl.select_k_best(fx.abundance_brand(spark, d), labels(spark, d), 10, "chi2"))


def copies(spark, d):
    """Brands with a near copy of each third brand."""
    ab = fx.abundance_brand(spark, d)
    twin = ab.filter("cast(substr(feature_id, 7) as int) % 3 = 0").select("sample_id", F.concat("feature_id", F.lit("~")).alias("feature_id"), (F.col("count") * 2).alias("count"))
    return ab.unionByName(twin)


@query("m02_drop_collinear", "SELECT p_brand AS feature_id FROM part GROUP BY 1")
def m02(spark, d):
    ab = copies(spark, d)
    scores = ab.select("feature_id").distinct().withColumn("score", F.when(F.col("feature_id").endswith("~"), 1.0).otherwise(2.0))
    return sl.drop_collinear(ab, scores)


SH = "SELECT sample_id, LN(SUM(count)) - SUM(count*LN(count))/SUM(count) AS h FROM abb GROUP BY 1"


@query("m03_leakage_check", cte("abb", "meta", sh=SH, x="SELECT m.sample_id, m.value AS y, h, f.feature_id, COALESCE(abb.count, 0) AS v FROM (SELECT * FROM meta JOIN sh USING (sample_id)) m CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f LEFT JOIN abb ON abb.sample_id = m.sample_id AND abb.feature_id = f.feature_id") + f"""
SELECT feature_id, {q6('CORR(v, y)')} AS r_target, {q6('CORR(v, h)')} AS r_shannon, ABS(CORR(v, y)) > 0.95 OR ABS(CORR(v, h)) > 0.2 AS leak FROM x GROUP BY 1""")
def m03(spark, d):
    return rounded(sl.leakage_check(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "value", diversity_limit=0.2))


@query("m04_biomarker_confidence")
def m04(spark, d):
    return sl.biomarker_confidence(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), ["balance", "lat", "lon"])


@query("m05_group_folds", cte("meta", g="SELECT study, COUNT(*) AS c FROM meta GROUP BY 1", r="SELECT study, ROW_NUMBER() OVER (ORDER BY c DESC, study) - 1 AS r FROM g") + """
SELECT sample_id, study AS "group", CAST(CASE WHEN CAST(FLOOR(r/5) AS BIGINT) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS INTEGER) AS fold FROM meta JOIN r USING (study)""")
def m05(spark, d):
    return sl.group_folds(fx.sample_meta(spark, d), "study")


@query("m05_spatial_folds")
def m05b(spark, d):
    return sl.spatial_folds(fx.sample_meta(spark, d))


@query("m05_group_holdout")
def m05c(spark, d):
    return sl.group_holdout(fx.sample_meta(spark, d), "study")


PROB = "SELECT (o_orderkey * 7919 % 1000)/CAST(1000 AS DOUBLE) AS p, CASE WHEN (o_orderkey * 7919 % 1000) + (o_orderkey * 31 % 600) > 800 THEN 1 ELSE 0 END AS y FROM orders"


@query("m06_best_threshold", cte(s=PROB, t="SELECT UNNEST(range(1, 100)) AS t") + f""", c AS (SELECT t, CAST(SUM(CASE WHEN y = 1 AND p*100 >= t - 1e-7 THEN 1 ELSE 0 END) AS DOUBLE) AS tp, CAST(SUM(CASE WHEN y = 0 AND p*100 >= t - 1e-7 THEN 1 ELSE 0 END) AS DOUBLE) AS fp, CAST(SUM(y) AS DOUBLE) AS a, CAST(SUM(1-y) AS DOUBLE) AS b FROM s, t GROUP BY 1),
m AS (SELECT t, COALESCE((tp*(b-fp) - fp*(a-tp))/NULLIF(SQRT((tp+fp)*a*b*((b-fp)+(a-tp))), 0), 0) AS m FROM c)
SELECT {q6('t/100')} AS threshold, {q6('m')} AS mcc FROM m ORDER BY ROUND(m, 12) DESC, t LIMIT 1""")
def m06(spark, d):
    k = F.col("o_orderkey")
    s = fx.table(spark, d, "orders").select(((k * 7919 % 1000) / 1000.0).alias("probability"), F.when(k * 7919 % 1000 + k * 31 % 600 > 800, 1).otherwise(0).alias("label"))
    return rounded(sl.best_threshold(s))


@query("m07_elastic_net_losgo")
def m07(spark, d):
    return sl.elastic_net_losgo(dense(spark, d), fx.sample_meta(spark, d), "value", "region")[0]


@query("m07_linear_discovery")
def m07b(spark, d):
    return sl.linear_discovery(dense(spark, d), fx.sample_meta(spark, d), "value", reg=1.0)


@query("m08_forest_importance")
def m08(spark, d):
    return sl.forest_importance(dense(spark, d), labels(spark, d))


@query("m08_batch_predictability")
def m08b(spark, d):
    return sl.batch_predictability(dense(spark, d), fx.sample_meta(spark, d).select("sample_id", F.col("region").alias("group")))


SX = """ok AS (SELECT study FROM meta GROUP BY 1 HAVING COUNT(*) >= 15 AND COUNT(DISTINCT "group") >= 2),
x AS (SELECT m.study, m.g, f.feature_id, COALESCE(abb.count, 0) AS v FROM (SELECT sample_id, study, "group" AS g FROM meta WHERE study IN (SELECT study FROM ok)) m CROSS JOIN (SELECT DISTINCT feature_id FROM abb) f LEFT JOIN abb ON abb.sample_id = m.sample_id AND abb.feature_id = f.feature_id),
s AS (SELECT study, feature_id, SUM(sv*sv/n) - SUM(sv)*SUM(sv)/SUM(n) AS b, SUM(ss) - SUM(sv)*SUM(sv)/SUM(n) AS t FROM (SELECT study, feature_id, g, COUNT(*) AS n, SUM(v) AS sv, SUM(v*v) AS ss FROM x GROUP BY 1, 2, 3) GROUP BY 1, 2),
k AS (SELECT study, feature_id, COALESCE(b/NULLIF(t, 0), 0) AS i, ROW_NUMBER() OVER (PARTITION BY study ORDER BY ROUND(COALESCE(b/NULLIF(t, 0), 0), 9) DESC, feature_id) AS r FROM s)"""


@query("m09_meta_analysis", cte("abb", "meta") + f""", {SX} SELECT feature_id, COUNT(*) AS study_frequency, {q6('COUNT(*)/(SELECT COUNT(*) FROM ok)')} AS frequency_pct, {q6('SUM(i)/(SELECT COUNT(*) FROM ok)')} AS avg_importance FROM k WHERE r <= 5 GROUP BY 1
ORDER BY COUNT(*) DESC, ROUND(SUM(i)/(SELECT COUNT(*) FROM ok), 9) DESC, feature_id LIMIT 5""")
def m09(spark, d):
    return rounded(sl.meta_analysis(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "study", "group", 5)[0])


@query("m10_consensus_weighting", f"""WITH i AS (SELECT p_brand AS f, AVG(p_retailprice) AS v FROM part GROUP BY 1), c AS (SELECT p_brand AS f, (COUNT(*) % 10)/CAST(10 AS DOUBLE) AS p FROM part WHERE p_size > 48 GROUP BY 1)
SELECT f AS feature_id, {q6('v')} AS importance, {q6('COALESCE(p, 0.05)')} AS meta_frequency, {q6('v*(COALESCE(p, 0.05) + 0.1)')} AS adjusted_importance, COALESCE(p, 0.05) >= 0.5 AS is_universal FROM i LEFT JOIN c USING (f)""")
def m10(spark, d):
    p = fx.table(spark, d, "part")
    i = p.groupBy(F.col("p_brand").alias("feature_id")).agg(F.avg("p_retailprice").alias("importance"))
    c = p.filter("p_size > 48").groupBy(F.col("p_brand").alias("feature_id")).agg(((F.count(F.lit(1)) % 10) / 10.0).alias("frequency_pct"))
    return rounded(sl.consensus_weighting(i, c))


@query("m11_consensus_two_lists", f"""WITH t AS (SELECT p_partkey AS k, (p_partkey * 37 % 1000 + 1)/CAST(1001 AS DOUBLE) AS q, (p_partkey * 91 % 997)/CAST(997 AS DOUBLE) AS i FROM part)
SELECT k AS feature_id, {q6('0.5*-LOG10(q) + 0.5*i')} AS combined_score FROM t WHERE q <= 0.2 AND i > (SELECT quantile_cont(i, 0.9) FROM t)""")
def m11(spark, d):
    k = F.col("p_partkey")
    t = fx.table(spark, d, "part").select(k.alias("feature_id"), ((k * 37 % 1000 + 1) / 1001.0).alias("q_value"), ((k * 91 % 997) / 997.0).alias("importance"))
    return rounded(sl.consensus_two_lists(t.select("feature_id", "q_value"), t.select("feature_id", "importance"), 0.2, 90))


@query("m12_shuffle_baseline")
def m12(spark, d):
    return sl.shuffle_baseline(fx.abundance_brand(spark, d), labels(spark, d), 20)


@query("m13_panel_validation")
def m13(spark, d):
    panel = sl.select_k_best(fx.abundance_brand(spark, d), labels(spark, d), 8)
    return sl.panel_validation(dense(spark, d), labels(spark, d), fx.sample_meta(spark, d), panel)


@query("m14_facility_targets", """SELECT c_custkey AS sample_id, CAST(c_custkey % 2 = 0 AND c_mktsegment = 'BUILDING' AS INTEGER) AS facility_match_building, CAST(c_custkey % 2 = 0 AND c_mktsegment = 'MACHINERY' AS INTEGER) AS facility_match_machinery FROM customer""")
def m14(spark, d):
    m = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.when(F.col("c_custkey") % 2 == 0, "True").otherwise("no").alias("facility_match"), F.col("c_mktsegment").alias("facility_type"))
    return sl.facility_targets(m, ["BUILDING", "MACHINERY", "unknown"])


@query("m15_evidence_synthesis", """WITH t AS (SELECT p_partkey AS k, p_type AS target, (p_partkey % 2 = 0) AS a, (p_partkey % 3 = 0) AS b, (p_partkey % 5 < 2) AS c, (p_partkey % 7 < 3) AS d, (p_partkey % 4 = 1) AS e, p_size > 25 AS sig FROM part),
s AS (SELECT *, CASE WHEN a THEN 1 ELSE 0 END + CASE WHEN b THEN 3 ELSE 0 END + CASE WHEN c THEN 5 ELSE 0 END + CASE WHEN d THEN 5 ELSE 0 END + CASE WHEN e THEN 2 ELSE 0 END AS score FROM t)
SELECT target, CAST(k AS VARCHAR) AS taxon, score, concat_ws(' + ', CASE WHEN a THEN 'Baseline' END, CASE WHEN b THEN 'Batch-Aware' END, CASE WHEN c THEN 'LOPOCV' END, CASE WHEN d THEN 'Spatial-CV' END, CASE WHEN e THEN 'Meta-Aware' END) || CASE WHEN sig THEN ' & Stat-Sig' ELSE '' END AS evidence,
CASE WHEN score >= 10 AND sig THEN 'Elite' WHEN score >= 7 THEN 'High' ELSE 'Moderate' END AS confidence FROM s WHERE score >= 4""")
def m15(spark, d):
    k, p = F.col("p_partkey"), fx.table(spark, d, "part")
    s = p.select(F.col("p_type").alias("target"), k.cast("string").alias("taxon"), (k % 2 == 0).alias("baseline"), (k % 3 == 0).alias("batch_aware"), (k % 5 < 2).alias("lopocv"), (k % 7 < 3).alias("spatial_cv"), (k % 4 == 1).alias("meta_aware"))
    return sl.evidence_synthesis(s, p.filter("p_size > 25").select(F.col("p_type").alias("target"), k.cast("string").alias("taxon")))


@query("m16_predict_environment")
def m16(spark, d):
    return sl.predict_environment(dense(spark, d), fx.sample_meta(spark, d), ["value", "balance"], min_samples=50)


@query("m17_overfit_gap", f"""WITH s AS (SELECT p_type AS target, p_size AS fold, AVG(p_retailprice)/2000 AS tr, AVG(p_retailprice)/2000 - (p_size % 10)/CAST(30 AS DOUBLE) AS te FROM part GROUP BY 1, 2)
SELECT target, {q6('AVG(tr)')} AS mean_train, {q6('AVG(te)')} AS mean_test, {q6('AVG(tr) - AVG(te)')} AS gap, CASE WHEN AVG(tr) - AVG(te) < 0.1437 THEN 'PASS' ELSE 'FAIL' END AS status FROM s GROUP BY 1""")
def m17(spark, d):
    s = fx.table(spark, d, "part").groupBy(F.col("p_type").alias("target"), F.col("p_size").alias("fold")).agg((F.avg("p_retailprice") / 2000).alias("train_score"))
    return rounded(sl.overfit_gap(s.withColumn("test_score", F.col("train_score") - (F.col("fold") % 10) / 30.0), 0.1437))


@query("m18_stable_features", cte("fm") + f""", s AS (SELECT l_suppkey % 20 AS run, 'd__B;p__' || p_type || ';g__' || replace(p_name, ' ', '_') AS f, l_discount AS i FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT f AS feature, {q6('COUNT(DISTINCT run)/(SELECT COUNT(DISTINCT run) FROM s)')} AS frequency, {q6('AVG(i)')} AS mean_importance, split_part(f, ';', 2) AS phylum, replace(split_part(f, '__', -1), '_', ' ') AS label FROM s GROUP BY 1 HAVING COUNT(DISTINCT run)/(SELECT COUNT(DISTINCT run) FROM s) >= 0.4""")
def m18(spark, d):
    p = fx.table(spark, d, "part")
    li = fx.table(spark, d, "lineitem").join(p, F.col("l_partkey") == p.p_partkey)
    f = F.concat(F.lit("d__B;p__"), "p_type", F.lit(";g__"), F.replace("p_name", F.lit(" "), F.lit("_")))
    return rounded(sl.stable_features(li.select((F.col("l_suppkey") % 20).alias("run"), f.alias("feature"), F.col("l_discount").alias("importance"))))
