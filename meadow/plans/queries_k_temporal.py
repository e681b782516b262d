"""Time series over the events table: subject = user, time = day, feature = event type."""

from pyspark.sql import functions as F

from meadow.operators import temporal as tm
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import q6, query, r6

STEP = "SELECT ev.*, step FROM ev JOIN (SELECT subject, day, ROW_NUMBER() OVER (PARTITION BY subject ORDER BY day) AS step FROM (SELECT DISTINCT subject, day FROM ev)) USING (subject, day)"


def ev(spark, d):
    return fx.events_daily(spark, d).withColumnRenamed("day", "ts")


@query("k01_temporal_structure", cte("ev", s="SELECT DISTINCT subject, day FROM ev") + """SELECT (SELECT COUNT(DISTINCT subject) FROM s) AS n_subjects, (SELECT COUNT(*) FROM (SELECT subject FROM s GROUP BY 1 HAVING COUNT(*) > 1)) AS n_repeated, (SELECT COUNT(DISTINCT day) FROM s) AS n_timepoints, TRUE AS is_longitudinal""")
def k01(spark, d):
    return tm.temporal_structure(ev(spark, d).select("subject", "ts").distinct())


@query("k02_turnover", cte("ev", t=STEP, z="SELECT subject, step, COUNT(*) AS n FROM t GROUP BY 1, 2", s="SELECT a.subject, a.step, COUNT(*) AS s FROM t a JOIN t b ON a.subject = b.subject AND a.feature_id = b.feature_id AND a.step = b.step + 1 GROUP BY 1, 2") + f"""
SELECT z.subject, CAST(z.step AS INTEGER) AS step, {q6('1 - COALESCE(s, 0)/(z.n + y.n - COALESCE(s, 0))')} AS turnover, z.n - COALESCE(s, 0) AS gains, y.n - COALESCE(s, 0) AS losses FROM z JOIN z y ON z.subject = y.subject AND z.step = y.step + 1 LEFT JOIN s ON s.subject = z.subject AND s.step = z.step""")
def k02(spark, d):
    return rounded(tm.turnover(ev(spark, d)))


@query("k03_stability_index", cte("ev") + f"SELECT subject, feature_id, {q6('CASE WHEN COUNT(*) < 2 THEN 0 ELSE GREATEST(0, 1 - STDDEV_POP(LOG10(count + 1))/AVG(LOG10(count + 1))/2) END')} AS stability FROM ev GROUP BY 1, 2")
def k03(spark, d):
    return rounded(tm.stability_index(ev(spark, d), ["subject", "feature_id"]))


@query("k04_community_stability", cte("ev", t=STEP, z="SELECT subject, step, SUM(count) AS n FROM t GROUP BY 1, 2", s="SELECT a.subject, a.step, SUM(LEAST(a.count, b.count)) AS m FROM t a JOIN t b ON a.subject = b.subject AND a.feature_id = b.feature_id AND a.step = b.step + 1 GROUP BY 1, 2") + f"""
, d AS (SELECT z.subject, 1 - 2*COALESCE(m, 0)/(z.n + y.n) AS d FROM z JOIN z y ON z.subject = y.subject AND z.step = y.step + 1 LEFT JOIN s ON s.subject = z.subject AND s.step = z.step)
SELECT subject, {q6('1 - AVG(d)')} AS stability_score, {q6('AVG(d)')} AS avg_step_distance FROM d GROUP BY 1""")
def k04(spark, d):
    return rounded(tm.community_stability(ev(spark, d)))


SER = "SELECT subject, step, SUM(count) AS v FROM t GROUP BY 1, 2"


@query("k05_autocorrelation", cte("ev", t=STEP, s=SER, m="SELECT subject, AVG(v) AS m, VAR_POP(v)*COUNT(*) AS c0 FROM s GROUP BY 1") + f"""
, a AS (SELECT subject, b.step - a.step AS lag, SUM((a.v - m)*(b.v - m))/NULLIF(MAX(c0), 0) AS r FROM s a JOIN s b USING (subject) JOIN m USING (subject) WHERE b.step - a.step BETWEEN 1 AND 5 GROUP BY 1, 2)
SELECT subject, CAST(lag AS INTEGER) AS lag, {q6('r')} AS acf, ABS(r) > 0.2 AS significant FROM a""")
def k05(spark, d):
    s = tm.with_step(ev(spark, d)).groupBy("subject", "step").agg(F.sum("count").alias("v"))
    return rounded(tm.autocorrelation(s, ["subject"], "step", "v", 5))


@query("k06_recurrent_sets", cte("ev", t=STEP, g="SELECT a.subject, a.step, f.feature_id, COALESCE(t.count, 0) AS v FROM (SELECT DISTINCT subject, step FROM t) a CROSS JOIN (SELECT DISTINCT feature_id FROM t) f LEFT JOIN t ON t.subject = a.subject AND t.step = a.step AND t.feature_id = f.feature_id") + """
, c AS (SELECT quantile_cont(v, 0.75) AS c FROM g), w AS (SELECT t.subject, s.step AS st, t.feature_id FROM (SELECT DISTINCT subject, step FROM t) s JOIN t ON t.subject = s.subject AND t.step BETWEEN s.step AND s.step + 2, c WHERE t.count > c AND s.step + 2 <= (SELECT MAX(step) FROM t u WHERE u.subject = s.subject)),
p AS (SELECT subject, st, string_agg(DISTINCT feature_id, ',' ORDER BY feature_id) AS features, COUNT(DISTINCT feature_id) AS size FROM w GROUP BY 1, 2) SELECT features, size, COUNT(*) AS n_windows FROM p WHERE size > 2 GROUP BY 1, 2""")
def k06(spark, d):
    return tm.recurrent_sets(ev(spark, d)).withColumn("features", F.concat_ws(",", "features"))


@query("k07_resilience", cte("ev", g="SELECT subject, SUM(CASE WHEN day < DATE '2024-01-15' THEN count ELSE 0 END) AS a, SUM(CASE WHEN day >= DATE '2024-01-15' THEN count ELSE 0 END) AS b FROM ev GROUP BY 1", r="SELECT subject, 1 - b/a AS i, CASE WHEN 1 - b/a > 0 THEN -LN(1 - b/a)/10 ELSE 0 END AS r FROM g WHERE a > 0") + f"""
SELECT subject, {q6('i')} AS impact, {q6('r')} AS recovery_rate, {q6('CASE WHEN r > 0 THEN -LN(0.05)/r END')} AS recovery_time, CASE WHEN r > 0.1 THEN 'Highly resilient' ELSE 'Low resilience' END AS interpretation FROM r""")
def k07(spark, d):
    return rounded(tm.resilience(ev(spark, d), ["subject"], F.lit("2024-01-15").cast("date")))


@query("k08_trajectory_profiles", cte("ev", s="SELECT subject, day, SUM(count)/5 AS y FROM ev GROUP BY 1, 2") + f"SELECT subject, {q6('AVG(y)')} AS mean, {q6('COALESCE(REGR_SLOPE(y, epoch(day)/86400), 0)')} AS slope FROM s GROUP BY 1 HAVING COUNT(*) >= 2")
def k08(spark, d):
    return rounded(tm.trajectory_profiles(ev(spark, d), 5))


@query("k08_trajectory_clusters")
def k08b(spark, d):
    return tm.trajectory_clusters(ev(spark, d), 5)
