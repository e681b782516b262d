"""Compositional transforms."""

from pyspark.sql import functions as F

from meadow.operators import compositional as cp
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import q6, query, r6

P = "SELECT COUNT(DISTINCT feature_id) AS p FROM ab"
CLR = """SELECT sample_id, feature_id, LN(count + 1) - m AS clr, -m AS zero_clr FROM ab JOIN
(SELECT sample_id, SUM(LN(count + 1)) / (SELECT p FROM p) AS m FROM ab GROUP BY 1) USING (sample_id)"""


@query("f01_clr", cte("ab", p=P, c=CLR) + f"SELECT sample_id, feature_id, {q6('clr')} AS clr, {q6('zero_clr')} AS zero_clr FROM c")
def f01(spark, d):
    return rounded(cp.clr(fx.abundance(spark, d)))


ABB = fx.SQL["abb"]


@query("f01_clr_dense", cte(ab=ABB, p=P, c=CLR) + f""", g AS (SELECT s.sample_id, f.feature_id FROM (SELECT DISTINCT sample_id FROM ab) s, (SELECT DISTINCT feature_id FROM ab) f),
z AS (SELECT sample_id, MIN(zero_clr) AS z FROM c GROUP BY 1)
SELECT g.sample_id, g.feature_id, {q6('COALESCE(clr, z)')} AS clr FROM g JOIN z USING (sample_id) LEFT JOIN c ON c.sample_id = g.sample_id AND c.feature_id = g.feature_id""")
def f01b(spark, d):
    return rounded(cp.clr_dense(fx.abundance_brand(spark, d)))


@query("f02_rclr", cte("ab", m="SELECT sample_id, AVG(LN(count)) AS m FROM ab GROUP BY 1") + f"SELECT sample_id, feature_id, {q6('LN(count) - m')} AS rclr FROM ab JOIN m USING (sample_id)")
def f02(spark, d):
    return rounded(cp.rclr(fx.abundance(spark, d)))


REP = """SELECT sample_id, feature_id, count/t * (1 - ((SELECT p FROM p) - k) / CAST((SELECT p FROM p) AS DOUBLE)**2) AS value, 1 / CAST((SELECT p FROM p) AS DOUBLE)**2 AS zv
FROM ab JOIN (SELECT sample_id, SUM(count) AS t, COUNT(*) AS k FROM ab GROUP BY 1) USING (sample_id)"""


@query("f03_replace_zeros", cte(ab=ABB, p=P, r=REP) + f"SELECT sample_id, feature_id, {q6('value')} AS value, {q6('zv')} AS zero_value FROM r")
def f03(spark, d):
    return rounded(cp.replace_zeros(fx.abundance_brand(spark, d)))


@query("f04_alr", cte(ab=ABB, p=P, r=REP) + f""", f AS (SELECT sample_id, COALESCE(MAX(CASE WHEN feature_id = 'Brand#5' THEN value END), MAX(zv)) AS ref FROM r GROUP BY 1)
SELECT sample_id, feature_id, {q6('LN(value) - LN(ref)')} AS alr, {q6('LN(zv) - LN(ref)')} AS zero_alr FROM r JOIN f USING (sample_id) WHERE feature_id <> 'Brand#5'""")
def f04(spark, d):
    return rounded(cp.alr(fx.abundance_brand(spark, d), "Brand#5"))


@query("f05_ilr", cte(ab=ABB, p=P, r=REP) + f""", g AS (SELECT s.sample_id, f.feature_id FROM (SELECT DISTINCT sample_id FROM ab) s, (SELECT DISTINCT feature_id FROM ab) f),
l AS (SELECT g.sample_id, g.feature_id, LN(COALESCE(value, 1 / CAST((SELECT p FROM p) AS DOUBLE)**2)) AS l FROM g LEFT JOIN r ON r.sample_id = g.sample_id AND r.feature_id = g.feature_id),
w AS (SELECT sample_id, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY feature_id) - 1 AS i, l, AVG(l) OVER (PARTITION BY sample_id ORDER BY feature_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM l)
SELECT sample_id, CAST(i AS INTEGER) AS coordinate, {q6('SQRT(i/(i+1.0))*(m - l)')} AS ilr FROM w WHERE i > 0""")
def f05(spark, d):
    return rounded(cp.ilr(fx.abundance_brand(spark, d)))


@query("f06_check_closed", cte("abb") + f""", n AS (SELECT sample_id, CASE WHEN sample_id % 2 = 0 THEN count / SUM(count) OVER (PARTITION BY sample_id) ELSE count END AS v FROM abb)
SELECT sample_id, {q6('SUM(v)')} AS total FROM n GROUP BY 1 HAVING ABS(SUM(v) - 1) > 1e-5""")
def f06(spark, d):
    from meadow.operators.table import with_share
    ab = with_share(fx.abundance_brand(spark, d))
    return rounded(cp.check_closed(ab.withColumn("count", F.when(F.col("sample_id") % 2 == 0, F.col("share")).otherwise(F.col("count")))))


@query("f06_check_clr_centered", cte("abb") + """SELECT DISTINCT sample_id, TRUE AS off FROM abb WHERE sample_id % 10 = 0""")
def f06b(spark, d):
    ab = fx.abundance_brand(spark, d)
    p = cp.feature_count(ab)
    c = cp.clr(ab, p).withColumn("clr", F.col("clr") + F.when(F.col("sample_id") % 10 == 0, 0.01).otherwise(0.0))
    return cp.check_clr_centered(c, p).select("sample_id", F.lit(True).alias("off"))


@query("f07_batch_center", cte("meta", ab=ABB, p=P, c=CLR) + f""", s AS (SELECT sample_id, MIN(zero_clr) AS z, study FROM c JOIN meta USING (sample_id) WHERE study IN (SELECT study FROM meta WHERE sample_id IN (SELECT sample_id FROM ab) GROUP BY 1 HAVING COUNT(*) >= 5) GROUP BY 1, 3),
g AS (SELECT study, f.feature_id, s.sample_id, z FROM s, (SELECT DISTINCT feature_id FROM ab) f),
m AS (SELECT g.study, g.feature_id, AVG(COALESCE(clr, z)) AS m FROM g LEFT JOIN c ON c.sample_id = g.sample_id AND c.feature_id = g.feature_id GROUP BY 1, 2)
SELECT sample_id, feature_id, study AS batch, {q6('clr - m')} AS value FROM c JOIN meta USING (sample_id) JOIN m USING (study, feature_id)""")
def f07(spark, d):
    b = fx.sample_meta(spark, d).select("sample_id", F.col("study").alias("batch"))
    live = fx.abundance_brand(spark, d)
    return rounded(cp.batch_center(live, b.join(live.select("sample_id").distinct(), "sample_id", "left_semi")))


@query("f08_percentile_normalize", cte("abb", "meta") + f""", b AS (SELECT sample_id, region FROM meta WHERE sample_id IN (SELECT sample_id FROM abb)),
g AS (SELECT b.sample_id, region, f.feature_id FROM b, (SELECT DISTINCT feature_id FROM abb) f),
x AS (SELECT g.*, COALESCE(count, 0) AS v FROM g LEFT JOIN abb ON abb.sample_id = g.sample_id AND abb.feature_id = g.feature_id),
r AS (SELECT *, RANK() OVER (PARTITION BY feature_id, region ORDER BY v) + (COUNT(*) OVER (PARTITION BY feature_id, region, v) - 1)/2 AS rk, COUNT(*) OVER (PARTITION BY feature_id, region) AS nb FROM x),
o AS (SELECT feature_id, v, ROW_NUMBER() OVER (PARTITION BY feature_id ORDER BY v) - 1 AS k FROM x),
q AS (SELECT *, (SELECT COUNT(*) - 1 FROM b) * rk / nb AS pos FROM r WHERE v > 0)
SELECT sample_id, q.feature_id, {q6('a.v + (c.v - a.v)*(pos - FLOOR(pos))')} AS count FROM q JOIN o a ON a.feature_id = q.feature_id AND a.k = FLOOR(pos)
JOIN o c ON c.feature_id = q.feature_id AND c.k = CEIL(pos)""")
def f08(spark, d):
    ab = fx.abundance_brand(spark, d)
    b = fx.sample_meta(spark, d).join(ab.select("sample_id").distinct(), "sample_id", "left_semi")
    return rounded(cp.percentile_normalize(ab, b.select("sample_id", F.col("region").alias("batch"))))


@query("f09_encode_covariates", cte("meta") + f"""SELECT sample_id, {q6('COALESCE(value, (SELECT quantile_cont(value, 0.5) FROM meta))')} AS value,
""" + ", ".join(f"CAST(COALESCE(\"group\", 'Unknown') = '{g}' AS INTEGER) AS group_{g}" for g in ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM meta")
def f09(spark, d):
    m = fx.sample_meta(spark, d).withColumn("hollow", F.when(F.col("sample_id") % 3 == 0, F.col("study")))
    return rounded(cp.encode_covariates(m, ["value", "group", "hollow"]))
