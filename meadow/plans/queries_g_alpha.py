"""Alpha diversity."""

from pyspark.sql import functions as F

from meadow.operators import alpha
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.registry import q6, query, r6

TOT = "SELECT sample_id, SUM(count) AS total FROM ab GROUP BY 1"


def rounded(df, *keep):
    return df.select(*[r6(c).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


@query("g01_richness", cte("ab", t=TOT) + f"""
, h AS (SELECT sample_id, COUNT(*) AS s, -SUM(count/total*LN(count/total)) AS h FROM ab JOIN t USING (sample_id) GROUP BY 1)
SELECT sample_id, s AS observed_features, {q6('h')} AS shannon, {q6('h / CASE WHEN s > 1 THEN LN(s) ELSE 1 END')} AS pielou FROM h""")
def g01(spark, d):
    return rounded(alpha.richness(fx.abundance(spark, d)))


LINE_AB = """SELECT o_custkey AS sample_id, l_partkey AS feature_id, CAST(COUNT(*) AS DOUBLE) AS count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


def line_counts(spark, d):
    """Number of lines per (customer, part): many singletons and doubletons."""
    return (fx.lines(spark, d).groupBy(F.col("o_custkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"))
            .agg(F.count(F.lit(1)).cast("double").alias("count")))


def brand_lines(spark, d):
    p = fx.table(spark, d, "part").select("p_partkey", "p_brand")
    return (fx.lines(spark, d).join(p, F.col("l_partkey") == p.p_partkey)
            .groupBy(F.col("o_custkey").alias("sample_id"), F.col("p_brand").alias("feature_id"))
            .agg(F.count(F.lit(1)).cast("double").alias("count")))


BRAND_LINES = """SELECT o_custkey AS sample_id, p_brand AS feature_id, CAST(COUNT(*) AS DOUBLE) AS count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"""


@query("g02_alpha_metrics", cte(ab=BRAND_LINES) + f"""
, g AS (SELECT sample_id, CAST(COUNT(*) AS DOUBLE) AS s, SUM(count) AS n, SUM(count*count) AS n2, MAX(count) AS mx, SUM(count*LN(count)) AS nl,
CAST(COUNT(*) FILTER (count = 1) AS DOUBLE) AS f1, CAST(COUNT(*) FILTER (count = 2) AS DOUBLE) AS f2,
CAST(COUNT(*) FILTER (count <= 10) AS DOUBLE) AS sr, SUM(CASE WHEN count <= 10 THEN count ELSE 0 END) AS nr,
SUM(CASE WHEN count <= 10 THEN count*(count-1) ELSE 0 END) AS ff FROM ab GROUP BY 1),
a AS (SELECT *, NULLIF(1 - f1/NULLIF(nr, 0), 0) AS cov, LN(n) - nl/n AS h FROM g),
b AS (SELECT *, sr/cov AS rp, GREATEST(sr/cov*ff/NULLIF(nr*(nr-1), 0) - 1, 0) AS gam FROM a)
SELECT sample_id, {q6('1 - n2/(n*n)')} AS simpson, {q6('n2/(n*n)')} AS dominance, {q6('mx/n')} AS berger_parker,
{q6('COALESCE((n - SQRT(n2))/NULLIF(n - SQRT(n), 0), 0)')} AS mcintosh, {q6('s + f1*(f1-1)/(2*(f2+1))')} AS chao1,
{q6('s - sr + COALESCE(rp + f1/cov*gam, rp, sr)')} AS ace, {q6('1 - f1/n')} AS goods_coverage,
{q6('COALESCE((EXP(h)-1)/NULLIF(s-1, 0), 0)')} AS heip_evenness FROM b""")
def g02(spark, d):
    return rounded(alpha.alpha_metrics(brand_lines(spark, d)))


@query("g02_gini", cte("ab") + f""", r AS (SELECT sample_id, count, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY count) AS i FROM ab)
SELECT sample_id, {q6('2*SUM(i*count)/(COUNT(*)*SUM(count)) - (COUNT(*)+1)/COUNT(*)')} AS gini FROM r GROUP BY 1""")
def g02b(spark, d):
    return rounded(alpha.gini(fx.abundance(spark, d)))


@query("g03_faith_pd", cte("ab", "branch") + """, h AS (SELECT DISTINCT sample_id, branch_id, length FROM ab JOIN branch USING (feature_id))
SELECT sample_id, SUM(length) AS faith_pd FROM h GROUP BY 1""")
def g03(spark, d):
    return alpha.faith_pd(fx.abundance(spark, d), fx.branch(spark, d))


@query("g04_phylo_entropy", cte("ab", "branch", t=TOT) + f""", dp AS (SELECT feature_id, SUM(length) AS depth FROM branch GROUP BY 1)
SELECT sample_id, {q6('SUM(-count/total*LN(count/total)*depth)')} AS phylo_entropy FROM ab JOIN t USING (sample_id)
JOIN dp USING (feature_id) GROUP BY 1""")
def g04(spark, d):
    return rounded(alpha.phylo_entropy(fx.abundance(spark, d), fx.branch(spark, d)))


@query("g05_rarefy")
def g05(spark, d):
    return alpha.rarefy(brand_lines(spark, d), 20)


@query("g06_rarefaction_curve", cte(ab=BRAND_LINES, t=TOT, dep="SELECT UNNEST([1, 5, 10, 20, 30]) AS depth") + f"""
SELECT sample_id, CAST(depth AS INTEGER) AS depth, {q6('SUM(CASE WHEN total - count < depth THEN 1 ELSE 1 - EXP(lgamma(total-count+1) - lgamma(total-count-depth+1) - lgamma(total+1) + lgamma(total-depth+1)) END)')}
AS expected_richness FROM ab JOIN t USING (sample_id), dep WHERE depth <= total GROUP BY 1, 2""")
def g06(spark, d):
    return rounded(alpha.rarefaction_curve(brand_lines(spark, d), [1, 5, 10, 20, 30]))


@query("g07_depth_adequacy", cte(ab=BRAND_LINES, t=TOT, dep="SELECT UNNEST([2, 4, 6, 8, 10, 15, 20, 25, 30, 35]) AS depth") + f"""
, c AS (SELECT sample_id, depth, SUM(CASE WHEN total - count < depth THEN 1 ELSE 1 - EXP(lgamma(total-count+1) - lgamma(total-count-depth+1) - lgamma(total+1) + lgamma(total-depth+1)) END) AS e
 FROM ab JOIN t USING (sample_id), dep WHERE depth <= total GROUP BY 1, 2),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY depth) AS i, COUNT(*) OVER (PARTITION BY sample_id) AS n FROM c),
z AS (SELECT sample_id, MAX(CASE WHEN i = n THEN e END) / (AVG(CASE WHEN i > FLOOR(n*0.8) THEN e END) + 1e-10) AS ratio FROM k GROUP BY 1)
SELECT sample_id, {q6('ratio')} AS plateau_ratio, ratio >= 0.95 AS adequate FROM z""")
def g07(spark, d):
    curve = alpha.rarefaction_curve(brand_lines(spark, d), [2, 4, 6, 8, 10, 15, 20, 25, 30, 35])
    return rounded(alpha.depth_adequacy(curve))


@query("g07_suggest_depth", cte("ab", t=TOT) + "SELECT CAST(FLOOR(quantile_cont(total, 0.1)) AS BIGINT) AS depth FROM t")
def g07b(spark, d):
    return alpha.suggest_depth(fx.abundance(spark, d))


@query("g08_alpha_vs_metadata", cte("ab", "meta", t=TOT, v="""SELECT sample_id, 'observed_features' AS metric, CAST(COUNT(*) AS DOUBLE) AS v FROM ab GROUP BY 1
UNION ALL SELECT sample_id, 'shannon', ROUND(-SUM(count/total*LN(count/total)), 6) FROM ab JOIN t USING (sample_id) GROUP BY 1""") + f"""
, j AS (SELECT metric, v, value, flag, "group" AS g FROM v JOIN meta USING (sample_id)), s AS (SELECT metric, RANK() OVER (PARTITION BY metric ORDER BY v) + (COUNT(*) OVER (PARTITION BY metric, v) - 1)/2 AS a, RANK() OVER (PARTITION BY metric ORDER BY value) + (COUNT(*) OVER (PARTITION BY metric, value) - 1)/2 AS b FROM j WHERE value IS NOT NULL),
r AS (SELECT *, RANK() OVER (PARTITION BY metric ORDER BY v) + (COUNT(*) OVER (PARTITION BY metric, v) - 1)/2 AS rk, COUNT(*) OVER (PARTITION BY metric) AS n FROM j), ti AS (SELECT metric, SUM(POWER(c, 3) - c) AS tie FROM (SELECT metric, v, COUNT(*) AS c FROM j GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT metric, SUM(q) AS q, MAX(n) AS n FROM (SELECT metric, g, POWER(SUM(rk), 2)/COUNT(*) AS q, CAST(MAX(n) AS DOUBLE) AS n FROM r GROUP BY 1, 2) GROUP BY 1)
SELECT metric, 'value' AS "column", 'spearman' AS test, {q6('CORR(a, b)')} AS statistic FROM s GROUP BY 1
UNION ALL SELECT metric, 'flag', 'mann_whitney', {q6('SUM(rk) - COUNT(*)*(COUNT(*) + 1)/2')} FROM r WHERE NOT flag GROUP BY 1
UNION ALL SELECT metric, 'group', 'kruskal', {q6('(12/(n*(n+1))*q - 3*(n+1))/(1 - tie/(n*n*n - n))')} FROM k JOIN ti USING (metric)""")
def g08(spark, d):
    r = alpha.richness(fx.abundance(spark, d))
    v = r.select("sample_id", F.explode(F.array(F.struct(F.lit("observed_features").alias("metric"), F.col("observed_features").cast("double").alias("value")),
                                                F.struct(F.lit("shannon").alias("metric"), F.round("shannon", 6).alias("value")))).alias("m")).select("sample_id", "m.metric", "m.value")
    return rounded(alpha.alpha_vs_metadata(v, fx.sample_meta(spark, d), ["value"], ["flag", "group"]).drop("p_value"))
