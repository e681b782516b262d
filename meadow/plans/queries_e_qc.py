"""Profiling, quality control and validation."""

from pyspark.sql import functions as F

from meadow.operators import qc
from meadow.operators.stats import spearman_features
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import q6, query, r6

def K():
    return F.col("c_custkey")



@query("e01_diagnose_zeros", cte("ab") + f"""SELECT n AS n_samples, p AS n_features, CAST(n*p - r AS BIGINT) AS total_zeros, {q6('1 - r/(n*p)')} AS zero_fraction,
(SELECT COUNT(*) FROM (SELECT COUNT(*) AS c FROM ab GROUP BY sample_id) WHERE c < p) AS samples_with_zeros, (SELECT COUNT(*) FROM (SELECT COUNT(*) AS c FROM ab GROUP BY feature_id) WHERE c < n) AS features_with_zeros
FROM (SELECT COUNT(DISTINCT sample_id) AS n, COUNT(DISTINCT feature_id) AS p, COUNT(*) AS r FROM ab)""")
def e01(spark, d):
    return rounded(qc.diagnose_zeros(fx.abundance(spark, d)))


COLS = ["study", "group", "value", "flag"]


@query("e02_profile_completeness", cte("meta") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(\"{c}\") AS n_complete, COUNT(*) - COUNT(\"{c}\") AS n_missing, {q6(f'100*COUNT({chr(34)}{c}{chr(34)})/COUNT(*)')} AS pct_full FROM meta" for c in COLS))
def e02(spark, d):
    return rounded(qc.profile_completeness(fx.sample_meta(spark, d), COLS))


@query("e03_profile_categories", cte("meta", v="""SELECT 'study' AS col, study AS v, COUNT(*) AS c FROM meta GROUP BY 2 UNION ALL SELECT 'group', "group", COUNT(*) FROM meta GROUP BY 2""") + f"""
SELECT col AS "column", COUNT(*) AS n_categories, {q6('LOG2(SUM(c)) - SUM(c*LOG2(c))/SUM(c)')} AS entropy, {q6('100*MAX(c)/SUM(c)')} AS majority_pct, {q6('100*MIN(c)/SUM(c)')} AS minority_pct, {q6('MAX(c)/MIN(c)')} AS imbalance_ratio FROM v GROUP BY 1""")
def e03(spark, d):
    return rounded(qc.profile_categories(fx.sample_meta(spark, d), ["study", "group"]))


@query("e04_profile_numeric", cte("meta") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {q6(f'AVG({c})')} AS mean, {q6(f'STDDEV({c})')} AS std, {q6(f'MIN({c})')} AS min, {q6(f'MAX({c})')} AS max, {q6(f'quantile_cont({c}, 0.5)')} AS median FROM meta" for c in ("value", "lat")))
def e04(spark, d):
    return rounded(qc.profile_numeric(fx.sample_meta(spark, d), ["value", "lat"]))


@query("e05_target_warnings", cte("meta") + """, f AS (SELECT COUNT(*) FILTER (flag) AS a, COUNT(*) FILTER (NOT flag) AS b FROM meta) SELECT 'nothing' AS target, 'ERROR' AS severity, 'Missing Target' AS category
UNION ALL SELECT 'value', 'WARNING', 'Missing Target Data' UNION ALL SELECT 'flag', CASE WHEN b/a > 100 THEN 'ERROR' ELSE 'WARNING' END, CASE WHEN b/a > 100 THEN 'Severe Imbalance' ELSE 'Class Imbalance' END FROM f WHERE b/a > 10
UNION ALL SELECT 'flag', 'WARNING', 'Small Class' FROM f WHERE a < 30 UNION ALL SELECT 'group', 'WARNING', 'Small Class' FROM (SELECT MIN(c) AS m FROM (SELECT COUNT(*) AS c FROM meta GROUP BY "group")) WHERE m < 30""")
def e05(spark, d):
    return qc.target_warnings(fx.sample_meta(spark, d), ["nothing", "value", "flag", "group"])


@query("e06_cramers_v", f"""WITH c AS (SELECT o_orderstatus AS x, o_orderpriority AS y, CAST(COUNT(*) AS DOUBLE) AS c FROM orders GROUP BY 1, 2),
q AS (SELECT SUM(c*c/(r*s)) - 1 AS phi, SUM(c) AS n, COUNT(DISTINCT x) AS a, COUNT(DISTINCT y) AS b FROM (SELECT *, SUM(c) OVER (PARTITION BY x) AS r, SUM(c) OVER (PARTITION BY y) AS s FROM c))
SELECT {q6('SQRT(GREATEST(phi, 0)/(LEAST(a, b) - 1))')} AS cramers_v, {q6('SQRT(GREATEST(0, phi - (a-1)*(b-1)/(n-1))/(LEAST(a - POWER(a-1, 2)/(n-1), b - POWER(b-1, 2)/(n-1)) - 1))')} AS corrected FROM q""")
def e06(spark, d):
    return rounded(qc.cramers_v(fx.table(spark, d, "orders"), "o_orderstatus", "o_orderpriority"))


@query("e07_confounding", cte("meta") + f""", k AS (SELECT * FROM meta WHERE value IS NOT NULL), e AS (SELECT SUM(n*POWER(m - (SELECT AVG(value) FROM k), 2)) / (SELECT VAR_POP(value)*COUNT(*) FROM k) AS e FROM (SELECT study, COUNT(*) AS n, AVG(value) AS m FROM k GROUP BY 1)),
r AS (SELECT RANK() OVER (ORDER BY lat) + (COUNT(*) OVER (PARTITION BY lat) - 1)/2 AS a, RANK() OVER (ORDER BY value) + (COUNT(*) OVER (PARTITION BY value) - 1)/2 AS b FROM k)
SELECT 'study' AS batch, 'eta_squared' AS kind, {q6('e')} AS value, CASE WHEN e >= 0.7 THEN 'high' WHEN e >= 0.49 THEN 'moderate' ELSE 'low' END AS level FROM e
UNION ALL SELECT 'lat', 'spearman', {q6('ABS(CORR(a, b))')}, CASE WHEN ABS(CORR(a, b)) >= 0.7 THEN 'high' WHEN ABS(CORR(a, b)) >= 0.49 THEN 'moderate' ELSE 'low' END FROM r""")
def e07(spark, d):
    return rounded(qc.confounding(fx.sample_meta(spark, d), "value", ["study", "lat"]))


@query("e08_crosstab_totals", """SELECT COALESCE(o_orderstatus, 'All') AS o_orderstatus, COALESCE(o_orderpriority, 'All') AS o_orderpriority, COUNT(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def e08(spark, d):
    return qc.crosstab_totals(fx.table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


NAMES = ["Pseudomonas", "Bacteroides", "Prevotella", "Streptococcus", "Cutibacterium", "Geobacter", "Bacillus"]
PHYLA = ["Proteobacteria", "Firmicutes", "Cyanobacteria", "Chloroflexi", "Actinobacteria"]


def taxa(spark, d):
    k = F.col("feature_id")
    return fx.feature_meta(spark, d).select("feature_id", F.get(F.array(*[F.lit(n) for n in NAMES]), (k % 7).cast("int")).alias("genus"),
                                            F.get(F.array(*[F.lit(n) for n in PHYLA]), (k % 5).cast("int")).alias("phylum"),
                                            F.repeat(F.lit("A"), (F.lit(230) + F.col("size")).cast("int")).alias("sequence"), "size")


TAXA = ("SELECT p_partkey AS feature_id, CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES)) + " END AS genus, CASE p_partkey % 5 "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(PHYLA)) + " END AS phylum, 230 + p_size AS len FROM part")


@query("e09_contaminants_database", cte(tx=TAXA) + """SELECT feature_id, CAST(CASE genus WHEN 'Pseudomonas' THEN 0.7 WHEN 'Bacteroides' THEN 0.6 WHEN 'Prevotella' THEN 0.6 WHEN 'Streptococcus' THEN 0.5 WHEN 'Cutibacterium' THEN 0.8 ELSE 0 END AS DOUBLE) AS db_score FROM tx""")
def e09(spark, d):
    return qc.contaminants_database(taxa(spark, d))


@query("e10_contaminants_frequency")
def e10(spark, d):
    return qc.contaminants_frequency(fx.abundance_brand(spark, d))


@query("e11_contaminants_ubiquity", cte(ab=fx.SQL["abb"], t="SELECT sample_id, SUM(count) AS t FROM ab GROUP BY 1", n="SELECT COUNT(DISTINCT sample_id) AS n FROM ab") + """
, g AS (SELECT feature_id, COUNT(*)/n AS p, SUM(count/t)/n AS m, SQRT(SUM(POWER(count/t, 2))/n - POWER(SUM(count/t)/n, 2)) AS s FROM ab JOIN t USING (sample_id), n GROUP BY 1, n)
SELECT feature_id, CAST(CASE WHEN p > 0.77 AND m < 0.041 AND s/(m + 1e-10) < 0.85 THEN 0.8 WHEN p > 0.77 AND m < 0.041 THEN 0.6 ELSE 0 END AS DOUBLE) AS ubiq_score FROM g""".replace("< 0.85", "< 1"))
def e11(spark, d):
    return qc.contaminants_ubiquity(fx.abundance_brand(spark, d), 0.77, 0.041)


def genus_table(spark, d):
    ab = fx.abundance_brand(spark, d)
    fm = ab.select("feature_id").distinct().withColumn("genus", F.when(F.col("feature_id") < "Brand#15", "Pseudomonas").otherwise("Geobacter"))
    return ab, fm


@query("e12_contaminants_combined")
def e12(spark, d):
    return qc.contaminants_combined(*genus_table(spark, d))


@query("e12_remove_contaminants", cte("ab", tx=TAXA) + "SELECT ab.* FROM ab JOIN tx USING (feature_id) WHERE genus NOT IN ('Pseudomonas', 'Bacteroides', 'Prevotella', 'Cutibacterium')")
def e12b(spark, d):
    return qc.remove_contaminants(fx.abundance(spark, d), qc.contaminants_database(taxa(spark, d)), "db_score", 0.5)


ORDER_SETS = """SELECT DISTINCT o_custkey AS batch, o_orderkey AS sample_id, l_returnflag || l_linenumber AS f FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
SETS = """SELECT batch, sample_id, MIN(sample_id) OVER (PARTITION BY batch, set) AS rep, n FROM (SELECT batch, sample_id, string_agg(f, ',' ORDER BY f) AS set, COUNT(*) AS n FROM o GROUP BY 1, 2)"""


@query("e13_cross_sample_overlap", cte(o=ORDER_SETS, st=SETS) + f""", r AS (SELECT * FROM st WHERE sample_id = rep),
p AS (SELECT x.batch, x.sample_id AS a, y.sample_id AS b, x.n AS na, y.n AS nb, COUNT(*) AS s FROM r x JOIN o u ON u.sample_id = x.sample_id JOIN o v ON v.batch = u.batch AND v.f = u.f JOIN r y ON y.sample_id = v.sample_id AND x.sample_id < y.sample_id GROUP BY 1, 2, 3, 4, 5)
SELECT batch, a, b, {q6('s/(na + nb - s)')} AS jaccard FROM p WHERE s/(na + nb - s) > 0.5""")
def e13(spark, d):
    """Orders of one customer as samples, return flag and line number as features: few features, many copies."""
    li = fx.lines(spark, d)
    ab = li.select(F.col("l_orderkey").alias("sample_id"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("feature_id"))
    b = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("batch"))
    return rounded(qc.cross_sample_overlap(ab, b, 0.5)[0])


@query("e13_overlap_members", cte(o=ORDER_SETS, st=SETS) + "SELECT batch, sample_id, rep, n FROM st")
def e13b(spark, d):
    li = fx.lines(spark, d)
    ab = li.select(F.col("l_orderkey").alias("sample_id"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("feature_id"))
    b = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("batch"))
    return qc.cross_sample_overlap(ab, b, 0.5)[1]


@query("e14_environment_match", cte("ab", tx=TAXA, en="SELECT c_custkey AS sample_id, CASE c_custkey % 3 WHEN 0 THEN 'soil' WHEN 1 THEN 'marine' ELSE 'other' END AS env FROM customer") + """
, t AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY count DESC, feature_id) AS k FROM ab) WHERE k <= 20), j AS (SELECT sample_id, env, phylum, genus FROM t JOIN tx USING (feature_id) JOIN en USING (sample_id)),
p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY c DESC, phylum) AS k FROM (SELECT sample_id, env, phylum, COUNT(*) AS c FROM j GROUP BY 1, 2, 3)),
h AS (SELECT sample_id, COUNT(*) FILTER ((env = 'soil' AND phylum IN ('Proteobacteria', 'Firmicutes', 'Actinobacteria')) OR (env = 'marine' AND phylum IN ('Proteobacteria', 'Cyanobacteria', 'Actinobacteria'))) AS hits FROM p WHERE k <= 3 GROUP BY 1),
o AS (SELECT sample_id, MAX(env = 'soil' AND genus IN ('Bacteroides', 'Prevotella')) AS odd FROM j GROUP BY 1)
SELECT en.sample_id, CASE WHEN env = 'other' OR hits IS NULL THEN 'UNKNOWN' WHEN hits < 2 THEN 'FAIL' WHEN odd THEN 'WARNING' ELSE 'PASS' END AS env_match FROM en LEFT JOIN h USING (sample_id) LEFT JOIN o USING (sample_id)""")
def e14(spark, d):
    env = F.when(K() % 3 == 0, "soil").when(K() % 3 == 1, "marine").otherwise("other")
    m = fx.table(spark, d, "customer").select(K().alias("sample_id"), env.alias("env"))
    return qc.environment_match(fx.abundance(spark, d), taxa(spark, d), m)


HUMAN = "genus IN ('Bacteroides', 'Prevotella', 'Streptococcus', 'Cutibacterium')"


@query("e15_human_fraction", cte("ab", tx=TAXA, g=f"SELECT sample_id, SUM(CASE WHEN {HUMAN} THEN count ELSE 0 END)/SUM(count) AS f FROM ab JOIN tx USING (feature_id) GROUP BY 1") + f"""
SELECT sample_id, {q6('f')} AS human_fraction, CASE WHEN f < 0.05 THEN 'NONE' WHEN f < 0.15 THEN 'LOW' WHEN f < 0.3 THEN 'MEDIUM' ELSE 'HIGH' END AS human_contamination FROM g""")
def e15(spark, d):
    return rounded(qc.human_fraction(fx.abundance(spark, d), taxa(spark, d)))


@query("e15_human_fraction_unannotated", cte("ab", tx=TAXA, g=f"SELECT sample_id, SUM(CASE WHEN feature_id % 2 = 0 AND {HUMAN} THEN count ELSE 0 END)/SUM(count) AS f FROM ab JOIN tx USING (feature_id) GROUP BY 1") + f"""
SELECT sample_id, {q6('f')} AS human_fraction, CASE WHEN f < 0.05 THEN 'NONE' WHEN f < 0.15 THEN 'LOW' WHEN f < 0.3 THEN 'MEDIUM' ELSE 'HIGH' END AS human_contamination FROM g""")
def e15_unannotated(spark, d):
    """Every second feature has no metadata; its counts stay in the total."""
    return rounded(qc.human_fraction(fx.abundance(spark, d), taxa(spark, d).filter("feature_id % 2 = 0")))


@query("e16_region_length_check", cte("ab", tx=TAXA, g="SELECT sample_id, quantile_cont(len, 0.5) AS m FROM ab JOIN tx USING (feature_id) GROUP BY 1") + f"""
, c AS (SELECT c_custkey AS sample_id, CASE c_custkey % 3 WHEN 0 THEN 'V4' WHEN 1 THEN 'V1-V2' END AS r FROM customer)
SELECT sample_id, {q6('m')} AS median_length, CASE WHEN r IS NULL OR m IS NULL THEN 'UNKNOWN' WHEN r = 'V4' AND m BETWEEN 240 AND 280 THEN 'PASS' WHEN r = 'V1-V2' AND m BETWEEN 280 AND 320 THEN 'PASS'
WHEN ABS(m - CASE WHEN r = 'V4' THEN 260 ELSE 300 END) < 50 THEN 'WARNING' ELSE 'FAIL' END AS primer_match FROM c LEFT JOIN g USING (sample_id)""")
def e16(spark, d):
    m = fx.table(spark, d, "customer").select(K().alias("sample_id"), F.when(K() % 3 == 0, "V4").when(K() % 3 == 1, "V1-V2").alias("region"))
    return rounded(qc.region_length_check(fx.abundance(spark, d), taxa(spark, d), m))


@query("e17_metadata_outliers")
def e17(spark, d):
    return qc.metadata_outliers(fx.sample_meta(spark, d), ["value", "lat", "lon"])


@query("e18_overall_flag", """WITH t AS (SELECT c_custkey AS k, c_custkey % 3 AS a, c_custkey % 4 AS b, c_custkey % 5 AS c FROM customer), s AS (SELECT k, CASE WHEN a = 0 THEN 1 ELSE 0 END + CASE WHEN b = 3 THEN 2 ELSE 0 END + CASE WHEN c = 0 THEN 1 ELSE 0 END AS f,
CASE WHEN a = 1 THEN 1 ELSE 0 END + CASE WHEN b IN (1, 2) THEN 1 ELSE 0 END AS w FROM t) SELECT k AS sample_id, CASE WHEN f >= 3 THEN 'FAIL' WHEN f >= 1 OR w >= 2 THEN 'WARNING' ELSE 'PASS' END AS flag FROM s""")
def e18(spark, d):
    pick = lambda m, *v: F.get(F.array(*[F.lit(x) for x in v]), (K() % m).cast("int"))
    flags = [pick(3, "FAIL", "WARNING", "PASS"), pick(4, "NONE", "LOW", "MEDIUM", "HIGH"), pick(5, "FAIL", "PASS", "PASS", "PASS", "UNKNOWN")]
    return fx.table(spark, d, "customer").select(K().alias("sample_id"), qc.overall_flag(flags).alias("flag"))


def measured(spark, d):
    return fx.table(spark, d, "customer").select(K().alias("sample_id"), (F.col("c_acctbal") / 100).alias("soil_depth"), (K() % 16).cast("double").alias("ph"), (K() % 90 + 250).cast("double").alias("temp_air"))


@query("e19_check_ranges", f"""SELECT c_custkey AS sample_id, {q6('CASE WHEN c_acctbal/100 BETWEEN 0 AND 11000 THEN c_acctbal/100 END')} AS soil_depth, CASE WHEN c_custkey % 16 <= 14 THEN CAST(c_custkey % 16 AS DOUBLE) END AS ph FROM customer""")
def e19(spark, d):
    out, _ = qc.check_ranges(measured(spark, d))
    return out.select("sample_id", r6("soil_depth").alias("soil_depth"), "ph")


@query("e19_check_ranges_report", """SELECT 'soil_depth' AS "column", 'ERROR' AS level, COUNT(*) FILTER (c_acctbal < 0) AS n_samples FROM customer UNION ALL SELECT 'ph', 'ERROR', COUNT(*) FILTER (c_custkey % 16 = 15) FROM customer
UNION ALL SELECT 'ph', 'WARNING', COUNT(*) FILTER (c_custkey % 16 NOT BETWEEN 3 AND 11) FROM customer UNION ALL SELECT 'soil_depth', 'WARNING', COUNT(*) FILTER (c_acctbal/100 NOT BETWEEN 0 AND 100) FROM customer""")
def e19b(spark, d):
    return qc.check_ranges(measured(spark, d))[1]


@query("e20_fix_kelvin_cm", f"""SELECT c_custkey AS sample_id, {q6('c_custkey % 90 + 250 - 273.15')} AS temp_air, {q6('c_acctbal/100')} AS soil_depth FROM customer""")
def e20(spark, d):
    return rounded(qc.fix_kelvin_cm(measured(spark, d), fix_cm=True).select("sample_id", "temp_air", "soil_depth"))


@query("e21_drop_redundant_columns")
def e21(spark, d):
    m = fx.sample_meta(spark, d)
    df = m.select("sample_id", "lat", "value", (F.col("balance") * 2 + 1).alias("double_balance"), F.col("lat").alias("lat_ena"), F.lit(None).cast("double").alias("hollow"))
    return qc.drop_redundant_columns(df)


@query("e22_geo_consistency", """WITH t AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 180 - 90 END AS lat FROM customer) SELECT k AS sample_id, 'ERROR' AS level, 'external data without coordinates' AS rule FROM t WHERE lat IS NULL
UNION ALL SELECT k, 'WARNING', 'marine sample near a pole' FROM t WHERE k % 2 = 0 AND ABS(lat) > 80 UNION ALL SELECT k, 'WARNING', 'facility over 1000 km away' FROM t WHERE k % 1500 > 1000""")
def e22(spark, d):
    df = fx.table(spark, d, "customer").select(K().alias("sample_id"), F.when(K() % 5 != 0, K() % 180 - 90).alias("latitude"), F.lit(0.0).alias("longitude"), F.when(K() % 2 == 0, "marine").otherwise("soil").alias("env_category_type"),
                                               (K() % 1500).alias("facility_distance_km"), F.lit(1.0).alias("SoilGrids_clay"))
    return qc.geo_consistency(df)[1]


def _habitat_sql():
    n = {(b, c): f"len(regexp_extract_all(t, '(?i)\\b({'|'.join(ts)})\\b'))" for b, cats in qc.HABITATS.items() for c, ts in cats.items()}
    score = {b: "(" + " + ".join(f"CAST({n[b, c]} > 0 AS INTEGER)" for c in cats) + ")" for b, cats in qc.HABITATS.items()}
    best = f"GREATEST({', '.join(score.values())})"
    cls = f"CASE WHEN {best} = 0 THEN 'unknown' " + " ".join(f"WHEN {score[b]} = {best} THEN '{b}'" for b in qc.HABITATS) + " END"
    return cls


@query("e23_categorize_habitat", f"WITH x AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'forest soil [ENVO:00001998]' WHEN 1 THEN 'Ocean water, coastal' WHEN 2 THEN 'hot spring brine' WHEN 3 THEN 'sewage sludge' WHEN 4 THEN 'unclear' ELSE 'lake sediment' END || ' ' || p_name AS t FROM part) SELECT p_partkey, {_habitat_sql()} AS biome_class FROM x")
def e23(spark, d):
    words = ["forest soil [ENVO:00001998]", "Ocean water, coastal", "hot spring brine", "sewage sludge", "unclear", "lake sediment"]
    p = fx.table(spark, d, "part").select("p_partkey", F.concat_ws(" ", F.get(F.array(*[F.lit(w) for w in words]), (F.col("p_partkey") % 6).cast("int")), "p_name").alias("t"))
    return p.select("p_partkey", qc.categorize_habitat(F.col("t"))["biome_class"].alias("biome_class"))


@query("e24_table_checks", """SELECT 'rows' AS "check", COUNT(*) AS value FROM orders UNION ALL SELECT 'missing_required', 1 UNION ALL SELECT 'duplicate_ids', COUNT(*) - COUNT(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'all_null_columns', 1""")
def e24(spark, d):
    o = fx.table(spark, d, "orders").withColumn("hollow", F.lit(None).cast("string"))
    return qc.table_checks(o, "o_custkey", ["o_orderkey", "absent"])


@query("e24_abundance_checks", cte("ab", "meta") + """SELECT 'samples' AS "check", COUNT(*) AS value, COUNT(*) >= 10 AS ok FROM meta UNION ALL SELECT 'features', COUNT(DISTINCT feature_id), COUNT(DISTINCT feature_id) >= 100 FROM ab
UNION ALL SELECT 'zero_samples', COUNT(*), COUNT(*) = 0 FROM meta WHERE sample_id NOT IN (SELECT sample_id FROM ab)""")
def e24b(spark, d):
    return qc.abundance_checks(fx.abundance(spark, d), fx.sample_meta(spark, d))


@query("e25_study_eligibility", cte("meta", g="SELECT study, COUNT(value) AS n, COALESCE(STDDEV(value), 0) AS x FROM meta GROUP BY 1") + """SELECT study, n, CASE WHEN n < 50 OR x = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN n < 50 THEN 'Small N' WHEN x = 0 THEN 'Zero Variance' END AS reason FROM g""")
def e25(spark, d):
    return qc.study_eligibility(fx.sample_meta(spark, d), "study", "value", 50)


@query("e25_two_tier_split", cte("meta", g="SELECT study, COUNT(value) AS n FROM meta GROUP BY 1") + "SELECT sample_id, n >= 50 AS may_test FROM meta JOIN g USING (study)")
def e25b(spark, d):
    m = fx.sample_meta(spark, d)
    return qc.two_tier_split(m, qc.study_eligibility(m, "study", "value", 50), "study").select("sample_id", "may_test")


ELIG = """m AS (SELECT sample_id, study, CASE WHEN sample_id % 25 < 12 THEN 'x' ELSE "group" END AS target FROM meta),
g AS (SELECT study, COUNT(DISTINCT target) AS k, COUNT(*) AS n FROM m GROUP BY 1), b AS (SELECT COALESCE(MAX(t) FILTER (e >= 100), 2) AS b FROM (SELECT t, FLOOR(SUM(CASE WHEN k >= t AND k > 1 THEN n ELSE 0 END)*0.7) AS e FROM g, (SELECT UNNEST([6, 5, 4, 3, 2]) AS t) GROUP BY 1))"""


@query("e26_eligible_samples", cte("meta") + f", {ELIG} SELECT sample_id FROM m JOIN g USING (study), b WHERE k >= b AND k > 1")
def e26(spark, d):
    m = fx.sample_meta(spark, d)
    m = m.withColumn("target", F.when(F.col("sample_id") % 25 < 12, "x").otherwise(F.col("group")))
    return qc.eligible_samples(m, "study", "target", 6).select("sample_id")


@query("e27_batch_variance_audit", cte("ab", "meta", b="SELECT sample_id, study FROM meta WHERE sample_id IN (SELECT sample_id FROM ab)") + f""", n AS (SELECT study, COUNT(*) AS n FROM b GROUP BY 1), p AS (SELECT COUNT(DISTINCT feature_id) AS p FROM ab),
v AS (SELECT study, feature_id, (SUM(count*count) - POWER(SUM(count), 2)/n)/(n-1) AS v FROM ab JOIN b USING (sample_id) JOIN n USING (study) GROUP BY 1, 2, n)
SELECT study AS batch, n, {q6('1 - COUNT(*) FILTER (v >= 1e-6)/p')} AS zero_var_fraction, n >= 60 AND 1 - COUNT(*) FILTER (v >= 1e-6)/p <= 0.9 AS passed FROM v JOIN n USING (study), p GROUP BY study, n, p""")
def e27(spark, d):
    from meadow.operators.compositional import batch_variance_audit
    ab = fx.abundance(spark, d)
    b = fx.sample_meta(spark, d).join(ab.select("sample_id").distinct(), "sample_id", "left_semi").select("sample_id", F.col("study").alias("batch"))
    return rounded(batch_variance_audit(ab, b, min_samples=60))


PRIMER = {"515F": "GTGYCAGCMGCCGCGGTAA", "806R": "GGACTACNVGGGTWTCTAAT"}
DNA = "translate(md5(CAST({0} AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
READS = f"""SELECT o_custkey % 20 AS run_id, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'GTGCCAGCAGCCGCGGTAA' ELSE '' END || {DNA.format('o_orderkey')} || {DNA.format('o_orderkey + 7')} ||
CASE WHEN o_orderkey % 4 = 0 THEN 'AGATCGGAAGAGC' WHEN o_orderkey % 5 = 0 THEN 'ATTAGAAACCCTCGTAGTCC' ELSE '' END AS seq FROM orders"""


def reads(spark, d, trimmed=False):
    k = F.col("o_orderkey")
    dna = lambda c: F.translate(F.md5(c.cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT")
    head = F.when(k % (30 if trimmed else 3) == 0, "GTGCCAGCAGCCGCGGTAA").otherwise("")
    tail = F.when(k % 4 == 0, "AGATCGGAAGAGC").when(k % 5 == 0, "ATTAGAAACCCTCGTAGTCC").otherwise("")
    return fx.table(spark, d, "orders").select((F.col("o_custkey") % 20).alias("run_id"), k.alias("read_id"), F.concat(head, dna(k), dna(k + 7), tail).alias("seq"))


def _primer_sql(name):
    rx = qc.iupac_regex(PRIMER[name])
    part = lambda e: q6(f"AVG(CASE WHEN regexp_matches({e}, '{rx}') THEN 1 ELSE 0 END)")
    rc = "reverse(translate(seq, 'ACGT', 'TGCA'))"
    return (f"SELECT run_id, '{name}' AS primer, {part('left(seq, 40)')} AS forward_5prime, {part('right(seq, 40)')} AS forward_3prime, {part(f'left({rc}, 40)')} AS reverse_comp_5prime, "
            f"{part(f'right({rc}, 40)')} AS reverse_comp_3prime FROM r GROUP BY 1")


@query("e28_primer_frequencies", cte(r=READS) + " UNION ALL ".join(_primer_sql(n) for n in PRIMER))
def e28(spark, d):
    return rounded(qc.primer_frequencies(reads(spark, d), PRIMER, 40))


@query("e28_adapter_frequencies", cte(r=READS) + " UNION ALL ".join(f"SELECT run_id, '{n}' AS adapter, {q6(f'AVG(CASE WHEN contains(seq, {chr(39)}{a}{chr(39)}) THEN 1 ELSE 0 END)')} AS frequency, AVG(CASE WHEN contains(seq, '{a}') THEN 1 ELSE 0 END) >= 0.05 AS detected FROM r GROUP BY 1" for n, a in qc.ADAPTERS.items()))
def e28b(spark, d):
    return rounded(qc.adapter_frequencies(reads(spark, d)))


@query("e29_trimming_check", cte(r=READS, u=READS.replace("% 3 = 0", "% 30 = 0")) + f""", b AS (SELECT run_id, AVG(CASE WHEN regexp_matches(left(seq, 40), '{qc.iupac_regex(PRIMER['515F'])}') THEN 1 ELSE 0 END) AS f FROM r GROUP BY 1), a AS (SELECT run_id, AVG(CASE WHEN regexp_matches(left(seq, 40), '{qc.iupac_regex(PRIMER['515F'])}') THEN 1 ELSE 0 END) AS f FROM u GROUP BY 1),
m AS (SELECT run_id, quantile_cont(l, 0.5) AS m FROM (SELECT run_id, LENGTH(seq) AS l FROM r) GROUP BY 1), n AS (SELECT run_id, quantile_cont(l, 0.5) AS m FROM (SELECT run_id, LENGTH(seq) AS l FROM u) GROUP BY 1)
SELECT run_id, '515F' AS primer, {q6('b.f')} AS before, {q6('a.f')} AS after, CASE WHEN a.f < b.f*0.1 THEN 'PASS' WHEN a.f < b.f*0.5 THEN 'WARNING' ELSE 'FAIL' END AS status, {q6('m.m - n.m')} AS length_shift,
CASE WHEN ABS(m.m - n.m - 19) < 10 THEN 'PASS' ELSE 'WARNING' END AS length_check FROM b JOIN a USING (run_id) JOIN m USING (run_id) JOIN n USING (run_id)""")
def e29(spark, d):
    return rounded(qc.trimming_check(reads(spark, d), reads(spark, d, True), {"515F": PRIMER["515F"]}, 40))


@query("e30_run_validity", cte(r=READS) + """, g AS (SELECT CAST(run_id*7 % 10 AS BIGINT) AS run_id, COUNT(*) AS reads, MIN(LENGTH(seq)) AS s FROM r GROUP BY 1)
SELECT run_id, reads, NOT (s < 65 OR reads < 2000) AS valid, CASE WHEN s < 65 THEN 'short reads' WHEN reads < 2000 THEN 'too few reads' END AS reason FROM g""")
def e30(spark, d):
    r = reads(spark, d).withColumn("run_id", F.col("run_id") * 7 % 10)
    return qc.run_validity(r, 65, 2000)


FREQ = """SELECT s_nationkey AS run_id, 'p' || (s_suppkey % 6) AS primer, MAX((s_suppkey * 37 % 100)/CAST(100 AS DOUBLE)) AS f FROM supplier GROUP BY 1, 2"""
PAIRS = [("V4", "p0", "p1"), ("V4", "p2", "p3"), ("V3-V4", "p4", "p1"), ("V3-V4", "p5", "p3")]


def frequencies(spark, d):
    s = F.col("s_suppkey")
    return fx.table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("run_id"), F.concat(F.lit("p"), (s % 6).cast("string")).alias("primer")).agg(F.max((s * 37 % 100) / 100.0).alias("frequency"))


@query("e31_region_scores", cte(f=FREQ, p="SELECT * FROM (VALUES " + ", ".join(map(str, PAIRS)) + ") t(region, fwd, rev)") + f""", j AS (SELECT r.run_id, region, fwd, rev, (COALESCE(a.f, 0) + COALESCE(b.f, 0))/2 AS s FROM (SELECT DISTINCT run_id FROM f) r CROSS JOIN p
LEFT JOIN f a ON a.run_id = r.run_id AND a.primer = fwd LEFT JOIN f b ON b.run_id = r.run_id AND b.primer = rev), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, region ORDER BY s DESC, fwd, rev) AS k FROM j)
SELECT run_id, region, {q6('s')} AS score, fwd, rev FROM k WHERE k = 1""")
def e31(spark, d):
    return rounded(qc.region_scores(frequencies(spark, d), spark.createDataFrame(PAIRS, "region string, fwd string, rev string")))


HITS = """SELECT l_suppkey AS run_id, l_partkey * 13 % 1400 AS s, l_partkey * 13 % 1400 + 100 + l_orderkey % 500 AS e, 150 + l_orderkey % 200 AS q, CAST(l_quantity AS BIGINT) AS z FROM lineitem"""


def hits(spark, d):
    start = F.col("l_partkey") * 13 % 1400
    return fx.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("run_id"), start.alias("sstart"), (start + 100 + F.col("l_orderkey") % 500).alias("send"),
                                                 (150 + F.col("l_orderkey") % 200).alias("qlen"), F.col("l_quantity").cast("long").alias("size"))


@query("e32_region_coverage", cte(h=HITS, g="SELECT * FROM (VALUES " + ", ".join(str((n, v[0], v[1])) for n, v in qc.V_REGIONS.items()) + ") t(region, f, r)") + f""", t AS (SELECT run_id, SUM(z) AS t FROM h GROUP BY 1),
c AS (SELECT run_id, region, SUM(z) AS c, SUM(z*q) AS l, SUM(z*s) AS a, SUM(z*e) AS b FROM h JOIN g ON s <= r AND e >= f WHERE e - s < q*1.5 GROUP BY 1, 2)
SELECT t.run_id, g.region, {q6('COALESCE(100*c/t, 0)')} AS coverage, {q6('COALESCE(l/c, 0)')} AS avg_len, {q6('COALESCE(a/c, 0)')} AS avg_start, {q6('COALESCE(b/c, 0)')} AS avg_end FROM t CROSS JOIN g LEFT JOIN c ON c.run_id = t.run_id AND c.region = g.region""")
def e32(spark, d):
    return rounded(qc.region_coverage(hits(spark, d)))


EVID = """SELECT l_suppkey AS run_id, l_linenumber AS n, AVG(l_discount)*10 AS p, AVG(l_quantity) AS v FROM lineitem GROUP BY 1, 2"""


@query("e33_predict_region", cte(x=EVID) + """, r AS (SELECT run_id, 'R' || n AS region, ROUND(p, 4) AS p4, ROUND(v, 2) AS v2, p, v, n*10 % 7 AS span FROM x),
k AS (SELECT run_id, ARG_MIN(region, (-v2, span, region)) FILTER (p >= 0.55 AND v >= 27) AS a, ARG_MIN(region, (-p4, span, region)) FILTER (p >= 0.55) AS b FROM r GROUP BY 1) SELECT run_id, COALESCE(a, b, 'Undetermined') AS prediction FROM k""")
def e33(spark, d):
    e = fx.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("run_id"), "l_linenumber").agg((F.avg("l_discount") * 10).alias("primer_score"), F.avg("l_quantity").alias("coverage"))
    n = F.col("l_linenumber")
    return qc.predict_region(e.select("run_id", F.concat(F.lit("R"), n.cast("int").cast("string")).alias("region"), "primer_score", "coverage", (n * 10 % 7).alias("span")), 0.55, 27)


@query("e33_study_consensus", """WITH p AS (SELECT c_nationkey AS study, c_mktsegment AS prediction, COUNT(*) AS n FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1, 2), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY study ORDER BY n DESC, prediction) AS k FROM p) SELECT study, prediction AS consensus FROM k WHERE k = 1""")
def e33b(spark, d):
    p = fx.table(spark, d, "customer").select(F.col("c_nationkey").alias("study"), F.when(F.col("c_mktsegment") == "BUILDING", "Undetermined").otherwise(F.col("c_mktsegment")).alias("prediction"))
    return qc.study_consensus(p, "study")


PANEL = [("GTGYCAGCMGCCGCGGTAA", 515, "Forward primer"), ("CCTACGGGNGGCWGCAG", 341, "Forward primer"), ("GGACTACNVGGGTWTCTAAT", 806, "Reverse primer"), ("AGAGTTTGATCMTGGCTCAG", 27, "Forward primer"), ("ATTACCGCGGCTGCTGG", 534, "Reverse primer")]


@query("e34_region_from_primers", """SELECT c_custkey AS run_id, CASE c_custkey % 5 WHEN 0 THEN 'V3-V4' WHEN 1 THEN 'V1-V3' WHEN 2 THEN 'V4-V5' WHEN 3 THEN 'V2-V3' ELSE 'NA' END AS region FROM customer""".replace("WHEN 3 THEN 'V2-V3'", "WHEN 3 THEN 'V1-V3'"))
def e34(spark, d):
    pick = lambda *v: F.get(F.array(*[F.lit(x) for x in v]), (K() % 5).cast("int"))
    r = fx.table(spark, d, "customer").select(K().alias("run_id"), pick("xxCCTACGGGAGGCAGCAGyy", "agagtttgatcatggctcag", "GTGCCAGCAGCCGCGGTAA", None, "nan").alias("fwd_seq"),
                                              pick("GGACTACAAGGGTATCTAAT", "ATTACCGCGGCTGCTGG", "NA", "ATTACCGCGGCTGCTGG", None).alias("rev_seq"))
    return qc.region_from_primers(r, PANEL)


@query("e34_known_primers", f"""SELECT c_custkey, CASE WHEN regexp_matches(s, '{qc.iupac_regex(PRIMER['515F'])}') THEN '515F' ELSE '806R' END AS primer FROM (SELECT c_custkey, upper(regexp_replace(
CASE c_custkey % 3 WHEN 0 THEN 'GTGCC-AGCAGCCGCGGTAA' WHEN 1 THEN 'ttGGACTACAAGGGTATCTAAT' ELSE 'ACGTACGTACGTACGT' END, '[^a-zA-Z]', '', 'g')) AS s FROM customer)
WHERE length(s) >= 10 AND regexp_matches(s, '{qc.iupac_regex(PRIMER['515F'])}|{qc.iupac_regex(PRIMER['806R'])}')""")
def e34b(spark, d):
    s = F.concat(F.when(K() % 3 == 0, "GTGCC-AGCAGCCGCGGTAA").when(K() % 3 == 1, "ttGGACTACAAGGGTATCTAAT").otherwise("ACGTACGTACGTACGT"), F.lit(" "), K().cast("string"))
    f = fx.table(spark, d, "customer").select(s.alias("seq"))
    return qc.known_primers(f, list(PRIMER.items())).select(F.element_at(F.split("seq", " "), -1).cast("long").alias("c_custkey"), "primer")


@query("e35_contaminants_prevalence", cte("abb", "meta") + f"""SELECT feature_id, COUNT(*) FILTER (flag) AS control_present, COUNT(*) FILTER (NOT flag) AS true_present, {q6('COUNT(*) FILTER (flag)/(SELECT COUNT(*) FROM meta WHERE flag)')} AS control_prevalence,
{q6('COUNT(*) FILTER (NOT flag)/(SELECT COUNT(*) FROM meta WHERE NOT flag)')} AS true_prevalence FROM abb JOIN meta USING (sample_id) GROUP BY 1""")
def e35(spark, d):
    return rounded(qc.contaminants_prevalence(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "flag").drop("p_value", "flagged"))
