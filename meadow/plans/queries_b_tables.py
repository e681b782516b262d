"""Filters and reshaping."""

from pyspark.sql import functions as F

from meadow.operators import table as tb
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.registry import q6, query, r6

TOT = "SELECT sample_id, SUM(count) AS total FROM ab GROUP BY 1"


@query("b01_filter_features", cte("ab", t=TOT) + """, k AS (SELECT feature_id FROM ab JOIN t USING (sample_id) GROUP BY 1
HAVING MAX(count/total) >= 0.05 AND COUNT(*) >= 25) SELECT * FROM ab WHERE feature_id IN (SELECT feature_id FROM k)""")
def b01(spark, d):
    return tb.filter_features(fx.abundance(spark, d), 5, 25)


@query("b02_filter_samples", cte("ab", t=TOT) + "SELECT ab.* FROM ab JOIN t USING (sample_id) WHERE total >= 1000")
def b02(spark, d):
    return tb.filter_samples(fx.abundance(spark, d), 1000)


@query("b03_normalize", cte("ab", t=TOT, f="SELECT feature_id, SUM(count) AS ft FROM ab GROUP BY 1") + f"""
SELECT sample_id, feature_id, {q6('count/total')} AS by_sample, {q6('count/ft')} AS by_feature
FROM ab JOIN t USING (sample_id) JOIN f USING (feature_id)""")
def b03(spark, d):
    ab = fx.abundance(spark, d)
    a = tb.normalize(ab).select("sample_id", "feature_id", r6("count").alias("by_sample"))
    b = tb.normalize(ab, 0).select("sample_id", "feature_id", r6("count").alias("by_feature"))
    return a.join(b, ["sample_id", "feature_id"])


@query("b04_presence_absence", cte("ab", f="SELECT feature_id, SUM(count) AS t FROM ab GROUP BY 1") + """
, c AS (SELECT feature_id, SUM(t) OVER (ORDER BY t DESC, feature_id) - t AS before, SUM(t) OVER () AS g FROM f)
SELECT sample_id, feature_id, CAST(1 AS DOUBLE) AS count FROM ab WHERE feature_id IN (SELECT feature_id FROM c WHERE before/g < 0.9)""")
def b04(spark, d):
    return tb.presence_absence(fx.abundance(spark, d), 0.9)


@query("b05_filter_presence_absence", cte("abb", "meta") + """
, n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (flag) AS nt, COUNT(*) FILTER (NOT flag) AS nf FROM meta),
s AS (SELECT feature_id, COUNT(*) AS p, COUNT(*) FILTER (flag) AS pt, COUNT(*) FILTER (NOT flag) AS pf
 FROM abb JOIN meta USING (sample_id) GROUP BY 1)
SELECT abb.* FROM abb JOIN s USING (feature_id), n WHERE p/n >= 0.5 AND pt/nt >= 0.6 AND pf/nf >= 0.6""")
def b05(spark, d):
    return tb.filter_presence_absence(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "flag", 0.5, 0.6)


@query("b06_filter_by_prevalence", cte("ab", "meta") + """
, n AS (SELECT COUNT(*) AS n, COUNT(DISTINCT study) AS nb FROM meta),
s AS (SELECT feature_id, COUNT(*) AS p, COUNT(DISTINCT study) AS pb FROM ab JOIN meta USING (sample_id) GROUP BY 1)
SELECT ab.* FROM ab JOIN s USING (feature_id), n WHERE p >= 0.02*n AND pb >= 0.6*nb""")
def b06(spark, d):
    return tb.filter_by_prevalence(fx.abundance(spark, d), fx.sample_meta(spark, d), "study", 0.02, 0.6)


@query("b07_drop_nontarget_taxa", cte("ab") + """SELECT ab.* FROM ab JOIN part ON feature_id = p_partkey
WHERE p_type NOT IN ('PROMO') AND p_size NOT IN (7) AND p_name NOT LIKE 'red%'""")
def b07(spark, d):
    p = fx.table(spark, d, "part")
    ranks = p.select(F.col("p_partkey").alias("feature_id"),
                     F.when(F.col("p_type") == "PROMO", "d__Eukaryota").otherwise("d__Bacteria").alias("kingdom"),
                     F.when(F.col("p_size") == 7, "o__Chloroplast").otherwise("o__X").alias("order"),
                     F.when(F.col("p_name").startswith("red"), "f__Mitochondria").otherwise("f__X").alias("family"))
    return tb.drop_nontarget_taxa(fx.abundance(spark, d), ranks)


@query("b08_filter_depth_prevalence", cte("ab", t=TOT) + """
, deep AS (SELECT ab.* FROM ab JOIN t USING (sample_id) WHERE total >= 900),
k AS (SELECT feature_id FROM deep GROUP BY 1 HAVING COUNT(*) >= (SELECT LEAST(COUNT(DISTINCT sample_id), 20) FROM deep))
SELECT * FROM deep WHERE feature_id IN (SELECT feature_id FROM k)""")
def b08(spark, d):
    return tb.filter_depth_prevalence(fx.abundance(spark, d), 900, 20)


@query("b09_drop_empty", """SELECT 'sample' AS kind, c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders
JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 49) UNION ALL SELECT 'feature', p_partkey FROM part WHERE p_partkey IN
(SELECT l_partkey FROM lineitem WHERE l_quantity > 49 AND l_orderkey IN (SELECT o_orderkey FROM orders))""")
def b09(spark, d):
    rows = fx.lines(spark, d).select(F.col("o_custkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"),
                                     F.when(F.col("l_quantity") > 49, 1.0).otherwise(0.0).alias("count"))
    s, f = tb.drop_empty(rows, fx.sample_meta(spark, d), fx.feature_meta(spark, d))
    return (s.select(F.lit("sample").alias("kind"), F.col("sample_id").alias("id"))
            .unionByName(f.select(F.lit("feature").alias("kind"), F.col("feature_id").alias("id"))))


@query("b10_parse_taxonomy", cte("fm") + """SELECT feature_id, 'Bacteria' AS kingdom, phylum,
CASE WHEN size % 5 = 0 THEN NULL ELSE 'S' || size END AS "order",
CASE WHEN size % 5 = 0 THEN 'Unclassified_c__' || replace(class, '#', '_') ELSE 'g__' || genus END AS genus_label FROM fm""")
def b10(spark, d):
    fm = fx.feature_meta(spark, d).select(
        "feature_id", F.when(F.col("size") % 5 == 0, F.substring_index("taxonomy", ";", 3)).otherwise(F.col("taxonomy")).alias("taxonomy"))
    return tb.parse_taxonomy(fm).select("feature_id", "kingdom", "phylum", "order", "genus_label")


@query("b11_genus_of", cte("fm") + """SELECT feature_id, CASE WHEN size % 4 = 0 THEN NULL WHEN size % 4 = 1 THEN genus
WHEN size % 4 = 2 THEN 'f' || split_part(name, ' ', 1) ELSE 'f' || split_part(name, ' ', 1) END AS genus FROM fm""".replace(
    "THEN NULL", "THEN 'Unknown'"))
def b11(spark, d):
    stem = F.substring_index("taxonomy", ";", 5)
    tax = (F.when(F.col("size") % 4 == 0, F.lit(None)).when(F.col("size") % 4 == 1, F.col("taxonomy"))
           .when(F.col("size") % 4 == 2, F.concat(stem, F.lit("; g__uncultured"))).otherwise(stem))
    tax = F.when(F.col("size") % 4 == 2, F.concat(stem, F.lit(";g__;Unclassified"))).otherwise(tax)
    fm = fx.feature_meta(spark, d)
    out = fm.select("feature_id", tb.genus_of(tax).alias("genus"), "size", "name")
    last = F.concat(F.lit("f"), F.element_at(F.split("name", " "), 1))
    return out.select("feature_id", F.when(F.col("genus") == "g", last).otherwise(F.col("genus")).alias("genus"))


@query("b12_collapse_taxa", cte("ab", "fm") + """SELECT sample_id, array_to_string(string_split(taxonomy, ';')[1:3], ';') AS feature_id,
SUM(count) AS count FROM ab JOIN fm USING (feature_id) GROUP BY 1, 2""")
def b12(spark, d):
    return tb.collapse_taxa(fx.abundance(spark, d), fx.feature_meta(spark, d), 3)


@query("b13_aggregate_by_rank", cte("ab", "fm") + """SELECT sample_id, phylum AS feature_id, SUM(count) AS count
FROM ab JOIN fm USING (feature_id) WHERE size % 6 <> 0 GROUP BY 1, 2""")
def b13(spark, d):
    fm = fx.feature_meta(spark, d).withColumn("phylum", F.when(F.col("size") % 6 == 0, " nan ").otherwise(F.col("phylum")))
    return tb.aggregate_by_rank(fx.abundance(spark, d), fm, "phylum")


@query("b14_trim_and_merge", cte("ab", "fm") + """SELECT sample_id, SUBSTR(name, 1, 4) AS feature_id, SUM(count) AS count
FROM ab JOIN fm USING (feature_id) GROUP BY 1, 2""")
def b14(spark, d):
    fm = fx.feature_meta(spark, d).withColumn("sequence", F.col("name"))
    return tb.trim_and_merge(fx.abundance(spark, d), fm, 4)


@query("b15_classify_feature_ids", """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'hashes' WHEN p_partkey % 3 = 1 THEN 'taxonomic'
WHEN p_size % 2 = 0 THEN 'raw_sequences' ELSE 'unknown' END AS id_kind, COUNT(*) AS n FROM part GROUP BY 1""")
def b15(spark, d):
    k = F.col("p_partkey")
    ids = (F.when(k % 3 == 0, F.md5("p_name")).when(k % 3 == 1, F.concat(F.lit("d__B;p__"), "p_type"))
           .when(F.col("p_size") % 2 == 0, F.lit("ACGTN")).otherwise(F.lit("other id!")))
    return tb.classify_feature_ids(fx.table(spark, d, "part").select(ids.alias("id")), "id")


@query("b16_clean_names", """WITH b AS (SELECT p_partkey, replace(p_name, ' ', '_') AS base,
ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)
SELECT p_partkey, base || CASE WHEN k = 1 THEN '' ELSE '_' || (k - 1) END AS clean FROM b""")
def b16(spark, d):
    p = fx.table(spark, d, "part").select("p_partkey", F.concat("p_size", F.lit("_["), "p_name", F.lit(".]")).alias("raw"))
    return tb.clean_names(p, "raw", "p_partkey").select("p_partkey", "clean")


@query("b17_filter_amplicon_runs", """SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
AND c_nationkey % 4 <> 0 AND c_nationkey % 7 <> 0""")
def b17(spark, d):
    from meadow.operators.clean import filter_amplicon_runs
    c = fx.table(spark, d, "customer")
    runs = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "amplicon").otherwise("WGS").alias("experiment_library_strategy"),
                    F.when(F.col("c_mktsegment") == "BUILDING", "V4 of 16s genes").alias("experiment_title"),
                    F.when(F.col("c_mktsegment") == "MACHINERY", "16S survey").alias("study_study_title"),
                    F.when(F.col("c_nationkey") % 4 == 0, "Homo sapiens").otherwise("soil metagenome").alias("biosample_scientific_name"),
                    F.when(F.col("c_nationkey") % 7 == 0, "human gut metagenome").alias("sample_scientific_name"))
    return filter_amplicon_runs(runs).select("c_custkey")


@query("b18_subsample_stratified")
def b18(spark, d):
    return tb.subsample_stratified(fx.sample_meta(spark, d), 200, "group").select("sample_id", "group")


MOM = """SELECT feature_id, SUM(count)/(SELECT COUNT(DISTINCT sample_id) FROM ab) AS mean,
SUM(count*count)/(SELECT COUNT(DISTINCT sample_id) FROM ab) - POWER(SUM(count)/(SELECT COUNT(DISTINCT sample_id) FROM ab), 2) AS variance
FROM ab GROUP BY 1"""


@query("b19_top_variance_features", cte("ab", m=MOM) + f"""SELECT feature_id, {q6('mean')} AS mean, {q6('variance')} AS variance
FROM m ORDER BY ROUND(variance, 9) DESC, feature_id LIMIT 50""")
def b19(spark, d):
    return tb.top_features(fx.abundance(spark, d), 50).select("feature_id", r6("mean").alias("mean"), r6("variance").alias("variance"))


@query("b19_top_mean_features", cte("ab", m=MOM) + f"""SELECT feature_id, {q6('mean')} AS mean FROM m
ORDER BY ROUND(mean, 9) DESC, feature_id LIMIT 50""")
def b19b(spark, d):
    return tb.top_features(fx.abundance(spark, d), 50, "mean").select("feature_id", r6("mean").alias("mean"))


@query("b20_drop_outlier_samples", cte("ab", p="SELECT sample_id, SUM(count) AS d, CAST(COUNT(*) AS DOUBLE) AS o FROM ab GROUP BY 1") + """
, g AS (SELECT AVG(d) AS md, STDDEV_POP(d) AS sd, AVG(o) AS mo, STDDEV_POP(o) AS so FROM p)
SELECT ab.* FROM ab JOIN p USING (sample_id), g WHERE ABS((d-md)/sd) <= 1.5 AND ABS((o-mo)/so) <= 1.5""")
def b20(spark, d):
    return tb.drop_outlier_samples(fx.abundance(spark, d), 1.5)


@query("b21_filter_small_classes", cte("meta") + """, c AS (SELECT study, COUNT(*) AS n FROM meta GROUP BY 1), k AS (SELECT COUNT(*) FILTER (n >= 60) AS k, COUNT(*) AS a, COALESCE(SUM(n) FILTER (n >= 60), 0) AS l, SUM(n) AS t FROM c)
SELECT sample_id, study FROM meta JOIN c USING (study), k WHERE n >= 60 OR NOT (k >= 2 AND k < a AND l >= GREATEST(10, FLOOR(t*0.1)) AND 1 - l/t <= 0.8)""")
def b21(spark, d):
    return tb.filter_small_classes(fx.sample_meta(spark, d), "study", 60).select("sample_id", "study")


@query("b22_screen_targets", cte("meta", c="""SELECT 'study' AS column, study AS v, COUNT(*) AS c FROM meta GROUP BY 2
UNION ALL SELECT 'group', "group", COUNT(*) FROM meta GROUP BY 2 UNION ALL SELECT 'value', CAST(value AS VARCHAR), COUNT(*) FROM meta GROUP BY 2
UNION ALL SELECT 'flag', CAST(flag AS VARCHAR), COUNT(*) FROM meta GROUP BY 2""") + """
, p AS (SELECT "column", SUM(c) FILTER (v IS NOT NULL) AS nn, COUNT(v) AS u, MIN(c) FILTER (v IS NOT NULL) AS mc FROM c GROUP BY 1),
r AS (SELECT "column", CASE WHEN nn < 20 THEN 'too few samples' WHEN "column" = 'value' AND u > 10 THEN NULL
WHEN mc < 10 THEN 'small class size' WHEN u > 10 THEN 'too many classes' END AS reason FROM p)
SELECT "column", reason IS NULL AS valid, reason FROM r""")
def b22(spark, d):
    return tb.screen_targets(fx.sample_meta(spark, d), ["study", "group", "value", "flag"])


@query("b23_type_columns", cte("meta") + """, u AS (SELECT COUNT(DISTINCT study) AS us FROM meta)
SELECT 'study' AS column, 'categorical' AS label, CAST(NULL AS VARCHAR) AS reason UNION ALL SELECT 'group', 'categorical', NULL
UNION ALL SELECT 'sample_id', 'numeric', NULL UNION ALL SELECT 'flag', 'categorical', NULL
UNION ALL SELECT 'value', CASE WHEN COUNT(value)/COUNT(*) < 0.9 THEN 'excluded' ELSE 'numeric' END,
 CASE WHEN COUNT(value)/COUNT(*) < 0.9 THEN 'low fullness' END FROM meta
UNION ALL SELECT 'text_number', 'numeric', NULL UNION ALL SELECT 'name', 'excluded', 'high cardinality categorical'""")
def b23(spark, d):
    m = fx.sample_meta(spark, d)
    m = m.withColumn("text_number", (F.col("sample_id") % 7).cast("string")).withColumn("name", F.concat(F.lit("n"), "sample_id"))
    return tb.type_columns(m, ["study", "group", "sample_id", "flag", "value", "text_number", "name"], fullness=0.9)
