"""Traits, functions, ecotypes."""

from pyspark.sql import functions as F

from meadow.operators import traits as tr
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.queries_e_qc import TAXA, taxa
from meadow.plans.queries_g_alpha import rounded
from meadow.plans.registry import q6, query, r6

PATTERNS = [("f1", "economy"), ("f1", "*ring"), ("f2", "blue"), ("f2", "s4*"), ("f3", "*bolt*"), ("f3", "promo")]


def found(spark, d):
    return tr.functions_from_taxonomy(fx.feature_meta(spark, d), spark.createDataFrame(PATTERNS, "function string, pattern string"))


FOUND = """SELECT DISTINCT feature_id, f AS function FROM (SELECT feature_id, UNNEST([lower(phylum), lower(replace(class, '#', '_')), 's' || size, split_part(name, ' ', 1), split_part(name, ' ', 2)]) AS n FROM fm)
JOIN (VALUES ('f1', 'economy'), ('f1', '%ring'), ('f2', 'blue'), ('f2', 's4%'), ('f3', '%bolt%'), ('f3', 'promo')) p(f, p) ON n LIKE p.p"""


@query("l01_functions_from_taxonomy", cte("fm", f=FOUND) + "SELECT feature_id, function FROM f")
def l01(spark, d):
    return found(spark, d)


@query("l01_functions_per_sample", cte("fm", "ab", f=FOUND) + "SELECT sample_id, function, SUM(count) AS count FROM ab JOIN f USING (feature_id) GROUP BY 1, 2")
def l01b(spark, d):
    return tr.functions_per_sample(fx.abundance(spark, d), found(spark, d))


@query("l02_functions_from_genus", cte(tx=TAXA) + """SELECT feature_id, UNNEST(CASE genus WHEN 'Pseudomonas' THEN ['heavy_metal_efflux', 'nitrate_reduction', 'biofilm_formation'] WHEN 'Geobacter' THEN ['uranium_reduction']
WHEN 'Bacillus' THEN ['arsenic_metabolism', 'nitrate_reduction', 'biofilm_formation'] END) AS function, CAST(0.5 AS DOUBLE) AS confidence FROM tx WHERE genus IN ('Pseudomonas', 'Geobacter', 'Bacillus')""")
def l02(spark, d):
    return tr.functions_from_genus(taxa(spark, d))


WORDS = {"short": ["the", "and", "in", "of"], "rare": ["zz", "qq", "the"]}


@query("l02_traits_from_text", f"""WITH s AS (SELECT doc_id, LEAST(1, ({' + '.join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in WORDS['short'])})*0.2) AS a, LEAST(1, ({' + '.join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in WORDS['rare'])})*0.2) AS b FROM documents)
SELECT doc_id, 'short' AS trait, {q6('LEAST(a, 0.7)')} AS confidence FROM s WHERE a >= 0.4 UNION ALL SELECT doc_id, 'rare', {q6('b')} FROM s WHERE b >= 0.4""")
def l02b(spark, d):
    return rounded(tr.traits_from_text(fx.table(spark, d, "documents"), "doc_id", "text", WORDS, {"short": 0.7}, 0.4))


HITS = "SELECT l_orderkey AS q, l_suppkey AS s, 95 + l_tax*50 + l_discount*10 AS pident, CAST(l_extendedprice AS DOUBLE) AS bit, CAST(l_quantity AS BIGINT) + 30 AS alnlen FROM lineitem"


def hits(spark, d):
    return fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("qseqid"), F.col("l_suppkey").alias("sseqid"), (F.lit(95) + F.col("l_tax") * 50 + F.col("l_discount") * 10).alias("pident"),
                                                 F.col("l_extendedprice").alias("bitscore"), (F.col("l_quantity").cast("long") + 30).alias("alnlen"))


@query("l03_filter_hits", cte(h=HITS) + "SELECT q AS qseqid, s AS sseqid, alnlen FROM h WHERE pident >= 97 AND alnlen >= 50")
def l03(spark, d):
    return tr.filter_hits(hits(spark, d), 0.97, 50).select("qseqid", "sseqid", "alnlen")


@query("l03_best_hit", cte(h=HITS, k="SELECT *, ROW_NUMBER() OVER (PARTITION BY q ORDER BY bit DESC, s) AS k FROM h WHERE pident >= 97") + "SELECT q AS qseqid, s AS sseqid, CAST(1 AS DOUBLE) AS weight FROM k WHERE k = 1")
def l03b(spark, d):
    return tr.best_hit(hits(spark, d), 97)


PROP = "SELECT q, s, w/SUM(w) OVER (PARTITION BY q) AS w FROM (SELECT q, s, SUM(bit) AS w FROM h WHERE pident >= 97 GROUP BY 1, 2)"


@query("l03_proportional_hits", cte(h=HITS, p=PROP) + f"SELECT q AS qseqid, s AS sseqid, {q6('w')} AS weight FROM p")
def l03c(spark, d):
    return rounded(tr.proportional_hits(hits(spark, d), 97))


def genes(spark, d):
    li = fx.table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("mag_id"), F.when(F.col("l_partkey") % 3 != 0, F.concat(F.lit("K"), (F.col("l_partkey") % 40).cast("string"))).alias("ko_id"))


KO = "SELECT DISTINCT l_suppkey AS mag, 'K' || (l_partkey % 40) AS ko FROM lineitem"


def kos(spark, d):
    return tr.mag_ko(genes(spark, d).join(fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("mag_id")), "mag_id"))


@query("l04_mag_ko", "SELECT DISTINCT l_suppkey AS mag_id, 'K' || (l_partkey % 40) AS ko_id FROM lineitem WHERE l_partkey % 3 <> 0")
def l04(spark, d):
    return tr.mag_ko(genes(spark, d))


def site_ko(spark, d):
    """customer x KO counts: features are parts, genomes suppliers, KOs follow the part number."""
    li = fx.table(spark, d, "lineitem")
    w = li.select(F.col("l_partkey").alias("qseqid"), F.col("l_suppkey").alias("sseqid"), F.lit(100.0).alias("pident"), F.col("l_extendedprice").alias("bitscore"))
    g = li.select(F.col("l_suppkey").alias("mag_id"), F.concat(F.lit("K"), (F.col("l_partkey") % 40).cast("string")).alias("ko_id"))
    return tr.sample_ko(fx.abundance_site(spark, d), tr.best_hit(w), tr.mag_ko(g))


BEST = "SELECT l_partkey AS f, l_suppkey AS mag FROM (SELECT l_partkey, l_suppkey, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_suppkey) AS k FROM lineitem) WHERE k = 1"
SKO = "SELECT sample_id, ko, SUM(count) AS count FROM abs_ JOIN best ON f = feature_id JOIN ko USING (mag) GROUP BY 1, 2"


@query("l04_sample_ko", cte("abs_", best=BEST, ko=KO, s=SKO) + "SELECT sample_id, ko AS ko_id, count FROM s")
def l04b(spark, d):
    return site_ko(spark, d)


@query("l04_sample_ko_clr", cte("abs_", best=BEST, ko=KO, s=SKO) + f""", p AS (SELECT COUNT(DISTINCT ko) AS p FROM s), m AS (SELECT sample_id, (SUM(LN(GREATEST(count, 0.5))) + (p - COUNT(*))*LN(0.5))/p AS m FROM s, p GROUP BY 1, p)
SELECT sample_id, ko AS ko_id, {q6('LN(GREATEST(count, 0.5)) - m')} AS clr, {q6('LN(0.5) - m')} AS zero_clr FROM s JOIN m USING (sample_id)""")
def l04c(spark, d):
    return rounded(tr.sample_ko_clr(site_ko(spark, d)))


GROUPS = [("copper", "K1"), ("copper", "K2"), ("copper", "K5"), ("zinc", "K7"), ("zinc", "K11"), ("zinc", "K999")]
PHEN = """SELECT sample_id, ph, SUM(count)/k AS score FROM s JOIN (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in GROUPS) + """) g(ph, ko) USING (ko) JOIN (SELECT ph, COUNT(DISTINCT ko) AS k FROM s JOIN (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in GROUPS) + """) g(ph, ko) USING (ko) GROUP BY 1) USING (ph) GROUP BY 1, 2, k"""


def phenotypes(spark, d):
    return tr.phenotype_scores(site_ko(spark, d), spark.createDataFrame(GROUPS, "phenotype string, ko_id string"))


@query("l05_phenotype_scores", cte("abs_", best=BEST, ko=KO, s=SKO, ph=PHEN) + f"SELECT sample_id, ph AS phenotype, {q6('score')} AS score FROM ph")
def l05(spark, d):
    return rounded(phenotypes(spark, d))


@query("l05_score_correlations", cte("abs_", "sites", best=BEST, ko=KO, s=SKO, ph=PHEN) + f""", j AS (SELECT ph, ROUND(score, 6) AS x, value AS y FROM ph JOIN sites USING (sample_id)),
r AS (SELECT ph, RANK() OVER (PARTITION BY ph ORDER BY x) + (COUNT(*) OVER (PARTITION BY ph, x) - 1)/2 AS a, RANK() OVER (PARTITION BY ph ORDER BY y) + (COUNT(*) OVER (PARTITION BY ph, y) - 1)/2 AS b FROM j)
SELECT ph AS phenotype, 'value' AS measure, {q6('CORR(a, b)')} AS rho, COUNT(*) AS n FROM r GROUP BY 1""")
def l05b(spark, d):
    m = fx.sites(spark, d).select("sample_id", F.lit("value").alias("measure"), "value")
    s = phenotypes(spark, d).withColumn("score", F.round("score", 6))
    return rounded(tr.score_correlations(s, m).drop("p_value"))


def expression(spark, d):
    ko = site_ko(spark, d).select("sample_id", "ko_id", F.col("count").alias("value"))
    other = ko.select("sample_id", "ko_id", (F.col("value") * 0.5 + F.length("sample_id") * 10).alias("value"))
    return ko, other


EXPR = "SELECT sample_id, ko, count AS p, count*0.5 + LENGTH(sample_id)*10 AS e FROM s"


@query("l06_expression_agreement", cte("abs_", best=BEST, ko=KO, s=SKO, x=EXPR) + f""", l AS (SELECT ko, LOG2(p+1) AS p, LOG2(e+1) AS e FROM x), r AS (SELECT *, RANK() OVER (PARTITION BY ko ORDER BY p) + (COUNT(*) OVER (PARTITION BY ko, p) - 1)/2 AS a, RANK() OVER (PARTITION BY ko ORDER BY e) + (COUNT(*) OVER (PARTITION BY ko, e) - 1)/2 AS b FROM l)
SELECT ko AS ko_id, {q6('CORR(a, b)')} AS rho, {q6('1 - SUM((e-p)*(e-p))/(VAR_POP(e)*COUNT(*))')} AS r_squared, COUNT(*) AS n FROM r GROUP BY 1 HAVING COUNT(*) >= 3""")
def l06(spark, d):
    return rounded(tr.expression_agreement(*expression(spark, d)))


@query("l06_expression_outliers", cte("abs_", best=BEST, ko=KO, s=SKO, x=EXPR) + f""", q AS (SELECT sample_id, ko, POWER(p - e, 2) AS q FROM x), m AS (SELECT AVG(q) AS m, STDDEV_POP(q) AS s FROM q) SELECT sample_id, ko AS ko_id, {q6('(q - m.m)/m.s')} AS z FROM q, m WHERE ABS((q - m.m)/m.s) > 2""")
def l06b(spark, d):
    return rounded(tr.expression_outliers(*expression(spark, d)))


@query("l07_trait_by_taxon", f"SELECT p_type AS taxon, CAST(COUNT(*) FILTER (p_size > 30) AS BIGINT) AS trait_count, {q6('AVG(CASE WHEN p_size > 30 THEN 1 ELSE 0 END)')} AS trait_prevalence FROM part GROUP BY 1")
def l07(spark, d):
    fm = fx.feature_meta(spark, d)
    return rounded(tr.trait_by_taxon(fm.select("feature_id", (F.col("size") > 30).cast("int").alias("value")), fm, "phylum"))


def kinds(spark, d):
    """Distinct (type, brand, size class) kinds as features with a mean size as trait."""
    p = fx.table(spark, d, "part")
    return p.groupBy("p_type", "p_brand").agg(F.avg("p_size").alias("value")).select(F.concat_ws("|", "p_type", "p_brand").alias("feature_id"), F.lit("x").alias("kingdom"), F.col("p_type").alias("phylum"), F.col("p_brand").alias("class"), "value")


KINDS = "SELECT p_type || '|' || p_brand AS f, p_type AS t, p_brand AS b, AVG(p_size) AS v FROM part GROUP BY 1, 2, 3"
TD = "SELECT x.f AS a, y.f AS b, CASE WHEN x.t <> y.t THEN 5 WHEN x.b <> y.b THEN 4 ELSE 0 END AS d, ABS(x.v - y.v) AS e FROM k x JOIN k y ON x.f < y.f"


@query("l08_taxonomic_distance", cte(k=KINDS, td=TD) + "SELECT a, b, CAST(d AS DOUBLE) AS d FROM td")
def l08(spark, d):
    return tr.taxonomic_distance(kinds(spark, d), ["kingdom", "phylum", "class"])


@query("l09_trait_signal", cte(k=KINDS, td=TD) + f"SELECT {q6('GREATEST(0, LEAST(1, CORR(d, e)))')} AS signal, COUNT(*) AS n_pairs FROM td WHERE d > 0")
def l09(spark, d):
    k = kinds(spark, d)
    return rounded(tr.clade_signal(k, k, ["kingdom", "phylum", "class"], reps=0))


@query("l09_trait_signal_p")
def l09b(spark, d):
    k = kinds(spark, d)
    return tr.clade_signal(k, k, ["kingdom", "phylum", "class"], reps=49)


@query("l10_trait_environment")
def l10(spark, d):
    f = tr.functions_per_sample(fx.abundance_site(spark, d), found(spark, d)).select("sample_id", F.col("function").alias("trait"), F.col("count").alias("score"))
    s = fx.sites(spark, d)
    m = s.select("sample_id", F.explode(F.array(F.struct(F.lit("value").alias("measure"), F.col("value").alias("value")), F.struct(F.lit("lat").alias("measure"), F.col("lat").cast("double").alias("value")))).alias("m")).select("sample_id", "m.measure", "m.value")
    return tr.trait_environment(f, m)[1]


@query("l11_niche_breadth", cte("ab", "meta") + f""", v AS (SELECT feature_id, 's' AS c, study AS v, CAST(COUNT(*) AS DOUBLE) AS n FROM ab JOIN meta USING (sample_id) GROUP BY 1, 3 UNION ALL SELECT feature_id, 'g', "group", COUNT(*) FROM ab JOIN meta USING (sample_id) GROUP BY 1, 3),
h AS (SELECT feature_id, c, CASE WHEN COUNT(*) > 1 THEN (LN(SUM(n)) - SUM(n*LN(n))/SUM(n))/LN(COUNT(*)) ELSE 0 END AS h FROM v GROUP BY 1, 2), p AS (SELECT feature_id, COUNT(*) AS p FROM ab GROUP BY 1)
SELECT feature_id, {q6('CASE WHEN p < 2 THEN 0.5 ELSE AVG(h) END')} AS niche_breadth FROM h JOIN p USING (feature_id) GROUP BY 1, p""")
def l11(spark, d):
    return rounded(tr.niche_breadth(fx.abundance(spark, d), fx.sample_meta(spark, d), ["study", "group"]))


@query("l12_ecotypes")
def l12(spark, d):
    return tr.ecotypes(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), ["balance", "lat", "lon"], 4)[0]


@query("l13_ecotype_features", cte("ab") + f""", p AS (SELECT feature_id FROM ab GROUP BY 1 HAVING COUNT(*)/(SELECT COUNT(DISTINCT sample_id) FROM ab) >= 0.02)
SELECT sample_id, feature_id || '_ecotype' || e AS ecotype_feature, {q6('count*0.25*(1 - (feature_id % 7)/CAST(10 AS DOUBLE))')} AS value FROM ab JOIN p USING (feature_id), (SELECT UNNEST([0, 1]) AS e)""")
def l13(spark, d):
    p = fx.table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ecotype"), F.lit(0.25).alias("prevalence"), ((F.col("p_partkey") % 7) / 10.0).alias("niche_breadth"))
    return rounded(tr.ecotype_features(fx.abundance(spark, d), p, 0.02))


@query("l14_abundance_boundaries", cte("ab") + f"SELECT feature_id, {q6('CASE WHEN COUNT(*) < 4 THEN MIN(count) ELSE quantile_cont(count, 0.25) END')} AS lower, {q6('CASE WHEN COUNT(*) < 4 THEN MAX(count) ELSE quantile_cont(count, 0.75) END')} AS upper FROM ab GROUP BY 1")
def l14(spark, d):
    return rounded(tr.abundance_boundaries(fx.abundance(spark, d)))


@query("l15_pathway_blocks", f"""WITH p AS (SELECT l_suppkey AS s, CASE l_partkey % 5 WHEN 0 THEN 'sugar cycle ' WHEN 1 THEN 'Nitrate uptake ' WHEN 2 THEN 'toluene degradation ' WHEN 3 THEN 'oxidative stress ' ELSE 'other ' END || (l_partkey % 20) AS w, SUM(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, CASE WHEN w LIKE 'sugar%' THEN 'Carbon Metabolism' WHEN w LIKE 'Nitrate%' THEN 'Nitrogen Cycling' WHEN w LIKE 'toluene%' THEN 'Sulfur/Xenobiotics' WHEN w LIKE 'oxidative%' THEN 'Stress/Defense' END AS b FROM p)
SELECT s AS sample_id, b AS block, {q6('SUM(v)')} AS total, {q6('SUM(v)/4')} AS mean FROM b WHERE b IS NOT NULL GROUP BY 1, 2""")
def l15(spark, d):
    k = F.col("l_partkey")
    name = F.concat(F.get(F.array(*[F.lit(x) for x in ("sugar cycle ", "Nitrate uptake ", "toluene degradation ", "oxidative stress ", "other ")]), (k % 5).cast("int")), (k % 20).cast("string"))
    p = fx.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("sample_id"), name.alias("pathway")).agg(F.sum("l_quantity").alias("value"))
    return rounded(tr.pathway_blocks(p))
