"""Metadata cleaning."""

from pyspark.sql import functions as F

from meadow.operators import clean as cl
from meadow.operators.kernels import spread
from meadow.plans import fixtures as fx
from meadow.plans.registry import q6, query, r6

def K():
    return F.col("c_custkey")



def customers(spark, d):
    return fx.table(spark, d, "customer")


def text(c):
    return F.col(c).cast("string")


@query("c01_harmonize", """SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal AS VARCHAR) END,
CAST(c_nationkey AS VARCHAR)) AS temperature, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS host_sex, c_name FROM customer""")
def c01(spark, d):
    df = customers(spark, d).select(
        "c_custkey", F.when(K() % 2 == 0, text("c_acctbal")).alias("temp_c"), F.col("c_nationkey").alias("Temperatur"),
        F.when(K() % 3 == 0, F.col("c_mktsegment")).alias("gender"), "c_name", F.when(K() < 0, K()).alias("empty"))
    return cl.harmonize(df, core=["c_custkey"])


@query("c02_drop_columns", "SELECT c_custkey, c_name FROM customer")
def c02(spark, d):
    df = customers(spark, d).select("c_custkey", "c_name", F.upper("c_name").alias("c_name"), "c_acctbal")
    return cl.drop_columns(df, ["c_acctbal"])


@query("c03_clean_sample_ids", """WITH t AS (SELECT o_orderkey, o_totalprice, LOWER(TRIM(o_orderpriority || (o_custkey % 50))) AS id FROM orders
WHERE o_custkey % 9 <> 0) SELECT id AS "#sampleid", MIN(o_orderkey) AS o_orderkey, ARG_MIN(o_totalprice, o_orderkey) AS o_totalprice
FROM t GROUP BY 1""")
def c03(spark, d):
    o = fx.table(spark, d, "orders")
    key = F.concat(F.lit("  "), "o_orderpriority", (F.col("o_custkey") % 50).cast("string"), F.lit(" "))
    df = o.select(F.when(F.col("o_custkey") % 9 == 0, F.lit("  ")).otherwise(key).alias("sample_id"), "o_orderkey", "o_totalprice")
    return cl.clean_sample_ids(df, "o_orderkey")


def MIX():
    return F.when(K() % 5 == 0, F.lit("n.d.")).when(K() % 5 == 1, F.concat(F.lit(" "), text("c_acctbal"))).otherwise(text("c_nationkey"))

MIX_SQL = "CASE WHEN c_custkey % 5 = 0 THEN 'n.d.' WHEN c_custkey % 5 = 1 THEN CAST(c_acctbal AS VARCHAR) ELSE CAST(c_nationkey AS VARCHAR) END"


@query("c04_force_numeric", f"SELECT c_custkey, TRY_CAST({MIX_SQL} AS DOUBLE) AS v FROM customer")
def c04(spark, d):
    return cl.force_numeric(customers(spark, d).select("c_custkey", MIX().alias("v")), ["v"])


@query("c04_numeric_losses", "SELECT 'v' AS \"column\", COUNT(*) FILTER (c_custkey % 5 = 0) AS lost FROM customer")
def c04b(spark, d):
    return cl.numeric_losses(customers(spark, d).select("c_custkey", MIX().alias("v")), ["v"])


@query("c05_map_values", """SELECT c_custkey, CASE LOWER(c_mktsegment) WHEN 'building' THEN 'construction' WHEN 'machinery' THEN 'machines'
ELSE LOWER(c_mktsegment) END AS segment FROM customer""")
def c05(spark, d):
    df = customers(spark, d).select("c_custkey", F.concat(F.lit(" "), "c_mktsegment").alias("segment"))
    return cl.map_values(df, {"segment": {"building": "construction", "machinery": "machines"}})


@query("c05_target_gene", """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '16S' WHEN 1 THEN '18S' WHEN 2 THEN NULL WHEN 3 THEN 'ITS'
ELSE 'rpoB' END AS gene FROM customer""")
def c05b(spark, d):
    g = F.get(F.array(*[F.lit(x) for x in ("16s rrna", "18S rRNA", "nan", "ITS2", " rpoB ")]), (K() % 5).cast("int"))
    return customers(spark, d).select("c_custkey", cl.target_gene(g).alias("gene"))


@query("c06_drop_habitats", "SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey % 11 <> 0")
def c06(spark, d):
    h = F.when(F.col("c_mktsegment") == "BUILDING", "Animal corpus").when(K() % 11 == 0, "animal distal gut").when(K() % 7 == 0, F.lit(None)).otherwise("soil")
    return cl.drop_habitats(customers(spark, d).select("c_custkey", h.alias("empo_3"))).select("c_custkey")


@query("c07_standardize_units", f"""SELECT c_custkey, {q6('CASE c_custkey % 3 WHEN 0 THEN c_acctbal WHEN 1 THEN (c_acctbal - 32)*5/9 ELSE c_acctbal - 273.15 END')} AS temp_celsius,
{q6('CASE WHEN c_custkey % 2 = 0 THEN c_nationkey*0.3048 ELSE c_nationkey END')} AS depth_meters FROM customer""")
def c07(spark, d):
    v = lambda n, i: F.when(K() % 3 == i, F.col("c_acctbal")).cast("string").alias(n)
    df = customers(spark, d).select("c_custkey", v("temp_c", 0), v("temp_f", 1), v("temp_k", 2), F.col("c_nationkey").alias("depth_m"),
                                    F.when(K() % 2 == 0, F.col("c_nationkey")).alias("depth_ft"))
    return cl.standardize_units(df).select("c_custkey", r6("temp_celsius").alias("temp_celsius"), r6("depth_meters").alias("depth_meters"))


@query("c08_collapse_suffixes", """SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_name END, c_mktsegment) AS title,
c_acctbal AS balance FROM customer""")
def c08(spark, d):
    df = customers(spark, d).select("c_custkey", F.when(K() % 2 == 0, F.col("c_name")).alias("title"),
                                    F.col("c_mktsegment").alias("title_sample"), F.col("c_acctbal").alias("balance_sample"))
    return cl.collapse_suffixes(df, "_sample")


@query("c09_merge_ph", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey / CAST(2 AS DOUBLE) WHEN c_custkey % 3 = 1 THEN c_acctbal END AS ph,
c_name AS phylum FROM customer""")
def c09(spark, d):
    df = customers(spark, d).select("c_custkey", F.when(K() % 3 == 1, text("c_acctbal")).otherwise("bad").alias("ph_level"),
                                    F.when(K() % 3 == 0, F.col("c_nationkey") / 2.0).alias("ph"), F.col("c_name").alias("phylum"))
    return cl.merge_ph(df)


def D():
    return F.date_add(F.lit("2019-01-01"), (K() % 700).cast("int"))

DSQL = "(DATE '2019-01-01' + CAST(c_custkey % 700 AS INTEGER))"


@query("c10_standardize_dates", f"""SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'not known' WHEN c_custkey % 4 = 2 THEN strftime({DSQL}, '%Y-01-01')
ELSE strftime({DSQL}, '%Y-%m-%d') END AS collection_date, 'x' || c_custkey AS note_time FROM customer""")
def c10(spark, d):
    s = (F.when(K() % 4 == 0, F.date_format(D(), "yyyy-MM-dd")).when(K() % 4 == 1, F.date_format(D(), "MM/dd/yyyy"))
         .when(K() % 4 == 2, F.date_format(D(), "yyyy")).otherwise("not known"))
    df = customers(spark, d).select("c_custkey", s.alias("collection_date"), F.concat(F.lit("x"), "c_custkey").alias("note_time"))
    return cl.standardize_dates(df)


@query("c10_archive_dates", f"""SELECT c_custkey, CASE WHEN c_custkey % 8 = 7 THEN 'autumn' WHEN c_custkey % 8 = 6 THEN strftime({DSQL}, '%Y-%m-01') ELSE strftime({DSQL}, '%Y-%m-%d') END AS collection_date FROM customer""")
def c10_archive(spark, d):
    """Layouts of archive metadata: zones, minutes, fractions, month names; text that is no date stays."""
    iso, k = F.date_format(D(), "yyyy-MM-dd"), K() % 8
    s = (F.when(k == 0, F.concat(iso, F.lit("T10:00:00Z"))).when(k == 1, F.concat(iso, F.lit("T10:00"))).when(k == 2, F.concat(iso, F.lit(" 10:00:00.5")))
         .when(k == 3, F.date_format(D(), "dd-MMM-yyyy")).when(k == 4, F.date_format(D(), "d MMMM yyyy")).when(k == 5, F.concat(iso, F.lit("T10:00:00+02:00")))
         .when(k == 6, F.date_format(D(), "MMM-yyyy")).otherwise("autumn"))
    return cl.standardize_dates(customers(spark, d).select("c_custkey", s.alias("collection_date")))


@query("c11_parse_date_precision", f"""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN strftime({DSQL}, '%Y-%m-%d') WHEN 1 THEN strftime({DSQL}, '%Y-%m-%d')
WHEN 2 THEN strftime({DSQL}, '%Y-%m') WHEN 3 THEN strftime({DSQL}, '%Y') END AS value,
CASE c_custkey % 5 WHEN 0 THEN 'day' WHEN 1 THEN 'day' WHEN 2 THEN 'month' WHEN 3 THEN 'year' ELSE 'unknown' END AS precision FROM customer""")
def c11(spark, d):
    s = (F.when(K() % 5 == 0, F.date_format(D(), "yyyy/MM/dd")).when(K() % 5 == 1, F.date_format(D(), "MM-dd-yyyy"))
         .when(K() % 5 == 2, F.date_format(D(), " yyyy-MM")).when(K() % 5 == 3, F.date_format(D(), "yyyy")).otherwise("2020-13-45"))
    v, p = cl.parse_date_precision(s)
    return customers(spark, d).select("c_custkey", v.alias("value"), p.alias("precision"))


@query("c12_extract_coordinates", f"""WITH t AS (SELECT c_custkey, (c_custkey % 170 - 85) + 0.5 AS y, (c_custkey % 340 - 170) + 0.25 AS x FROM customer)
SELECT c_custkey, {q6('y')} AS lat, {q6('x')} AS lon FROM t WHERE c_custkey % 6 <> 4""")
def c12(spark, d):
    y, x = (K() % 170 - 85) + 0.5, (K() % 340 - 170) + 0.25
    txt = lambda v: F.abs(v).cast("string")
    ns, ew = F.when(y < 0, "S").otherwise("N"), F.when(x < 0, "W").otherwise("E")
    dm = lambda v, letter: F.concat(F.floor(F.abs(v)).cast("string"), F.lit("°"), ((F.abs(v) - F.floor(F.abs(v))) * 60).cast("int").cast("string"), F.lit("' "), letter)
    loc = (F.when(K() % 6 == 1, F.concat(txt(y), F.lit(" "), ns, F.lit(" "), txt(x), F.lit(" "), ew))
           .when(K() % 6 == 2, F.concat(y.cast("string"), F.lit(", "), x.cast("string")))
           .when(K() % 6 == 3, F.concat(dm(y, ns), F.lit(" "), dm(x, ew)))
           .when(K() % 6 == 4, F.lit("somewhere")))
    df = customers(spark, d).select("c_custkey", F.when(K() % 6 == 0, y.cast("string")).alias("lat"), F.when(K() % 6 == 0, x).alias("longitude"),
                                    F.when(K() % 6 == 5, F.concat(y.cast("string"), F.lit(","), x.cast("string"))).alias("lat_lon"), loc.alias("location"))
    return cl.extract_coordinates(df).select("c_custkey", r6("lat").alias("lat"), r6("lon").alias("lon"))


@query("c13_clamp_coordinates", f"""WITH t AS (SELECT c_custkey, c_acctbal/20 AS y, c_acctbal/10 AS x FROM customer)
SELECT c_custkey, {q6('LEAST(GREATEST(y, -90), 90)')} AS lat, {q6('LEAST(GREATEST(x, -180), 180)')} AS lon, y NOT BETWEEN -90 AND 90 OR x NOT BETWEEN -180 AND 180 AS clipped FROM t""")
def c13(spark, d):
    df = customers(spark, d).select("c_custkey", (F.col("c_acctbal") / 20).alias("lat"), (F.col("c_acctbal") / 10).alias("lon"))
    ok, bad = cl.clamp_coordinates(df)
    return (ok.join(bad.select("c_custkey", F.lit(True).alias("b")), "c_custkey", "left")
            .select("c_custkey", r6("lat").alias("lat"), r6("lon").alias("lon"), F.coalesce("b", F.lit(False)).alias("clipped")))


def _terms_sql(terms):
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'''contains(t, '{w}')''' for w in ws)} THEN '{k}'" for k, ws in terms.items()) + " ELSE 'Unknown' END"


@query("c14_infer_terms", "WITH x AS (SELECT doc_id, LOWER(text || ' ' || source) AS t FROM documents) SELECT doc_id, "
       + ", ".join(f"{_terms_sql(t)} AS {c}" for c, t in cl.ONTOLOGY.items()) + " FROM x")
def c14(spark, d):
    docs = spread(fx.table(spark, d, "documents").select("doc_id", "text", "source"))
    return cl.infer_terms(docs, F.concat_ws(" ", "text", "source")).drop("text", "source")


@query("c15_clean_numeric_text", """SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS plain,
CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 1000 + c_nationkey + CAST(0.5 AS DOUBLE) END AS with_unit, c_mktsegment AS words, CAST(c_custkey AS VARCHAR) AS my_id FROM customer""")
def c15(spark, d):
    df = customers(spark, d).select(
        "c_custkey", F.when(K() % 20 == 0, "missing").otherwise(text("c_nationkey")).alias("plain"),
        F.when(K() % 10 == 0, "approx").otherwise(F.concat(F.lit("1,0"), F.lpad(text("c_nationkey"), 2, "0"), F.lit(".5 cm"))).alias("with_unit"),
        F.col("c_mktsegment").alias("words"), text("c_custkey").alias("my_id"))
    return cl.clean_numeric_text(df, ["plain", "with_unit", "words", "my_id"])


@query("c16_coalesce_variants", """SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN 'a' END, CASE WHEN c_custkey % 3 = 0 THEN 'b' END, c_mktsegment) AS depth FROM customer""")
def c16(spark, d):
    df = customers(spark, d).select("c_custkey", F.when(K() % 2 == 0, "a").alias("depth"), F.when(K() % 3 == 0, "b").alias("depth_sample"),
                                    F.col("c_mktsegment").alias("depth_ena"), F.when(K() < 0, "x").alias("hollow"))
    return cl.coalesce_variants(df, ["depth", "elevation"])


@query("c16_coalesce_prefixes", """SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN 'run' END, c_mktsegment) AS title, c_name AS run_accession FROM customer""")
def c16b(spark, d):
    df = customers(spark, d).select("c_custkey", F.when(K() % 2 == 0, "run").alias("run_title"), F.col("c_mktsegment").alias("study_title"),
                                    F.col("c_name").alias("run_accession"))
    return cl.coalesce_prefixes(df)


@query("c17_unpack_nested", """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 1 THEN CAST(c_nationkey AS VARCHAR) WHEN 2 THEN NULL
WHEN 3 THEN c_mktsegment ELSE '[''a'', ''b'']' END AS v FROM customer""")
def c17(spark, d):
    s = (F.when(K() % 5 == 0, F.concat(F.lit("['"), "c_mktsegment", F.lit("']"))).when(K() % 5 == 1, F.concat(F.lit("{'value': "), "c_nationkey", F.lit("}")))
         .when(K() % 5 == 2, F.lit("[]")).when(K() % 5 == 3, F.concat(F.lit("[{'value': '"), "c_mktsegment", F.lit("'}]"))).otherwise("['a', 'b']"))
    return customers(spark, d).select("c_custkey", cl.unpack_nested(s).alias("v"))


@query("c18_aggregate_runs", f"""SELECT o_custkey, array_to_string(list_sort(list_distinct(list(o_orderpriority))), '|') AS priorities, {q6('AVG(o_totalprice)')} AS price,
ARG_MIN(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1""")
def c18(spark, d):
    o = fx.table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("priorities"),
                                            F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    out = cl.aggregate_runs(o, "o_custkey", "o_orderkey", ["priorities"], ["price"])
    return out.select("o_custkey", F.concat_ws("|", "priorities").alias("priorities"), r6("price").alias("price"), "status")


MERGES = """
c AS (SELECT value, COUNT(*) AS n FROM v GROUP BY 1),
p AS (SELECT a.value, b.value AS target, b.n FROM c a JOIN c b ON a.value <> b.value AND (b.n > a.n OR (b.n = a.n AND b.value < a.value))
 AND 1 - levenshtein(a.value, b.value) / GREATEST(LENGTH(a.value), LENGTH(b.value)) >= 0.9)
SELECT 'segment' AS "column", value, (ARRAY_AGG(target ORDER BY n DESC, target))[1] AS target FROM p GROUP BY value"""


@query("c19_suggest_value_merges", """WITH v AS (SELECT LOWER(c_mktsegment) || CASE WHEN c_custkey % 10 = 0 THEN ' groupz' ELSE ' groups' END AS value FROM customer),""" + MERGES)
def c19(spark, d):
    v = F.concat("c_mktsegment", F.when(K() % 10 == 0, " GROUPZ").otherwise(" GROUPS"))
    return cl.suggest_value_merges(customers(spark, d).select(v.alias("segment")), ["segment"])


@query("c19_case", """WITH v AS (SELECT LOWER(c_mktsegment) || ' site ' || (c_custkey % 150) AS value FROM customer),""" + MERGES)
def c19_case(spark, d):
    """Mixed case, and more values than any cap on them would let through."""
    v = F.concat("c_mktsegment", F.lit(" Site "), (K() % 150).cast("string"))
    v = F.when(K() % 3 == 0, F.lower(v)).when(K() % 3 == 1, F.upper(v)).otherwise(v)
    return cl.suggest_value_merges(customers(spark, d).select(v.alias("segment")), ["segment"])


ACC = [("SAMEA1234567", "SAMEA", 1.0), (" samn123 ", "SAMN", 0.7), ("SRR123456", "SRR", 1.0), ("PRJNA9", "PRJNA", 1.0), ("ERR1", "ERR", 0.7),
       ("SRR123456.SAMN123456", "COMPOUND", 1.0), ("xyz", None, 0.0)]


@query("c20_classify_accessions", "SELECT c_custkey, CASE c_custkey % 7 " + " ".join(
    f"WHEN {i} THEN " + (f"'{t}'" if t else "NULL") for i, (_, t, _) in enumerate(ACC)) + " END AS kind, CASE c_custkey % 7 " + " ".join(
    f"WHEN {i} THEN CAST({c} AS DOUBLE)" for i, (_, _, c) in enumerate(ACC)) + " END AS confidence FROM customer")
def c20(spark, d):
    a = F.get(F.array(*[F.lit(x) for x, _, _ in ACC]), (K() % 7).cast("int"))
    kind, conf = cl.classify_accession(a)
    return customers(spark, d).select("c_custkey", kind.alias("kind"), conf.cast("double").alias("confidence"))


@query("c21_record_type", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'run' WHEN c_custkey % 3 = 1 THEN 'experiment' ELSE 'biosample' END AS kind FROM customer""")
def c21(spark, d):
    return customers(spark, d).select("c_custkey", cl.record_type(F.when(K() % 3 == 0, "srr1").otherwise("x"), F.when(K() % 3 == 1, "ERX5")).alias("kind"))


@query("c22_flags_and_defaults", """SELECT c_custkey, c_custkey % 4 = 0 AS status, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_name END, 'N/A') AS run_acc, 'N/A' AS study_acc
FROM customer WHERE NOT (c_nationkey = 0 AND c_custkey % 3 = 0)""")
def c22(spark, d):
    df = customers(spark, d).select("c_custkey", F.when(K() % 4 == 0, "Yes").otherwise("no").alias("status"), F.when(K() % 2 == 0, F.col("c_name")).alias("run_acc"),
                                    F.col("c_nationkey").alias("lat"), (K() % 3).alias("lon"))
    return cl.flags_and_defaults(df, "status", ["run_acc", "study_acc"]).drop("lat", "lon")


@query("c23_standard_facility_type", """SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'Nuclear Power Plant' WHEN 1 THEN 'Salt Mine' WHEN 2 THEN 'Uranium Mine'
WHEN 3 THEN 'Gold Mine' WHEN 4 THEN 'Unknown' ELSE 'odd' END AS kind FROM supplier""")
def c23(spark, d):
    i = (F.col("s_suppkey") % 6).cast("int")
    pick = lambda *v: F.get(F.array(*[F.lit(x) for x in v]), i)
    k = cl.standard_facility_type(pick("BWR type", "salt works", None, "", "nan", "odd"), pick("x", "gold", "y", "Old GOLD pit", "z", "w"),
                                  pick("a", "WNA", "mindat", "PRIS", "a", "a"))
    return fx.table(spark, d, "supplier").select("s_suppkey", k.alias("kind"))


PI = "3.141592653589793"


@query("c24_day_length_and_season", f"""WITH t AS (SELECT c_custkey, c_custkey % 160 - 80 AS lat, {DSQL} AS dt FROM customer),
u AS (SELECT *, EXTRACT(doy FROM dt) AS doy FROM t),
v AS (SELECT *, LEAST(GREATEST(1 - TAN(RADIANS(lat)) * TAN(RADIANS(23.44 * COS((doy - 172) * 2 * {PI} / 365))), 0), 2) AS m,
CASE WHEN lat < 0 THEN fmod(doy + 182.5, 365) ELSE doy END AS s FROM u)
SELECT c_custkey, {q6(f'24 * (1 - ACOS(1 - m) / {PI})')} AS day_hours, CASE WHEN s >= 80 AND s < 172 THEN 'Spring' WHEN s >= 172 AND s < 264 THEN 'Summer'
WHEN s >= 264 AND s < 355 THEN 'Autumn' ELSE 'Winter' END AS season FROM v""")
def c24(spark, d):
    lat = (K() % 160 - 80).cast("double")
    return customers(spark, d).select("c_custkey", r6(cl.day_length(lat, D())).alias("day_hours"), cl.season(lat, D()).alias("season"))


@query("c25_proxy_columns", f"""WITH e AS (SELECT c_custkey, c_custkey % 40 AS t, c_custkey % 23 AS mt, (c_custkey % 100)/CAST(100 AS DOUBLE) AS ndvi, c_custkey % 900 AS npp,
c_custkey % 6000 AS rain, c_custkey % 70 AS agb, c_custkey % 90 AS stock, c_custkey % 12 AS soc, c_custkey % 200 - 100 AS anom, (c_custkey % 10)/CAST(10 AS DOUBLE) AS farm,
c_custkey % 55 AS dens, c_custkey % 63 AS night, 4 + c_custkey % 5 AS ph, c_custkey % 35 AS cec FROM customer),
m AS (SELECT MAX(ndvi) AS mn, MAX(npp) AS mp, STDDEV_SAMP(mt) AS sd, MAX(dens) AS md, MAX(farm) AS mf, MAX(night) AS ml FROM e)
SELECT c_custkey, {q6('ABS(t-mt)/(sd+0.1)')} AS proxy_overall_climate_stress, {q6('(ndvi/mn + npp/(mp+1))/2')} AS proxy_vegetation_productivity_index,
{q6('CASE WHEN t>5 AND t<30 THEN 0.3 ELSE 0 END + CASE WHEN rain>100 AND rain<5000 THEN 0.3 ELSE 0 END + ndvi*0.4')} AS proxy_growing_season_suitability,
{q6('npp/(stock+agb+1)')} AS proxy_carbon_cycling_intensity,
{q6('LEAST(t/25, 1)*0.4 + LEAST(GREATEST((anom+100)/200, 0), 1)*0.3 + LEAST(soc/10, 1)*0.3')} AS proxy_decomposition_potential,
{q6('LEAST(dens/(md+1)*0.4 + farm*0.4 + night/100*0.2, 1)')} AS proxy_habitat_fragmentation_risk,
{q6('(farm/mf + dens/md + night/ml)/3')} AS proxy_human_impact_intensity,
{q6('GREATEST(1 - ABS(ph-6.5)/7, 0)*0.3 + LEAST(cec/30, 1)*0.35 + LEAST(soc/5, 1)*0.35')} AS proxy_soil_fertility_index,
{q6('LEAST(GREATEST(1 - ABS(t-mt)/(sd+0.1), 0), 1)')} AS proxy_ecosystem_resilience_score FROM e, m""")
def c25(spark, d):
    v = lambda n, e: e.cast("double").alias(n)
    df = customers(spark, d).select(
        "c_custkey", v("weather_temp_c", K() % 40), v("bioclim_annual_mean_temp", K() % 23), v("vegetation_ndvi_seasonal", (K() % 100) / 100.0),
        v("carbon_npp_gC_m2_year", K() % 900), v("bioclim_annual_precip", K() % 6000), v("carbon_agb_mg_ha", K() % 70), v("soil_carbon_stock_total", K() % 90),
        v("soil_grids_soc_pct", K() % 12), v("soil_moisture_anomaly_pct", K() % 200 - 100), v("human_agricultural_fraction", (K() % 10) / 10.0),
        v("human_settlement_density_per_km2", K() % 55), v("human_nightlights_intensity", K() % 63), v("soil_grids_ph", 4 + K() % 5), v("soil_grids_cec", K() % 35))
    out = cl.proxy_columns(df)
    names = ["overall_climate_stress", "vegetation_productivity_index", "growing_season_suitability", "carbon_cycling_intensity", "decomposition_potential",
             "habitat_fragmentation_risk", "human_impact_intensity", "soil_fertility_index", "ecosystem_resilience_score"]
    return out.select("c_custkey", *[r6(f"proxy_{n}").alias(f"proxy_{n}") for n in names])


CLAY = "CASE WHEN clay < 10 THEN 0.3 WHEN clay < 25 THEN 0.6 WHEN clay < 40 THEN 0.9 ELSE 0.8 END"
ACID = "CASE WHEN ph < 4.5 THEN 0.8 WHEN ph < 6.5 THEN 0.9 WHEN ph < 7.5 THEN 0.6 ELSE 0.3 END"
CEC = "CASE WHEN cec < 80 THEN 0.3 WHEN cec < 150 THEN 0.6 WHEN cec < 250 THEN 0.9 ELSE 0.95 END"
LOWOC = "CASE WHEN soc < 30 THEN 0.95 WHEN soc < 60 THEN 0.7 ELSE 0.3 END"
HIOC = "CASE WHEN soc < 30 THEN 0.3 WHEN soc < 60 THEN 0.6 WHEN soc < 100 THEN 0.9 ELSE 0.95 END"
SOIL = """e AS (SELECT c_custkey, COALESCE(CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 60 END, 30) AS clay, 3.5 + c_custkey % 6 AS ph, c_custkey % 130 AS soc,
c_custkey % 300 AS cec, c_custkey % 100 AS sand FROM customer)"""
URANIUM = f"({CLAY})*0.4 + ({ACID})*0.25 + ({LOWOC})*0.2 + ({CEC})*0.15"
CADMIUM = (f"({ACID})*0.35 + ({HIOC})*0.3 + (CASE WHEN cec < 80 THEN 0.95 WHEN cec < 150 THEN 0.6 ELSE 0.2 END)*0.2 + "
           "(CASE WHEN sand BETWEEN 50 AND 70 THEN 0.9 WHEN sand BETWEEN 40 AND 80 THEN 0.7 ELSE 0.4 END)*0.15")
NICKEL = (f"(({CLAY})*0.3 + (CASE WHEN ph < 6 THEN 0.6 WHEN ph < 7.5 THEN 0.95 WHEN ph < 8 THEN 0.7 ELSE 0.4 END)*0.25 + ({LOWOC})*0.25 + GREATEST(0, 1 - ABS(ph-7)/3)*0.2)")


def soil(spark, d):
    v = lambda n, e: e.cast("double").alias(n)
    return customers(spark, d).select(F.col("c_custkey").alias("sample_id"), v("clay", F.when(K() % 9 != 0, K() % 60)), v("phh2o", 3.5 + K() % 6),
                                      v("soc", K() % 130), v("cec", K() % 300), v("sand", K() % 100))


@query("c26_element_proxy", f"WITH {SOIL} SELECT c_custkey AS sample_id, {q6(URANIUM)} AS uranium_elem, {q6(CADMIUM)} AS cadmium_elem, {q6(NICKEL)} AS nickel_elem FROM e")
def c26(spark, d):
    out = cl.element_proxy(soil(spark, d), ["uranium", "cadmium", "nickel"])
    return out.select("sample_id", *[r6(f"{m}_elem").alias(f"{m}_elem") for m in ("uranium", "cadmium", "nickel")])


@query("c27_combine_proxies", f"""WITH {SOIL} SELECT c_custkey AS sample_id, {q6(f'0.4*CASE WHEN c_custkey % 2 = 0 THEN 0.8 ELSE 0.5 END + 0.6*({URANIUM})')} AS uranium_proxy FROM e""")
def c27(spark, d):
    elem = cl.element_proxy(soil(spark, d), ["uranium"]).select("sample_id", "uranium_elem")
    geo = customers(spark, d).filter(K() % 2 == 0).select(F.col("c_custkey").alias("sample_id"), F.lit(0.8).alias("uranium_geo"))
    return cl.combine_proxies(geo, elem, ["uranium"]).select("sample_id", r6("uranium_proxy").alias("uranium_proxy"))


_ROCKS = ["Ultramafic", "mafic", "GRANITIC", "slate", None]
_FORMATIONS = ["Laterite", "uraninite", "chalcopyrite", None, "chalk", "Pentlandite", "bastnasite"]


def _nth(names: list, at: str) -> str:
    return "CASE " + at + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names) if n) + " END"


def _rows(table: dict) -> str:
    return "(VALUES " + ", ".join(f"('{k}', '{m}', {v}::DOUBLE)" for k, r in table.items() for m, v in r.items()) + ")"


@query("c28_geology_metals", f"""WITH e AS (SELECT c_custkey AS sample_id, lower({_nth(_ROCKS, "c_custkey % 5")}) AS r, lower({_nth(_FORMATIONS, "c_custkey % 7")}) AS f FROM customer),
t AS (SELECT * FROM {_rows(cl.ROCK_METALS)} v(k, metal, s)), u AS (SELECT * FROM {_rows(cl.FORMATION_METALS)} v(k, metal, s)),
a AS (SELECT sample_id, metal, s, 1 AS o FROM e JOIN u ON f = k UNION ALL SELECT sample_id, metal, s, 2 FROM e JOIN t ON r = k),
b AS (SELECT sample_id, metal, arg_min(s, o) AS score FROM a GROUP BY 1, 2)
SELECT sample_id, metal, score FROM b UNION ALL SELECT sample_id, 'unknown', 0.3::DOUBLE FROM e WHERE sample_id NOT IN (SELECT sample_id FROM b)""")
def c28(spark, d):
    pick = lambda names, n: F.get(F.array(*[F.lit(x) for x in names]), (K() % n).cast("int"))
    return cl.geology_metals(customers(spark, d).select(F.col("c_custkey").alias("sample_id"), pick(_ROCKS, 5).alias("rock_type"), pick(_FORMATIONS, 7).alias("formation")))


@query("c29_surface_metals", f"""WITH e AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'igneous' ELSE 'sedimentary' END AS rock, nullif(c_custkey % 60, 0)::DOUBLE AS clay,
nullif(c_custkey % 4, 0)/2::DOUBLE AS iron, nullif(c_custkey % 5, 0)/2::DOUBLE AS al, nullif(c_custkey % 6, 0)::DOUBLE AS oc, nullif(c_custkey % 10, 0)/10::DOUBLE AS mi, c_custkey % 25 AS slope FROM customer),
s AS (SELECT k, CASE WHEN rock = 'igneous' AND clay IS NOT NULL THEN LEAST(1, 0.5::DOUBLE + clay/100*0.3 + CASE WHEN slope > 10 THEN 0.1 ELSE 0 END) END AS u,
CASE WHEN iron IS NOT NULL THEN LEAST(1, 0.3::DOUBLE + iron*0.5) END AS a, CASE WHEN clay IS NOT NULL THEN LEAST(1, 0.4::DOUBLE + clay/100*0.3 + COALESCE(al*0.2, 0)) END AS c,
CASE WHEN oc IS NOT NULL THEN LEAST(1, 0.5::DOUBLE + oc/20*0.3) END AS l, mi FROM e), t AS (SELECT *, COALESCE(u, a, c, l, mi) IS NULL AS none FROM s)
SELECT k AS sample_id, {', '.join(f"{q6(f'CASE WHEN none THEN 0.5::DOUBLE ELSE {x} END')} AS {m}_geo" for m, x in (("uranium", "u"), ("arsenic", "a"), ("copper", "c"), ("lead", "l"), ("zinc", "mi"), ("nickel", "mi"), ("cadmium", "mi")))} FROM t""")
def c29(spark, d):
    v = lambda e, name, by=1.0: F.nullif(e, F.lit(0)).cast("double").__truediv__(by).alias(name)
    df = customers(spark, d).select(
        F.col("c_custkey").alias("sample_id"), F.when(K() % 3 == 0, "igneous").otherwise("sedimentary").alias("rock_type"), v(K() % 60, "clay_percent"),
        v(K() % 4, "iron_oxide_percent", 2.0), v(K() % 5, "aluminum_oxide_percent", 2.0), v(K() % 6, "organic_carbon_percent"), v(K() % 10, "metal_mineral_index", 10.0),
        (K() % 25).alias("slope_percent"))
    out = cl.surface_metals(df)
    return out.select("sample_id", *[r6(c).alias(c) for c in out.columns if c.endswith("_geo")])
