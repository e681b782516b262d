"""Joins, equi and by distance."""

from pyspark.sql import functions as F

from meadow.operators import geo, joins
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.registry import q6, query, r6


def hav(a, b):
    return (f"2*6371.0*ASIN(LEAST(1.0, SQRT(POWER(SIN(RADIANS({b}.lat-{a}.lat)/2), 2) + COS(RADIANS({a}.lat))*COS(RADIANS({b}.lat))"
            f"*POWER(SIN(RADIANS({b}.lon-{a}.lon)/2), 2))))")


@query("d01_sync_samples", cte("abb") + "SELECT sample_id, feature_id FROM abb WHERE sample_id % 3 = 0")
def d01(spark, d):
    ab = fx.abundance_brand(spark, d).withColumn("sample_id", F.concat(F.lit("S"), "sample_id"))
    m = fx.table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("s"), "c_custkey", F.lit(" ")).alias("sample_id"))
    a, _ = joins.sync_samples(ab, m)
    return a.select(F.substring("sample_id", 2, 20).cast("long").alias("sample_id"), "feature_id")


@query("d02_join_metadata", cte("abb", "meta") + """SELECT feature_id, "group", COUNT(*) AS n, SUM(count) AS total FROM abb JOIN meta USING (sample_id) GROUP BY 1, 2""")
def d02(spark, d):
    m = fx.sample_meta(spark, d).select(F.col("sample_id").alias("run_accession"), "group")
    j = joins.join_metadata(fx.abundance_brand(spark, d), m)
    return j.groupBy("feature_id", "group").agg(F.count(F.lit(1)).alias("n"), F.sum("count").alias("total"))


@query("d02_add_metadata_column", cte("abb", "meta") + """SELECT sample_id, feature_id, count, CASE WHEN sample_id % 2 = 0 THEN study END AS site FROM abb LEFT JOIN meta USING (sample_id)""")
def d02b(spark, d):
    m = fx.sample_meta(spark, d).filter("sample_id % 2 = 0").withColumnRenamed("sample_id", "#sampleid")
    return joins.add_metadata_column(fx.abundance_brand(spark, d), m, "study", "site")


@query("d03_assemble_runs", """WITH r AS (SELECT l_orderkey, MIN((CAST(l_linenumber AS BIGINT)*1000000 + l_partkey)*100000 + l_suppkey) AS ln, ARG_MIN(l_shipdate, (CAST(l_linenumber AS BIGINT)*1000000 + l_partkey)*100000 + l_suppkey) AS sd FROM lineitem GROUP BY 1)
SELECT o_orderkey AS experiment_accession, c_name AS sample_title, n_name AS study_title, COALESCE(ln, -1) AS run_accession, CAST(sd AS VARCHAR) AS run_day, c_mktsegment AS biosample_kind
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN r ON o_orderkey = l_orderkey""")
def d03(spark, d):
    o, c, n, li = (fx.table(spark, d, t) for t in ("orders", "customer", "nation", "lineitem"))
    ck = c.select("c_custkey", "c_nationkey")
    e = o.join(ck, o.o_custkey == ck.c_custkey, "left").select(F.col("o_orderkey").alias("accession"), F.col("o_custkey").alias("sample_accession"),
                                                               F.col("c_nationkey").alias("study_accession"))
    s = c.select(F.col("c_custkey").alias("accession"), F.col("c_name").alias("title"))
    st = n.select(F.col("n_nationkey").alias("accession"), F.col("n_name").alias("title"))
    r = li.select(((F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).alias("accession"), F.col("l_orderkey").alias("experiment_accession"), F.col("l_shipdate").alias("day"))
    b = c.select(F.col("c_custkey").alias("accession"), F.col("c_mktsegment").alias("kind"))
    return joins.assemble_runs(e, s, st, r, b).select(
        "experiment_accession", "sample_title", "study_title", F.coalesce("run_accession", F.lit(-1)).alias("run_accession"),
        F.date_format("run_day", "yyyy-MM-dd HH:mm:ss").alias("run_day"), "biosample_kind")


@query("d04_join_with_fallback_key", """WITH s AS (SELECT o_custkey, ARG_MIN(o_totalprice, o_orderkey) AS p FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1)
SELECT c_custkey AS experiment_accession, c_acctbal AS price, p AS price_sample FROM customer LEFT JOIN s ON o_custkey = c_custkey""")
def d04(spark, d):
    runs = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("experiment_accession"), F.col("c_acctbal").alias("price"))
    s = fx.table(spark, d, "orders").filter("o_custkey % 2 = 0").select(F.col("o_custkey").alias("study_accession"), F.col("o_totalprice").alias("price"), "o_orderkey")
    return joins.join_with_fallback_key(runs, s, "o_orderkey").drop("o_orderkey")


@query("d05_merge_by_record_type", """SELECT c_custkey AS run_accession, c_nationkey AS sample_accession, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS title_run, n_name AS title_biosample
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def d05(spark, d):
    c, n = fx.table(spark, d, "customer"), fx.table(spark, d, "nation")
    obs = c.select(F.col("c_custkey").alias("run_accession"), F.col("c_nationkey").cast("long").alias("sample_accession"))
    rec = (c.filter("c_custkey % 2 = 0").select(F.lit("run").alias("kind"), F.col("c_custkey").alias("accession"), F.col("c_name").alias("title"))
           .unionByName(n.select(F.lit("biosample").alias("kind"), F.col("n_nationkey").cast("long").alias("accession"), F.col("n_name").alias("title"))))
    return joins.merge_by_record_type(obs, rec, "title").select("run_accession", F.col("sample_accession").cast("int"), "title_run", "title_biosample")


@query("d06_merge_sources", """WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_name END AS title FROM customer WHERE c_custkey % 3 <> 0),
b AS (SELECT c_custkey AS id, c_mktsegment AS title, c_acctbal AS size FROM customer WHERE c_custkey % 5 <> 0)
SELECT id, COALESCE(CASE WHEN TRIM(a.title) <> '' THEN a.title END, b.title, a.title) AS title, size,
CASE WHEN a.title IS NOT NULL AND b.title IS NOT NULL THEN 'ENA,SRA' WHEN b.title IS NULL THEN 'ENA' ELSE 'SRA' END AS sources FROM a FULL JOIN b USING (id)""")
def d06(spark, d):
    c = fx.table(spark, d, "customer")
    k = F.col("c_custkey")
    a = c.filter("c_custkey % 3 <> 0").select(k.alias("id"), F.when(k % 4 == 0, " ").otherwise(F.col("c_name")).alias("title"))
    b = c.filter("c_custkey % 5 <> 0").select(k.alias("id"), F.col("c_mktsegment").alias("title"), F.col("c_acctbal").alias("size"))
    return joins.merge_sources(a, b, "id")


@query("d07_fill_missing", cte("meta") + "SELECT sample_id, COALESCE(value, balance) AS value, study AS place FROM meta")
def d07(spark, d):
    m = fx.sample_meta(spark, d)
    extra = m.select("sample_id", F.col("balance").alias("value"), F.col("study").alias("place"))
    return joins.fill_missing(m.select("sample_id", "value"), extra, "sample_id")


@query("d08_nearest_facility", cte("meta", "fac") + f""", p AS (SELECT sample_id, facility_id, facility, is_nuclear, {hav('meta', 'fac')} AS km FROM meta, fac WHERE meta.lat <> 0),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY km, facility_id) AS k FROM p)
SELECT sample_id, {q6('km')} AS facility_distance_km, km <= 800 AS industry_match, km <= 800 AND is_nuclear AS facility_match, km <= 800 AND NOT is_nuclear AS analog_match,
CASE WHEN km <= 800 THEN facility END AS facility_name FROM r WHERE k = 1""")
def d08(spark, d):
    out = geo.nearest_facility(fx.sample_meta(spark, d), fx.facilities(spark, d), 800)
    return out.withColumn("facility_distance_km", r6("facility_distance_km"))


@query("d09_nearest_by_view", cte("meta", "fac") + f"""SELECT sample_id, {q6('MIN(CASE WHEN is_nuclear THEN ' + hav('meta', 'fac') + ' END)')} AS dist_nuclear_km,
{q6('MIN(CASE WHEN NOT is_nuclear THEN ' + hav('meta', 'fac') + ' END)')} AS dist_analog_km,
{q6("MIN(CASE WHEN facility_type = 'type1' THEN " + hav('meta', 'fac') + ' END)')} AS dist_salts_km FROM meta, fac GROUP BY 1""")
def d09(spark, d):
    f = fx.facilities(spark, d).withColumn("facility_type_standard", F.when(F.col("facility_type") == "type1", "Salt Mine").otherwise("Mill"))
    views = ["dist_nuclear_km", "dist_analog_km", "dist_salts_km"]
    return geo.nearest_by_view(fx.sample_meta(spark, d), f, views).select("sample_id", *[r6(v).alias(v) for v in views])


@query("d10_samples_within_radius", cte("meta", "fac") + f"SELECT facility_id AS point_id, sample_id, {q6(hav('meta', 'fac'))} AS km FROM meta, fac WHERE {hav('meta', 'fac')} <= 700")
def d10(spark, d):
    p = fx.facilities(spark, d).withColumnRenamed("facility_id", "point_id")
    return geo.samples_within_radius(fx.sample_meta(spark, d), p, 700).withColumn("km", r6("km"))


@query("d11_borrow_from_nearby", cte("meta", "fac") + f""", p AS (SELECT meta.sample_id, facility_id, facility, (CASE WHEN facility_id % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN facility_id % 4 = 0 THEN 2 ELSE 0 END)*1000
 - {hav('meta', 'fac')} - CASE WHEN facility_id % 5 = 0 THEN 10 ELSE 0 END AS s FROM meta, fac WHERE meta.sample_id % 2 = 1 AND {hav('meta', 'fac')} <= 900),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY s DESC, facility_id) AS k FROM p)
SELECT meta.sample_id, COALESCE(r.facility_id, -1) AS donor, CASE WHEN meta.sample_id % 3 <> 0 THEN r.facility END AS site_nearby_inferred FROM meta LEFT JOIN r ON meta.sample_id = r.sample_id AND k = 1""")
def d11(spark, d):
    i = F.col("facility_id")
    arch = fx.facilities(spark, d).select(i.alias("archive_id"), "lat", "lon", F.when(i % 3 == 0, "2020").alias("collection_date"),
                                          F.when(i % 4 == 0, "x").alias("location"), F.when(i % 5 == 0, "host").alias("host"), F.col("facility").alias("site"))
    s = F.col("sample_id")
    m = fx.sample_meta(spark, d).select("sample_id", "lat", "lon", F.when(s % 2 == 0, "SRR1").alias("accession"), F.when(s % 3 == 0, "known").alias("site"))
    return geo.borrow_from_nearby(m, arch, 900, ["site"]).select("sample_id", F.coalesce("donor", F.lit(-1)).alias("donor"), "site_nearby_inferred")


@query("d12_dedup_facilities")
def d12(spark, d):
    f = fx.facilities(spark, d).withColumns({"data_source": F.element_at(F.array(F.lit("NRC"), F.lit("GEM"), F.lit("WNA")), (F.col("source") + 1).cast("int")),
                                             "lat": F.round(F.col("lat") / 10, 1), "lon": F.round(F.col("lon") / 10, 1)})
    return geo.dedup_facilities(f.select("facility_id", "facility", "data_source", "lat", "lon"), 50.0)


@query("d13_dedup_coordinates", cte("meta") + f""", p AS (SELECT sample_id, lat, lon, FLOOR(lat/(50000/CAST(111320 AS DOUBLE))) AS a FROM meta),
q AS (SELECT *, FLOOR(lon/((50000/CAST(111320 AS DOUBLE))/GREATEST(COS(RADIANS((a+0.5)*(50000/CAST(111320 AS DOUBLE)))), 1e-6))) AS b FROM p)
SELECT sample_id, {q6('FIRST_VALUE(lat) OVER w')} AS cluster_lat, {q6('FIRST_VALUE(lon) OVER w')} AS cluster_lon FROM q WINDOW w AS (PARTITION BY a, b ORDER BY lat, lon)""")
def d13(spark, d):
    return geo.dedup_coordinates(fx.sample_meta(spark, d), 50_000).select("sample_id", r6("cluster_lat").alias("cluster_lat"), r6("cluster_lon").alias("cluster_lon"))


@query("d13_expand_results", cte("meta") + f"""SELECT sample_id, {q6('FLOOR(lat)+1')} AS value FROM meta""")
def d13b(spark, d):
    m = fx.sample_meta(spark, d).select("sample_id", F.floor("lat").alias("cluster_lat"), F.floor("lon").alias("cluster_lon"))
    res = m.select("cluster_lat", "cluster_lon").distinct().withColumn("value", F.col("cluster_lat") + 1)
    return geo.expand_results(m, res).select("sample_id", r6("value").alias("value"))


def _region_sql():
    inside = lambda b: f"lat BETWEEN {b[0]} AND {b[1]} AND lon BETWEEN {b[2]} AND {b[3]}"
    small = [r for r in geo.REGIONS if r[1][1] - r[1][0] < 90]
    return "CASE " + " ".join(f"WHEN {inside(b)} THEN '{n}'" for n, b, _ in reversed(small)) + " ELSE 'ocean' END"


FRAC = "((lat - FLOOR(lat)) + (lon - FLOOR(lon)))*0.1"


@query("d14_region_lookup", cte("meta") + f""", r AS (SELECT sample_id, lat, lon, {_region_sql()} AS region FROM meta)
SELECT sample_id, region, {q6("GREATEST(0.1, CASE region " + " ".join(f"WHEN '{n}' THEN {v[0]}" for n, _, v in geo.REGIONS) + f" END * (1 + ({FRAC} - 0.05) + 0.15*({FRAC}*2 - 1)))")} AS ni_ppm FROM r""")
def d14(spark, d):
    return geo.region_lookup(fx.sample_meta(spark, d), ["ni"]).select("sample_id", "region", r6("ni_ppm").alias("ni_ppm"))


def primers(spark, d):
    p = fx.table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(k.cast("string").alias("name"), F.when(k % 2 == 0, "Forward primer").otherwise(" Reverse primer ").alias("direction"),
                    (k * 37 % 1500).cast("int").alias("position_start"), (k * 37 % 1500 + 15 + k % 10).cast("int").alias("position_end"))


PRIMERS = """SELECT CAST(p_partkey AS VARCHAR) AS name, CASE WHEN p_partkey % 2 = 0 THEN 'Forward primer' ELSE 'Reverse primer' END AS direction,
p_partkey * 37 % 1500 AS s, p_partkey * 37 % 1500 + 15 + p_partkey % 10 AS e FROM part"""
SPOTS = [8, 341, 515, 799, 1100]
REGION_ROWS = [("V4", 515, 806, 20), ("V3-V4", 341, 805, 20), ("V1-V3", 27, 534, 15)]


@query("d15_primers_at", cte(pr=PRIMERS, spot=f"SELECT UNNEST({SPOTS}) AS position") + """SELECT position, name, CAST(s AS INTEGER) AS position_start, CAST(e AS INTEGER) AS position_end
FROM pr, spot WHERE direction = 'Forward primer' AND s <= position + 30 AND e >= GREATEST(0, position - 30)""")
def d15(spark, d):
    spots = spark.createDataFrame([(s,) for s in SPOTS], "position int")
    return joins.primers_at(primers(spark, d), spots, 30, "Forward primer")


@query("d15_primer_pairs", cte(pr=PRIMERS, rg="SELECT * FROM (VALUES " + ", ".join(str(r) for r in REGION_ROWS) + ") t(region, f, r, w)") + """
SELECT region, a.name AS fwd, b.name AS rev FROM rg JOIN pr a ON a.direction = 'Forward primer' AND a.s <= f + w AND a.e >= GREATEST(0, f - w)
JOIN pr b ON b.direction = 'Reverse primer' AND b.s <= r + w AND b.e >= GREATEST(0, r - w) WHERE a.s < b.s""")
def d15b(spark, d):
    regions = spark.createDataFrame(REGION_ROWS, "region string, fwd_pos int, rev_pos int, leeway int")
    return joins.primer_pairs(primers(spark, d), regions).select("region", "fwd", "rev")


@query("d16_split_cached", """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS stored FROM customer""")
def d16(spark, d):
    c = fx.table(spark, d, "customer").select("c_custkey")
    cache = fx.table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    a, b = joins.split_cached(c, cache, "c_custkey")
    return a.withColumn("stored", F.lit(True)).unionByName(b.withColumn("stored", F.lit(False)))


@query("d17_samples_by_project", """SELECT c_nationkey AS project, 0 AS part, array_to_string(list_sort(list(c_custkey)), ',') AS samples FROM customer GROUP BY 1""")
def d17(spark, d):
    c = fx.table(spark, d, "customer").select(F.col("c_nationkey").alias("project"), "c_custkey")
    out = joins.samples_by_project(c, "project", "c_custkey")
    return out.select("project", "part", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


@query("d18_align_target", cte("abb", "meta") + "SELECT sample_id, feature_id, count, value AS target FROM abb JOIN meta USING (sample_id) WHERE value IS NOT NULL")
def d18(spark, d):
    return joins.align_target(fx.abundance_brand(spark, d), fx.sample_meta(spark, d), "value")


PUBS = """SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN 'doi' || (doc_id % 301) END AS doi, LOWER(SUBSTR(text, 1, 12)) AS t, CAST(2000 + doc_id % 3 AS INTEGER) AS year FROM documents"""


@query("d19_dedup_publications", cte(p=PUBS) + """, a AS (SELECT *, CASE WHEN doi IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY doi ORDER BY doc_id) END AS k FROM p),
b AS (SELECT doc_id, ROW_NUMBER() OVER (PARTITION BY TRIM(t), year ORDER BY doc_id) AS j FROM a WHERE (k IS NULL OR k > 1) AND TRIM(t) <> '')
SELECT doc_id FROM a WHERE k = 1 UNION ALL SELECT doc_id FROM b WHERE j = 1""")
def d19(spark, d):
    i = F.col("doc_id")
    p = fx.table(spark, d, "documents").select("doc_id", F.when(i % 4 != 0, F.concat(F.lit("doi"), i % 301)).alias("doi"),
                                               F.substring("text", 1, 12).alias("title"), (2000 + i % 3).cast("int").alias("year"))
    return joins.dedup_publications(p, "doc_id").select("doc_id")


@query("d20_match_dataset", """WITH q AS (SELECT DISTINCT UPPER(CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE SUBSTR(s_name, 10) END) AS query FROM supplier),
x AS (SELECT s_suppkey AS k, UPPER(s_name) AS a, 'P' || s_nationkey AS b FROM supplier),
e AS (SELECT query, MIN(k) AS dataset FROM q JOIN x ON query = a OR query = b GROUP BY 1)
SELECT * FROM e UNION ALL SELECT query, MIN(k) FROM q JOIN x ON contains(a, query) OR contains(b, query) WHERE query NOT IN (SELECT query FROM e) GROUP BY 1""")
def d20(spark, d):
    s = fx.table(spark, d, "supplier")
    q = s.select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.expr("substr(s_name, 10)")).alias("query"))
    x = s.select("s_suppkey", "s_name", F.concat(F.lit("P"), "s_nationkey").alias("p"))
    return joins.match_dataset(q, x, ["s_name", "p"], "s_suppkey")


@query("d21_uncovered_points", cte("meta", "fac") + f"""SELECT DISTINCT {q6('lat')} AS lat, {q6('lon')} AS lon FROM meta WHERE NOT EXISTS
(SELECT 1 FROM fac WHERE {hav('meta', 'fac')} < 0.9*(500 + facility_id % 7 * 100))""")
def d21(spark, d):
    s = fx.facilities(spark, d).select("lat", "lon", (500 + F.col("facility_id") % 7 * 100).cast("double").alias("radius_km"))
    return geo.uncovered_points(fx.sample_meta(spark, d), s).select(r6("lat").alias("lat"), r6("lon").alias("lon"))
