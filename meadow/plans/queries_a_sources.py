"""Sources, sinks and ingestion."""

from pyspark.sql import functions as F

from meadow.operators import alpha
from meadow.plans import fixtures as fx
from meadow.plans.fixtures import cte
from meadow.plans.registry import q6, query, r6
from meadow.sources import tables as src
from meadow.streaming.ingest import ingest_incremental


@query("flagship_shannon_by_segment", cte("ab", "meta") + f"""
, t AS (SELECT sample_id, SUM(count) AS total FROM ab GROUP BY 1 HAVING SUM(count) >= 100),
h AS (SELECT ab.sample_id, -SUM(count/total*LN(count/total)) AS h FROM ab JOIN t USING (sample_id) GROUP BY 1)
SELECT "group", COUNT(*) AS n_samples, {q6('AVG(h)')} AS mean_shannon FROM h JOIN meta USING (sample_id) GROUP BY 1""")
def flagship(spark, d):
    from meadow.operators.table import filter_samples
    ab = filter_samples(fx.abundance(spark, d), 100)
    h = alpha.shannon(ab)
    return (h.join(fx.sample_meta(spark, d).select("sample_id", "group"), "sample_id").groupBy("group")
            .agg(F.count(F.lit(1)).alias("n_samples"), r6(F.avg("shannon")).alias("mean_shannon")))


@query("a01_read_metadata", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def a01(spark, d):
    df = src.read_metadata(spark, f"{d}/customer.parquet", "parquet")
    return df.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("a01_read_abundance", """SELECT l_orderkey AS sample_id, l_partkey AS feature_id, l_quantity AS count
FROM lineitem WHERE l_quantity > 0""")
def a01b(spark, d):
    return src.read_abundance(spark, f"{d}/lineitem.parquet", "l_orderkey", "l_partkey", "l_quantity")


@query("a02_merge_metadata", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS kind
FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 'supplier' FROM supplier""")
def a02(spark, d):
    a = fx.table(spark, d, "customer").select(F.col("c_custkey").alias(" ID "), F.col("c_name").alias("Name"),
                                              F.col("c_mktsegment").alias("SEGMENT"))
    b = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("NAME "),
                                              F.lit("supplier").alias("Kind"))
    return src.merge_metadata(a, b)


@query("a03_merge_tables", """SELECT o_custkey AS sample_id, l_partkey AS feature_id, SUM(l_quantity) AS count FROM lineitem
JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def a03(spark, d):
    rows = fx.lines(spark, d)
    part = lambda flag: (rows.filter(F.col("l_returnflag") == flag)
                         .groupBy(F.col("o_custkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"))
                         .agg(F.sum("l_quantity").alias("count")))
    return src.merge_tables(*[part(f) for f in ("A", "N", "R")])


@query("a03_merge_feature_meta", """SELECT p_partkey AS feature_id, CASE WHEN p_size > 25 THEN p_name ELSE 'b:' || p_name END AS label,
CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS origin FROM part""")
def a03b(spark, d):
    p = fx.table(spark, d, "part")
    first = p.filter("p_size > 25").select(F.col("p_partkey").alias("feature_id"), F.col("p_name").alias("label"),
                                           F.col("p_brand").alias("origin"))
    second = p.select(F.col("p_partkey").alias("feature_id"), F.concat(F.lit("b:"), "p_name").alias("label"),
                      F.col("p_type").alias("origin"))
    return src.merge_feature_meta(first, second)


@query("a04_ingest_incremental", """SELECT l_suppkey AS sample_id, l_partkey AS feature_id, SUM(l_quantity) AS count
FROM lineitem GROUP BY 1, 2""")
def a04(spark, d):
    schema = fx.table(spark, d, "lineitem").schema
    clean = lambda df: (df.groupBy(F.col("l_suppkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"))
                        .agg(F.sum("l_quantity").alias("count")))
    base = src.work_folder(spark, "ingest")
    return ingest_incremental(spark, f"{d}/lineitem*.parquet", schema, f"{base}/parts", f"{base}/state", clean)


@query("a05_to_wide", cte("abb") + "SELECT sample_id, " + ", ".join(
    f"COALESCE(SUM(CASE WHEN feature_id = 'Brand#{i}' THEN count END), 0) AS \"Brand#{i}\"" for i in range(1, 26))
    + " FROM abb GROUP BY 1")
def a05(spark, d):
    return src.to_wide(fx.abundance_brand(spark, d), [f"Brand#{i}" for i in range(1, 26)])


@query("a05_to_long", cte("abb") + "SELECT sample_id, feature_id, count FROM abb WHERE feature_id IN ("
       + ", ".join(f"'Brand#{i}'" for i in range(1, 26)) + ")")
def a05b(spark, d):
    return src.to_long(src.to_wide(fx.abundance_brand(spark, d), [f"Brand#{i}" for i in range(1, 26)]))


@query("a06_partition_subsets", """SELECT UPPER(n_name || '.' || c_mktsegment || '.' || CASE WHEN c_acctbal < 0 THEN 'neg' ELSE 'pos' END
|| '.' || r_name) AS subset_id, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def a06(spark, d):
    m = fx.sample_meta(spark, d).withColumn("sign", F.when(F.col("flag"), "neg").otherwise("pos"))
    return (src.partition_subsets(m, "study", "group", "sign", "region").groupBy("subset_id")
            .agg(F.count(F.lit(1)).alias("n")))


@query("a07_write_by_location", """SELECT n_nationkey AS query_lat, n_regionkey AS query_lon, COUNT(*) AS n FROM customer
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def a07(spark, d):
    c, n = fx.table(spark, d, "customer"), fx.table(spark, d, "nation")
    df = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", F.col("n_nationkey").alias("query_lat"), F.col("n_regionkey").alias("query_lon"))
    path = src.work_folder(spark, "by-location")
    src.write_by_location(df, path)
    return (spark.read.schema("c_custkey long, query_lat int, query_lon int").parquet(path)
            .groupBy("query_lat", "query_lon").agg(F.count(F.lit(1)).alias("n")))


@query("a08_export_long", cte("abb") + "SELECT sample_id, feature_id, count FROM abb")
def a08(spark, d):
    path = src.work_folder(spark, "export")
    src.export_long(fx.abundance_brand(spark, d), path, "tsv")
    return src.read_metadata(spark, path, "tsv").select(
        F.col("sample_id").cast("long"), "feature_id", F.col("count").cast("double"))


@query("a09_manifest", """WITH p AS (SELECT DISTINCT o_custkey AS sample_id, '/reads/' || l_shipmode_ AS path FROM
(SELECT o_custkey, CAST(o_orderkey AS VARCHAR) || '.fastq' AS l_shipmode_ FROM orders)),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY path) AS k FROM p)
SELECT a.sample_id, a.path AS forward_filepath, b.path AS reverse_filepath FROM r a JOIN r b
ON a.sample_id = b.sample_id AND a.k = 1 AND b.k = 2""")
def a09(spark, d):
    o = fx.table(spark, d, "orders")
    paths = o.select(F.col("o_custkey").alias("sample_id"),
                     F.concat(F.lit("/reads/"), F.col("o_orderkey").cast("string"), F.lit(".fastq")).alias("path"))
    return src.manifest(paths)
