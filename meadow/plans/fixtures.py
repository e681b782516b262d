"""Input tables of the operators, derived from the star-schema tables, each with its SQL twin.

`cte(...)` gives the WITH clause of the twins, so an oracle query starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lines(spark, d):
    """lineitem with its customer."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey)


def abundance(spark, d):
    """sample = customer, feature = part, count = quantity."""
    return (lines(spark, d).groupBy(F.col("o_custkey").alias("sample_id"), F.col("l_partkey").alias("feature_id"))
            .agg(F.sum("l_quantity").alias("count")))


def abundance_brand(spark, d):
    """sample = customer, feature = brand (25 features, dense)."""
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return (lines(spark, d).join(p, F.col("l_partkey") == p.p_partkey)
            .groupBy(F.col("o_custkey").alias("sample_id"), F.col("p_brand").alias("feature_id"))
            .agg(F.sum("l_quantity").alias("count")))


def abundance_kind(spark, d):
    """sample = customer, feature = brand and type (about 125 features)."""
    p = table(spark, d, "part").select("p_partkey", F.concat_ws("|", "p_brand", "p_type").alias("kind"))
    return (lines(spark, d).join(p, F.col("l_partkey") == p.p_partkey)
            .groupBy(F.col("o_custkey").alias("sample_id"), F.col("kind").alias("feature_id"))
            .agg(F.sum("l_quantity").alias("count")))


def abundance_site(spark, d):
    """sample = nation and segment (125 samples at every scale), feature = part: for pair operators."""
    c = table(spark, d, "customer").select("c_custkey", site_id().alias("sample_id"))
    return (lines(spark, d).join(c, F.col("o_custkey") == c.c_custkey)
            .groupBy("sample_id", F.col("l_partkey").alias("feature_id"))
            .agg(F.sum("l_quantity").alias("count")))


def site_id():
    return F.concat_ws(":", F.col("c_nationkey").cast("string"), F.col("c_mktsegment"))


def sites(spark, d):
    """sample_meta of abundance_site: study, group, flag, lat, lon, value."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    k, s = F.col("n_nationkey"), F.length("c_mktsegment")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .groupBy("n_nationkey", "c_mktsegment", "n_regionkey", site_id().alias("sample_id"))
            .agg(F.avg("c_acctbal").alias("value"))
            .select("sample_id", F.col("n_nationkey").cast("string").alias("study"),
                    F.col("c_mktsegment").alias("group"), F.col("n_regionkey").cast("string").alias("region"),
                    F.round("value", 4).alias("value"),
                    ((k * 37) % 120 - 60 + s / 100.0).alias("lat"),
                    ((k * 91) % 300 - 150 + s / 100.0).alias("lon")))


def sample_meta(spark, d):
    """customer with nation and region; every seventh value is null."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("c_custkey").alias("sample_id"), F.col("n_name").alias("study"),
                    F.col("r_name").alias("region"), F.col("c_mktsegment").alias("group"),
                    (F.col("c_acctbal") < 0).alias("flag"), F.col("c_acctbal").alias("balance"),
                    F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("value"),
                    ((F.col("c_custkey") * 37 % 18000) / 100.0 - 90).alias("lat"),
                    ((F.col("c_custkey") * 91 % 36000) / 100.0 - 180).alias("lon")))


def feature_meta(spark, d):
    """part as a lineage of domain, type, brand, size and part."""
    p = table(spark, d, "part")
    lineage = F.concat(F.lit("d__Bacteria;p__"), F.col("p_type"), F.lit(";c__"),
                       F.regexp_replace("p_brand", "#", "_"), F.lit(";o__S"), F.col("p_size").cast("string"),
                       F.lit(";f__"), F.element_at(F.split("p_name", " "), 1),
                       F.lit(";g__"), F.element_at(F.split("p_name", " "), 2))
    return p.select(F.col("p_partkey").alias("feature_id"), lineage.alias("taxonomy"),
                    F.col("p_type").alias("phylum"), F.col("p_brand").alias("class"),
                    F.element_at(F.split("p_name", " "), 2).alias("genus"),
                    F.col("p_size").alias("size"), F.col("p_name").alias("name"))


def branch(spark, d):
    """A three-level tree: type (length 3), brand within type (2), part (1)."""
    p = table(spark, d, "part")
    rows = lambda bid, length: p.select(bid.alias("branch_id"), F.col("p_partkey").alias("feature_id"),
                                        F.lit(float(length)).alias("length"))
    return (rows(F.concat(F.lit("t:"), "p_type"), 3)
            .unionByName(rows(F.concat(F.lit("b:"), F.col("p_type"), F.lit("|"), F.col("p_brand")), 2))
            .unionByName(rows(F.concat(F.lit("p:"), F.col("p_partkey").cast("string")), 1)))


def facilities(spark, d):
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("facility_id"), F.col("s_name").alias("facility"),
                    F.concat(F.lit("type"), (F.col("s_suppkey") % 5).cast("string")).alias("facility_type"),
                    (F.col("s_suppkey") % 3).alias("source"), (F.col("s_suppkey") % 2 == 0).alias("is_nuclear"),
                    ((F.col("s_suppkey") * 3701 % 18000) / 100.0 - 90).alias("lat"),
                    ((F.col("s_suppkey") * 9103 % 36000) / 100.0 - 180).alias("lon"))


def events_daily(spark, d):
    """sample = (user, day), feature = event type."""
    e = table(spark, d, "events")
    return (e.groupBy(F.col("user_id").alias("subject"), F.to_date("ts").alias("day"),
                      F.col("event_type").alias("feature_id"))
            .agg(F.count(F.lit(1)).cast("double").alias("count")))


SQL = {
    "ab": """SELECT o_custkey AS sample_id, l_partkey AS feature_id, SUM(l_quantity) AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "abb": """SELECT o_custkey AS sample_id, p_brand AS feature_id, SUM(l_quantity) AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "abk": """SELECT o_custkey AS sample_id, p_brand || '|' || p_type AS feature_id, SUM(l_quantity) AS count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "abs_": """SELECT CAST(c_nationkey AS VARCHAR) || ':' || c_mktsegment AS sample_id, l_partkey AS feature_id,
        SUM(l_quantity) AS count FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "sites": """SELECT CAST(n_nationkey AS VARCHAR) || ':' || c_mktsegment AS sample_id,
        CAST(n_nationkey AS VARCHAR) AS study, c_mktsegment AS "group", CAST(n_regionkey AS VARCHAR) AS region,
        ROUND(AVG(c_acctbal), 4) AS value,
        (n_nationkey * 37) % 120 - 60 + LENGTH(c_mktsegment) / CAST(100 AS DOUBLE) AS lat,
        (n_nationkey * 91) % 300 - 150 + LENGTH(c_mktsegment) / CAST(100 AS DOUBLE) AS lon
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey, c_mktsegment, n_regionkey""",
    "meta": """SELECT c_custkey AS sample_id, n_name AS study, r_name AS region, c_mktsegment AS "group",
        c_acctbal < 0 AS flag, c_acctbal AS balance, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS value,
        (c_custkey * 37 % 18000) / CAST(100 AS DOUBLE) - 90 AS lat,
        (c_custkey * 91 % 36000) / CAST(100 AS DOUBLE) - 180 AS lon
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fm": """SELECT p_partkey AS feature_id, 'd__Bacteria;p__' || p_type || ';c__' || replace(p_brand, '#', '_')
        || ';o__S' || p_size || ';f__' || split_part(p_name, ' ', 1) || ';g__' || split_part(p_name, ' ', 2) AS taxonomy,
        p_type AS phylum, p_brand AS class, split_part(p_name, ' ', 2) AS genus, p_size AS size, p_name AS name
        FROM part""",
    "branch": """SELECT 't:' || p_type AS branch_id, p_partkey AS feature_id, CAST(3 AS DOUBLE) AS length FROM part
        UNION ALL SELECT 'b:' || p_type || '|' || p_brand, p_partkey, 2 FROM part
        UNION ALL SELECT 'p:' || p_partkey, p_partkey, 1 FROM part""",
    "fac": """SELECT s_suppkey AS facility_id, s_name AS facility, 'type' || (s_suppkey % 5) AS facility_type,
        s_suppkey % 3 AS source, s_suppkey % 2 = 0 AS is_nuclear,
        (s_suppkey * 3701 % 18000) / CAST(100 AS DOUBLE) - 90 AS lat,
        (s_suppkey * 9103 % 36000) / CAST(100 AS DOUBLE) - 180 AS lon FROM supplier""",
    "ev": """SELECT user_id AS subject, CAST(ts AS DATE) AS day, event_type AS feature_id,
        CAST(COUNT(*) AS DOUBLE) AS count FROM events GROUP BY 1, 2, 3""",
}


def cte(*names: str, **extra: str) -> str:
    """WITH clause holding the named fixtures and any extra CTEs, in order."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{k} AS ({v})" for k, v in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"
