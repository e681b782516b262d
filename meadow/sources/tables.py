"""Readers, writers and ingestion of count tables and metadata."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared spark.checkpoint.dir. Where that is unset, a session on one machine gets a
    temporary folder, kept for the session; on a cluster it is an error, as executors could not read each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="meadow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; sets a local one only where none is configured."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(work_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Parquet in the shared folder, read back. For tables that a loop joins with themselves: a checkpoint keeps the size that was
    estimated for the plan that made it, joins multiply these, and after some rounds the number alone fills the driver's memory."""
    path = work_folder(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table of written() that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_abundance(spark: SparkSession, path: str, sample: str = "sample_id", feature: str = "feature_id",
                   count: str = "count") -> DataFrame:
    """Parquet count table with the contract's column names; zero and null counts are dropped."""
    df = spark.read.parquet(path)
    return (df.select(F.col(sample).alias("sample_id"), F.col(feature).alias("feature_id"),
                      F.col(count).cast("double").alias("count")).filter(F.col("count") > 0))


def read_metadata(spark: SparkSession, path: str, fmt: str = "tsv") -> DataFrame:
    """Metadata with every column as text. fmt: tsv, csv or parquet."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return spark.read.csv(path, sep="\t" if fmt == "tsv" else ",", header=True, inferSchema=False)


def tidy_names(df: DataFrame) -> DataFrame:
    """Column names lower-cased and trimmed."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def merge_metadata(*frames: DataFrame) -> DataFrame:
    """Stack metadata tables after tidying names; missing columns become null."""
    out = tidy_names(frames[0])
    for f in frames[1:]:
        out = out.unionByName(tidy_names(f), allowMissingColumns=True)
    return out


def merge_tables(*tables: DataFrame) -> DataFrame:
    """Outer merge of count tables: equal (sample, feature) ids are summed."""
    out = tables[0].select("sample_id", "feature_id", "count")
    for t in tables[1:]:
        out = out.unionByName(t.select("sample_id", "feature_id", "count"))
    return out.groupBy("sample_id", "feature_id").agg(F.sum("count").alias("count"))


def merge_feature_meta(*tables: DataFrame) -> DataFrame:
    """Feature metadata of several tables; the first table that has a feature keeps its row."""
    cols = [c for c in tables[0].columns if c != "feature_id"]
    out = None
    for i, t in enumerate(tables):
        t = t.select("feature_id", F.struct(*cols).alias("m"), F.lit(i).alias("ord"))
        out = t if out is None else out.unionByName(t)
    return out.groupBy("feature_id").agg(F.min_by("m", "ord").alias("m")).select("feature_id", "m.*")


def to_wide(abundance: DataFrame, features: list) -> DataFrame:
    """Samples x features frame for an explicit feature list, 0 where absent."""
    return abundance.groupBy("sample_id").pivot("feature_id", features).agg(F.sum("count")).fillna(0.0)


def to_long(wide: DataFrame, key: str = "sample_id") -> DataFrame:
    """Back to (sample, feature, count > 0)."""
    values = [c for c in wide.columns if c != key]
    return (wide.unpivot([key], [F.col(f"`{c}`").cast("double").alias(c) for c in values], "feature_id", "count")
            .filter(F.col("count") > 0))


def partition_subsets(runs: DataFrame, study: str, layout: str, platform: str, region: str) -> DataFrame:
    """subset_id = STUDY.LAYOUT.PLATFORM.REGION in upper case."""
    return runs.withColumn("subset_id", F.upper(F.concat_ws(".", *[F.col(c) for c in (study, layout, platform, region)])))


def write_partitioned(df: DataFrame, path: str, *cols: str, max_records: int = 5_000_000) -> None:
    """One folder per value of cols, every row kept; a hot value is cut into several files."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(*cols).parquet(path)


def write_by_location(df: DataFrame, path: str) -> None:
    """One output per query location."""
    write_partitioned(df, path, "query_lat", "query_lon")


def export_long(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a long table as parquet or TSV."""
    w = df.write.mode("overwrite")
    w.parquet(path) if fmt == "parquet" else w.csv(path, sep="\t", header=True)


def manifest(paths: DataFrame, layout: str = "paired") -> DataFrame:
    """paths(sample_id, path) -> one row per sample with one or two read paths in path order.

    Samples with fewer paths than the layout needs are left out.
    """
    known = paths.filter(F.col("path").isNotNull() & (F.col("path") != ""))
    two = known.groupBy("sample_id").agg(F.min("path").alias("first"), F.count(F.lit(1)).alias("n"))
    if layout != "paired":
        return two.select("sample_id", F.col("first").alias("absolute_filepath"))
    rest = (known.join(two, "sample_id").filter(F.col("path") > F.col("first"))
            .groupBy("sample_id").agg(F.min("path").alias("reverse")))
    return two.join(rest, "sample_id").select(
        "sample_id", F.col("first").alias("forward_filepath"), F.col("reverse").alias("reverse_filepath"))
