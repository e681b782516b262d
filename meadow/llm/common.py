"""Helpers shared by the operators of this subpackage: written tables, global order, connected components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from meadow.sources.tables import work_folder

#: A word is a maximal run of characters other than space and the five ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression that names a value, so that it is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def settle(df: DataFrame, purpose: str = "table") -> DataFrame:
    """Write to the shared folder and read back: lineage is cut, and the planner knows the size."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table that settle() wrote and nothing reads any more: what came of it must be written itself."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._settled_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[Column], out: str = "pos") -> DataFrame:
    """Adds the 0-based position of every row in the order of unique keys, without a window over all rows.

    Rows are range-partitioned and written; each part is numbered on its own and gets the count of the parts before it.
    Null keys come first unless `order` says otherwise. The only table ordered in one task has one row per part.
    """
    named = df.select("*", *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [F.col(f"_o{i}") for i in range(len(order))]
    parts = settle(named.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "order")
    return number_parts(parts, keys, out).drop("_part", *[f"_o{i}" for i in range(len(order))])


def number_parts(parts: DataFrame, keys: list[Column], out: str) -> DataFrame:
    """Positions of rows of a table whose column `_part` counts ranges of the order."""
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return (parts.withColumn("_own", own).join(starts, "_part")
            .withColumn(out, F.col("_start") + F.col("_own") - 1).drop("_own", "_start"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node reachable.

    Alternates large-star and small-star rounds on a table of edges that point to smaller nodes until nothing
    changes. Minima merge before the shuffle; the joins back are plain, so that skewed nodes can be split.
    Loops, repeated edges and rows with a null end are ignored; an empty input gives an empty result.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())
    e = settle(e, "edges")
    mark = _mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, e = e, settle(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        forget(last)
        before, mark = mark, _mark(e)
        if mark == before:
            break
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_memory(name: str, make: Callable[[], object]) -> object:
    """What `make` gives, made once per worker process and kept between its tasks, in a module of this package's own.

    Functions travel to the executors by value, so that globals of theirs would be new in every task."""
    held = sys.modules.setdefault("_meadow_worker", types.ModuleType("_meadow_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
