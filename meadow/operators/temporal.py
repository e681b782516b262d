"""Time series of communities: table(subject, ts, feature_id, count) unless said otherwise.

Consecutive samples meet through an equi join on (subject, feature, step), so only neighbours in time are paired.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window as W, functions as F

from meadow.operators.kernels import exact_quantiles
from meadow.sources.tables import cut_lineage


def temporal_structure(samples: DataFrame, subject: str = "subject", ts: str = "ts") -> DataFrame:
    """n_subjects, n_timepoints, n_repeated, is_longitudinal from (subject, ts) sample rows."""
    g = samples.groupBy(subject).agg(F.count(F.lit(1)).alias("c"))
    s = g.agg(F.count(F.lit(1)).alias("n_subjects"), F.count_if(F.col("c") > 1).alias("n_repeated"))
    t = samples.select(ts).distinct().agg(F.count(F.lit(1)).alias("n_timepoints"))
    return s.crossJoin(t).withColumn("is_longitudinal", F.col("n_repeated") > 0)


def with_step(table: DataFrame) -> DataFrame:
    """Adds step = 1, 2, ... of the time inside its subject; ranked on the distinct times only."""
    times = table.select("subject", "ts").distinct()
    step = F.row_number().over(W.partitionBy("subject").orderBy("ts"))
    return cut_lineage(table.join(times.withColumn("step", step), ["subject", "ts"]))


def turnover(table: DataFrame) -> DataFrame:
    """subject, step, turnover (1 - Jaccard), gains, losses against the previous time."""
    t = with_step(table.filter("count > 0"))
    size = t.groupBy("subject", "step").agg(F.count_distinct("feature_id").alias("n"))
    prev = t.select("subject", "feature_id", (F.col("step") + 1).alias("step"))
    shared = t.select("subject", "feature_id", "step").join(prev, ["subject", "feature_id", "step"]).groupBy("subject", "step").agg(F.count_distinct("feature_id").alias("s"))
    before = size.select("subject", (F.col("step") + 1).alias("step"), F.col("n").alias("m"))
    j = size.join(before, ["subject", "step"]).join(shared, ["subject", "step"], "left").fillna(0, ["s"])
    return j.select("subject", "step", (1 - F.col("s") / (F.col("n") + F.col("m") - F.col("s"))).alias("turnover"),
                    (F.col("n") - F.col("s")).alias("gains"), (F.col("m") - F.col("s")).alias("losses"))


def stability_index(table: DataFrame, keys: list[str], value: str = "count", log_transform: bool = True) -> DataFrame:
    """max(0, 1 - CV / 2) over positive values; 0 for fewer than two."""
    x = F.log10(F.col(value) + 1) if log_transform else F.col(value)
    g = table.filter(F.col(value) > 0).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(x).alias("m"), F.stddev_pop(x).alias("s"))
    return g.select(*keys, F.when(F.col("n") < 2, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("s") / F.col("m") / 2)).alias("stability"))


def community_stability(table: DataFrame) -> DataFrame:
    """subject, stability_score = 1 - mean Bray-Curtis of consecutive samples."""
    t = with_step(table)
    tot = t.groupBy("subject", "step").agg(F.sum("count").alias("t"))
    prev = t.select("subject", "feature_id", (F.col("step") + 1).alias("step"), F.col("count").alias("p"))
    mins = t.join(prev, ["subject", "feature_id", "step"]).groupBy("subject", "step").agg(F.sum(F.least("count", "p")).alias("m"))
    before = tot.select("subject", (F.col("step") + 1).alias("step"), F.col("t").alias("u"))
    d = tot.join(before, ["subject", "step"]).join(mins, ["subject", "step"], "left").select("subject", (1 - 2 * F.coalesce("m", F.lit(0.0)) / (F.col("t") + F.col("u"))).alias("d"))
    return d.groupBy("subject").agg((1 - F.avg("d")).alias("stability_score"), F.avg("d").alias("avg_step_distance"))


def autocorrelation(series: DataFrame, keys: list[str], index: str, value: str, max_lag: int = 10, limit: float = 0.2) -> DataFrame:
    """keys, lag, acf, significant of series rows (keys, whole-number index, value): an equi join on index + lag."""
    m = series.groupBy(*keys).agg(F.avg(value).alias("_m"), F.count(F.lit(1)).alias("_n"), (F.var_pop(value) * F.count(F.lit(1))).alias("_c0"))
    x = series.join(m, keys).select(*keys, F.col(index).alias("_i"), (F.col(value) - F.col("_m")).alias("_x"), "_n", "_c0")
    lagged = x.select(*keys, F.col("_x").alias("_y"), F.col("_i").alias("_j"), F.explode(F.sequence(F.lit(1), F.lit(max_lag))).alias("lag"))
    lagged = lagged.withColumn("_i", F.col("_j") + F.col("lag")).drop("_j")
    s = x.join(lagged, [*keys, "_i"]).groupBy(*keys, "lag").agg(F.sum(F.col("_x") * F.col("_y")).alias("_s"), F.max("_c0").alias("_c0"))
    acf = F.try_divide(F.col("_s"), F.col("_c0"))
    return s.select(*keys, "lag", acf.alias("acf"), (F.abs(acf) > limit).alias("significant"))


def recurrent_sets(table: DataFrame, window: int = 3, quantile: float = 0.75) -> DataFrame:
    """features, n_windows: sets of more than two features above the table's quantile (absent cells count as zero) in any
    time of a sliding window, counted over windows.

    Windows with the same set are counted by two sums of hashes; only one window of each distinct set is listed.
    """
    t = with_step(table)
    n = t.select("subject", "step").distinct().count() * t.select("feature_id").distinct().count()
    cut = exact_quantiles(t, [], "count", {"cut": quantile}, n=n)
    last = t.groupBy("subject").agg(F.max("step").alias("last"))
    top = t.crossJoin(F.broadcast(cut)).filter("count > cut").join(last, "subject")
    start = F.explode(F.sequence(F.greatest(F.lit(1), F.col("step") - window + 1), F.col("step")))
    rows = cut_lineage(top.select("subject", "feature_id", "last", start.alias("start")).filter(F.col("start") + window - 1 <= F.col("last"))
                       .select("subject", "start", "feature_id").distinct())
    h = rows.groupBy("subject", "start").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("feature_id").cast("decimal(38,0)")).alias("h1"),
                                             F.sum(F.xxhash64("feature_id", F.lit(7)).cast("decimal(38,0)")).alias("h2")).filter("size > 2")
    g = h.groupBy("size", "h1", "h2").agg(F.count(F.lit(1)).alias("n_windows"), F.min(F.struct("subject", "start")).alias("w"))
    one = g.select("n_windows", "size", F.col("w.subject").alias("subject"), F.col("w.start").alias("start"))
    return rows.join(one, ["subject", "start"]).groupBy("subject", "start", "n_windows", "size").agg(
        F.array_sort(F.collect_list("feature_id")).alias("features")).select("features", "size", "n_windows")


def resilience(table: DataFrame, keys: list[str], at, recovery_window: int = 10) -> DataFrame:
    """impact = 1 - after / before sums around a time, recovery rate = -ln(impact) / window, time to 95 % recovery."""
    g = table.groupBy(*keys).agg(F.sum(F.when(F.col("ts") < at, F.col("count")).otherwise(0.0)).alias("pre"),
                                 F.sum(F.when(F.col("ts") >= at, F.col("count")).otherwise(0.0)).alias("post")).filter("pre > 0")
    impact = 1 - F.col("post") / F.col("pre")
    rate = F.when(impact > 0, -F.log(impact) / recovery_window).otherwise(0.0)
    return g.select(*keys, impact.alias("impact"), rate.alias("recovery_rate"), F.when(rate > 0, -F.log(F.lit(0.05)) / rate).alias("recovery_time"),
                    F.when(rate > 0.1, "Highly resilient").otherwise("Low resilience").alias("interpretation"))


def trajectory_profiles(table: DataFrame, n_features: int) -> DataFrame:
    """subject, mean, slope of the samples' mean abundance (absent features are zeros) over time in days."""
    s = table.groupBy("subject", "ts").agg((F.sum("count") / n_features).alias("y"))
    x = F.unix_seconds(F.col("ts").cast("timestamp")) / 86400.0
    return s.groupBy("subject").agg(F.avg("y").alias("mean"), F.coalesce(F.regr_slope("y", x), F.lit(0.0)).alias("slope"), F.count(F.lit(1)).alias("n")).filter("n >= 2").drop("n")


def trajectory_clusters(table: DataFrame, n_features: int, k: int = 4, seed: int = 42) -> DataFrame:
    """subject, mean, slope, cluster: k-means on scaled mean and slope."""
    v = VectorAssembler(inputCols=["mean", "slope"], outputCol="raw").transform(trajectory_profiles(table, n_features)).persist()
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="features").fit(v).transform(v)
    return KMeans(k=k, seed=seed).fit(scaled).transform(scaled).select("subject", "mean", "slope", F.col("prediction").alias("cluster"))
