"""Compositional transforms. Absent features enter in closed form: every transform gives the value of the present rows and,
per sample, the one value that all absent features of that sample share."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Window as W, functions as F

from meadow.operators.kernels import exact_quantiles, small, value_ranks
from meadow.operators.table import with_share
from meadow.sources.tables import cut_lineage


def feature_count(ab: DataFrame) -> int:
    """Number of distinct features: one number to the driver."""
    return ab.select("feature_id").distinct().count()


def clr(ab: DataFrame, p: int | None = None, pseudocount: float = 1.0) -> DataFrame:
    """sample_id, feature_id, clr, zero_clr: log(x + c) minus the sample's mean over all p features."""
    p = p or feature_count(ab)
    lx = F.log(F.col("count") + pseudocount)
    lc = F.log(F.lit(float(pseudocount)))
    mean = ab.groupBy("sample_id").agg(((F.sum(lx) + (F.lit(p) - F.count(F.lit(1))) * lc) / p).alias("_m"))
    return ab.join(mean, "sample_id").select("sample_id", "feature_id", (lx - F.col("_m")).alias("clr"), (lc - F.col("_m")).alias("zero_clr"))


def rclr(ab: DataFrame) -> DataFrame:
    """log of present counts minus their sample mean; absent stays absent."""
    mean = ab.groupBy("sample_id").agg(F.avg(F.log("count")).alias("_m"))
    return ab.join(mean, "sample_id").select("sample_id", "feature_id", (F.log("count") - F.col("_m")).alias("rclr"))


def replace_zeros(ab: DataFrame, p: int | None = None) -> DataFrame:
    """Multiplicative replacement on closed rows: zeros become delta = 1/p^2, the rest shrinks. Adds zero_value."""
    p = p or feature_count(ab)
    delta = (1.0 / p) ** 2
    s = ab.groupBy("sample_id").agg(F.sum("count").alias("_t"), (F.lit(p) - F.count(F.lit(1))).alias("_z"))
    value = F.col("count") / F.col("_t") * (1 - F.col("_z") * delta)
    return ab.join(s, "sample_id").select("sample_id", "feature_id", value.alias("value"), F.lit(delta).alias("zero_value"))


def alr(ab: DataFrame, reference, p: int | None = None) -> DataFrame:
    """log ratio to a reference feature after zero replacement: present rows and the sample's zero_alr."""
    r = replace_zeros(ab, p)
    ref = r.groupBy("sample_id").agg(F.coalesce(F.max(F.when(F.col("feature_id") == reference, F.col("value"))), F.max("zero_value")).alias("_ref"))
    return (r.join(ref, "sample_id").filter(F.col("feature_id") != reference)
            .select("sample_id", "feature_id", (F.log("value") - F.log("_ref")).alias("alr"), (F.log("zero_value") - F.log("_ref")).alias("zero_alr")))


def dense_grid(samples: DataFrame, features: DataFrame, chunks: int = 64) -> DataFrame:
    """Every sample with every kept feature, as an equi join on feature chunks, so the grid is built by many tasks."""
    f = features.select("feature_id", F.pmod(F.xxhash64("feature_id"), F.lit(chunks)).alias("_ch"))
    s = samples.select("sample_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("_ch"))
    return s.join(f, "_ch").drop("_ch")


DENSE_FEATURES = 4096  # kept features up to which the cells of a sample are one row on their way


def with_zeros(ab: DataFrame, value: str, zero: str, features: DataFrame | None = None) -> DataFrame:
    """Dense (sample, feature, value) over kept features; absent cells take the sample's zero column.

    With up to DENSE_FEATURES features a sample's cells meet once and its missing ones are added there; beyond, the grid is joined."""
    feats = cut_lineage((features if features is not None else ab).select("feature_id").distinct())
    if feats.count() <= DENSE_FEATURES:
        cell = lambda f, x: F.struct(f.alias("feature_id"), x.alias("x"))
        kept = F.when(F.col("_kept"), cell(F.col("feature_id"), F.col(value)))
        s = (ab.join(F.broadcast(feats.withColumn("_kept", F.lit(True))), "feature_id", "left")
             .groupBy("sample_id").agg(F.first(zero).alias("_z"), F.collect_list(kept).alias("_have"))
             .crossJoin(F.broadcast(feats.agg(F.collect_list("feature_id").alias("_every")))))
        absent = F.transform(F.array_except("_every", F.transform("_have", lambda c: c["feature_id"])), lambda f: cell(f, F.col("_z")))
        return (s.select("sample_id", "_z", F.explode(F.concat("_have", absent)).alias("c"))
                .select("sample_id", "c.feature_id", F.coalesce("c.x", "_z").alias(value)))
    zeros = ab.groupBy("sample_id").agg(F.first(zero).alias("_z"))
    grid = dense_grid(ab.select("sample_id").distinct(), feats)
    return (grid.join(zeros, "sample_id").join(ab.select("sample_id", "feature_id", value), ["sample_id", "feature_id"], "left")
            .select("sample_id", "feature_id", F.coalesce(value, "_z").alias(value)))


def clr_dense(ab: DataFrame, features: DataFrame | None = None, p: int | None = None, pseudocount: float = 1.0) -> DataFrame:
    """Dense CLR values over kept features. The table is written once, as its features, means and cells are asked for."""
    ab = cut_lineage(ab.select("sample_id", "feature_id", "count"))
    return with_zeros(clr(ab, p, pseudocount), "clr", "zero_clr", features if features is not None else ab)


def ilr(ab: DataFrame) -> DataFrame:
    """Orthonormal log ratios over features in id order: coordinate i compares the mean log of the first i features with
    the next one. Dense in the features, so meant for an aggregated or filtered table."""
    dense = with_zeros(replace_zeros(ab), "value", "zero_value").withColumn("l", F.log("value"))
    w = W.partitionBy("sample_id").orderBy("feature_id")
    i = F.row_number().over(w) - 1
    before = F.avg("l").over(w.rowsBetween(W.unboundedPreceding, -1))
    out = dense.select("sample_id", "feature_id", i.alias("coordinate"), (F.sqrt(i / (i + 1.0)) * (before - F.col("l"))).alias("ilr"))
    return out.filter("coordinate > 0").select("sample_id", "coordinate", "ilr")


def check_closed(ab: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Samples whose values do not sum to 1."""
    s = ab.groupBy("sample_id").agg(F.sum("count").alias("total"))
    return s.filter(F.abs(F.col("total") - 1) > tolerance)


def check_clr_centered(c: DataFrame, p: int, tolerance: float = 1e-3) -> DataFrame:
    """Samples whose CLR values (with zeros) do not sum to 0."""
    s = c.groupBy("sample_id").agg((F.sum("clr") + (F.lit(p) - F.count(F.lit(1))) * F.first("zero_clr")).alias("total"))
    return s.filter(F.abs("total") > tolerance)


def batch_variance_audit(ab: DataFrame, batches: DataFrame, value: str = "count", zero: str | None = None, min_samples: int = 5,
                         max_zero_var: float = 0.9) -> DataFrame:
    """batch, n, zero_var_fraction, passed: batches with too few samples or too many near-constant features fail.

    `zero` names a per-sample column with the value of absent cells (CLR); without it absent cells are 0. Features
    absent from a batch have one value only when the zero value is constant, so their variance comes from the zeros.
    """
    z = F.col(zero) if zero else F.lit(0.0)
    j = ab.join(batches.select("sample_id", "batch"), "sample_id")
    per_sample = ab.groupBy("sample_id").agg(F.first(z).alias("_z")) if zero else None
    size = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    if zero:
        zs = batches.join(per_sample, "sample_id").groupBy("batch").agg(F.sum("_z").alias("sz"), F.sum(F.col("_z") ** 2).alias("szz"))
        size = size.join(zs, "batch")
    else:
        size = size.withColumns({"sz": F.lit(0.0), "szz": F.lit(0.0)})
    x = F.col(value)
    m = j.groupBy("batch", "feature_id").agg(F.sum(x - z).alias("s"), F.sum(x * x - z * z).alias("ss"))
    v = m.join(size, "batch").withColumn("var", (F.col("ss") + F.col("szz") - (F.col("s") + F.col("sz")) ** 2 / F.col("n")) / (F.col("n") - 1))
    p = ab.select("feature_id").distinct().agg(F.count(F.lit(1)).alias("p"))
    live = v.groupBy("batch").agg(F.count_if(F.col("var") >= 1e-6).alias("varying"), F.count(F.lit(1)).alias("seen"))
    out = size.join(live, "batch", "left").crossJoin(F.broadcast(p)).fillna(0, ["varying", "seen"])
    zero_var = (F.col("szz") - F.col("sz") ** 2 / F.col("n")) / (F.col("n") - 1)
    varying = F.col("varying") + F.when(zero_var >= 1e-6, F.col("p") - F.col("seen")).otherwise(0)
    frac = 1 - varying / F.col("p")
    return out.select("batch", "n", frac.alias("zero_var_fraction"), ((F.col("n") >= min_samples) & (frac <= max_zero_var)).alias("passed"))


def batch_center(ab: DataFrame, batches: DataFrame, min_samples: int = 5) -> DataFrame:
    """CLR of present rows minus the batch mean of the feature (absent samples of the batch counted), passing batches only."""
    c = clr(ab)
    ok = batch_variance_audit(c, batches, "clr", "zero_clr", min_samples).filter("passed").select("batch")
    b = batches.join(ok, "batch", "left_semi").select("sample_id", "batch")
    zs = c.groupBy("sample_id").agg(F.first("zero_clr").alias("z")).join(b, "sample_id").groupBy("batch").agg(F.sum("z").alias("sz"), F.count(F.lit(1)).alias("n"))
    j = c.join(b, "sample_id")
    mean = (j.groupBy("batch", "feature_id").agg(F.sum(F.col("clr") - F.col("zero_clr")).alias("s")).join(zs, "batch")
            .select("batch", "feature_id", ((F.col("s") + F.col("sz")) / F.col("n")).alias("m")))
    return j.join(mean, ["batch", "feature_id"]).select("sample_id", "feature_id", "batch", (F.col("clr") - F.col("m")).alias("value"))


def percentile_normalize(ab: DataFrame, batches: DataFrame) -> DataFrame:
    """Value -> global quantile at the value's percentile inside its batch, zeros included; batches of one keep values.

    Works on value histograms. Quantile positions meet the global histogram through buckets of positions, an equi join.
    """
    j = cut_lineage(ab.join(batches.select("sample_id", "batch"), "sample_id"))
    size = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    n = batches.count()
    keys = j.select("feature_id").distinct()
    totals = dense_pairs(keys, size)
    local = value_ranks(j, ["feature_id", "batch"], "count", totals=totals).join(size, "batch")
    pos = local.select("feature_id", "batch", "value", ((n - 1) * F.col("rank") / F.col("n")).alias("pos"))
    glob = value_ranks(j, ["feature_id"], "count", n=n)
    width = 1024
    hi = F.col("rank") + (F.col("cnt") - 1) / 2.0 - 1
    g = glob.select("feature_id", F.col("value").alias("g"), (hi - F.col("cnt") + 1).cast("long").alias("lo"), hi.cast("long").alias("hi"))
    g = g.withColumn("_b", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))

    def at(p, name):
        q = pos.select("feature_id", p.cast("long").alias("k")).distinct().withColumn("_b", F.floor(F.col("k") / width))
        return q.join(g, ["feature_id", "_b"]).filter("k between lo and hi").select("feature_id", F.col("k").alias(f"k_{name}"), F.col("g").alias(name))

    low, high = F.floor(F.col("pos")), F.least(F.ceil(F.col("pos")), F.lit(n - 1))
    q = pos.withColumns({"k_low": low.cast("long"), "k_high": high.cast("long")})
    q = q.join(at(low, "low"), ["feature_id", "k_low"]).join(at(high, "high"), ["feature_id", "k_high"])
    new = q.select("feature_id", "batch", "value", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("pos") - F.col("k_low"))).alias("new"))
    out = j.join(new.withColumnRenamed("value", "count"), ["feature_id", "batch", "count"], "left").join(size, "batch")
    return out.select("sample_id", "feature_id", F.when(F.col("n") < 2, F.col("count")).otherwise(F.col("new")).alias("count"))


def dense_pairs(features: DataFrame, groups: DataFrame) -> DataFrame:
    """features x groups with the group's size n; groups are the few labels of a design."""
    return features.crossJoin(small(groups))


def encode_covariates(meta: DataFrame, cols: list[str], one_hot: bool = True, max_categories: int = 1000) -> DataFrame:
    """Numeric covariates with the median for nulls, categories with Unknown, one-hot without the first level or as codes.

    Columns more than half empty or with too many levels are left out with a warning that names them and the reason; levels (at
    most max_categories) go to the driver.
    """
    types = dict(meta.dtypes)
    row = meta.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"n_{c}") for c in cols],
                   *[F.count_distinct(F.col(c)).alias(f"u_{c}") for c in cols]).first()
    out = [F.col("sample_id")]
    for c in cols:
        if row["_n"] - row[f"n_{c}"] > 0.5 * row["_n"]:
            warnings.warn(f"covariate {c} left out: more than half of its values are null", stacklevel=2)
            continue
        if types[c] in ("double", "float", "int", "bigint"):
            med = exact_quantiles(meta, [], c, {"m": 0.5}).first()["m"]
            out.append(F.coalesce(F.col(c).cast("double"), F.lit(med)).alias(c))
        elif row[f"u_{c}"] <= max_categories:
            v = F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))
            levels = sorted(r[0] for r in meta.select(v.alias("v")).distinct().collect())
            if one_hot:
                out += [(v == x).cast("int").alias(f"{c}_{x}") for x in levels[1:]]
            else:
                out.append(F.coalesce(*[F.when(v == x, i) for i, x in enumerate(levels)]).alias(c))
        else:
            warnings.warn(f"covariate {c} left out: {row[f'u_{c}']} levels, at most {max_categories} are encoded", stacklevel=2)
    return meta.select(*out)
