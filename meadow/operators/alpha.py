"""Alpha diversity: per-sample aggregates over present rows, absent features enter in closed form."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from meadow.operators.kernels import exact_quantiles, running_total
from meadow.operators.table import with_share
from meadow.sources.tables import cut_lineage
from meadow.functions.tails import p_absent


def shannon(ab: DataFrame) -> DataFrame:
    """Shannon entropy (natural log): ln N - sum(n ln n) / N, so one aggregate and no join back to totals."""
    return (ab.groupBy("sample_id")
            .agg(F.sum("count").alias("t"), F.sum(F.col("count") * F.log("count")).alias("nl"))
            .select("sample_id", (F.log("t") - F.col("nl") / F.col("t")).alias("shannon")))


def richness(ab: DataFrame) -> DataFrame:
    """observed_features, shannon, pielou; a log S of 0 divides by 1."""
    g = ab.groupBy("sample_id").agg(F.count(F.lit(1)).alias("observed_features"), F.sum("count").alias("t"),
                                    F.sum(F.col("count") * F.log("count")).alias("nl"))
    h = F.log("t") - F.col("nl") / F.col("t")
    ls = F.when(F.col("observed_features") > 1, F.log("observed_features")).otherwise(1.0)
    return g.select("sample_id", "observed_features", h.alias("shannon"), (h / ls).alias("pielou"))


def alpha_metrics(ab: DataFrame, rare: int = 10) -> DataFrame:
    """simpson, dominance, berger_parker, mcintosh, chao1, ace, goods_coverage, heip_evenness per sample."""
    c = F.col("count")
    few = c <= rare
    g = ab.groupBy("sample_id").agg(
        F.count(F.lit(1)).cast("double").alias("s"), F.sum("count").alias("n"), F.sum(c * c).alias("n2"),
        F.max("count").alias("mx"), F.sum(c * F.log("count")).alias("nl"),
        F.count_if(c == 1).cast("double").alias("f1"), F.count_if(c == 2).cast("double").alias("f2"),
        F.count_if(few).cast("double").alias("s_rare"), F.sum(F.when(few, c).otherwise(0.0)).alias("n_rare"),
        F.sum(F.when(few, c * (c - 1)).otherwise(0.0)).alias("ff"))
    col = F.col
    dom = col("n2") / (col("n") * col("n"))
    h = F.log("n") - col("nl") / col("n")
    chao = col("s") + col("f1") * (col("f1") - 1) / (2 * (col("f2") + 1))
    cov = 1 - F.try_divide(col("f1"), col("n_rare"))
    rare_part = F.try_divide(col("s_rare"), cov)
    gamma = F.greatest(F.try_divide(rare_part * col("ff"), col("n_rare") * (col("n_rare") - 1)) - 1, F.lit(0.0))
    ace = (col("s") - col("s_rare")
           + F.coalesce(rare_part + F.try_divide(col("f1"), cov) * gamma, rare_part, col("s_rare")))
    return g.select(
        "sample_id", (1 - dom).alias("simpson"), dom.alias("dominance"), (col("mx") / col("n")).alias("berger_parker"),
        F.coalesce(F.try_divide(col("n") - F.sqrt("n2"), col("n") - F.sqrt("n")), F.lit(0.0)).alias("mcintosh"),
        chao.alias("chao1"), ace.alias("ace"), (1 - col("f1") / col("n")).alias("goods_coverage"),
        F.coalesce(F.try_divide(F.exp(h) - 1, col("s") - 1), F.lit(0.0)).alias("heip_evenness"))


def gini(ab: DataFrame) -> DataFrame:
    """Gini index over present features from the value histogram: ties share one row, no per-sample sort of rows."""
    hist = ab.groupBy("sample_id", "count").agg(F.count(F.lit(1)).alias("k"))
    run = running_total(hist, ["sample_id"], "count", "k", "hi")
    place = F.col("hi") - (F.col("k") - 1) / 2.0
    g = run.groupBy("sample_id").agg(F.sum(F.col("k") * F.col("count") * place).alias("w"), F.sum("k").alias("n"),
                                     F.sum(F.col("k") * F.col("count")).alias("t"))
    return g.select("sample_id", (2 * F.col("w") / (F.col("n") * F.col("t")) - (F.col("n") + 1) / F.col("n")).alias("gini"))


def faith_pd(ab: DataFrame, branch: DataFrame) -> DataFrame:
    """Total length of branches with any present leaf."""
    hit = ab.join(branch, "feature_id").groupBy("sample_id", "branch_id").agg(F.max("length").alias("length"))
    return hit.groupBy("sample_id").agg(F.sum("length").alias("faith_pd"))


def phylo_entropy(ab: DataFrame, branch: DataFrame) -> DataFrame:
    """Sum of -p ln p x root distance of the leaf."""
    depth = branch.groupBy("feature_id").agg(F.sum("length").alias("depth"))
    p = with_share(ab).join(depth, "feature_id")
    return p.groupBy("sample_id").agg(F.sum(-F.col("share") * F.log("share") * F.col("depth")).alias("phylo_entropy"))


def rarefy(ab: DataFrame, depth: int, seed: int = 42, blocks: int = 64) -> DataFrame:
    """Subsample each sample to `depth` reads without replacement; samples with fewer reads are returned unchanged.

    Counts are taken as whole reads (fractions are cut off, cells without a read are left out). A sample's depth is dealt
    over hash blocks of features by a multivariate hypergeometric draw, then over the features of a block by another,
    so there is no row per read and a wide sample is many groups. Draws are seeded by sample, block and `seed` alone.
    """
    whole = ab.select("sample_id", "feature_id", F.floor("count").cast("long").alias("n")).filter("n > 0")
    whole = whole.withColumn("block", F.pmod(F.xxhash64("feature_id"), F.lit(blocks)).cast("int"))
    cells = cut_lineage(whole.groupBy("sample_id", "block").agg(F.sort_array(F.collect_list(F.struct("feature_id", "n"))).alias("c"), F.sum("n").alias("n")))
    sums = cells.select("sample_id", "block", "n")
    per = sums.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("block", "n"))).alias("b"), F.sum("n").alias("t"))
    rng = F.xxhash64("sample_id", F.lit(seed))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def deal(counts: pd.Series, key: pd.Series) -> pd.Series:
        def draw(c, k):
            c = np.asarray(c, np.int64)
            size = min(depth, int(c.sum()))
            if len(c) == 1 or size == c.sum():
                return c if size == c.sum() else np.array([size])
            return np.random.default_rng(k % 2**63).multivariate_hypergeometric(c, size, method="marginals")

        return pd.Series([draw(c, k) for c, k in zip(counts, key)])

    share = per.withColumn("d", deal(F.transform("b", lambda x: x["n"]), rng))
    share = share.select("sample_id", F.explode(F.arrays_zip(F.transform("b", lambda x: x["block"]).alias("block"), F.col("d"))).alias("x")).select(
        "sample_id", "x.block", F.col("x.d").alias("d"))
    share = cut_lineage(share.filter("d > 0"))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def inside(counts: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        draw = lambda c, d, k: np.random.default_rng(k % 2**63).multivariate_hypergeometric(np.asarray(c, np.int64), int(d), method="marginals")
        return pd.Series([draw(c, d, k) for c, d, k in zip(counts, size, key)])

    j = cells.join(share, ["sample_id", "block"])
    # Only blocks of several features that are taken in part need a draw.
    drawn = (F.size("c") > 1) & (F.col("d") < F.col("n"))
    counts = F.transform("c", lambda x: x["n"])
    part = j.filter(drawn).withColumn("k", inside(counts, "d", F.xxhash64("sample_id", "block", F.lit(seed))))
    j = j.filter(~drawn).withColumn("k", F.when(F.size("c") == 1, F.array("d")).otherwise(counts)).unionByName(part)
    out = j.select("sample_id", F.explode(F.arrays_zip(F.transform("c", lambda x: x["feature_id"]).alias("f"), F.col("k"))).alias("x"))
    return out.select("sample_id", F.col("x.f").alias("feature_id"), F.col("x.k").cast("double").alias("count")).filter("count > 0")


def rarefaction_curve(ab: DataFrame, depths: list[int]) -> DataFrame:
    """Expected richness at each depth: sum over features of 1 - C(N - n, d) / C(N, d), exact.

    Equal counts of a sample share one probability, so the Arrow function sees (sample, count) histogram rows.
    """
    hist = ab.groupBy("sample_id", "count").agg(F.count(F.lit(1)).alias("k"))
    tot = ab.groupBy("sample_id").agg(F.sum("count").alias("total"))
    grid = F.explode(F.array(*[F.lit(float(x)) for x in depths]))
    rows = hist.join(tot, "sample_id").withColumn("depth", grid).filter(F.col("depth") <= F.col("total"))
    p = rows.withColumn("seen", F.col("k") * (1 - p_absent("total", "count", "depth")))
    return p.groupBy("sample_id", F.col("depth").cast("int").alias("depth")).agg(F.sum("seen").alias("expected_richness"))


def depth_adequacy(curve: DataFrame, plateau: float = 0.95) -> DataFrame:
    """Share of the mean of the last fifth of the curve in its end value; adequate at the plateau threshold."""
    n = curve.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.max_by("expected_richness", "depth").alias("last"),
                                       F.sort_array(F.collect_list(F.struct("depth", "expected_richness"))).alias("c"))
    start = F.floor(F.col("n") * 0.8).cast("int")
    tail = F.transform(F.slice("c", start + 1, F.col("n").cast("int") - start), lambda x: x["expected_richness"])
    mean = F.aggregate(tail, F.lit(0.0), lambda acc, x: acc + x) / F.size(tail)
    ratio = F.col("last") / (mean + 1e-10)
    return n.select("sample_id", ratio.alias("plateau_ratio"), (ratio >= plateau).alias("adequate"))


def suggest_depth(ab: DataFrame, quantile: float = 0.1) -> DataFrame:
    """The depth quantile over samples, rounded down."""
    tot = ab.groupBy("sample_id").agg(F.sum("count").alias("total"))
    return exact_quantiles(tot, [], "total", {"depth": quantile}).select(F.floor("depth").cast("long").alias("depth"))


def alpha_vs_metadata(values: DataFrame, meta: DataFrame, numeric: list[str], categories: list[str]) -> DataFrame:
    """metric, column, test, statistic, p_value for values(sample_id, metric, value).

    Spearman for numbers, Mann-Whitney for two groups, Kruskal-Wallis for more; all metrics of a column in one plan.
    """
    from meadow.operators import stats
    # Every test reads both tables several times; the diversity behind the values is worked out once.
    v = cut_lineage(values.select("sample_id", F.col("metric").alias("feature_id"), F.col("value").cast("double").alias("count")))
    live = cut_lineage(meta.join(v.select("sample_id").distinct(), "sample_id", "left_semi"))
    out = None
    for c in numeric:
        s = stats.spearman_features(v, live, c)
        one = s.select(F.col("feature_id").alias("metric"), F.lit(c).alias("column"), F.lit("spearman").alias("test"), F.col("rho").alias("statistic"), "p_value")
        out = one if out is None else out.unionByName(one)
    for c in categories:
        lab = stats.labelled(live, c)
        names = sorted(r[0] for r in lab.select("group").distinct().limit(3).collect())
        if len(names) < 2:
            continue
        if len(names) == 2:
            s = stats.mann_whitney(v, lab, tuple(names), zeros=False, medians=False).withColumnRenamed("u", "statistic")
        else:
            s = stats.kruskal(v, lab, zeros=False).withColumnRenamed("h", "statistic")
        one = s.select(F.col("feature_id").alias("metric"), F.lit(c).alias("column"), F.lit("mann_whitney" if len(names) == 2 else "kruskal").alias("test"), "statistic", "p_value")
        out = one if out is None else out.unionByName(one)
    return out
