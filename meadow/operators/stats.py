"""Feature-wise tests, effect sizes and multiple testing.

Tables are (sample_id, feature_id, count) with absent = 0 and labels (sample_id, group). All features are tested in one
plan; the rank tests work on (feature, value, group) histograms, so a feature present in every sample is a few histogram
rows spread over buckets, never one sorted group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from meadow.functions import tails
from meadow.operators.kernels import exact_quantiles, running_total, small, value_bucket, value_ranks
from meadow.operators.permute import bootstrap_d, maxima, permutation_p
from meadow.sources.tables import cut_lineage


def labelled(labels: DataFrame, group: str = "group") -> DataFrame:
    return labels.filter(F.col(group).isNotNull()).select("sample_id", F.col(group).cast("string").alias("group"))


def group_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("group").agg(F.count(F.lit(1)).alias("ng"))


def group_moments(ab: DataFrame, labels: DataFrame, value: str = "count") -> DataFrame:
    """feature_id, group, ng, mean, var (sample variance), present for every feature and group, zeros counted."""
    x = F.col(value)
    m = ab.join(labels, "sample_id").groupBy("feature_id", "group").agg(
        F.sum(x).alias("s"), F.sum(x * x).alias("ss"), F.count_if(x != 0).alias("present"))
    grid = m.select("feature_id").distinct().crossJoin(small(group_sizes(labels)))
    m = grid.join(m, ["feature_id", "group"], "left").fillna(0, ["s", "ss", "present"])
    mean = F.col("s") / F.col("ng")
    var = F.try_divide(F.greatest(F.col("ss") - F.col("ng") * mean * mean, F.lit(0.0)), F.col("ng") - 1)
    return m.select("feature_id", "group", "ng", mean.alias("mean"), var.alias("var"), "present")


def group_rank_sums(ab: DataFrame, labels: DataFrame, value: str = "count", zeros: bool = True) -> DataFrame:
    """feature_id, group, ng, rank_sum, n, tie: average-rank sums per group, tie = sum of t^3 - t."""
    h = cut_lineage(ab.join(labels, "sample_id").groupBy("feature_id", F.col(value).alias("value"), "group")
                    .agg(F.count(F.lit(1)).alias("cnt")))
    sizes = small(group_sizes(labels))
    grid = h.select("feature_id").distinct().crossJoin(sizes)
    if zeros:
        seen = h.groupBy("feature_id", "group").agg(F.sum("cnt").alias("p"))
        z = grid.join(seen, ["feature_id", "group"], "left").withColumn("cnt", F.col("ng") - F.coalesce("p", F.lit(0)))
        h = h.unionByName(z.filter("cnt > 0").select("feature_id", F.lit(0.0).alias("value"), "group", "cnt"))
        h = h.groupBy("feature_id", "value", "group").agg(F.sum("cnt").alias("cnt"))
    t = h.groupBy("feature_id", "value").agg(F.sum("cnt").alias("t"))
    r = running_total(t, ["feature_id"], "value", "t").withColumn("rank", F.col("cum") - (F.col("t") - 1) / 2.0)
    ties = r.groupBy("feature_id").agg(F.sum("t").alias("n"), F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("tie"))
    sums = h.join(r.select("feature_id", "value", "rank"), ["feature_id", "value"]).groupBy("feature_id", "group").agg(
        F.sum(F.col("cnt") * F.col("rank")).alias("rank_sum"))
    return grid.join(sums, ["feature_id", "group"], "left").fillna(0, ["rank_sum"]).join(ties, "feature_id")


def _two(df: DataFrame, groups: tuple[str, str], cols: list[str]) -> DataFrame:
    """One row per feature with <col>1 and <col>2 for the two groups."""
    pick = lambda c, g: F.max(F.when(F.col("group") == g, F.col(c)))
    return df.filter(F.col("group").isin(*groups)).groupBy("feature_id").agg(
        *[pick(c, g).alias(f"{c}{i + 1}") for c in cols for i, g in enumerate(groups)])


def only(labels: DataFrame, groups: tuple[str, str]) -> DataFrame:
    return labels.filter(F.col("group").isin(*groups))


def prevalent(ab: DataFrame, labels: DataFrame, min_prevalence: float) -> DataFrame:
    """Features present in at least the share of labelled samples."""
    n = labels.agg(F.count(F.lit(1)).alias("n"))
    p = ab.join(labels, "sample_id", "left_semi").groupBy("feature_id").agg(F.count(F.lit(1)).alias("p"))
    return p.crossJoin(F.broadcast(n)).filter(F.col("p") / F.col("n") >= min_prevalence).select("feature_id")


def mann_whitney(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], value: str = "count", zeros: bool = True,
                 medians: bool = True) -> DataFrame:
    """U of the first group, tie-corrected normal p with continuity correction, Cliff's delta, group medians."""
    lab = only(labels, groups)
    r = group_rank_sums(ab, lab, value, zeros)
    t = _two(r, groups, ["ng", "rank_sum"]).join(r.groupBy("feature_id").agg(F.max("n").alias("n"), F.max("tie").alias("tie")), "feature_id")
    n1, n2, n = F.col("ng1"), F.col("ng2"), F.col("n")
    u = F.col("rank_sum1") - n1 * (n1 + 1) / 2.0
    var = n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie"), n * (n - 1)))
    t = t.withColumns({"u": u, "z": F.try_divide(F.greatest(F.abs(u - n1 * n2 / 2.0) - 0.5, F.lit(0.0)), F.sqrt(var))})
    out = t.select("feature_id", "u", tails.p_normal("z").alias("p_value"), (2 * F.col("u") / (n1 * n2) - 1).alias("cliffs_delta"))
    if not medians:
        return out
    med = group_medians(ab, lab, value, zeros)
    return out.join(_two(med, groups, ["median"]).withColumnsRenamed({"median1": "median_group1", "median2": "median_group2"}), "feature_id")


def group_medians(ab: DataFrame, labels: DataFrame, value: str = "count", zeros: bool = True) -> DataFrame:
    """feature_id, group, median from the value histogram, zeros counted."""
    j = ab.join(labels, "sample_id")
    tot = None
    if zeros:
        tot = j.select("feature_id").distinct().crossJoin(small(group_sizes(labels))).withColumnRenamed("ng", "n")
    r = value_ranks(j, ["feature_id", "group"], value, totals=tot)
    size = r.groupBy("feature_id", "group").agg(F.sum("cnt").alias("n"))
    hi = F.col("rank") + (F.col("cnt") - 1) / 2.0
    lo = hi - F.col("cnt") + 1
    mid = lambda k: F.max(F.when((lo <= k) & (hi >= k), F.col("value")))
    a, b = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    return r.join(size, ["feature_id", "group"]).groupBy("feature_id", "group").agg(((mid(a) + mid(b)) / 2.0).alias("median"))


def effect_sizes(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], pseudocount: float = 1.0) -> DataFrame:
    """cohens_d, hedges_g, glass_delta, log2_fc per feature from group moments (first minus second group)."""
    m = _two(group_moments(ab, only(labels, groups)), groups, ["ng", "mean", "var"])
    c = F.col
    pooled = F.sqrt(((c("ng1") - 1) * c("var1") + (c("ng2") - 1) * c("var2")) / (c("ng1") + c("ng2") - 2))
    diff = c("mean1") - c("mean2")
    d = F.when((c("ng1") >= 2) & (c("ng2") >= 2), F.coalesce(F.try_divide(diff, pooled), F.lit(0.0)))
    return m.select("feature_id", d.alias("cohens_d"), (d * (1 - 3 / (4 * (c("ng1") + c("ng2")) - 9))).alias("hedges_g"),
                    F.coalesce(F.try_divide(diff, F.sqrt("var2")), F.lit(0.0)).alias("glass_delta"),
                    F.log2((c("mean1") + pseudocount) / (c("mean2") + pseudocount)).alias("log2_fc"))


# Limits of negligible, small and medium effects.
EFFECT_LIMITS = {"cohens_d": (0.2, 0.5, 0.8), "cliffs_delta": (0.147, 0.33, 0.474), "eta_squared": (0.01, 0.06, 0.14)}


def effect_band(value: Column, kind: str = "cohens_d") -> Column:
    a, b, c = EFFECT_LIMITS[kind]
    v = F.abs(value)
    return F.when(v < a, "negligible").when(v < b, "small").when(v < c, "medium").when(v.isNotNull(), "large")


def t_test(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], equal_var: bool = False, pseudocount: float = 1.0) -> DataFrame:
    """Student or Welch t, p and log2 fold change per feature."""
    m = _two(group_moments(ab, only(labels, groups)), groups, ["ng", "mean", "var"])
    c = F.col
    a, b = c("var1") / c("ng1"), c("var2") / c("ng2")
    if equal_var:
        df = (c("ng1") + c("ng2") - 2).cast("double")
        pooled = ((c("ng1") - 1) * c("var1") + (c("ng2") - 1) * c("var2")) / df
        se = F.sqrt(pooled * (1 / c("ng1") + 1 / c("ng2")))
    else:
        se = F.sqrt(a + b)
        df = F.try_divide((a + b) ** 2, a * a / (c("ng1") - 1) + b * b / (c("ng2") - 1))
    m = m.withColumns({"t": F.try_divide(c("mean1") - c("mean2"), se), "df": df})
    return m.select("feature_id", "t", "df", tails.p_t("t", "df").alias("p_value"),
                    F.log2((c("mean1") + pseudocount) / (c("mean2") + pseudocount)).alias("log2_fc"))


def kruskal(ab: DataFrame, labels: DataFrame, value: str = "count", zeros: bool = True) -> DataFrame:
    """Tie-corrected H, p, eta-squared = (H - k + 1) / (n - k)."""
    r = group_rank_sums(ab, labels, value, zeros)
    g = r.groupBy("feature_id").agg(F.sum(F.col("rank_sum") ** 2 / F.col("ng")).alias("q"), F.max("n").alias("n"),
                                    F.max("tie").alias("tie"), F.count(F.lit(1)).alias("k"))
    n, k = F.col("n").cast("double"), F.col("k")
    h = F.try_divide(12 / (n * (n + 1)) * F.col("q") - 3 * (n + 1), 1 - F.try_divide(F.col("tie"), n ** 3 - n))
    g = g.withColumns({"h": h, "df": (k - 1).cast("double")})
    return g.select("feature_id", "h", tails.p_chi2("h", "df").alias("p_value"), ((F.col("h") - k + 1) / (n - k)).alias("eta_squared"))


def fisher_exact(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], min_samples: int = 5) -> DataFrame:
    """2 x 2 presence counts per feature in two groups, odds ratio and two-sided p; features in >= min_samples samples."""
    m = _two(group_moments(ab, only(labels, groups)), groups, ["present", "ng"])
    m = m.filter(F.col("present1") + F.col("present2") >= min_samples)
    m = m.withColumns({"absent1": F.col("ng1") - F.col("present1"), "absent2": F.col("ng2") - F.col("present2")})
    odds = F.try_divide(F.col("present1") * F.col("absent2"), F.col("present2") * F.col("absent1"))
    return m.select("feature_id", "present1", "absent1", "present2", "absent2", odds.alias("odds_ratio"),
                    tails.p_fisher("present1", "present2", "absent1", "absent2").alias("p_value"))


def anova_f(ab: DataFrame, labels: DataFrame, value: str = "count") -> DataFrame:
    """One-way F, p and eta-squared per feature from group moments."""
    m = group_moments(ab, labels, value)
    g = m.groupBy("feature_id").agg(F.sum("ng").cast("double").alias("n"), F.sum(F.col("ng") * F.col("mean")).alias("s"),
                                    F.sum(F.col("ng") * F.col("mean") ** 2).alias("q"),
                                    F.sum((F.col("ng") - 1) * F.coalesce("var", F.lit(0.0))).alias("ssw"), F.count(F.lit(1)).cast("double").alias("k"))
    g = g.withColumn("ssb", F.greatest(F.col("q") - F.col("s") ** 2 / F.col("n"), F.lit(0.0)))
    g = g.withColumns({"d1": F.col("k") - 1, "d2": F.col("n") - F.col("k")})
    g = g.withColumn("f", F.try_divide(F.col("ssb") / F.col("d1"), F.col("ssw") / F.col("d2")))
    return g.select("feature_id", "f", tails.p_f("f", "d1", "d2").alias("p_value"),
                    F.coalesce(F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw")), F.lit(0.0)).alias("eta_squared"))


def spearman_features(ab: DataFrame, meta: DataFrame, target: str, value: str = "count", min_present: int = 1) -> DataFrame:
    """Spearman rho and p of every feature with a numeric column, zeros as one tie block.

    sum(rx * ry) over absent samples is the zero rank times what is left of sum(ry), so no dense grid is made.
    """
    y = meta.filter(F.col(target).isNotNull()).select("sample_id", F.col(target).cast("double").alias("y"))
    n = y.count()
    ry = value_ranks(y, [], "y").select(F.col("value").alias("y"), F.col("rank").alias("ry"), F.col("cnt").alias("cy"))
    tot = ry.agg(F.sum(F.col("cy") * F.col("ry") ** 2).alias("yy"), F.sum(F.col("cy") * F.col("ry")).alias("sy"))
    x = ab.join(y.join(ry.drop("cy"), "y"), "sample_id")
    rx = value_ranks(x, ["feature_id"], value, n=n)
    sums = rx.groupBy("feature_id").agg(F.sum(F.col("cnt") * F.col("rank") ** 2).alias("xx"),
                                        F.max(F.when(F.col("value") == 0, F.col("rank"))).alias("r0"))
    xr = rx.select("feature_id", F.col("value").alias(value), F.col("rank").alias("rx"))
    cross = x.join(xr, ["feature_id", value]).groupBy("feature_id").agg(
        F.sum(F.col("rx") * F.col("ry")).alias("xy"), F.sum("ry").alias("py"), F.count(F.lit(1)).alias("present"))
    g = cross.join(sums, "feature_id").crossJoin(F.broadcast(tot))
    mean = n * ((n + 1) / 2.0) ** 2
    xy = F.col("xy") + F.coalesce("r0", F.lit(0.0)) * (F.col("sy") - F.col("py"))
    rho = F.try_divide(xy - mean, F.sqrt((F.col("xx") - mean) * (F.col("yy") - mean)))
    g = g.filter(F.col("present") >= min_present).withColumn("rho", F.greatest(F.least(rho, F.lit(1.0)), F.lit(-1.0)))
    g = g.withColumns({"t": F.when(F.abs("rho") < 1, F.col("rho") * F.sqrt((n - 2) / (1 - F.col("rho") ** 2))).when(F.col("rho").isNotNull(), F.lit(1e12)),
                       "df": F.lit(float(n - 2))})
    return g.select("feature_id", "rho", tails.p_t("t", "df").alias("p_value"), "present", F.lit(n).alias("n"))


# ---------------------------------------------------------------- multiple testing


def adjust_p(df: DataFrame, p: str = "p_value", method: str = "fdr_bh", strata: list[str] = (), out: str = "p_adj") -> DataFrame:
    """Bonferroni, Sidak, Holm, BH or BY adjusted p per stratum; null and NaN p become null and do not count.

    Equal p values share one histogram row. Ranks come from bucketed running totals and the running extreme is taken in
    two levels (inside a bucket, then over bucket extremes), so no window holds a whole stratum.
    """
    keys = list(strata)
    df = cut_lineage(df.withColumn(p, F.nanvl(F.col(p).cast("double"), F.lit(None).cast("double"))))
    known = df.filter(F.col(p).isNotNull())
    hist = known.groupBy(*keys, F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    size = hist.groupBy(*keys).agg(F.sum("_c").alias("_m"))
    h = hist.join(size, keys) if keys else hist.crossJoin(F.broadcast(size))
    m, v = F.col("_m").cast("double"), F.col("_p")
    if method == "bonferroni":
        h = h.withColumn("_a", v * m)
    elif method == "sidak":
        h = h.withColumn("_a", -F.expm1(m * F.log1p(-v)))
    else:
        h = running_total(h, keys, "_p", "_c", "_hi")
        rank_low = F.col("_hi") - F.col("_c") + 1
        if method == "holm":
            h = _running_extreme(h.withColumn("_s", v * (m - rank_low + 1)), keys, "_p", "_s", F.max, "_a", forward=True)
        else:
            scale = m if method == "fdr_bh" else m * harmonic(F.col("_m"))
            h = _running_extreme(h.withColumn("_s", v * scale / F.col("_hi")), keys, "_p", "_s", F.min, "_a", forward=False)
    adj = h.select(*keys, F.col("_p").alias(p), F.least(F.col("_a"), F.lit(1.0)).alias(out))
    return known.join(adj, [*keys, p]).unionByName(df.filter(F.col(p).isNull()).withColumn(out, F.lit(None).cast("double")))


def harmonic(m: Column) -> Column:
    """1 + 1/2 + ... + 1/m: summed for small m, by its asymptotic series (error below 1e-14) for large m."""
    x = m.cast("double")
    series = F.log(x) + 0.57721566490153286 + 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4)
    direct = F.aggregate(F.sequence(F.lit(1), F.least(m, F.lit(1000)).cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / i)
    return F.when(m <= 1000, direct).otherwise(series)


def _running_extreme(h: DataFrame, keys: list[str], order: str, value: str, fn, out: str, forward: bool) -> DataFrame:
    b = h.withColumn("_b", value_bucket(F.col(order)))
    ends = b.groupBy(*keys, "_b").agg(fn(value).alias("_e"))
    # Windows that end at the last row are worked out anew for each row; the order is turned instead.
    way = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    over = W.partitionBy(*(keys or [F.lit(0)])).orderBy(way("_b")).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(*keys, "_b", fn("_e").over(over).alias("_edge"))
    inside = fn(value).over(W.partitionBy(*keys, "_b").orderBy(way(order)).rowsBetween(W.unboundedPreceding, 0))
    pick = F.greatest if forward else F.least
    return b.join(ends, [*keys, "_b"]).withColumn(out, pick(inside, "_edge")).drop("_b", "_edge")


METHODS = ["bonferroni", "sidak", "holm", "fdr_bh", "fdr_by"]


def compare_corrections(df: DataFrame, p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """method, rejected: number of adjusted p below alpha by method."""
    out = None
    for m in METHODS:
        one = adjust_p(df.select(p), p, m).agg(F.count_if(F.col("p_adj") <= alpha).alias("rejected")).select(F.lit(m).alias("method"), "rejected")
        out = one if out is None else out.unionByName(one)
    return out


def hierarchical_fdr(tests: DataFrame, alpha: float = 0.05, p: str = "p_value") -> DataFrame:
    """tests(node, parent, p_value): BH inside the root family, then inside the children of each rejected node.

    A family is the children of one parent; one pass per tree level, each pass one partitioned adjustment. A cycle of
    parents is not reachable from a root; a node that was decided is not decided again, so the passes end.
    """
    root = F.lit("") if dict(tests.dtypes)["parent"] == "string" else F.lit(-1)
    family = tests.filter("parent is null").withColumn("parent", root)
    rest = tests.filter("parent is not null")
    done = None
    while True:
        level = cut_lineage(adjust_p(family, p, "fdr_bh", ["parent"]).withColumn("rejected", F.coalesce(F.col("p_adj") <= alpha, F.lit(False))))
        out = level.select("node", "rejected")
        done = out if done is None else done.unionByName(out)
        hit = level.filter("rejected").select(F.col("node").alias("parent"))
        family = rest.join(hit, "parent", "left_semi").join(done.select("node"), "node", "left_anti")
        if family.isEmpty():
            break
    return tests.join(done, "node", "left").select("node", F.coalesce("rejected", F.lit(False)).alias("rejected"))


# ---------------------------------------------------------------- combinations


def test_with_effect_size(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], p_threshold: float = 0.05,
                          effect_threshold: float = 0.5) -> DataFrame:
    """Mann-Whitney p, BH p, Cohen's d and Cliff's delta, and whether both p and d pass."""
    mw = mann_whitney(ab, labels, groups, medians=False)
    es = effect_sizes(ab, labels, groups)
    j = adjust_p(mw, "p_value").join(es, "feature_id")
    both = (F.col("p_adj") < p_threshold) & (F.abs("cohens_d") >= effect_threshold)
    return j.select("feature_id", "p_value", "p_adj", "cliffs_delta", "cohens_d", "hedges_g", "log2_fc",
                    effect_band(F.col("cohens_d")).alias("size"), F.coalesce(both, F.lit(False)).alias("significant"))


def compare_methods(results: dict[str, DataFrame], alpha: float = 0.05) -> DataFrame:
    """feature_id, method of every significant feature."""
    out = None
    for name, df in results.items():
        one = df.filter(F.col("p_adj") < alpha).select("feature_id", F.lit(name).alias("method"))
        out = one if out is None else out.unionByName(one)
    return out


def consensus_features(found: DataFrame, min_methods: int = 2) -> DataFrame:
    g = found.groupBy("feature_id").agg(F.count_distinct("method").alias("n_methods"),
                                        F.concat_ws(", ", F.array_sort(F.collect_set("method"))).alias("methods"))
    return g.filter(F.col("n_methods") >= min_methods)


def top_features_table(results: DataFrame, n_top: int = 20, sort_by: str = "frequency", alpha: float = 0.05) -> DataFrame:
    """results(test, feature_id, p_value, effect): number of significant tests, mean and min p, mean absolute effect."""
    g = results.filter(F.col("p_value") < alpha).groupBy("feature_id").agg(
        F.count(F.lit(1)).alias("n_significant_tests"), F.concat_ws(", ", F.array_sort(F.collect_set("test"))).alias("tests"),
        F.avg("p_value").alias("mean_p_value"), F.min("p_value").alias("min_p_value"), F.avg(F.abs("effect")).alias("mean_effect_size"))
    order = ([F.desc("n_significant_tests"), F.asc(F.round("mean_p_value", 12))] if sort_by == "frequency" else [F.desc(F.round("mean_effect_size", 12))])
    return g.orderBy(*order, "feature_id").limit(n_top)


def effect_summary(df: DataFrame, effect: str, kind: str = "cliffs_delta") -> DataFrame:
    """band, n, share, mean and median absolute effect per band."""
    e = df.filter(F.col(effect).isNotNull()).select(effect_band(F.col(effect), kind).alias("band"), F.abs(effect).alias("e"))
    total = e.agg(F.count(F.lit(1)).alias("total"))
    g = e.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.avg("e").alias("mean_effect"))
    med = exact_quantiles(e, ["band"], "e", {"median_effect": 0.5})
    return g.join(med, "band").crossJoin(F.broadcast(total)).select("band", "n", (F.col("n") / F.col("total")).alias("share"), "mean_effect", "median_effect")


def core_features(ab: DataFrame, labels: DataFrame, prevalence: float = 0.8, abundance: float = 0.01) -> DataFrame:
    """Features of a group with prevalence and mean share (zeros counted) above the limits."""
    from meadow.operators.table import with_share
    j = with_share(ab).join(labels, "sample_id")
    g = j.groupBy("group", "feature_id").agg(F.count(F.lit(1)).alias("p"), F.sum("share").alias("s")).join(small(group_sizes(labels)), "group")
    out = g.select("group", "feature_id", (F.col("p") / F.col("ng")).alias("prevalence"), (F.col("s") / F.col("ng")).alias("mean_abundance"))
    return out.filter((F.col("prevalence") >= prevalence) & (F.col("mean_abundance") >= abundance))


# ---------------------------------------------------------------- permutations


def permutation_test(ab: DataFrame, labels: DataFrame, reps: int = 99, kind: str = "ttest", seed: int = 42, stop: int | None = None) -> DataFrame:
    """Statistic (absolute mean difference of two groups, or F) and p = (b + 1) / (B + 1) per feature; with `stop` a feature
    leaves after so many exceedances, at permutation l, and has p = stop / l. See permute."""
    return permutation_p(ab, labels, reps, kind, seed, stop=stop).select("feature_id", "statistic", "p_perm")


def maxt(ab: DataFrame, labels: DataFrame, reps: int = 99, kind: str = "ftest", seed: int = 42) -> DataFrame:
    """Family-wise p: share of permutations whose largest statistic over all features reaches the feature's."""
    own, top = maxima(ab, labels, reps, kind, seed)
    tops = F.broadcast(top.agg(F.collect_list("top").alias("tops")))  # one number per permutation
    b = F.size(F.filter("tops", lambda x: x >= F.col("statistic") - F.abs("statistic") * 1e-12))
    return own.crossJoin(tops).select("feature_id", "statistic", ((b + 1) / (reps + 1.0)).alias("p_maxt"))


def compare_tests(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], reps: int = 99, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Parametric and permutation p per feature, their difference, and whether both give the same verdict."""
    lab = only(labels, groups)
    a = t_test(ab, lab, groups).select("feature_id", F.col("p_value").alias("p_parametric"))
    b = permutation_test(ab, lab, reps, "ttest", seed).select("feature_id", "p_perm")
    agree = (F.col("p_parametric") < alpha) == (F.col("p_perm") < alpha)
    return a.join(b, "feature_id").select("feature_id", "p_parametric", "p_perm", F.abs(F.col("p_parametric") - F.col("p_perm")).alias("difference"), agree.alias("agree"))


def bootstrap_ci(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], reps: int = 100, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """Percentile interval of Cohen's d: each replicate weights samples by Poisson(1) counts from a seeded hash. See permute."""
    return bootstrap_d(ab, only(labels, groups), groups, reps, confidence, seed)
