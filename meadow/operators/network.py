"""Feature networks: pair statistics come from tiles (see pairs); edges above a threshold never meet a table of all pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from meadow.functions import tails
from meadow.operators.compositional import alr, clr
from meadow.operators.geo import connected_components
from meadow.operators.kernels import value_ranks
from meadow.operators.pairs import pair_tiles
from meadow.sources.tables import cut_lineage


def _feature_heads(ab: DataFrame, value: str, zero: str | None, n: int | None) -> tuple[DataFrame, DataFrame, int]:
    """(per feature sez, s, v, szz, see; cells e = x - z that are not 0; number of samples).

    Absent cells count as 0, or as the sample's `zero`. With z the zero and e = x - z present rows only: cov(x, y) needs
    sum(e f) from the tile and sums of e, z and e z per feature.
    """
    n = n or ab.select("sample_id").distinct().count()
    z = F.col(zero) if zero else F.lit(0.0)
    e = ab.select("sample_id", "feature_id", (F.col(value) - z).alias("e"), z.alias("z"))
    zs = e.groupBy("sample_id").agg(F.first("z").alias("z")).agg(F.sum("z").alias("sz"), F.sum(F.col("z") ** 2).alias("szz"))
    f = e.groupBy("feature_id").agg(F.sum("e").alias("se"), F.sum(F.col("e") * F.col("z")).alias("sez"), F.sum(F.col("e") ** 2).alias("see"))
    total = F.col("se") + F.col("sz")
    f = f.crossJoin(F.broadcast(zs)).select("feature_id", "sez", total.alias("s"), ((F.col("see") + 2 * F.col("sez") + F.col("szz") - total * total / n) / (n - 1)).alias("v"),
                                            "szz", "see")
    return f, e.filter("e <> 0").select("sample_id", "feature_id", "e"), n


def _cov(dot, a, b, n):
    return (dot + a[0] + b[0] + a[3] - a[1] * b[1] / n) / (n - 1)


def _pair_values(ab: DataFrame, value: str, zero: str | None, n: int | None, measures: dict, least: tuple | None = None) -> DataFrame:
    """a, b and one column per measure, a function of (cov, va, vb), for every feature pair; null where it is not a number.

    `least` = (measure, threshold) keeps pairs whose absolute value is at least the threshold; as measures rise with the
    covariance, a tile drops pairs whose products still to come cannot bring them there."""
    # Written once: samples, heads and cells each read it, heads several times.
    heads, cells, n = _feature_heads(cut_lineage(ab.select("sample_id", "feature_id", value, *([zero] if zero else []))), value, zero, n)
    kind = dict(heads.dtypes)["feature_id"]

    def finish(a, b, sums, ha, hb):
        ha, hb = ha.T, hb.T
        with np.errstate(divide="ignore", invalid="ignore"):
            out = {name: f(_cov(sums["dot"], ha, hb, n), ha[2], hb[2]) for name, f in measures.items()}
        return pd.DataFrame({"a": a, "b": b, **{k: pd.Series(v).astype("Float64").mask(~np.isfinite(v)) for k, v in out.items()}})

    def reach(dot, rest, ha, hb):
        ha, hb = ha.T[:, :, None], hb.T[:, None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            ends = [np.abs(measures[least[0]](_cov(dot + d, ha, hb, n), ha[2], hb[2])) for d in (rest, -rest)]
        return np.maximum(*ends) >= least[1] * (1 - 1e-12)

    schema = f"a {kind}, b {kind}, " + ", ".join(f"{m} double" for m in measures)
    size = {"rows_per_block": 512, "cols_per_chunk": 256} if least else {}
    return pair_tiles(heads, cells, "feature_id", finish, schema, "sample_id", "e", ("dot",), reach if least else None, "see" if least else None, **size)


def _pearson(cov, va, vb):
    return cov / np.sqrt(np.where(va * vb > 0, va * vb, np.nan))


def _phi(cov, va, vb):
    return (va + vb - 2 * cov) / np.where(va + vb != 0, va + vb, np.nan)


def pair_covariances(ab: DataFrame, value: str, zero: str | None = None, n: int | None = None) -> DataFrame:
    """a, b, va, vb, cov (sample, ddof 1) for every feature pair; absent cells count as 0, or as the sample's `zero`."""
    return _pair_values(ab, value, zero, n, {"va": lambda c, va, vb: va + 0 * c, "vb": lambda c, va, vb: vb + 0 * c, "cov": lambda c, va, vb: c})


def proportionality(ab: DataFrame, p: int | None = None, pseudocount: float = 1.0) -> DataFrame:
    """vlr = var(log ratio), phi = vlr / (va + vb), rho = 1 - phi on CLR values, for every feature pair."""
    return _pair_values(clr(ab, p, pseudocount), "clr", "zero_clr", None, {
        "vlr": lambda c, va, vb: va + vb - 2 * c, "phi": _phi, "rho": lambda c, va, vb: 1 - _phi(c, va, vb)})


def keep_prevalent(ab: DataFrame, min_prevalence: float) -> DataFrame:
    n = ab.select("sample_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    ok = (ab.groupBy("feature_id").agg(F.count(F.lit(1)).alias("p")).crossJoin(F.broadcast(n))
          .filter(F.col("p") / F.col("n") >= min_prevalence))
    return ab.join(ok, "feature_id", "left_semi")


def proportionality_edges(ab: DataFrame, threshold: float = 0.7, min_prevalence: float = 0.1) -> DataFrame:
    """src, dst, weight = rho where abs(rho) >= threshold among prevalent features; pairs that cannot reach it leave the tile early."""
    kept = cut_lineage(keep_prevalent(cut_lineage(ab.select("sample_id", "feature_id", "count")), min_prevalence))
    r = _pair_values(clr(kept), "clr", "zero_clr", None, {"weight": lambda c, va, vb: 1 - _phi(c, va, vb)}, ("weight", threshold))
    return r.filter(F.abs("weight") >= threshold).select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight")


def clr_correlation(ab: DataFrame, transform: str = "clr", reference=None) -> DataFrame:
    """Pearson correlation of CLR (or ALR) values for every feature pair."""
    t = clr(ab) if transform == "clr" else alr(ab, reference)
    return _pair_values(t, transform, f"zero_{transform}", None, {"r": _pearson})


def count_correlation(ab: DataFrame) -> DataFrame:
    """Pearson correlation of counts (absent = 0) for every feature pair."""
    return _pair_values(ab, "count", None, None, {"r": _pearson})


def correlated_counts(ab: DataFrame, threshold: float) -> DataFrame:
    """a, b, r of the feature pairs with abs(r) >= threshold, without a table of the others."""
    return _pair_values(ab, "count", None, None, {"r": _pearson}, ("r", threshold)).filter(F.abs("r") >= threshold)


def effective_tests(ab: DataFrame) -> DataFrame:
    """1 + (p - 1)(1 - var(eigenvalues) / p): the variance of the eigenvalues is the mean squared entry sum minus 1.

    A tile gives one row, the sum of its squared correlations."""
    heads, cells, n = _feature_heads(ab, "count", None, None)

    def finish(a, b, sums, ha, hb):
        with np.errstate(divide="ignore", invalid="ignore"):
            r = _pearson(_cov(sums["dot"], ha.T, hb.T, n), ha.T[2], hb.T[2])
        return pd.DataFrame({"rr": [float(np.nansum(r * r))]})

    s = pair_tiles(heads, cells, "feature_id", finish, "rr double", "sample_id", "e", ("dot",), rows_per_block=512).agg(F.coalesce(F.sum("rr"), F.lit(0.0)).alias("rr"))
    p = ab.select("feature_id").distinct().agg(F.count(F.lit(1)).cast("double").alias("p"))
    return s.crossJoin(p).select((1 + (F.col("p") - 1) * (1 - ((F.col("p") + 2 * F.col("rr")) / F.col("p") - 1) / F.col("p"))).alias("effective"))


def spearman_network(ab: DataFrame, top: int = 100, min_rho: float = 0.5, alpha: float = 0.05) -> DataFrame:
    """Edges among the `top` most abundant features: Spearman with BH p < alpha and abs rho > min_rho, with its sign."""
    from meadow.operators.stats import adjust_p
    from meadow.operators.table import top_features
    ab = cut_lineage(ab.select("sample_id", "feature_id", "count"))
    kept = cut_lineage(ab.join(F.broadcast(top_features(ab, top, "mean").select("feature_id")), "feature_id", "left_semi"))
    n = ab.select("sample_id").distinct().count()
    rk = value_ranks(kept, ["feature_id"], "count", n=n)
    zero = rk.filter("value = 0").select("feature_id", F.col("rank").alias("r0"))
    rows = kept.join(rk.select("feature_id", F.col("value").alias("count"), "rank"), ["feature_id", "count"]).join(zero, "feature_id", "left")
    # Shift ranks so that an absent cell is 0: correlation does not change.
    shifted = rows.select("sample_id", "feature_id", (F.col("rank") - F.coalesce("r0", F.lit(0.0))).alias("count")).filter("count <> 0")
    c = pair_covariances(shifted, "count", n=n)
    r = c.select("a", "b", F.try_divide(F.col("cov"), F.sqrt(F.col("va") * F.col("vb"))).alias("rho")).filter("rho is not null")
    r = r.withColumns({"t": F.col("rho") * F.sqrt((n - 2) / F.greatest(1 - F.col("rho") ** 2, F.lit(1e-12))), "df": F.lit(float(n - 2))})
    adj = adjust_p(r.withColumn("p_value", tails.p_t("t", "df")), "p_value")
    return adj.filter((F.col("p_adj") < alpha) & (F.abs("rho") > min_rho)).select(
        F.col("a").alias("src"), F.col("b").alias("dst"), F.col("rho").alias("weight"), F.signum("rho").cast("int").alias("sign"), "p_adj")


def network_stats(edges: DataFrame) -> DataFrame:
    """nodes, edges, density, components."""
    nodes = edges.select(F.col("src").alias("n")).unionByName(edges.select(F.col("dst").alias("n"))).distinct()
    comp = connected_components(edges).select("component").distinct().agg(F.count(F.lit(1)).alias("components"))
    s = nodes.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(edges.agg(F.count(F.lit(1)).alias("edges"))).crossJoin(comp)
    return s.withColumn("density", F.try_divide(2.0 * F.col("edges"), F.col("nodes") * (F.col("nodes") - 1)))


def compare_networks(networks: dict[str, DataFrame]) -> DataFrame:
    """first, second, shared, jaccard for each pair of methods: one grouped pass over the tagged edges."""
    tagged = None
    for name, e in networks.items():
        one = e.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct().withColumn("m", F.lit(name))
        tagged = one if tagged is None else tagged.unionByName(one)
    who = tagged.groupBy("x", "y").agg(F.collect_set("m").alias("ms"))
    names = sorted(networks)
    rows = [F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.array_contains("ms", a).cast("int").alias("ia"),
                     F.array_contains("ms", b).cast("int").alias("ib")) for i, a in enumerate(names) for b in names[i + 1:]]
    g = who.select(F.explode(F.array(*rows)).alias("r")).groupBy("r.first", "r.second").agg(
        F.sum(F.col("r.ia") * F.col("r.ib")).alias("shared"), F.sum(F.greatest("r.ia", "r.ib")).alias("either"))
    return g.select("first", "second", "shared", F.coalesce(F.try_divide(F.col("shared"), F.col("either")), F.lit(0.0)).alias("jaccard"))


def local_clustering(edges: DataFrame) -> DataFrame:
    """node, degree, clustering: links among a node's neighbours over the possible links.

    Triangles are found from each edge's lower-degree end, so a hub's neighbour pairs are never listed.
    """
    e = edges.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).filter("x <> y").distinct()
    both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
    deg = both.groupBy(F.col("x").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    d = e.join(deg.select(F.col("node").alias("x"), F.col("degree").alias("dx")), "x").join(deg.select(F.col("node").alias("y"), F.col("degree").alias("dy")), "y")
    up = (F.col("dx") < F.col("dy")) | ((F.col("dx") == F.col("dy")) & (F.col("x") < F.col("y")))
    o = d.select(F.when(up, F.col("x")).otherwise(F.col("y")).alias("u"), F.when(up, F.col("y")).otherwise(F.col("x")).alias("v"))
    wedge = o.join(o.select("u", F.col("v").alias("w")), "u").filter("v < w")
    tri = wedge.join(e.select(F.col("x").alias("v"), F.col("y").alias("w")), ["v", "w"])
    t = tri.select(F.explode(F.array("u", "v", "w")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("t"))
    j = deg.join(t, "node", "left").fillna(0, ["t"])
    return j.select("node", "degree", F.coalesce(F.try_divide(2.0 * F.col("t"), F.col("degree") * (F.col("degree") - 1)), F.lit(0.0)).alias("clustering"))


def study_feature_matrix(pairs: DataFrame, studies: list[str]) -> DataFrame:
    """feature_id, one 0/1 column per study, n_studies; most shared first."""
    w = pairs.select("feature_id", "study").distinct().groupBy("feature_id").pivot("study", studies).agg(F.count(F.lit(1)).cast("int")).fillna(0, studies)
    return w.withColumn("n_studies", sum((F.col(f"`{s}`") for s in studies), F.lit(0))).orderBy(F.desc("n_studies"), "feature_id")
