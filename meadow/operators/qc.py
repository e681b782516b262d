"""Profiling, quality control and validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meadow.functions import tails
from meadow.operators.clean import number
from meadow.operators.kernels import exact_quantiles, quantile, small, spread, value_ranks
from meadow.operators.stats import spearman_features
from meadow.operators.table import sample_count, with_share
from meadow.sources.tables import cut_lineage

# ---------------------------------------------------------------- profiles


def diagnose_zeros(ab: DataFrame) -> DataFrame:
    """Zero totals and fractions by closed form: zeros = samples x features - rows."""
    s = ab.groupBy("sample_id").agg(F.count(F.lit(1)).alias("r"))
    f = ab.groupBy("feature_id").agg(F.count(F.lit(1)).alias("r"))
    n = s.agg(F.count(F.lit(1)).alias("n_samples"), F.sum("r").alias("rows"))
    p = f.agg(F.count(F.lit(1)).alias("n_features"))
    size = n.crossJoin(p)
    sz = s.crossJoin(F.broadcast(p)).agg(F.count_if(F.col("r") < F.col("n_features")).alias("samples_with_zeros"))
    fz = f.crossJoin(F.broadcast(n.select("n_samples"))).agg(F.count_if(F.col("r") < F.col("n_samples")).alias("features_with_zeros"))
    total = F.col("n_samples") * F.col("n_features")
    return size.crossJoin(sz).crossJoin(fz).select(
        "n_samples", "n_features", (total - F.col("rows")).alias("total_zeros"), (1 - F.col("rows") / total).alias("zero_fraction"),
        "samples_with_zeros", "features_with_zeros")


def profile_completeness(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """column, n_complete, n_missing, pct_full: one aggregate, then one row per column."""
    cols = cols or df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols])
    long = row.unpivot(["_n"], cols, "column", "n_complete")
    return long.select("column", "n_complete", (F.col("_n") - F.col("n_complete")).alias("n_missing"),
                       (100.0 * F.col("n_complete") / F.col("_n")).alias("pct_full"))


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, val, c for non-null values of all columns in one pass."""
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "val")
    return long.filter("val is not null").groupBy("column", "val").agg(F.count(F.lit(1)).alias("c"))


def profile_categories(df: DataFrame, cols: list[str]) -> DataFrame:
    """n_categories, entropy (base 2), majority and minority %, imbalance ratio per column."""
    c = F.col("c").cast("double")
    g = value_counts(df, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_categories"), F.sum("c").alias("n"), F.sum(c * F.log2("c")).alias("cl"),
        F.max("c").alias("mx"), F.min("c").alias("mn"))
    return g.select("column", "n_categories", (F.log2("n") - F.col("cl") / F.col("n")).alias("entropy"), (100.0 * F.col("mx") / F.col("n")).alias("majority_pct"),
                    (100.0 * F.col("mn") / F.col("n")).alias("minority_pct"), (F.col("mx") / F.col("mn")).alias("imbalance_ratio"))


def profile_numeric(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """mean, std, min, max, median per column; the median comes from value histograms, or percentile_approx."""
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "v").filter("v is not null")
    med = [F.percentile_approx("v", 0.5, 10_000).alias("median")] if approximate else []
    g = long.groupBy("column").agg(F.avg("v").alias("mean"), F.stddev("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), *med)
    return g if approximate else g.join(exact_quantiles(long, ["column"], "v", {"median": 0.5}), "column")


def target_warnings(df: DataFrame, targets: list[str]) -> DataFrame:
    """target, severity, category: absent column, missing values, one class, imbalance > 10 or > 100, class under 30."""
    spark = df.sparkSession
    have = [t for t in targets if t in df.columns]
    out = [spark.createDataFrame([(t, "ERROR", "Missing Target") for t in targets if t not in have], "target string, severity string, category string")]
    comp = profile_completeness(df, have).filter("n_missing > 0")
    out.append(comp.select(F.col("column").alias("target"), F.lit("WARNING"), F.lit("Missing Target Data")))
    types = dict(df.dtypes)
    cat = [t for t in have if types[t] in ("string", "boolean")]
    if cat:
        g = value_counts(df, cat).groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.max("c").alias("mx"), F.min("c").alias("mn"))
        rules = [(F.col("k") < 2, "ERROR", "Single Class"), (F.col("mx") / F.col("mn") > 100, "ERROR", "Severe Imbalance"),
                 ((F.col("mx") / F.col("mn") > 10) & (F.col("mx") / F.col("mn") <= 100), "WARNING", "Class Imbalance"), (F.col("mn") < 30, "WARNING", "Small Class")]
        hits = F.filter(F.array(*[F.when(cond, F.struct(F.lit(s).alias("severity"), F.lit(c).alias("category"))) for cond, s, c in rules]), lambda x: x.isNotNull())
        out.append(g.select(F.col("column").alias("target"), F.explode(hits).alias("h")).select("target", "h.severity", "h.category"))
    return reduce(lambda a, b: a.union(b), out)


# ---------------------------------------------------------------- association


def cramers_v(df: DataFrame, x: str, y: str) -> DataFrame:
    """cramers_v and its bias-corrected form: chi2 = n (sum c^2 / (row col) - 1) over the cells that occur."""
    c = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).cast("double").alias("c"))
    c = cut_lineage(c)
    r = c.groupBy("x").agg(F.sum("c").alias("r"))
    s = c.groupBy("y").agg(F.sum("c").alias("s"))
    t = c.join(r, "x").join(s, "y").agg(F.sum(F.col("c") ** 2 / (F.col("r") * F.col("s"))).alias("q"), F.sum("c").alias("n"))
    t = t.crossJoin(r.agg(F.count(F.lit(1)).alias("nr"))).crossJoin(s.agg(F.count(F.lit(1)).alias("nc")))
    n, nr, nc = F.col("n"), F.col("nr"), F.col("nc")
    phi2 = F.greatest(F.col("q") - 1, F.lit(0.0))
    corr = F.greatest(F.lit(0.0), phi2 - (nr - 1) * (nc - 1) / (n - 1))
    dim = F.least(nr - (nr - 1) ** 2 / (n - 1), nc - (nc - 1) ** 2 / (n - 1)) - 1
    v = F.when(n < 10, 0.0).otherwise(F.coalesce(F.sqrt(F.try_divide(phi2, F.least(nr, nc) - 1)), F.lit(0.0)))
    return t.select(v.alias("cramers_v"), F.coalesce(F.sqrt(F.try_divide(corr, dim)), F.lit(0.0)).alias("corrected"))


def eta_squared(df: DataFrame, num: str, cat: str) -> DataFrame:
    """Between over total sum of squares of a number over a category; groups of one do not count as groups."""
    k = df.filter(F.col(num).isNotNull() & F.col(cat).isNotNull())
    g = k.groupBy(cat).agg(F.count(F.lit(1)).alias("n"), F.avg(num).alias("m"))
    t = k.agg(F.avg(num).alias("gm"), (F.var_pop(num) * F.count(F.lit(1))).alias("sst"))
    return g.filter("n > 1").crossJoin(F.broadcast(t)).agg(
        F.coalesce(F.try_divide(F.sum(F.col("n") * (F.col("m") - F.col("gm")) ** 2), F.max("sst")), F.lit(0.0)).alias("eta_squared"))


def rank_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman rho over rows where both are known."""
    k = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x is not null and y is not null")
    for c in ("x", "y"):
        r = value_ranks(k, [], c).select(F.col("value").alias(c), F.col("rank").alias(f"r{c}"))
        k = k.join(r, c)
    return k.agg(F.corr("rx", "ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def confounding(df: DataFrame, target: str, batches: list[str], threshold: float = 0.7) -> DataFrame:
    """batch, kind, value, level: Spearman, corrected Cramer's V or eta-squared by column kinds; high, moderate, low."""
    types = dict(df.dtypes)
    numeric = lambda c: types[c] in ("double", "float", "int", "bigint")
    out = None
    for b in batches:
        if b == target or b not in df.columns:
            continue
        if numeric(b) and numeric(target):
            one = rank_correlation(df, b, target).select(F.lit("spearman").alias("kind"), F.abs("rho").alias("value"))
        elif numeric(b) or numeric(target):
            num, cat = (b, target) if numeric(b) else (target, b)
            one = eta_squared(df, num, cat).select(F.lit("eta_squared").alias("kind"), F.col("eta_squared").alias("value"))
        else:
            one = cramers_v(df, b, target).select(F.lit("cramers_v").alias("kind"), F.col("corrected").alias("value"))
        one = one.select(F.lit(b).alias("batch"), "kind", "value")
        out = one if out is None else out.unionByName(one)
    level = F.when(F.col("value") >= threshold, "high").when(F.col("value") >= 0.7 * threshold, "moderate").otherwise("low")
    return out.withColumn("level", level)


def crosstab_totals(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts per (x, y) with margins named All."""
    f = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))
    c = df.select(f(x).alias(x), f(y).alias(y)).cube(x, y).agg(F.count(F.lit(1)).alias("n"))
    return c.select(F.coalesce(x, F.lit("All")).alias(x), F.coalesce(y, F.lit("All")).alias(y), "n")


# ---------------------------------------------------------------- contamination

# Genera of extraction kits and reagents, and of human sources with their scores (later lists win).
KIT_GENERA = ["Bradyrhizobium", "Sphingomonas", "Phyllobacterium", "Burkholderia", "Ralstonia", "Cupriavidus", "Methylobacterium", "Novosphingobium",
              "Pseudomonas", "Acinetobacter", "Stenotrophomonas", "Sphingobium", "Sphingopyxis", "Herbaspirillum", "Achromobacter", "Rhodococcus"]
HUMAN_GENERA = {
    "skin": (0.8, ["Propionibacterium", "Cutibacterium", "Staphylococcus", "Corynebacterium", "Micrococcus", "Kocuria"]),
    "gut": (0.6, ["Bacteroides", "Prevotella", "Faecalibacterium", "Bifidobacterium", "Ruminococcus", "Blautia", "Escherichia", "Enterococcus", "Clostridium"]),
    "oral": (0.5, ["Streptococcus", "Veillonella", "Fusobacterium", "Porphyromonas", "Actinomyces", "Rothia"]),
}


def contaminants_database(feature_meta: DataFrame, check_human: bool = True) -> DataFrame:
    """feature_id, db_score from genus lists; a fixed handful of names, so a plain expression."""
    g = F.coalesce(F.col("genus"), F.lit("Unknown"))
    score = [F.when(g.isin(names), s) for _, (s, names) in reversed(HUMAN_GENERA.items())] if check_human else []
    return feature_meta.select("feature_id", F.coalesce(*score, F.when(g.isin(KIT_GENERA), 0.7), F.lit(0.0)).alias("db_score"))


def contaminants_frequency(ab: DataFrame, min_present: int = 5, min_samples: int = 10) -> DataFrame:
    """feature_id, freq_score: abs Spearman rho with depth where it is negative with p < 0.05."""
    depth = ab.groupBy("sample_id").agg(F.sum("count").alias("depth"))
    s = spearman_features(ab, depth, "depth")
    hit = (F.col("rho") < 0) & (F.col("p_value") < 0.05) & (F.col("present") >= min_present) & (F.col("n") >= min_samples)
    return s.select("feature_id", F.when(hit, F.least(F.abs("rho"), F.lit(1.0))).otherwise(0.0).alias("freq_score"))


def contaminants_ubiquity(ab: DataFrame, prevalence: float = 0.9, abundance: float = 0.001) -> DataFrame:
    """feature_id, ubiq_score: common and scarce features 0.6, also steady ones (CV < 1) 0.8; zeros counted."""
    n = sample_count(ab)
    g = with_share(ab).groupBy("feature_id").agg(F.count(F.lit(1)).alias("p"), F.sum("share").alias("s"), F.sum(F.col("share") ** 2).alias("ss"))
    g = g.crossJoin(F.broadcast(n)).withColumn("m", F.col("s") / F.col("n"))
    cv = F.sqrt(F.greatest(F.col("ss") / F.col("n") - F.col("m") ** 2, F.lit(0.0))) / (F.col("m") + 1e-10)
    hit = (F.col("p") / F.col("n") > prevalence) & (F.col("m") < abundance)
    return g.select("feature_id", F.when(hit & (cv < 1), 0.8).when(hit, 0.6).otherwise(0.0).alias("ubiq_score"))


def contaminants_combined(ab: DataFrame, feature_meta: DataFrame, prevalence: float = 0.9, abundance: float = 0.001) -> DataFrame:
    """Mean of the three scores, number of methods over 0.5, verdict."""
    j = contaminants_frequency(ab).join(contaminants_ubiquity(ab, prevalence, abundance), "feature_id")
    j = j.join(contaminants_database(feature_meta), "feature_id", "left").fillna(0.0, ["db_score"])
    cols = ["db_score", "freq_score", "ubiq_score"]
    mean = sum((F.col(c) for c in cols), F.lit(0.0)) / 3
    return j.select("feature_id", *cols, mean.alias("combined_score"), sum(((F.col(c) > 0.5).cast("int") for c in cols), F.lit(0)).alias("n_methods_flagged"),
                    (mean > 0.5).alias("is_contaminant"))


def remove_contaminants(ab: DataFrame, scores: DataFrame, score: str = "combined_score", threshold: float = 0.5) -> DataFrame:
    return ab.join(scores.filter(F.col(score) > threshold), "feature_id", "left_anti")


def contaminants_prevalence(ab: DataFrame, meta: DataFrame, control: str, threshold: float = 0.1) -> DataFrame:
    """Presence counts in control and true samples, Fisher p, flagged when more common in controls with p below the threshold."""
    m = meta.select("sample_id", F.col(control).alias("is_control")).filter("is_control is not null")
    size = m.agg(F.count_if("is_control").alias("nc"), F.count_if(~F.col("is_control")).alias("nt"))
    g = ab.join(m, "sample_id").groupBy("feature_id").agg(F.count_if("is_control").alias("control_present"), F.count_if(~F.col("is_control")).alias("true_present"))
    g = g.crossJoin(F.broadcast(size)).withColumns({"ca": F.col("nc") - F.col("control_present"), "ta": F.col("nt") - F.col("true_present")})
    g = g.withColumn("p_value", tails.p_fisher("control_present", "true_present", "ca", "ta"))
    pc, pt = F.col("control_present") / F.col("nc"), F.col("true_present") / F.col("nt")
    return g.select("feature_id", "control_present", "true_present", pc.alias("control_prevalence"), pt.alias("true_prevalence"), "p_value",
                    ((F.col("p_value") < threshold) & (pc > pt)).alias("flagged"))


def cross_sample_overlap(ab: DataFrame, batches: DataFrame, min_overlap: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): sample pairs of one batch with Jaccard above min_overlap.

    Samples with the same feature set are one representative (members lists who they stand for, all of them at Jaccard 1),
    so copies are never paired with each other. Representatives meet only on their rarest features: two sets above the
    limit must share one of the first n - ceil(t n) + 1 features in rarity order, so very common features join nothing.
    Every candidate is then counted exactly.
    """
    j = cut_lineage(ab.join(batches.select("sample_id", "batch"), "sample_id").select("batch", "sample_id", "feature_id").distinct())
    size = j.groupBy("batch", "sample_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("feature_id").cast("decimal(38,0)")).alias("h1"),
                                               F.sum(F.xxhash64("feature_id", F.lit(7)).cast("decimal(38,0)")).alias("h2"))
    rep = size.groupBy("batch", "n", "h1", "h2").agg(F.min("sample_id").alias("rep"))
    members = cut_lineage(size.join(rep, ["batch", "n", "h1", "h2"]).select("batch", "sample_id", "rep", "n"))
    reps = members.filter("sample_id = rep").select("batch", F.col("sample_id"), "n")
    rows = j.join(reps, ["batch", "sample_id"])
    rare = rows.groupBy("batch", "feature_id").agg(F.count(F.lit(1)).alias("df"))
    ranked = cut_lineage(rows.join(rare, ["batch", "feature_id"]))
    k = F.row_number().over(W.partitionBy("batch", "sample_id").orderBy("df", "feature_id"))
    prefix = ranked.withColumn("k", k).filter(F.col("k") <= F.col("n") - F.ceil(F.lit(min_overlap) * F.col("n")) + 1)
    a = prefix.select("batch", "feature_id", F.col("sample_id").alias("a"), F.col("n").alias("na"))
    b = prefix.select("batch", "feature_id", F.col("sample_id").alias("b"), F.col("n").alias("nb"))
    close = (F.col("a") < F.col("b")) & (F.least("na", "nb") > min_overlap * F.greatest("na", "nb"))
    cand = a.join(b, ["batch", "feature_id"]).filter(close).select("batch", "a", "b", "na", "nb").distinct()
    both = (cand.join(ranked.select("batch", F.col("sample_id").alias("a"), "feature_id"), ["batch", "a"])
            .join(ranked.select("batch", F.col("sample_id").alias("b"), "feature_id"), ["batch", "b", "feature_id"])
            .groupBy("batch", "a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("na").alias("na"), F.max("nb").alias("nb")))
    jac = F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))
    return both.select("batch", "a", "b", jac.alias("jaccard")).filter(F.col("jaccard") > min_overlap), members


# ---------------------------------------------------------------- sample identity

# Phyla expected and genera suspicious per environment; human-associated genera; amplicon lengths per region.
EXPECTED_PHYLA = {
    "soil": ["Proteobacteria", "Actinobacteria", "Acidobacteria", "Bacteroidetes", "Firmicutes", "Verrucomicrobia"],
    "marine": ["Proteobacteria", "Bacteroidetes", "Cyanobacteria", "Actinobacteria", "Planctomycetes"],
    "freshwater": ["Proteobacteria", "Actinobacteria", "Bacteroidetes", "Cyanobacteria", "Verrucomicrobia"],
    "wastewater": ["Proteobacteria", "Bacteroidetes", "Firmicutes", "Actinobacteria", "Chloroflexi"],
}
SUSPICIOUS_GENERA = {
    "soil": ["Bacteroides", "Prevotella", "Bifidobacterium"], "marine": ["Escherichia", "Clostridium", "Lactobacillus"],
    "freshwater": ["Bacteroides", "Prevotella"], "wastewater": [],
}
HUMAN_ASSOCIATED = ["Propionibacterium", "Staphylococcus", "Corynebacterium", "Cutibacterium", "Malassezia", "Bacteroides", "Prevotella", "Faecalibacterium",
                    "Bifidobacterium", "Ruminococcus", "Blautia", "Coprococcus", "Streptococcus", "Veillonella", "Fusobacterium", "Porphyromonas", "Actinomyces"]
REGION_LENGTHS = {"V1-V2": (280, 320), "V1-V3": (460, 520), "V3-V4": (420, 480), "V4": (240, 280), "V4-V5": (360, 420), "V6-V8": (420, 480)}


def environment_match(ab: DataFrame, feature_meta: DataFrame, meta: DataFrame, env: str = "env", phyla: dict = EXPECTED_PHYLA,
                      suspicious: dict = SUSPICIOUS_GENERA) -> DataFrame:
    """PASS, WARNING, FAIL or UNKNOWN per sample from its 20 most abundant features (ties by id)."""
    top = ab.withColumn("k", F.row_number().over(W.partitionBy("sample_id").orderBy(F.desc("count"), "feature_id"))).filter("k <= 20")
    t = top.join(feature_meta.select("feature_id", "phylum", "genus"), "feature_id").join(meta.select("sample_id", F.col(env).alias("env")), "sample_id")
    member = lambda table, c: F.coalesce(*[F.when(F.col("env") == e, F.col(c).isin(v) if v else F.lit(False)) for e, v in table.items()], F.lit(False))
    ph = t.filter("phylum is not null").groupBy("sample_id", "env", "phylum").agg(F.count(F.lit(1)).alias("c"))
    ph = ph.withColumn("k", F.row_number().over(W.partitionBy("sample_id").orderBy(F.desc("c"), "phylum"))).filter("k <= 3")
    hits = ph.groupBy("sample_id").agg(F.count_if(member(phyla, "phylum")).alias("hits"))
    odd = t.groupBy("sample_id").agg(F.coalesce(F.max(member(suspicious, "genus")), F.lit(False)).alias("odd"))
    j = meta.select("sample_id", F.col(env).alias("env")).join(hits, "sample_id", "left").join(odd, "sample_id", "left")
    known = F.col("env").isin(list(phyla)) & F.col("hits").isNotNull()
    return j.select("sample_id", F.when(~F.coalesce(known, F.lit(False)), "UNKNOWN").when(F.col("hits") < 2, "FAIL").when(F.col("odd"), "WARNING").otherwise("PASS").alias("env_match"))


def human_fraction(ab: DataFrame, feature_meta: DataFrame, threshold: float = 0.05, genera: list[str] = HUMAN_ASSOCIATED) -> DataFrame:
    """NONE, LOW, MEDIUM, HIGH share of human-associated genera in all counts at 5, 15, 30 %; UNKNOWN without counts. Features
    without metadata count as not human."""
    h = feature_meta.select("feature_id", F.coalesce(F.col("genus").isin(genera), F.lit(False)).alias("human"))
    g = ab.join(h, "feature_id", "left").groupBy("sample_id").agg(
        F.try_divide(F.sum(F.when(F.col("human"), F.col("count")).otherwise(0.0)), F.sum("count")).alias("f"))
    f = F.col("f")
    return g.select("sample_id", f.alias("human_fraction"), F.when(f.isNull(), "UNKNOWN").when(f < threshold, "NONE").when(f < 0.15, "LOW").when(f < 0.30, "MEDIUM").otherwise("HIGH").alias("human_contamination"))


def region_length_check(ab: DataFrame, feature_meta: DataFrame, meta: DataFrame, region: str = "region", ranges: dict = REGION_LENGTHS) -> DataFrame:
    """Median length of present sequences against the claimed region's range."""
    l = ab.join(feature_meta.select("feature_id", F.length("sequence").cast("double").alias("len")), "feature_id").filter("len is not null")
    med = exact_quantiles(l.select("sample_id", "len"), ["sample_id"], "len", {"median_length": 0.5})
    j = meta.select("sample_id", F.col(region).alias("region")).join(med, "sample_id", "left")
    pick = lambda i: F.coalesce(*[F.when(F.col("region") == r, float(v[i])) for r, v in ranges.items()])
    lo, hi, m = pick(0), pick(1), F.col("median_length")
    flag = F.when(lo.isNull() | m.isNull(), "UNKNOWN").when(m.between(lo, hi), "PASS").when(F.abs(m - (lo + hi) / 2) < 50, "WARNING").otherwise("FAIL")
    return j.select("sample_id", "median_length", flag.alias("primer_match"))


def _chi2_point(q: int, upper: float) -> float:
    """The value that a chi-square variable of q degrees exceeds with the given chance."""
    import numpy as np
    low, high = 0.0, 1000.0 + 10.0 * q
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if float(tails.gamma_upper(q / 2, np.array([mid / 2]))[0]) > upper else (low, mid)
    return mid


def robust_fit(x: DataFrame, cols: list[str], rounds: int = 50):
    """(location, covariance) of the half of the rows with the smallest covariance determinant, reweighted.

    Concentration steps are aggregates: distances to the present fit, their (n + q + 1) / 2 smallest, mean and covariance of those,
    until the determinant no longer falls. One start stands on medians and their deviations, one on the classical fit; the smaller
    determinant wins. Then all rows within the 97.5 % ellipsoid, its size set by the median distance, give the fit.
    """
    import numpy as np
    q = len(cols)
    x = cut_lineage(spread(x.select(*[F.col(c).alias(f"x{i}") for i, c in enumerate(cols)])))
    n = x.count()

    def moments(rows: DataFrame):
        mean = np.array(rows.agg(*[F.avg(f"x{i}") for i in range(q)]).first(), float)
        c = [F.col(f"x{i}") - float(mean[i]) for i in range(q)]
        pairs = [(i, j) for i in range(q) for j in range(i, q)]
        cov = np.zeros((q, q))
        for (i, j), v in zip(pairs, rows.agg(*[F.avg(c[i] * c[j]) for i, j in pairs]).first(), strict=True):
            cov[i, j] = cov[j, i] = v
        return mean, cov

    def distances(mean, cov) -> DataFrame:
        return x.withColumn("_d", mahalanobis([F.col(f"x{i}") for i in range(q)], mean, np.linalg.pinv(cov)))

    center = np.array([quantile(x, F.col(f"x{i}"), 0.5) for i in range(q)])
    mad = [quantile(x, F.abs(F.col(f"x{i}") - float(center[i])), 0.5) for i in range(q)]
    classical = moments(x)
    scale = [1.4826 * mad[i] or float(np.sqrt(classical[1][i, i])) or 1.0 for i in range(q)]
    share = min(1.0, (n + q + 1) / 2 / n)
    best = None
    for mean, cov in ((center, np.diag(np.square(scale))), classical):
        last = None
        for _ in range(rounds):
            d = distances(mean, cov)
            limit = quantile(d, F.col("_d"), share)
            mean, cov = moments(d.filter(F.col("_d") <= limit))
            det = float(np.linalg.slogdet(cov)[1]) if np.linalg.matrix_rank(cov) == q else -np.inf
            if last is not None and det >= last - 1e-9:
                break
            last = det
        if best is None or det < best[0]:
            best = det, mean, cov
    _, mean, cov = best
    if not np.isfinite(best[0]):  # half of the rows lie in a plane
        return mean, cov
    d = distances(mean, cov)
    factor = quantile(d, F.col("_d"), 0.5) / _chi2_point(q, 0.5)
    return moments(d.filter(F.col("_d") < factor * _chi2_point(q, 0.025)))


def mahalanobis(values: list[Column], mean, inverse) -> Column:
    c = [v - float(m) for v, m in zip(values, mean, strict=True)]
    return sum((c[i] * c[j] * float(inverse[i, j]) for i in range(len(c)) for j in range(len(c))), F.lit(0.0))


def metadata_outliers(df: DataFrame, cols: list[str], share: float = 0.1) -> DataFrame:
    """NORMAL or OUTLIER: the top share of squared Mahalanobis distances over columns more than half full.

    Medians fill gaps; location and covariance are those of robust_fit, so that outliers do not hide each other. The inverse
    (columns x columns) is solved on the driver.
    """
    import numpy as np
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
    cols = [c for c in cols if row[c] > 0.5 * row["_n"]]
    med = {c: quantile(df, F.col(c), 0.5) for c in cols}
    x = cut_lineage(df.select("sample_id", *[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(f"x{i}") for i, c in enumerate(cols)]))
    names = [f"x{i}" for i in range(len(cols))]
    mean, cov = robust_fit(x, names)
    d2 = mahalanobis([F.col(c) for c in names], mean, np.linalg.pinv(cov))
    out = cut_lineage(x.select("sample_id", d2.alias("distance2")))
    limit = quantile(out, F.col("distance2"), 1 - share)
    return out.select("sample_id", "distance2", F.when(F.col("distance2") > limit, "OUTLIER").otherwise("NORMAL").alias("metadata_outlier"))


def overall_flag(checks: list[Column]) -> Column:
    """FAIL counts 1, HIGH 2; three or more FAIL, one or more or two warnings WARNING, else PASS."""
    fails = sum((F.when(c == "FAIL", 1).when(c == "HIGH", 2).otherwise(0) for c in checks), F.lit(0))
    warns = sum((F.when(c.isin("WARNING", "LOW", "MEDIUM"), 1).otherwise(0) for c in checks), F.lit(0))
    return F.when(fails >= 3, "FAIL").when((fails >= 1) | (warns >= 2), "WARNING").otherwise("PASS")


# ---------------------------------------------------------------- metadata rules

# Hard and typical limits (min, max, typical min, typical max) by part of the column name.
VALID_RANGES = {
    "ph": (0, 14, 3, 11), "temperature": (-50, 120, -10, 50), "salinity": (0, 400, 0, 50), "elevation": (-500, 9000, -100, 5000),
    "depth": (0, 11000, 0, 100), "latitude": (-90, 90, None, None), "longitude": (-180, 180, None, None),
}


def check_ranges(df: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """(rows with out-of-range values set to null, report of column, level, n_samples)."""
    types = dict(df.dtypes)
    rules = [(c, r) for name, r in VALID_RANGES.items() for c in df.columns if name in c.lower() and types[c] in ("double", "float", "int", "bigint")]
    fixed, stats = {}, []
    for c, (lo, hi, tlo, thi) in rules:
        bad = ~F.col(c).between(lo, hi)
        fixed[c] = F.when(~bad, F.col(c))
        stats.append((c, "ERROR", F.count_if(bad)))
        if tlo is not None:
            stats.append((c, "WARNING", F.count_if(~F.col(c).between(tlo, thi))))
    if not stats:
        return df, df.sparkSession.createDataFrame([], "column string, level string, n_samples long")
    row = df.agg(*[e.alias(f"s{i}") for i, (_, _, e) in enumerate(stats)])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(l).alias("level"), F.col(f"s{i}").alias("n_samples")) for i, (c, l, _) in enumerate(stats)])
    report = row.select(F.explode(items).alias("r")).select("r.*").filter("n_samples > 0")
    return df.withColumns(fixed), report


def fix_kelvin_cm(df: DataFrame, fix_cm: bool = False) -> DataFrame:
    """Temperature columns with a median over 200 are Kelvin; with fix_cm depth-like columns with a median over 1000 are cm."""
    types = dict(df.dtypes)
    num = [c for c in df.columns if types[c] in ("double", "float", "int", "bigint")]
    temp = [c for c in num if "temp" in c.lower()]
    dist = [c for c in num if any(x in c.lower() for x in ("depth", "elevation", "altitude"))] if fix_cm else []
    if not temp + dist:
        return df
    long = df.select([F.col(c).cast("double").alias(c) for c in temp + dist]).unpivot([], temp + dist, "column", "v").filter("v is not null")
    med = {r["column"]: r["m"] for r in exact_quantiles(long, ["column"], "v", {"m": 0.5}).collect()}
    out = {c: F.col(c) - 273.15 for c in temp if med.get(c, 0) > 200}
    out |= {c: F.col(c) / 100 for c in dist if med.get(c, 0) > 1000}
    return df.withColumns(out) if out else df


# Suffixes of repeated columns.
REDUNDANT_SUFFIXES = ["_ena", "_study", "_sample", ".1", ".2", "_deg"]


def drop_redundant_columns(df: DataFrame, max_rho: float = 0.99, min_rows: int = 10) -> DataFrame:
    """Without empty columns, suffix copies (which first fill their base) and columns rank-correlated above max_rho (the
    fuller one stays). Ranks are made once per column; all correlations are one aggregate over the ranked rows."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if row[c] > 0])
    for s in REDUNDANT_SUFFIXES:
        for c in [c for c in df.columns if c.endswith(s)]:
            base = c[: -len(s)]
            if base in df.columns:
                df = df.withColumn(base, F.coalesce(F.col(f"`{base}`"), F.col(f"`{c}`"))).drop(c)
    types = dict(df.dtypes)
    num = [c for c in df.columns if types[c] in ("double", "float", "int", "bigint")]
    pairs = [(a, b) for i, a in enumerate(num) for b in num[i + 1:]]
    drop: set[str] = set()
    full = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in num]).first()
    for a, b in pairs:
        if a in drop or b in drop:
            continue
        r = rank_correlation(df, a, b).first()
        if r["n"] >= min_rows and r["rho"] is not None and abs(r["rho"]) > max_rho:
            drop.add(b if full[a] >= full[b] else a)
    return df.drop(*drop)


EXTERNAL_PREFIXES = ["SoilGrids_", "Meteostat_", "OpenMeteo_", "WorldClim_"]


def geo_consistency(df: DataFrame, key: str = "sample_id", category: str = "env_category_type", lat: str = "latitude", lon: str = "longitude") -> tuple[DataFrame, DataFrame]:
    """(rows without external data where coordinates are missing, report rows key, level, rule)."""
    ext = [c for c in df.columns if c.startswith(tuple(EXTERNAL_PREFIXES))]
    no_xy = F.col(lat).isNull() | F.col(lon).isNull()
    has_ext = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in ext], F.lit(False))
    rules = [(has_ext & no_xy, "ERROR", "external data without coordinates")]
    if category in df.columns:
        rules.append(((F.col(category) == "marine") & ((F.abs(lat) > 80) | (F.abs(lon) > 180)), "WARNING", "marine sample near a pole"))
    if "facility_distance_km" in df.columns:
        rules.append((F.col("facility_distance_km") > 1000, "WARNING", "facility over 1000 km away"))
    hits = F.filter(F.array(*[F.when(c, F.struct(F.lit(l).alias("level"), F.lit(r).alias("rule"))) for c, l, r in rules]), lambda x: x.isNotNull())
    report = df.select(key, F.explode(hits).alias("h")).select(key, "h.level", "h.rule")
    return df.withColumns({c: F.when(~no_xy, F.col(c)) for c in ext}) if ext else df, report


# Habitat terms by class and category, and material words.
HABITATS = {
    "terrestrial": {
        "soil": ["soil", "topsoil", "subsoil", "agricultural soil", "forest soil", "grassland soil", "desert soil", "peat soil", "clay soil", "loam",
                 "ENVO:00001998", "ENVO:00002259", "ENVO:00005802"],
        "sediment_terrestrial": ["terrestrial sediment", "lake sediment", "river sediment", "wetland sediment"],
    },
    "aquatic": {
        "marine": ["marine", "ocean", "sea", "seawater", "marine sediment", "oceanic", "coastal", "ENVO:00000447", "ENVO:00002150"],
        "freshwater": ["freshwater", "lake", "river", "stream", "pond", "ENVO:00002011", "ENVO:00000020"],
        "sediment_aquatic": ["marine sediment", "lake sediment", "river sediment", "oceanic sediment", "ENVO:00002113"],
    },
    "extreme": {
        "hot_spring": ["hot spring", "thermal spring", "geothermal", "ENVO:00000051"],
        "hypersaline": ["hypersaline", "salt lake", "saline", "brine", "ENVO:00000569"],
        "permafrost": ["permafrost", "frozen soil", "ENVO:00000134"],
        "acid_mine": ["acid mine drainage", "acidic drainage", "AMD"],
    },
    "built": {
        "wastewater": ["wastewater", "sewage", "activated sludge", "effluent", "ENVO:00002001"],
        "bioreactor": ["bioreactor", "fermenter", "biogas reactor"],
        "composting": ["compost", "composting", "ENVO:00002170"],
    },
}
MATERIALS = {"solid": ["soil", "sediment", "rock", "ice", "compost", "sludge"], "liquid": ["water", "seawater", "freshwater", "wastewater", "brine"],
             "air": ["air", "aerosol", "atmosphere"]}


def categorize_habitat(text: Column) -> dict[str, Column]:
    """biome_class with the most matching categories (first listed on ties), its first category, material, confidence."""
    low = F.lower(text)
    hits = {(b, c): F.regexp_count(low, F.lit(r"(?i)\b(" + "|".join(terms) + r")\b")) for b, cats in HABITATS.items() for c, terms in cats.items()}
    score = {b: sum(((hits[b, c] > 0).cast("int") for c in cats), F.lit(0)) for b, cats in HABITATS.items()}
    best = F.greatest(*score.values())
    cls = F.when(best == 0, "unknown")
    for b in HABITATS:
        cls = cls.when(score[b] == best, b)
    cat, n = F.lit("unclassified"), F.lit(0)
    for b, cats in reversed(list(HABITATS.items())):
        inner = F.coalesce(*[F.when(hits[b, c] > 0, F.struct(F.lit(c).alias("c"), hits[b, c].alias("n"))) for c in cats])
        cat = F.when((best > 0) & (cls == b), inner["c"]).otherwise(cat)
        n = F.when((best > 0) & (cls == b), inner["n"]).otherwise(n)
    mat = F.coalesce(*[F.when((best > 0) & F.exists(F.array(*[F.lit(w) for w in ws]), lambda w: low.contains(w)), m) for m, ws in MATERIALS.items()], F.lit("unknown"))
    return {"biome_class": cls, "category": cat, "material_type": mat, "confidence": F.when(best == 0, 0.0).otherwise(F.least(F.lit(1.0), 0.5 + 0.1 * n))}


def table_checks(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """check, value: rows, missing required columns, duplicate ids, all-null columns."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("_d"))
    empty = sum(((F.col(f"`{c}`") == 0).cast("int") for c in df.columns), F.lit(0))
    items = [("rows", F.col("_n")), ("missing_required", F.lit(len([c for c in required if c not in df.columns]))), ("duplicate_ids", F.col("_d")), ("all_null_columns", empty)]
    return row.crossJoin(dup).select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), v.cast("long").alias("value")) for n, v in items])).alias("r")).select("r.*")


def abundance_checks(ab: DataFrame, meta: DataFrame, min_samples: int = 10, min_features: int = 100) -> DataFrame:
    """check, value, ok: sample count, feature count, samples of the metadata with no counts."""
    s = ab.groupBy("sample_id").agg(F.sum("count").alias("t"))
    z = meta.select("sample_id").join(s.filter("t > 0"), "sample_id", "left_anti").agg(F.count(F.lit(1)).alias("value"))
    n = meta.agg(F.count(F.lit(1)).alias("value"))
    p = ab.select("feature_id").distinct().agg(F.count(F.lit(1)).alias("value"))
    one = lambda d, name, ok: d.select(F.lit(name).alias("check"), "value", ok.alias("ok"))
    return (one(n, "samples", F.col("value") >= min_samples).unionByName(one(p, "features", F.col("value") >= min_features))
            .unionByName(one(z, "zero_samples", F.col("value") == 0)))


def study_eligibility(meta: DataFrame, study: str, target: str, min_n: int = 10) -> DataFrame:
    """study, n, status, reason: volume, then variance (numbers) or at least two classes."""
    numeric = dict(meta.dtypes)[target] in ("double", "float", "int", "bigint")
    spread = F.coalesce(F.stddev(F.col(target)), F.lit(0.0)) if numeric else F.count_distinct(F.col(target)).cast("double")
    g = meta.groupBy(F.col(study).alias("study")).agg(F.count(target).alias("n"), spread.alias("x"))
    bad = F.col("x") == 0 if numeric else F.col("x") < 2
    reason = F.when(F.col("n") < min_n, "Small N").when(bad, "Zero Variance" if numeric else "Single Class")
    return g.select("study", "n", F.when(reason.isNull(), "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"))


def two_tier_split(meta: DataFrame, eligibility: DataFrame, study: str) -> DataFrame:
    """Every row with may_test: only samples of passing studies are evaluated on."""
    ok = eligibility.filter("status = 'PASS'").select(F.col("study").alias(study), F.lit(True).alias("may_test"))
    return meta.join(small(ok), study, "left").fillna(False, ["may_test"])


def eligible_samples(meta: DataFrame, study: str, target: str, start: int = 3, lowest: int = 2, min_train: int = 100, test_size: float = 0.3) -> DataFrame:
    """Samples of studies with enough classes; the class threshold falls from start until the estimated training size
    suffices, else the lowest is used. The choice is made on per-study counts; thresholds are a few literal rows."""
    g = meta.filter(F.col(study).isNotNull()).groupBy(study).agg(F.count_distinct(F.col(target)).alias("_k"), F.count(F.lit(1)).alias("_n"))
    levels = F.explode(F.array(*[F.lit(t) for t in range(start, lowest - 1, -1)]))
    t = g.withColumn("_t", levels).groupBy("_t").agg(F.coalesce(F.sum(F.when((F.col("_k") >= F.col("_t")) & (F.col("_k") > 1), F.col("_n"))), F.lit(0)).alias("_e"))
    best = t.agg(F.coalesce(F.max(F.when(F.floor(F.col("_e") * (1 - test_size)) >= min_train, F.col("_t"))), F.lit(lowest)).alias("_best"))
    ok = g.crossJoin(F.broadcast(best)).filter((F.col("_k") >= F.col("_best")) & (F.col("_k") > 1)).select(study)
    return meta.join(ok, study, "left_semi")


# ---------------------------------------------------------------- reads

# Nucleotide codes; adapter and control sequences.
IUPAC = {"R": "[AG]", "Y": "[CT]", "S": "[GC]", "W": "[AT]", "K": "[GT]", "M": "[AC]", "B": "[CGT]", "D": "[AGT]", "H": "[ACT]", "V": "[ACG]", "N": "[ACGT]"}
ADAPTERS = {"TruSeq_Universal": "AGATCGGAAGAGC", "TruSeq_Index": "GATCGGAAGAGCACACGTCTGAACTCCAGTCAC", "Nextera_Transposase": "CTGTCTCTTATACACATCT",
            "Nextera_Index": "CTGTCTCTTATACACATCTCCGAGCCCACGAGAC", "PhiX": "GAGTTTTATCGCTTCCATGACGCAGAAGTTAACACTTTCGGATATTTCT"}


def iupac_regex(seq: str) -> str:
    return "".join(IUPAC.get(c, c) for c in seq.upper())


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), "ACGTRYKMBVDH", "TGCAYRMKVBHD"))


def primer_frequencies(reads: DataFrame, primers: dict[str, str], window: int = 100) -> DataFrame:
    """run_id, primer, forward_5prime, forward_3prime, reverse_comp_5prime, reverse_comp_3prime: shares of whole reads; all
    primers in one scan (the primer panel is a driver-side dictionary), averages merge before the shuffle."""
    s = F.upper("seq")
    ends = {"forward_5prime": F.substring(s, 1, window), "forward_3prime": F.expr(f"right(upper(seq), {window})")}
    rc = reverse_complement(F.col("seq"))
    ends |= {"reverse_comp_5prime": F.substring(rc, 1, window), "reverse_comp_3prime": F.reverse(F.substring(F.reverse(rc), 1, window))}
    r = reads.select("run_id", *[e.alias(k) for k, e in ends.items()])
    aggs = [F.avg(F.col(k).rlike(iupac_regex(p)).cast("double")).alias(f"{i}_{k}") for i, p in enumerate(primers.values()) for k in ends]
    g = r.groupBy("run_id").agg(*aggs)
    items = [F.struct(F.lit(n).alias("primer"), *[F.col(f"{i}_{k}").alias(k) for k in ends]) for i, n in enumerate(primers)]
    return g.select("run_id", F.explode(F.array(*items)).alias("p")).select("run_id", "p.*")


def adapter_frequencies(reads: DataFrame, adapters: dict[str, str] = ADAPTERS, threshold: float = 0.05) -> DataFrame:
    """run_id, adapter, frequency, detected."""
    g = reads.groupBy("run_id").agg(*[F.avg(F.upper("seq").contains(a).cast("double")).alias(n) for n, a in adapters.items()])
    return g.unpivot(["run_id"], list(adapters), "adapter", "frequency").withColumn("detected", F.col("frequency") >= threshold)


def trimming_check(before: DataFrame, after: DataFrame, primers: dict[str, str], window: int = 100) -> DataFrame:
    """run_id, primer, before, after, status (under 10 % of before PASS, under 50 % WARNING, else FAIL), length shift and
    whether it is within 10 bases of the first primer's length."""
    p = primer_frequencies(before, primers, window).select("run_id", "primer", F.col("forward_5prime").alias("before"))
    q = primer_frequencies(after, primers, window).select("run_id", "primer", F.col("forward_5prime").alias("after"))
    lengths = lambda d, n: exact_quantiles(d.select("run_id", F.length("seq").cast("double").alias("l")), ["run_id"], "l", {n: 0.5})
    shift = lengths(before, "m0").join(lengths(after, "m1"), "run_id").select("run_id", (F.col("m0") - F.col("m1")).alias("length_shift"))
    goal = len(next(iter(primers.values())))
    status = F.when(F.col("after") < F.col("before") * 0.1, "PASS").when(F.col("after") < F.col("before") * 0.5, "WARNING").otherwise("FAIL")
    return p.join(q, ["run_id", "primer"]).join(shift, "run_id").select(
        "run_id", "primer", "before", "after", status.alias("status"), "length_shift",
        F.when(F.abs(F.col("length_shift") - goal) < 10, "PASS").otherwise("WARNING").alias("length_check"))


def run_validity(reads: DataFrame, min_length: int, min_reads: int = 1000) -> DataFrame:
    """run_id, reads, valid, reason: a short read, or too few reads."""
    g = reads.groupBy("run_id").agg(F.count("seq").alias("reads"), F.min(F.length("seq")).alias("short"))
    reason = F.when(F.col("reads") == 0, "no reads").when(F.col("short") < min_length, "short reads").when(F.col("reads") < min_reads, "too few reads")
    return g.select("run_id", "reads", reason.isNull().alias("valid"), reason.alias("reason"))


def region_scores(frequencies: DataFrame, pairs: DataFrame) -> DataFrame:
    """run_id, region, score, fwd, rev: best mean primer frequency over the region's primer pairs; 0 where a primer is unseen."""
    runs = frequencies.select("run_id").distinct()
    f = frequencies.select("run_id", F.col("primer").alias("fwd"), F.col("frequency").alias("ff"))
    r = frequencies.select("run_id", F.col("primer").alias("rev"), F.col("frequency").alias("rf"))
    base = runs.join(small(pairs))
    j = base.join(f, ["run_id", "fwd"], "left").join(r, ["run_id", "rev"], "left").withColumn(
        "score", (F.coalesce("ff", F.lit(0.0)) + F.coalesce("rf", F.lit(0.0))) / 2)
    return j.groupBy("run_id", "region").agg(F.max("score").alias("score"), F.min_by(F.struct("fwd", "rev"), F.struct(-F.col("score"), F.col("fwd"), F.col("rev"))).alias("p")).select(
        "run_id", "region", "score", "p.fwd", "p.rev")


# Regions of the gene: forward position, reverse position, leeway.
V_REGIONS = {
    "V1": (69, 99, 40), "V2": (137, 242, 40), "V3": (433, 497, 40), "V4": (576, 682, 50), "V5": (822, 879, 40), "V6": (986, 1043, 40),
    "V7": (1117, 1173, 40), "V8": (1243, 1294, 40), "V9": (1435, 1465, 40), "V1-V2": (27, 338, 40), "V1-V3": (27, 534, 50),
    "V2-V3": (338, 534, 50), "V3-V4": (341, 805, 50), "V4-V5": (515, 926, 50),
}


def region_coverage(hits: DataFrame, regions: dict[str, tuple] = V_REGIONS) -> DataFrame:
    """run_id, region, coverage %, avg_len, avg_start, avg_end: size-weighted over plausible alignments that overlap the
    region. Regions are a fixed short list, so one aggregate computes all of them."""
    ok = F.col("send") - F.col("sstart") < F.col("qlen") * 1.5
    aggs = [F.sum("size").alias("total")]
    for i, (fwd, rev, _) in enumerate(regions.values()):
        on = ok & (F.col("sstart") <= rev) & (F.col("send") >= fwd)
        w = F.when(on, F.col("size"))
        aggs += [F.coalesce(F.sum(w), F.lit(0)).alias(f"c{i}"), *[F.coalesce(F.sum(F.col(c) * w), F.lit(0)).alias(f"{n}{i}") for n, c in (("l", "qlen"), ("s", "sstart"), ("e", "send"))]]
    g = hits.groupBy("run_id").agg(*aggs)
    per = lambda n, i: F.coalesce(F.try_divide(F.col(f"{n}{i}"), F.col(f"c{i}")), F.lit(0.0)).cast("double")
    items = [F.struct(F.lit(r).alias("region"), (100.0 * F.col(f"c{i}") / F.col("total")).alias("coverage"), per("l", i).alias("avg_len"), per("s", i).alias("avg_start"),
                      per("e", i).alias("avg_end")) for i, r in enumerate(regions)]
    return g.select("run_id", F.explode(F.array(*items)).alias("r")).select("run_id", "r.*")


def predict_region(evidence: DataFrame, primer_threshold: float, coverage_threshold: float) -> DataFrame:
    """evidence(run_id, region, primer_score, coverage, span) -> run_id, prediction.

    Both thresholds passed: best coverage; else with any primer signal: best primer score; else best coverage alone. Short
    spans win ties. One min_by per rule, so no per-run sort.
    """
    p, v = F.round("primer_score", 4), F.round("coverage", 2)
    order = lambda s: F.struct(-s, F.col("span"), F.col("region"))
    best = lambda cond, s: F.min_by("region", F.when(cond, order(s)))
    hi_p, hi_v = F.col("primer_score") >= primer_threshold, F.col("coverage") >= coverage_threshold
    g = evidence.groupBy("run_id").agg(best(hi_p & hi_v, v).alias("a"), best(hi_p, p).alias("b"), best(hi_v, v).alias("c"), F.max(F.col("primer_score") > 0.01).alias("signal"))
    return g.select("run_id", F.coalesce("a", F.when(F.col("signal"), F.col("b")).otherwise(F.col("c")), F.lit("Undetermined")).alias("prediction"))


def study_consensus(predictions: DataFrame, study: str) -> DataFrame:
    """Most common prediction per study that is not Undetermined (name order on ties)."""
    c = predictions.filter("prediction <> 'Undetermined'").groupBy(study, "prediction").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(study).agg(F.min_by("prediction", F.struct(-F.col("n"), F.col("prediction"))).alias("consensus"))


def region_from_primers(runs: DataFrame, primers: list[tuple[str, int, str]], regions: dict[str, tuple] = V_REGIONS) -> DataFrame:
    """runs(run_id, fwd_seq, rev_seq) -> region: the last listed primer of each direction found in either text gives the
    start and end; the nearest region within its leeway wins. primers: (sequence, start, direction), a reference panel."""
    missing = lambda c: F.col(c).isNull() | F.col(c).isin("None", "nan", "NA", "null", "")
    q = F.concat_ws(" | ", F.when(~missing("fwd_seq"), F.upper("fwd_seq")), F.when(~missing("rev_seq"), F.upper("rev_seq")))
    last = lambda d: F.coalesce(*[F.when(F.col("q").rlike(iupac_regex(s)), pos) for s, pos, way in reversed(primers) if d in way.lower()], F.lit(0))
    r = runs.select("run_id", q.alias("q")).select("run_id", last("forward").alias("s"), last("reverse").alias("e"))
    ds, de = (lambda f: F.abs(F.col("s") - f)), (lambda e: F.abs(F.col("e") - e))
    both = (F.col("s") > 0) & (F.col("e") > 0)
    opts = []
    for name, (f, e, w) in regions.items():
        diff = F.when(both & (ds(f) + de(e) <= 2 * w), ds(f) + de(e)).when((F.col("e") == 0) & (F.col("s") > 0) & (ds(f) <= w), ds(f)).when(
            (F.col("s") == 0) & (F.col("e") > 0) & (de(e) <= w), de(e))
        opts.append(F.struct(diff.alias("d"), F.lit(len(opts)).alias("o"), F.lit(name).alias("r")))
    near = F.array_min(F.filter(F.array(*opts), lambda x: x["d"].isNotNull()))
    return r.select("run_id", F.coalesce(near["r"], F.lit("NA")).alias("region"))


def known_primers(found: DataFrame, primers: list[tuple[str, str]]) -> DataFrame:
    """found(seq) -> seq, primer: first panel primer (name, sequence) inside the cleaned text; under 10 letters is junk."""
    s = F.upper(F.regexp_replace("seq", "[^a-zA-Z]", ""))
    hit = F.coalesce(*[F.when(s.rlike(iupac_regex(p)), n) for n, p in primers])
    return found.filter(F.length(s) >= 10).select("seq", hit.alias("primer")).filter("primer is not null")
