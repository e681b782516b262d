"""Filters and reshaping of (sample_id, feature_id, count) tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from meadow.operators.kernels import running_total, small
from meadow.schema import EMPTY_RANKS, RANKS


def sample_totals(ab: DataFrame) -> DataFrame:
    return ab.groupBy("sample_id").agg(F.sum("count").alias("total"))


def feature_totals(ab: DataFrame) -> DataFrame:
    return ab.groupBy("feature_id").agg(F.sum("count").alias("total"))


def with_share(ab: DataFrame, key: str = "sample_id") -> DataFrame:
    """Adds share = count / total of the key. Totals are a partial aggregate joined back, so a hot key is not one
    window; AQE splits a skewed join key."""
    tot = ab.groupBy(key).agg(F.sum("count").alias("_total"))
    return ab.join(tot, key).withColumn("share", F.col("count") / F.col("_total")).drop("_total")


def normalize(ab: DataFrame, axis: int = 1) -> DataFrame:
    """Divide by sample totals (axis 1) or feature totals (axis 0)."""
    return (with_share(ab, "sample_id" if axis == 1 else "feature_id")
            .select("sample_id", "feature_id", F.col("share").alias("count")))


def filter_features(ab: DataFrame, min_rel_abundance: float, min_samples: int, on: str = "share") -> DataFrame:
    """Features whose largest share (or raw count) is >= min_rel_abundance % and that are in >= min_samples samples."""
    base = with_share(ab) if on == "share" else ab.withColumn("share", F.col("count"))
    keep = (base.groupBy("feature_id").agg(F.max("share").alias("m"), F.count(F.lit(1)).alias("n"))
            .filter((F.col("m") >= min_rel_abundance / 100) & (F.col("n") >= min_samples)))
    return ab.join(keep, "feature_id", "left_semi")


def filter_samples(ab: DataFrame, min_counts: float) -> DataFrame:
    return ab.join(sample_totals(ab).filter(F.col("total") >= min_counts), "sample_id", "left_semi")


def top_share_features(ab: DataFrame, share: float = 0.99) -> DataFrame:
    """The most abundant features that together reach the share of all counts, largest first, ties by id."""
    tot = feature_totals(ab)
    grand = tot.agg(F.sum("total").alias("grand"))
    by_total = tot.groupBy("total").agg(F.sum("total").alias("w"))
    run = running_total(by_total.withColumn("neg", -F.col("total")), [], "neg", "w")
    place = W.partitionBy("total").orderBy("feature_id")
    ranked = tot.withColumn("k", F.row_number().over(place))
    before = F.col("cum") - F.col("w") + (F.col("k") - 1) * F.col("total")
    return (ranked.join(run.drop("neg"), "total").crossJoin(F.broadcast(grand))
            .filter(before / F.col("grand") < share).select("feature_id"))


def presence_absence(ab: DataFrame, share: float = 0.99) -> DataFrame:
    """0/1 table limited to the most abundant features that reach the share of all counts."""
    return (ab.join(top_share_features(ab, share), "feature_id", "left_semi")
            .select("sample_id", "feature_id", F.lit(1.0).alias("count")))


def filter_presence_absence(ab: DataFrame, meta: DataFrame, col: str, prevalence: float,
                            group_prevalence: float) -> DataFrame:
    """Features present in >= prevalence of samples and >= group_prevalence of the True and of the False group."""
    m = meta.select("sample_id", F.col(col).alias("g"))
    size = m.agg(F.count(F.lit(1)).alias("n"), F.count_if("g").alias("nt"), F.count_if(~F.col("g")).alias("nf"))
    kept = ab.join(m, "sample_id")
    stats = kept.groupBy("feature_id").agg(F.count(F.lit(1)).alias("p"), F.count_if("g").alias("pt"),
                                           F.count_if(~F.col("g")).alias("pf"))
    keep = stats.crossJoin(F.broadcast(size)).filter(
        (F.col("p") / F.col("n") >= prevalence) & (F.col("pt") / F.col("nt") >= group_prevalence)
        & (F.col("pf") / F.col("nf") >= group_prevalence))
    return kept.join(keep, "feature_id", "left_semi").select("sample_id", "feature_id", "count")


def filter_by_prevalence(ab: DataFrame, meta: DataFrame, batch: str, min_sample_prevalence: float = 0.10,
                         min_project_prevalence: float = 0.05) -> DataFrame:
    """Features in >= 10 % of samples and in >= 5 % of projects. Metadata rows are the samples."""
    m = meta.select("sample_id", F.col(batch).alias("b"))
    size = m.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("b").alias("nb"))
    per = (ab.join(m, "sample_id").groupBy("feature_id", "b").agg(F.count(F.lit(1)).alias("c"))
           .groupBy("feature_id").agg(F.sum("c").alias("p"), F.count("b").alias("pb")))
    keep = per.crossJoin(F.broadcast(size)).filter(
        (F.col("p") >= min_sample_prevalence * F.col("n")) & (F.col("pb") >= min_project_prevalence * F.col("nb")))
    return ab.join(keep, "feature_id", "left_semi")


def drop_nontarget_taxa(ab: DataFrame, ranks: DataFrame) -> DataFrame:
    """Without eukaryotes, mitochondria and chloroplasts; samples left with no rows disappear by themselves."""
    has = lambda c, p: F.coalesce(F.col(c).rlike(p), F.lit(False))
    bad = ranks.filter(has("kingdom", "(?i)Eukaryota|Eukarya") | has("family", "(?i)mitochondria")
                       | has("order", "(?i)chloroplast")).select("feature_id")
    return ab.join(bad, "feature_id", "left_anti")


def filter_depth_prevalence(ab: DataFrame, min_depth: float = 5000, min_samples: int = 2) -> DataFrame:
    """Deep samples first, then features in >= min(min_samples, n) of them."""
    deep = filter_samples(ab, min_depth)
    n = deep.select("sample_id").distinct().agg(F.least(F.count(F.lit(1)), F.lit(min_samples)).alias("need"))
    keep = (deep.groupBy("feature_id").agg(F.count(F.lit(1)).alias("p")).crossJoin(F.broadcast(n))
            .filter(F.col("p") >= F.col("need")))
    return deep.join(keep, "feature_id", "left_semi")


def drop_empty(ab: DataFrame, meta: DataFrame, feature_meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sample and feature metadata rows that have any count."""
    live = ab.filter(F.col("count") > 0)
    return (meta.join(live.select("sample_id").distinct(), "sample_id", "left_semi"),
            feature_meta.join(live.select("feature_id").distinct(), "feature_id", "left_semi"))


def _parts(taxonomy):
    return F.filter(F.transform(F.split(taxonomy, ";"), lambda p: F.trim(p)), lambda p: p != "")


def parse_taxonomy(feature_meta: DataFrame, col: str = "taxonomy") -> DataFrame:
    """Ranks without their x__ prefix, and genus_label = 6th part or Unclassified_<last part>."""
    parts = _parts(F.col(col))
    out = feature_meta.withColumn("_p", parts)
    for i, rank in enumerate(RANKS):
        label = F.regexp_replace(F.get("_p", F.lit(i)), "^[a-z]__", "")
        out = out.withColumn(rank, F.when(label != "", label))
    last = F.when(F.size("_p") > 0, F.element_at("_p", -1)).otherwise("Unknown")
    genus = (F.when(F.col(col).isNull() | (F.col(col) == "Unassigned"), "Unassigned")
             .when(F.size("_p") >= 6, F.get("_p", F.lit(5)))
             .otherwise(F.concat(F.lit("Unclassified_"), last)))
    return out.withColumn("genus_label", genus).drop("_p")


def genus_of(taxonomy):
    """Last usable g__ part, else last usable part, else Unknown."""
    parts = F.transform(F.split(taxonomy, ";"), lambda p: F.trim(p))
    usable = lambda p: (p != "") & ~F.lower(p).isin("unclassified", "uncultured")
    genera = F.filter(F.transform(F.filter(parts, lambda p: p.startswith("g__")),
                                  lambda p: F.trim(F.replace(p, F.lit("g__"), F.lit("")))), usable)
    plain = F.filter(F.transform(F.split(taxonomy, ";"),
                                 lambda p: F.trim(F.replace(F.replace(p, F.lit("__"), F.lit("")), F.lit("_"), F.lit(" ")))), usable)
    last = lambda a: F.when(F.size(a) > 0, F.element_at(a, -1))
    return F.coalesce(last(genera), last(plain), F.lit("Unknown"))


def collapse_taxa(ab: DataFrame, feature_meta: DataFrame, level: int) -> DataFrame:
    """Cut the lineage after its first `level` parts (shorter ones become Unclassified) and sum."""
    p = F.split("taxonomy", ";")
    label = F.when(F.size(p) >= level, F.concat_ws(";", F.slice(p, 1, level))).otherwise("Unclassified")
    return (ab.join(feature_meta.select("feature_id", label.alias("label")), "feature_id")
            .groupBy("sample_id", F.col("label").alias("feature_id")).agg(F.sum("count").alias("count")))


def aggregate_by_rank(ab: DataFrame, feature_meta: DataFrame, rank: str) -> DataFrame:
    """Counts per rank label; Unassigned is dropped unless it is the only label."""
    label = F.trim(F.col(rank).cast("string"))
    fm = feature_meta.select("feature_id", F.when(label.isNull() | label.isin(EMPTY_RANKS), "Unassigned")
                             .otherwise(label).alias("label"))
    named = fm.agg(F.max(F.col("label") != "Unassigned").alias("named"))
    keep = fm.crossJoin(F.broadcast(named)).filter(~F.col("named") | (F.col("label") != "Unassigned"))
    return (ab.join(keep.drop("named"), "feature_id")
            .groupBy("sample_id", F.col("label").alias("feature_id")).agg(F.sum("count").alias("count")))


def trim_and_merge(ab: DataFrame, feature_meta: DataFrame, length: int = 250) -> DataFrame:
    """Cut sequences to a length and sum the counts of equal cut sequences."""
    fm = feature_meta.select("feature_id", F.substring("sequence", 1, length).alias("trimmed"))
    return (ab.join(fm, "feature_id").groupBy("sample_id", F.col("trimmed").alias("feature_id"))
            .agg(F.sum("count").alias("count")))


# Shapes of a feature id.
ID_PATTERNS = [
    ("taxonomic", r"^d__\w+(;p__\w+)?(;c__\w+)?(;o__\w+)?(;f__\w+)?(;g__\w+)?(;s__\w+)?$"),
    ("hashes", r"^[a-f0-9]{32}$|^[a-f0-9]{64}$"),
    ("raw_sequences", r"(?i)^[ACGTRYSWKMBDHVN]+$"),
]


def classify_feature_ids(ids: DataFrame, col: str) -> DataFrame:
    """How many ids look taxonomic, like a hash, like a sequence, or like none of them."""
    kind = F.coalesce(*[F.when(F.col(col).rlike(p), k) for k, p in ID_PATTERNS], F.lit("unknown"))
    return ids.groupBy(kind.alias("id_kind")).agg(F.count(F.lit(1)).alias("n"))


def clean_names(names: DataFrame, col: str, ordinal: str) -> DataFrame:
    """Spaces to _, no []<>., and no leading digits; repeats numbered _1, _2 in ordinal order."""
    s = F.regexp_replace(F.regexp_replace(F.col(col), " ", "_"), r"[\[\]<>\.,]", "")
    s = F.when(s.startswith("ASV_"), s).otherwise(F.regexp_replace(s, r"^[\d_]+", ""))
    df = names.withColumn("base", F.when(s == "", "unnamed_feature").otherwise(s)).withColumn("w", F.lit(1))
    run = running_total(df, ["base"], ordinal, "w", "k")
    tail = F.concat(F.lit("_"), (F.col("k") - 1).cast("string"))
    return run.withColumn("clean", F.when(F.col("k") == 1, F.col("base")).otherwise(F.concat("base", tail))).drop("w", "k", "base")


def subsample_stratified(meta: DataFrame, n: int, group: str, seed: int = 42) -> DataFrame:
    """About n rows keeping group ratios, at least one per group, never more than n.

    Rows are picked by a seeded hash, so the choice is the same for any partitioning.
    """
    h = meta.withColumn("_h", F.xxhash64(F.col("sample_id"), F.lit(seed)))
    sizes = h.groupBy(group).agg(F.count(F.lit(1)).alias("_c"))
    total = h.agg(F.count(F.lit(1)).alias("_all"))
    quota = sizes.crossJoin(F.broadcast(total)).withColumn(
        "_q", F.greatest(F.lit(1), F.rint(F.lit(n) * F.col("_c") / F.col("_all")))).select(group, "_q")
    bucket = F.shiftright("_h", 54)
    ranked = running_total(h.withColumn("_w", F.lit(1)), [group], "_h", "_w", "_k", bucket)
    picked = ranked.join(quota, group).filter(F.col("_k") <= F.col("_q"))
    final = running_total(picked, [], "_h", "_w", "_all_k", bucket)
    return final.filter(F.col("_all_k") <= n).drop("_h", "_w", "_k", "_q", "_all_k")


def feature_moments(ab: DataFrame, n: int | DataFrame) -> DataFrame:
    """mean and population variance per feature over n samples, absent samples counted as zeros."""
    m = ab.groupBy("feature_id").agg(F.sum("count").alias("s"), F.sum(F.col("count") ** 2).alias("ss"),
                                     F.count(F.lit(1)).alias("present"))
    if isinstance(n, DataFrame):
        m = m.crossJoin(F.broadcast(n))
    else:
        m = m.withColumn("n", F.lit(n))
    return m.withColumn("mean", F.col("s") / F.col("n")).withColumn(
        "variance", F.col("ss") / F.col("n") - F.col("mean") ** 2)


def sample_count(ab: DataFrame) -> DataFrame:
    return ab.select("sample_id").distinct().agg(F.count(F.lit(1)).alias("n"))


def top_features(ab: DataFrame, k: int, by: str = "variance") -> DataFrame:
    """k features with the largest variance or mean, zeros included; a top-k sort, ties by id."""
    mom = feature_moments(ab, sample_count(ab))
    return mom.orderBy(F.round(by, 9).desc(), "feature_id").limit(k).select("feature_id", "mean", "variance")


def drop_outlier_samples(ab: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Without samples whose depth or feature count is more than threshold deviations from the mean."""
    per = ab.groupBy("sample_id").agg(F.sum("count").alias("d"), F.count(F.lit(1)).alias("o"))
    g = per.agg(F.avg("d").alias("md"), F.stddev_pop("d").alias("sd"), F.avg("o").alias("mo"), F.stddev_pop("o").alias("so"))
    z = lambda x, m, s: F.coalesce(F.abs(F.try_divide(F.col(x) - F.col(m), F.col(s))), F.lit(0.0))
    bad = per.crossJoin(F.broadcast(g)).filter((z("d", "md", "sd") > threshold) | (z("o", "mo", "so") > threshold))
    return ab.join(bad, "sample_id", "left_anti")


def filter_small_classes(meta: DataFrame, label: str, min_samples: int = 2, max_removed: float = 0.8) -> DataFrame:
    """Drop classes under min_samples, but keep all when under 2 classes, under 10 rows or 10 %, or too much would go."""
    counts = meta.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    ok = F.col("_c") >= min_samples
    d = counts.filter(F.col(label).isNotNull()).agg(
        F.count_if(ok).alias("_k"), F.count(F.lit(1)).alias("_all"),
        F.sum(F.when(ok, F.col("_c")).otherwise(0)).alias("_left"), F.sum("_c").alias("_n"))
    apply = ((F.col("_k") >= 2) & (F.col("_k") < F.col("_all"))
             & (F.col("_left") >= F.greatest(F.lit(10), F.floor(F.col("_n") * 0.1)))
             & (1 - F.col("_left") / F.col("_n") <= max_removed))
    keep = counts.crossJoin(F.broadcast(d)).filter(~apply | ok).select(label)
    return meta.join(keep, label, "left_semi")


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """column, n, non_null, n_unique, n_numeric, min_class: one row per column from value counts.

    Values are counted per (column, value) with partial aggregation, so one popular value costs nothing extra.
    """
    total = df.agg(F.count(F.lit(1)).alias("n"))
    long = df.select([F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "val")
    per = long.groupBy("column", "val").agg(F.count(F.lit(1)).alias("c"))
    known = F.col("val").isNotNull()
    return (per.groupBy("column").agg(
        F.coalesce(F.sum(F.when(known, F.col("c"))), F.lit(0)).alias("non_null"),
        F.count_if(known).alias("n_unique"),
        F.coalesce(F.sum(F.when(F.col("val").try_cast("double").isNotNull(), F.col("c"))), F.lit(0)).alias("n_numeric"),
        F.min(F.when(known, F.col("c"))).alias("min_class")).crossJoin(F.broadcast(total)))


def _kinds(df: DataFrame, cols: list[str]):
    types = dict(df.dtypes)
    def kind(t):
        if t in ("int", "bigint", "smallint", "tinyint"):
            return "int"
        return "float" if t in ("double", "float") or t.startswith("decimal") else "bool" if t == "boolean" else "text"
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(kind(types[c])))])[F.col("column")]


def screen_targets(df: DataFrame, cols: list[str], min_samples_per_group: int = 10, max_classes: int = 10) -> DataFrame:
    """column, valid, reason: enough values, and for classes enough rows per class and not too many classes."""
    p = column_profile(df, cols).withColumn("kind", _kinds(df, cols))
    regression = F.col("kind").isin("int", "float") & (F.col("n_unique") > max_classes)
    reason = (F.when(F.col("non_null") < 20, "too few samples").when(regression, F.lit(None))
              .when(F.col("min_class") < min_samples_per_group, "small class size")
              .when(F.col("n_unique") > max_classes, "too many classes"))
    return p.select("column", reason.isNull().alias("valid"), reason.alias("reason"))


def type_columns(df: DataFrame, cols: list[str], fullness: float = 0.4, max_categories: int = 50,
                 admin: list[str] = (), priority: list[str] = ()) -> DataFrame:
    """column, label (categorical, numeric, excluded), reason."""
    p = column_profile(df, cols).withColumn("kind", _kinds(df, cols))
    prio = F.col("column").isin(list(priority)) | F.col("column").startswith("facility_")
    reason = (F.when(F.col("column").isin(list(admin)), "admin list")
              .when(~prio & (F.col("non_null") / F.col("n") < fullness), "low fullness")
              .when(F.col("n_unique") <= 1, "1 unique value")
              .when((F.col("kind") == "text") & (F.col("n_unique") > max_categories), "high cardinality categorical"))
    label = (F.when(reason.isNotNull(), "excluded").when(F.col("kind") == "float", "numeric")
             .when(F.col("kind") == "int", F.when(F.col("n_unique") < max_categories / 2, "categorical").otherwise("numeric"))
             .when((F.col("kind") == "text") & (F.col("n_numeric") / F.col("non_null") > 0.9), "numeric")
             .otherwise("categorical"))
    return p.select("column", label.alias("label"), reason.alias("reason"))
