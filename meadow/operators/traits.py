"""Traits, functions and ecotypes."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from meadow.operators.kernels import all_pairs, dense_index, exact_quantiles, permute_index, running_total, small, summed_pieces, value_ranks
from meadow.operators.table import sample_count
from meadow.sources.tables import cut_lineage
from meadow.functions import tails


# ---------------------------------------------------------------- functions from names


def lineage_parts(taxonomy):
    """Lower-case lineage names without rank prefixes."""
    t = F.regexp_replace(F.lower(F.trim(taxonomy)), r"\s*[a-z]__\s*", ";")
    t = F.regexp_replace(F.regexp_replace(t, ";+", ";"), "^;|;$", "")
    return F.split(t, ";")


class Wildcards:
    """Patterns with * for any text, matched against a whole name by one automaton over their literal pieces.

    The automaton (a trie with failure links) finds all pieces of a name in one pass over it; a pattern is looked at where its
    longest piece occurs, and then its pieces must follow each other from the name's start to its end."""

    def __init__(self, patterns: list[tuple[str, str]]):
        self.always, self.by_piece, self.automaton = [], {}, ahocorasick.Automaton()
        for pattern, function in sorted(set(patterns)):
            pieces = pattern.split("*")
            key = max(pieces, key=len)
            (self.by_piece.setdefault(key, []) if key else self.always).append((pieces, function))
        for piece in self.by_piece:
            self.automaton.add_word(piece, piece)
        if self.by_piece:
            self.automaton.make_automaton()

    @staticmethod
    def fits(name: str, pieces: list[str]) -> bool:
        first, *middle, last = pieces
        if len(name) < len(first) + len(last) or not name.startswith(first) or not name.endswith(last):
            return False
        at, end = len(first), len(name) - len(last)
        for piece in middle:
            found = name.find(piece, at, end)
            if found < 0:
                return False
            at = found + len(piece)
        return True

    def match(self, name: str) -> list[str]:
        seen = {piece for _, piece in self.automaton.iter(name)} if self.by_piece else set()
        return sorted({f for p in seen for pieces, f in self.by_piece[p] if self.fits(name, pieces)} | {f for _, f in self.always})


def functions_from_taxonomy(feature_meta: DataFrame, patterns: DataFrame) -> DataFrame:
    """feature_id, function for patterns(function, pattern) that match any lineage name as a whole; * is any text.

    Names are made distinct first. Plain patterns are an equi join. Those with * are one automaton, which each task holds and
    applies once to a name; the pattern table, a list of curated names, is taken to the driver for it.
    """
    parts = feature_meta.select("feature_id", F.explode(lineage_parts(F.col("taxonomy"))).alias("name")).filter("name <> ''").distinct()
    names = parts.select("name").distinct()
    p = patterns.select("function", F.lower("pattern").alias("pattern"))
    plain = names.join(p.filter(~F.col("pattern").contains("*")).withColumnRenamed("pattern", "name"), "name")
    wild = [(r["pattern"], r["function"]) for r in p.filter(F.col("pattern").contains("*")).distinct().collect()]

    def matched(batches):
        known = Wildcards(wild)
        for pdf in batches:
            found = [(n, f) for n in pdf["name"] for f in known.match(n)]
            yield pd.DataFrame(found, columns=["name", "function"], dtype=object)

    loose = names.mapInPandas(matched, "name string, function string")
    return parts.join(plain.select("name", "function").unionByName(loose), "name").select("feature_id", "function").distinct()


def functions_per_sample(ab: DataFrame, functions: DataFrame) -> DataFrame:
    """Summed counts of the features with each function."""
    return ab.join(functions, "feature_id").groupBy("sample_id", "function").agg(F.sum("count").alias("count"))


# Genera that carry a function.
FUNCTION_GENERA = {
    "uranium_reduction": ["Geobacter", "Anaeromyxobacter", "Desulfosporosinus"],
    "arsenic_metabolism": ["Sulfurospirillum", "Thermodesulfobacterium", "Bacillus"],
    "heavy_metal_efflux": ["Cupriavidus", "Ralstonia", "Pseudomonas"],
    "nitrate_reduction": ["Bacillus", "Paracoccus", "Pseudomonas"],
    "sulfur_metabolism": ["Thiobacillus", "Allochromatium", "Desulfovibrio"],
    "biofilm_formation": ["Pseudomonas", "Bacillus", "Vibrio"],
}


def functions_from_genus(feature_meta: DataFrame, confidence: float = 0.5, table: dict[str, list[str]] = FUNCTION_GENERA) -> DataFrame:
    """feature_id, function, confidence by genus: a short fixed list turned into an array column, no join."""
    hits = F.filter(F.array(*[F.when(F.col("genus").isin(g), F.lit(f)) for f, g in table.items()]), lambda x: x.isNotNull())
    return feature_meta.select("feature_id", F.explode(hits).alias("function"), F.lit(confidence).alias("confidence"))


def traits_from_text(docs: DataFrame, key: str, text: str, keywords: dict[str, list[str]], caps: dict[str, float], threshold: float = 0.5) -> DataFrame:
    """key, trait, confidence: 0.2 per keyword found, at most 1 and at most the trait's own confidence, kept from threshold."""
    low = F.lower(text)
    score = {t: F.least(F.lit(1.0), sum((low.contains(w.lower()).cast("int") for w in ws), F.lit(0)) * 0.2) for t, ws in keywords.items()}
    items = F.array(*[F.struct(F.lit(t).alias("trait"), s.alias("raw"), F.least(s, F.lit(caps.get(t, 1.0))).alias("confidence")) for t, s in score.items()])
    return docs.select(key, F.explode(items).alias("i")).filter(F.col("i.raw") >= threshold).select(key, "i.trait", "i.confidence")


# ---------------------------------------------------------------- genomes


def filter_hits(hits: DataFrame, identity: float = 0.99, length: int = 50) -> DataFrame:
    share = identity if identity <= 1 else identity / 100
    return hits.filter((F.col("pident") >= share * 100) & (F.col("alnlen") >= length))


def best_hit(hits: DataFrame, min_pident: float = 99.0) -> DataFrame:
    """qseqid, sseqid of the highest bitscore (smallest genome id on ties), weight 1."""
    return (hits.filter(F.col("pident") >= min_pident).groupBy("qseqid")
            .agg(F.min_by("sseqid", F.struct(-F.col("bitscore"), F.col("sseqid"))).alias("sseqid")).withColumn("weight", F.lit(1.0)))


def proportional_hits(hits: DataFrame, min_pident: float = 99.0, weighting: str = "bitscore") -> DataFrame:
    """qseqid, sseqid, weight summing to 1 per query: uniform, bitscore or pident."""
    w = {"uniform": F.lit(1.0), "bitscore": F.col("bitscore").cast("double"), "pident": F.col("pident") / 100.0}[weighting]
    h = hits.filter(F.col("pident") >= min_pident).groupBy("qseqid", "sseqid").agg(F.sum(w).alias("w"))
    tot = h.groupBy("qseqid").agg(F.sum("w").alias("t"))
    return h.join(tot, "qseqid").select("qseqid", "sseqid", (F.col("w") / F.col("t")).alias("weight"))


def mag_ko(genes: DataFrame) -> DataFrame:
    """Distinct (genome, KO) with a known KO."""
    return genes.filter("ko_id is not null and ko_id <> ''").select("mag_id", "ko_id").distinct()


def sample_ko(ab: DataFrame, weights: DataFrame, kos: DataFrame) -> DataFrame:
    """sample_id, ko_id, count = abundance x genome weight x KO presence. Genome abundance is summed before the KO join."""
    g = (ab.join(weights.select(F.col("qseqid").alias("feature_id"), F.col("sseqid").alias("mag_id"), "weight"), "feature_id")
         .groupBy("sample_id", "mag_id").agg(F.sum(F.col("count") * F.col("weight")).alias("x")))
    return g.join(kos, "mag_id").groupBy("sample_id", "ko_id").agg(F.sum("x").alias("count"))


def sample_ko_clr(ko: DataFrame, floor: float = 0.5) -> DataFrame:
    """sample_id, ko_id, clr, zero_clr: values under the floor (absent ones too) raised to it before the log."""
    p = ko.select("ko_id").distinct().count()
    l, z = F.log(F.greatest("count", F.lit(floor))), F.log(F.lit(floor))
    m = ko.groupBy("sample_id").agg(((F.sum(l) + (F.lit(p) - F.count(F.lit(1))) * z) / p).alias("m"))
    return ko.join(m, "sample_id").select("sample_id", "ko_id", (l - F.col("m")).alias("clr"), (z - F.col("m")).alias("zero_clr"))


def phenotype_scores(ko: DataFrame, groups: DataFrame) -> DataFrame:
    """sample_id, phenotype, score: mean KO value of groups(phenotype, ko_id) over the group's KOs that occur at all."""
    g = groups.join(ko.select("ko_id").distinct(), "ko_id", "left_semi").distinct()
    n = g.groupBy("phenotype").agg(F.count(F.lit(1)).alias("k"))
    return (ko.join(g, "ko_id").groupBy("sample_id", "phenotype").agg(F.sum("count").alias("s")).join(small(n), "phenotype")
            .select("sample_id", "phenotype", (F.col("s") / F.col("k")).alias("score")))


def score_correlations(scores: DataFrame, measured: DataFrame, key: str = "phenotype") -> DataFrame:
    """key, measure, rho, n, p_value: Spearman of (sample, key, score) with measured(sample_id, measure, value), both known."""
    j = cut_lineage(scores.join(measured, "sample_id").filter("score is not null and value is not null").select("sample_id", key, "measure", "score", "value"))
    for c, r in (("score", "rx"), ("value", "ry")):
        ranks = value_ranks(j.withColumnRenamed(c, "_v"), [key, "measure"], "_v").select(key, "measure", F.col("value").alias(c), F.col("rank").alias(r))
        j = j.join(ranks, [key, "measure", c])
    g = j.groupBy(key, "measure").agg(F.corr("rx", "ry").alias("rho"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    g = g.withColumns({"t": F.col("rho") * F.sqrt((F.col("n") - 2) / F.greatest(1 - F.col("rho") ** 2, F.lit(1e-15))), "df": (F.col("n") - 2).cast("double")})
    return g.select(key, "measure", "rho", "n", tails.p_t("t", "df").alias("p_value"))


def expression_agreement(predicted: DataFrame, measured: DataFrame) -> DataFrame:
    """ko_id, rho (Spearman of log2(x + 1)), r_squared of predicted against measured, n; cells known on both sides."""
    l = lambda c: F.log2(F.col(c) + 1)
    j = predicted.select("sample_id", "ko_id", F.col("value").alias("p")).join(measured.select("sample_id", "ko_id", F.col("value").alias("e")), ["sample_id", "ko_id"])
    j = cut_lineage(j.filter("p is not null and e is not null").select("sample_id", "ko_id", l("p").alias("p"), l("e").alias("e")))
    r = j
    for c in ("p", "e"):
        ranks = value_ranks(j, ["ko_id"], c).select("ko_id", F.col("value").alias(c), F.col("rank").alias(f"r{c}"))
        r = r.join(ranks, ["ko_id", c])
    g = r.groupBy("ko_id").agg(F.corr("rp", "re").alias("rho"), F.count(F.lit(1)).alias("n"), F.sum((F.col("e") - F.col("p")) ** 2).alias("sr"),
                               (F.var_pop("e") * F.count(F.lit(1))).alias("st"))
    return g.filter("n >= 3").select("ko_id", "rho", (1 - F.try_divide(F.col("sr"), F.col("st"))).alias("r_squared"), "n")


def expression_outliers(predicted: DataFrame, measured: DataFrame, threshold: float = 2.0) -> DataFrame:
    """sample_id, ko_id, z of the squared residual where abs z > threshold."""
    j = predicted.select("sample_id", "ko_id", F.col("value").alias("p")).join(measured.select("sample_id", "ko_id", F.col("value").alias("e")), ["sample_id", "ko_id"])
    r = j.select("sample_id", "ko_id", ((F.col("p") - F.col("e")) ** 2).alias("q"))
    s = r.agg(F.avg("q").alias("m"), F.stddev_pop("q").alias("s"))
    return r.crossJoin(F.broadcast(s)).select("sample_id", "ko_id", ((F.col("q") - F.col("m")) / F.col("s")).alias("z")).filter(F.abs("z") > threshold)


# ---------------------------------------------------------------- trait patterns


def trait_by_taxon(traits: DataFrame, feature_meta: DataFrame, rank: str) -> DataFrame:
    """taxon, trait_count, trait_prevalence of traits(feature_id, value)."""
    j = feature_meta.select("feature_id", F.col(rank).alias("taxon")).join(traits, "feature_id")
    return j.groupBy("taxon").agg(F.sum("value").alias("trait_count"), F.avg("value").alias("trait_prevalence"))


def taxonomic_distance(feature_meta: DataFrame, ranks: list[str], weights: list[int] | None = None) -> DataFrame:
    """a, b, d for every feature pair: the weight (6 for the first rank, down to 0) of the first rank that differs."""
    weights = weights or list(range(6, 6 - len(ranks), -1))
    f = feature_meta.select("feature_id", *[F.coalesce(F.col(r).cast("string"), F.lit("nan")).alias(f"r{i}") for i, r in enumerate(ranks)])
    p = all_pairs(f, "feature_id")
    for s in ("a", "b"):
        p = p.join(f.select(F.col("feature_id").alias(s), *[F.col(f"r{i}").alias(f"{s}{i}") for i in range(len(ranks))]), s)
    d = F.coalesce(*[F.when(F.col(f"a{i}") != F.col(f"b{i}"), F.lit(float(w))) for i, w in enumerate(weights)], F.lit(0.0))
    return p.select("a", "b", d.alias("d"))


def trait_signal(traits: DataFrame, dist: DataFrame, reps: int = 99, seed: int = 42) -> DataFrame:
    """signal, p_value, n_pairs: correlation over pairs with distance > 0 of trait difference and distance, clipped to 0..1;
    p from permuted trait labels, (b + 1) / (B + 1). traits(feature_id, value)."""
    from meadow.operators.beta import _joined, mantel
    t = traits.select(F.col("feature_id").alias("sample_id"), F.col("value").cast("double").alias("v"))
    pairs = dist.filter("d > 0")
    diff = _joined(pairs.select("a", "b"), t, ["v"]).select("a", "b", F.abs(F.col("v_a") - F.col("v_b")).alias("d"))
    if not reps:
        m = mantel(pairs, diff, "pearson", 0)
        return m.select(F.greatest(F.lit(0.0), F.least(F.lit(1.0), "r")).alias("signal"), "n_pairs")
    full = _joined(all_pairs(t, "sample_id"), t, ["v"]).select("a", "b", F.abs(F.col("v_a") - F.col("v_b")).alias("d"))
    return permuted_trait_signal(pairs, full, reps, seed)


def permuted_trait_signal(pairs: DataFrame, diff: DataFrame, reps: int, seed: int) -> DataFrame:
    """Correlation of distances with relabelled trait differences; differences of every pair are needed for relabelling."""
    x, y = cut_lineage(pairs.select("a", "b", F.col("d").alias("x"))), cut_lineage(diff.select("a", "b", F.col("d").alias("y")))
    ids = cut_lineage(dense_index(y.select(F.col("a").alias("id")).unionByName(y.select(F.col("b").alias("id"))).distinct(), "id"))
    n = ids.count()

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def images(i: pd.Series) -> pd.Series:
        return pd.Series(list(permute_index(i.to_numpy(), n, reps, seed)))

    moved = ids.select("id", F.posexplode(images("idx")).alias("rep", "to")).join(ids.select(F.col("id").alias("new"), F.col("idx").alias("to")), "to")
    moved = cut_lineage(moved.select("rep", "id", "new"))
    p = x.join(moved.select("rep", F.col("id").alias("a"), F.col("new").alias("na")), "a").join(moved.select("rep", F.col("id").alias("b"), F.col("new").alias("nb")), ["rep", "b"])
    p = p.select("rep", "x", F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).join(y, ["a", "b"])
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))
    perm = p.groupBy("rep").agg(clip(F.corr("x", "y")).alias("pr"))
    obs = x.join(y, ["a", "b"]).agg(clip(F.corr("x", "y")).alias("signal"), F.count(F.lit(1)).alias("n_pairs"))
    b = F.count_if(F.col("pr") >= F.col("signal") - 1e-12)
    return perm.crossJoin(F.broadcast(obs)).agg(F.max("signal").alias("signal"), ((b + 1) / (reps + 1.0)).alias("p_value"), F.max("n_pairs").alias("n_pairs"))


def rank_trie(feature_meta: DataFrame, ranks: list[str]) -> DataFrame:
    """feature_id and clades, one struct (level, clade) for each clade of two or more features: level i holds the features that
    agree in the first i ranks. Ranks are compared as in taxonomic_distance: as strings, null is a name of its own."""
    names = [F.coalesce(F.col(r).cast("string"), F.lit("nan")) for r in ranks]
    key = lambda i: F.sha2(F.to_json(F.array(*names[:i])), 256)
    f = feature_meta.select("feature_id", F.posexplode(F.array(*[key(i) for i in range(1, len(ranks) + 1)])).alias("level", "clade"))
    f = f.withColumn("level", F.col("level") + 1)
    shared = f.groupBy("level", "clade").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    f = f.join(shared, ["level", "clade"]).groupBy("feature_id").agg(F.collect_list(F.struct("level", F.xxhash64("level", "clade").alias("clade"), "m")).alias("clades"))
    return feature_meta.select("feature_id").join(f, "feature_id", "left")


def clade_sums(rows: DataFrame, reps_col: str = "rep") -> DataFrame:
    """rep, level, pairs, ys, yy: over the pairs inside the clades of a level their number and the sums of |difference| and its square.

    rows (rep, level, clade, m, v). With values in order, L below and m - L - c above a value of c features, the sum of
    |difference| is the sum of v c (2 L + c - m): a sorted running count per clade, no pairs. Equal values merge first."""
    hist = rows.groupBy(reps_col, "level", "clade", "m", "v").agg(F.count(F.lit(1)).alias("c"))
    run = running_total(hist, [reps_col, "level", "clade"], "v", "c", "hi")
    part = run.groupBy(reps_col, "level", "clade").agg(
        F.max("m").alias("m"), F.sum(F.col("v") * F.col("c") * (2 * (F.col("hi") - F.col("c")) + F.col("c") - F.col("m"))).alias("ys"),
        F.sum(F.col("v") * F.col("c")).alias("s"), F.sum(F.col("v") * F.col("v") * F.col("c")).alias("ss"))
    yy = F.greatest(F.col("m") * F.col("ss") - F.col("s") * F.col("s"), F.lit(0.0))
    return part.groupBy(reps_col, "level").agg(F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("pairs"), F.sum("ys").alias("ys"), F.sum(yy).alias("yy"))


def clade_signal(traits: DataFrame, feature_meta: DataFrame, ranks: list[str], weights: list[int] | None = None, reps: int = 99,
                 seed: int = 42, per_pass: int = 25) -> DataFrame:
    """trait_signal on taxonomic distances, without a table of pairs: signal, p_value (where reps), n_pairs.

    The distance of two features is the weight of the first rank that differs, so the pairs at level i of the rank trie less
    those at level i + 1 have weight i, and correlation over pairs needs the sums of clade_sums only. A permutation gives each
    feature the value at its permuted index; per_pass permutations are summed in one pass, P log P each. traits (feature_id,
    value); features without a value or a row in feature_meta take no part.
    """
    weights = weights or list(range(6, 6 - len(ranks), -1))
    t = traits.select("feature_id", F.col("value").cast("double").alias("v")).filter("v is not null")
    f = cut_lineage(dense_index(rank_trie(feature_meta.join(t, "feature_id", "left_semi"), ranks).join(t, "feature_id"), "feature_id"))
    n = f.count()
    spark = f.sparkSession
    ends = "signal double, p_value double, n_pairs long" if reps else "signal double, n_pairs long"
    inside = lambda d: d.select("rep", F.explode("clades").alias("k"), "v").select("rep", "k.level", "k.clade", "k.m", "v")
    top = f.select(F.lit(-1).alias("rep"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("clade"), F.lit(n).cast("long").alias("m"), "v")
    found = clade_sums(top.unionByName(inside(f.withColumn("rep", F.lit(-1))))).collect()
    values = f.select(F.col("idx").alias("to"), "v")

    def images(first: int, size: int):
        @F.pandas_udf(T.ArrayType(T.LongType()))
        def run(i: pd.Series) -> pd.Series:
            return pd.Series(list(permute_index(i.to_numpy(), n, size, seed, first)))
        return run("idx")

    for first in range(0, reps, per_pass):
        moved = f.select("clades", F.posexplode(images(first, min(per_pass, reps - first))).alias("rep", "to")).withColumn("rep", F.col("rep") + first)
        found += clade_sums(inside(moved.join(values, "to"))).collect()
    # One row per permutation and level reaches the driver.
    at = {(r["rep"], r["level"]): (r["pairs"], r["ys"], r["yy"]) for r in found}
    own = [i for i, w in enumerate(weights) if w > 0]

    def correlation(rep: int) -> tuple[float, int]:
        level = lambda i: np.array(at.get((rep if i else -1, i), (0.0, 0.0, 0.0)))
        between = {i: level(i) - level(i + 1) for i in own}
        pairs, ys, yy = sum(between.values(), np.zeros(3))
        xs = sum(weights[i] * between[i][0] for i in own)
        xx = sum(weights[i] ** 2 * between[i][0] for i in own)
        xy = sum(weights[i] * between[i][1] for i in own)
        if not pairs:
            return 0.0, 0
        spread = (xx - xs * xs / pairs) * (yy - ys * ys / pairs)
        r = (xy - xs * ys / pairs) / spread ** 0.5 if spread > 1e-12 * xx * max(yy, 1e-300) else 0.0
        return float(min(1.0, max(0.0, r))), int(round(pairs))

    signal, n_pairs = correlation(-1)
    if not reps:
        return spark.createDataFrame([(signal, n_pairs)], ends)
    b = sum(correlation(r)[0] >= signal - 1e-12 for r in range(reps))
    return spark.createDataFrame([(signal, (b + 1) / (reps + 1.0), n_pairs)], ends)


def trait_environment(scores: DataFrame, measured: DataFrame, key: str = "trait", alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """(correlations per trait and measure, strength per measure = 0.4 share significant + 0.6 strongest)."""
    c = cut_lineage(score_correlations(scores, measured, key))
    s = c.groupBy("measure").agg((0.4 * F.avg((F.col("p_value") < alpha).cast("double")) + 0.6 * F.coalesce(F.max(F.abs("rho")), F.lit(0.0))).alias("strength"))
    return c, s


def niche_breadth(ab: DataFrame, meta: DataFrame, cols: list[str]) -> DataFrame:
    """Mean normalised entropy of the environment values where a feature is present; 0.5 below two samples."""
    m = meta.select("sample_id", *[F.col(c).cast("string").alias(c) for c in cols])
    present = ab.groupBy("feature_id").agg(F.count(F.lit(1)).alias("present"))
    long = ab.select("sample_id", "feature_id").join(m, "sample_id").select("feature_id", F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("val")) for c in cols])).alias("e"))
    n = long.filter("e.val is not null").groupBy("feature_id", "e.col", "e.val").agg(F.count(F.lit(1)).cast("double").alias("c"))
    h = n.groupBy("feature_id", "col").agg(F.sum("c").alias("t"), F.sum(F.col("c") * F.log("c")).alias("cl"), F.count(F.lit(1)).alias("k"))
    e = F.when(F.col("k") > 1, (F.log("t") - F.col("cl") / F.col("t")) / F.log("k")).otherwise(0.0)
    b = h.groupBy("feature_id").agg(F.avg(e).alias("b"))
    return present.join(b, "feature_id", "left").select("feature_id", F.when(F.col("present") < 2, 0.5).otherwise(F.coalesce("b", F.lit(0.5))).alias("niche_breadth"))


IN_TASK = 100_000  # rows of a feature up to which its clusters are found inside one task
BUNDLE = 50_000  # rows, about, of the features that a task takes together
PACKED = 500_000  # points, about, that a task holds while it packs them by feature
DIGITS = 9  # of means, so that the order of a sum cannot keep a centroid moving


def _distances2(x: np.ndarray, cs: np.ndarray) -> np.ndarray:
    """Squared distances, one row per centroid, of points given as one row per dimension."""
    return np.stack([sum((v - c) ** 2 for v, c in zip(x, row)) for row in cs])


def _sums(x: np.ndarray, cs: np.ndarray) -> np.ndarray:
    """Sums and counts (last column) of the points nearest to each centroid, ties to the lower one."""
    near, low = np.zeros(x.shape[1], np.intp), None
    for i, row in enumerate(cs):
        d = sum((v - c) ** 2 for v, c in zip(x, row))
        if low is None:
            low = d
        else:
            near[d < low] = i
            np.minimum(low, d, out=low)
    return np.stack([np.bincount(near, weights=v, minlength=len(cs)) for v in [*x, np.ones(x.shape[1])]], 1)


def _means(sums: np.ndarray) -> np.ndarray:
    """The sorted centroids of sums and counts. A centroid without points goes."""
    live = sums[sums[:, -1] > 0]
    new = np.round(live[:, :-1] / live[:, -1:], DIGITS) + 0.0
    return new[np.lexsort(new.T[::-1])]


def _silhouettes(x: np.ndarray, cs: np.ndarray) -> np.ndarray:
    two = np.sqrt(np.partition(_distances2(x, cs), 1, axis=0)[:2])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(two[1] > 0, (two[1] - two[0]) / two[1], 0.0)


def _settled(start: np.ndarray, seen: set, new: np.ndarray) -> bool:
    """Whether no mean moved any more; raises when the means come back to an earlier place."""
    if new.shape == start.shape and (new == start).all():
        return True
    mark = new.tobytes()
    if mark in seen:
        raise RuntimeError("ecotypes: the centroids of a feature go round in a cycle")
    seen.add(mark)
    return False


def _clustered(x: np.ndarray, h: np.ndarray, max_k: int) -> tuple[int, float, np.ndarray] | None:
    """(k, silhouette, cluster of each row) of the best k of one feature; starting points as in _starts()."""
    best = None
    slot = h % max_k
    xt = np.ascontiguousarray(x.T)
    firsts = {s: x[np.flatnonzero(slot == s)[h[slot == s].argmin()]] for s in np.unique(slot)}
    for k in range(2, max_k + 1):
        start = np.array([c for s, c in firsts.items() if s < k])
        if not len(start):
            continue
        cs, seen = start[np.lexsort(start.T[::-1])], set()
        while not _settled(cs, seen, new := _means(_sums(xt, cs))):
            cs = new
        if len(cs) < 2:
            continue
        s = _silhouettes(xt, cs).mean()
        if best is None or s > best[1]:
            best = k, float(s), _distances2(xt, cs).argmin(0)
    return best


def _clustered_in_tasks(rows: DataFrame, max_k: int, min_silhouette: float) -> DataFrame:
    """feature_id, k, silhouette, sample_id, ecotype of features with few rows: bundles of whole features, one pass."""
    kinds = dict(rows.dtypes)
    ddl = f"feature_id {kinds['feature_id']}, k int, silhouette double, sample_id {kinds['sample_id']}, ecotype int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"feature_id": [], "k": [], "silhouette": [], "sample_id": [], "ecotype": []})]
        for f, part in pdf.groupby("feature_id", sort=False):
            best = _clustered(np.stack(part["x"].to_numpy()), part["h"].to_numpy(), max_k)
            if best is not None and best[1] >= min_silhouette:
                out.append(pd.DataFrame({"feature_id": f, "k": best[0], "silhouette": best[1], "sample_id": part["sample_id"].to_numpy(), "ecotype": best[2]}))
        return pd.concat(out[1:] or out)

    bundles = max(1, -(-rows.count() // BUNDLE))
    return rows.groupBy(F.pmod(F.xxhash64("feature_id"), F.lit(bundles)).alias("bundle")).applyInPandas(run, ddl)


def _packed(rows: DataFrame, code: dict) -> DataFrame:
    """f (place of the feature), x: the points of many rows of one feature, dimension by dimension, as binary."""
    def run(batches):
        held, n = {}, 0

        def blocks():
            keys = list(held)
            return pa.RecordBatch.from_pydict({"f": pa.array(keys, pa.int32()), "x": pa.array([np.concatenate(held[f], axis=1).tobytes() for f in keys], pa.binary())})

        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            f = np.array([code[v] for v in batch.column("feature_id").to_pylist()], np.int32)
            for one in np.unique(f):
                held.setdefault(int(one), []).append(x[f == one].T)
            n += batch.num_rows
            if n >= PACKED:
                yield blocks()
                held, n = {}, 0
        if held:
            yield blocks()

    return rows.select("feature_id", "x").mapInArrow(run, "f int, x binary")


def _block_sums(blocks: DataFrame, dim: int, cs: dict, what) -> dict:
    """Sums of what(points, centroids) over all blocks, for the (feature, k) in cs; a task gives one row for each."""
    order = sorted(cs)
    at: dict = {}
    for i, (f, k) in enumerate(order):
        at.setdefault(f, []).append((i, cs[f, k]))

    def run(batches):
        acc = {}
        for batch in batches:
            for f, raw in zip(batch.column("f").to_pylist(), batch.column("x")):
                x = np.frombuffer(raw.as_buffer()).reshape(dim, -1)
                for i, c in at.get(f, ()):
                    acc[i] = acc.get(i, 0.0) + what(x, c)
        if acc:
            yield pa.RecordBatch.from_pydict({"at": pa.array(list(acc), pa.int32()), "x": [np.asarray(v, float).tobytes() for v in acc.values()]})

    got = summed_pieces(blocks.mapInArrow(run, "at int, x binary"))
    return {key: got[i] for i, key in enumerate(order)}


def _clustered_in_rounds(rows: DataFrame, dim: int, max_k: int, min_silhouette: float) -> DataFrame:
    """The same for features of any number of rows: their points are packed into blocks once, and each round is a pass over the
    blocks that gives sums per centroid. The driver holds the centroids only, at most max_k^2 for every IN_TASK rows."""
    # One starting point per hash class of samples, the one of the smallest hash; minima merge before the shuffle.
    starts = rows.groupBy("feature_id", F.pmod("h", F.lit(max_k)).alias("slot")).agg(F.min_by("x", "h").alias("c")).collect()
    names = sorted({r["feature_id"] for r in starts}, key=str)
    code = {f: i for i, f in enumerate(names)}
    blocks = cut_lineage(_packed(rows, code))
    firsts: dict = {}
    for r in starts:
        firsts.setdefault(code[r["feature_id"]], []).append((r["slot"], r["c"]))
    moving, seen, settled = {}, {}, {}
    for i, points in firsts.items():
        for k in range(2, max_k + 1):
            start = np.array([c for slot, c in points if slot < k])
            if len(start):
                moving[i, k], seen[i, k] = start[np.lexsort(start.T[::-1])], set()
    while moving:
        sums = _block_sums(blocks, dim, moving, _sums)
        new = {key: _means(v.reshape(-1, dim + 1)) for key, v in sums.items()}
        still = {key for key in moving if _settled(moving[key], seen[key], new[key])}
        settled.update({key: moving[key] for key in still})
        moving = {key: new[key] for key in new if key not in still}
    settled = {key: cs for key, cs in settled.items() if len(cs) > 1}
    sil = _block_sums(blocks, dim, settled, lambda x, c: np.array([_silhouettes(x, c).sum(), x.shape[1]])) if settled else {}
    best: dict = {}
    for (i, k), (total, count) in sorted(sil.items()):
        if i not in best or total / count > best[i][1]:
            best[i] = k, float(total / count)
    kept = {names[i]: (k, s, settled[i, k]) for i, (k, s) in best.items() if s >= min_silhouette}
    kinds = dict(rows.dtypes)

    def members(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).T
            f = np.array([code[v] for v in batch.column("feature_id").to_pylist()])
            for one in np.unique(f):
                if names[one] in kept:
                    k, s, cs = kept[names[one]]
                    here = np.flatnonzero(f == one)
                    part = batch.take(pa.array(here))
                    yield pa.RecordBatch.from_arrays([part.column("feature_id"), pa.array([k] * len(here), pa.int32()), pa.array([s] * len(here), pa.float64()), part.column("sample_id"),
                                                      pa.array(_distances2(x[:, here], cs).argmin(0), pa.int32())], names=["feature_id", "k", "silhouette", "sample_id", "ecotype"])

    return rows.select("feature_id", "sample_id", "x").mapInArrow(members, f"feature_id {kinds['feature_id']}, k int, silhouette double, sample_id {kinds['sample_id']}, ecotype int")


def ecotypes(ab: DataFrame, meta: DataFrame, cols: list[str], max_k: int = 4, min_prevalence: float = 0.05, min_silhouette: float = 0.2,
             seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(feature_id, k, ecotype, size, prevalence, silhouette), (feature_id, sample_id, ecotype).

    The samples of a feature are clustered on scaled metadata by Lloyd rounds until no centroid moves (a cycle raises), for k =
    2..max_k; silhouettes use centroids; the best k at or above min_silhouette stays. Features with up to IN_TASK rows are clustered
    in bundles, each inside a task and in one pass; the others, which a task could not hold, by rounds over all their rows. Both
    start from the same points and follow the same rule.
    """
    stats = meta.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)], *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    z = [F.coalesce((F.col(c).cast("double") - float(stats[f"m{i}"])) / float(stats[f"s{i}"] or 1.0), F.lit(0.0)) for i, c in enumerate(cols)]
    pts = meta.select("sample_id", F.array(*z).alias("x"))
    n = meta.count()
    keep = ab.groupBy("feature_id").agg(F.count(F.lit(1)).alias("p")).filter((F.col("p") >= min_prevalence * n) & (F.col("p") >= 2 * max_k))
    rows = cut_lineage(ab.join(keep, "feature_id").select("feature_id", "sample_id", "p").join(pts, "sample_id")
                       .withColumn("h", F.xxhash64("feature_id", "sample_id", F.lit(seed))))
    few, many = rows.filter(F.col("p") <= IN_TASK).drop("p"), rows.filter(F.col("p") > IN_TASK).drop("p")
    members = _clustered_in_tasks(few, max_k, min_silhouette)
    if not many.isEmpty():
        members = members.unionByName(_clustered_in_rounds(many, len(cols), max_k, min_silhouette))
    members = cut_lineage(members)
    prof = members.groupBy("feature_id", "k", "silhouette", "ecotype").agg(F.count(F.lit(1)).alias("size")).withColumn("prevalence", F.col("size") / n)
    return prof, members.select("feature_id", "sample_id", "ecotype")


def ecotype_features(ab: DataFrame, profiles: DataFrame, min_prevalence: float = 0.05) -> DataFrame:
    """sample_id, ecotype_feature, value = abundance x prevalence x (1 - niche breadth); features present in enough samples.
    profiles(feature_id, ecotype, prevalence, niche_breadth)."""
    n = sample_count(ab)
    live = ab.groupBy("feature_id").agg(F.count(F.lit(1)).alias("p")).crossJoin(F.broadcast(n)).filter(F.col("p") / F.col("n") >= min_prevalence)
    v = F.col("count") * F.col("prevalence") * (1 - F.col("niche_breadth"))
    name = F.concat(F.col("feature_id").cast("string"), F.lit("_ecotype"), F.col("ecotype").cast("string"))
    return ab.join(live, "feature_id", "left_semi").join(profiles, "feature_id").select("sample_id", name.alias("ecotype_feature"), v.alias("value")).filter("value > 0")


def abundance_boundaries(ab: DataFrame, percentile: float = 25.0) -> DataFrame:
    """feature_id, lower, upper: percentiles of positive values; the extremes for fewer than four."""
    pos = ab.filter("count > 0")
    q = exact_quantiles(pos, ["feature_id"], "count", {"lo": percentile / 100, "hi": 1 - percentile / 100})
    e = pos.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("mn"), F.max("count").alias("mx"))
    few = F.col("n") < 4
    return e.join(q, "feature_id").select("feature_id", F.when(few, F.col("mn")).otherwise(F.col("lo")).alias("lower"), F.when(few, F.col("mx")).otherwise(F.col("hi")).alias("upper"))


# Words that put a pathway in a block.
PATHWAY_BLOCKS = {
    "Carbon Metabolism": "carbon|glycolysis|cycle|sugar", "Nitrogen Cycling": "nitrogen|nitrate|ammonia|denitrif",
    "Sulfur/Xenobiotics": "sulfur|degrad|toluene|benzoate", "Stress/Defense": "antibiotic|resistance|stress|oxidative",
}


def pathway_blocks(pathways: DataFrame, blocks: dict[str, str] = PATHWAY_BLOCKS) -> DataFrame:
    """sample_id, block, total, mean of pathways(sample_id, pathway, value); the mean is over all pathways of the block."""
    hit = F.filter(F.array(*[F.when(F.col("pathway").rlike(f"(?i){p}"), F.lit(b)) for b, p in blocks.items()]), lambda x: x.isNotNull())
    names = pathways.select("pathway").distinct().select("pathway", F.explode(hit).alias("block"))
    size = names.groupBy("block").agg(F.count(F.lit(1)).alias("k"))
    s = pathways.join(names, "pathway").groupBy("sample_id", "block").agg(F.sum("value").alias("total"))
    return s.join(F.broadcast(size), "block").select("sample_id", "block", "total", (F.col("total") / F.col("k")).alias("mean"))
