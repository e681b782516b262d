"""Feature selection and model evaluation: the data side in closed form, models by MLlib."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from meadow.operators.beta import cell_vectors, sample_cells, to_vectors
from meadow.operators.kernels import exact_quantiles, small, summed_pieces
from meadow.operators.network import correlated_counts
from meadow.operators.stats import anova_f, group_sizes, spearman_features
from meadow.operators.table import sample_count
from meadow.sources.tables import cut_lineage


def pearson_target(ab: DataFrame, meta: DataFrame, target: str, value: str = "count") -> DataFrame:
    """feature_id, r, n of every feature with a numeric column, absent = 0: sums over present rows plus column sums."""
    y = meta.filter(F.col(target).isNotNull()).select("sample_id", F.col(target).cast("double").alias("y"))
    t = y.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") ** 2).alias("syy"))
    x = F.col(value)
    g = ab.join(y, "sample_id").groupBy("feature_id").agg(F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"), F.sum(x * F.col("y")).alias("sxy"))
    g = g.crossJoin(F.broadcast(t))
    n = F.col("n")
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    var = (F.col("sxx") - F.col("sx") ** 2 / n) * (F.col("syy") - F.col("sy") ** 2 / n)
    return g.select("feature_id", F.try_divide(cov, F.sqrt(F.when(var > 0, var))).alias("r"), "n")


def feature_scores(ab: DataFrame, labels: DataFrame, method: str = "f_classif") -> DataFrame:
    """feature_id, score: ANOVA F (labels sample_id, group), regression F (labels sample_id, value), or chi-squared."""
    if method == "f_classif":
        return anova_f(ab, labels).select("feature_id", F.col("f").alias("score"))
    if method == "f_regression":
        r = pearson_target(ab, labels, "value")
        return r.select("feature_id", F.try_divide(F.col("r") ** 2 * (F.col("n") - 2), 1 - F.col("r") ** 2).alias("score"))
    n = labels.agg(F.count(F.lit(1)).alias("n"))
    o = ab.join(labels, "sample_id").groupBy("feature_id", "group").agg(F.sum("count").alias("o"))
    tot = o.groupBy("feature_id").agg(F.sum("o").alias("t"))
    grid = tot.crossJoin(small(group_sizes(labels))).crossJoin(F.broadcast(n)).join(o, ["feature_id", "group"], "left")
    e = F.col("t") * F.col("ng") / F.col("n")
    return grid.groupBy("feature_id").agg(F.sum((F.coalesce("o", F.lit(0.0)) - e) ** 2 / e).alias("score"))


def select_k_best(ab: DataFrame, labels: DataFrame, k: int, method: str = "f_classif") -> DataFrame:
    """The k best features, ties by id: a top-k sort."""
    return feature_scores(ab, labels, method).filter("score is not null").orderBy(F.round("score", 9).desc(), "feature_id").limit(k)


def drop_collinear(ab: DataFrame, scores: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Kept features: those collinear with nothing, and the best scored member of each anchored group.

    A feature anchors the group of its earlier (id order) collinear partners.
    """
    r = cut_lineage(correlated_counts(ab, threshold).filter(F.abs("r") > threshold).select("a", "b"))
    tied = r.select(F.explode(F.array("a", "b")).alias("feature_id")).distinct()
    free = ab.select("feature_id").distinct().join(tied, "feature_id", "left_anti")
    members = r.select(F.col("b").alias("anchor"), F.col("a").alias("feature_id")).unionByName(r.select(F.col("b").alias("anchor"), F.col("b").alias("feature_id")).distinct())
    best = members.join(scores, "feature_id").groupBy("anchor").agg(F.min_by("feature_id", F.struct(-F.col("score"), F.col("feature_id"))).alias("feature_id"))
    return free.unionByName(best.select("feature_id")).distinct()


def leakage_check(ab: DataFrame, meta: DataFrame, target: str, limit: float = 0.95, diversity_limit: float = 0.8) -> DataFrame:
    """feature_id, r_target, r_shannon, leak: too close to the target or to the sample's Shannon diversity."""
    from meadow.operators.alpha import shannon
    a = pearson_target(ab, meta, target).select("feature_id", F.col("r").alias("r_target"))
    b = pearson_target(ab, shannon(ab), "shannon").select("feature_id", F.col("r").alias("r_shannon"))
    leak = (F.abs("r_target") > limit) | (F.abs("r_shannon") > diversity_limit)
    return a.join(b, "feature_id", "full").select("feature_id", "r_target", "r_shannon", F.coalesce(leak, F.lit(False)).alias("leak"))


def biomarker_confidence(ab: DataFrame, covariates: DataFrame, cols: list[str], rho_limit: float = 0.8) -> DataFrame:
    """feature_id, score = 100 - 20 per covariate with p < 0.05, links, REJECTED when one has abs rho at the limit."""
    out = None
    for c in cols:
        one = spearman_features(ab, covariates, c).select("feature_id", F.lit(c).alias("covariate"), "rho", "p_value")
        out = one if out is None else out.unionByName(one)
    hit = F.col("p_value") < 0.05
    g = out.groupBy("feature_id").agg(F.count_if(hit).alias("links"), F.coalesce(F.max(hit & (F.abs("rho") >= rho_limit)), F.lit(False)).alias("leaky"))
    return g.select("feature_id", F.greatest(F.lit(0), 100 - 20 * F.col("links")).alias("score"), "links", F.when(F.col("leaky"), "REJECTED").otherwise("PASSED").alias("status"))


# ---------------------------------------------------------------- folds


def group_folds(meta: DataFrame, group: str, threshold: int = 10) -> DataFrame:
    """sample_id, group, fold. Up to threshold groups: one fold each. More: 3 to 5 folds, groups dealt largest first in
    snake order, so fold sizes balance without a serial pass over the groups."""
    from meadow.operators.kernels import running_total
    g = meta.filter(F.col(group).isNotNull()).groupBy(F.col(group).cast("string").alias("group")).agg(F.count(F.lit(1)).alias("c"))
    n = g.count()
    folds = n if n <= threshold else min(5, max(3, n // 2))
    w = g.withColumn("neg", -F.col("c")).withColumn("one", F.lit(1))
    per = running_total(w.groupBy("neg").agg(F.sum("one").alias("k")), [], "neg", "k").select("neg", (F.col("cum") - F.col("k")).alias("before"))
    from pyspark.sql import Window as W
    place = F.row_number().over(W.partitionBy("neg").orderBy("group")) - 1
    r = w.withColumn("place", place).join(per, "neg").withColumn("r", F.col("place") + F.col("before"))
    lap, pos = F.floor(F.col("r") / folds), F.col("r") % folds
    fold = F.when(lap % 2 == 0, pos).otherwise(folds - 1 - pos).cast("int") if n > threshold else F.col("r").cast("int")
    return meta.select("sample_id", F.col(group).cast("string").alias("group")).join(small(r.select("group", fold.alias("fold"))), "group").select("sample_id", "group", "fold")


def spatial_folds(meta: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """sample_id, fold from k-means on the points' positions on the unit sphere."""
    from meadow.operators.geo import _axes
    p = meta.filter("lat is not null and lon is not null").select("sample_id", array_to_vector(F.array(*_axes(F.col("lat"), F.col("lon")))).alias("features")).persist()
    return KMeans(k=k, seed=seed).fit(p).transform(p).select("sample_id", F.col("prediction").alias("fold"))


def group_holdout(meta: DataFrame, group: str, test_size: float = 0.3, seed: int = 42) -> DataFrame:
    """sample_id, is_test: whole groups by a seeded hash of the group name."""
    h = F.pmod(F.xxhash64(F.col(group).cast("string"), F.lit(seed)), F.lit(10_000)) < int(test_size * 10_000)
    return meta.select("sample_id", F.coalesce(h, F.lit(False)).alias("is_test"))


def best_threshold(scored: DataFrame, truth: str = "label", prob: str = "probability") -> DataFrame:
    """threshold, mcc: the first of 99 thresholds with the highest Matthews correlation. One histogram pass over rows."""
    step = F.floor(F.round(F.col(prob) * 100, 6)).cast("int")
    h = scored.groupBy(F.greatest(F.lit(0), F.least(F.lit(100), step)).alias("b")).agg(F.count_if(F.col(truth) == 1).alias("p"), F.count_if(F.col(truth) == 0).alias("n"))
    t = h.agg(F.sum("p").alias("tp_all"), F.sum("n").alias("n_all"))
    c = h.select(F.explode(F.sequence(F.lit(1), F.lit(99))).alias("t"), "b", "p", "n").filter("b >= t").groupBy("t").agg(F.sum("p").alias("tp"), F.sum("n").alias("fp"))
    every = h.sparkSession.range(1, 100).select(F.col("id").cast("int").alias("t"))
    j = every.join(c, "t", "left").fillna(0).crossJoin(F.broadcast(t))
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    fn, tn = F.col("tp_all") - tp, F.col("n_all") - fp
    mcc = F.coalesce(F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))), F.lit(0.0))
    return j.agg(F.min_by(F.struct(F.col("t"), mcc.alias("mcc")), F.struct(-F.round(mcc, 12), F.col("t"))).alias("b")).select((F.col("b.t") / 100.0).alias("threshold"), F.col("b.mcc").alias("mcc"))


# ---------------------------------------------------------------- models


def feature_vectors(dense: DataFrame, value: str) -> tuple[DataFrame, list]:
    """(sample_id, features), feature ids in vector order. Kept features only; one row is one sample, written once."""
    cells = cut_lineage(sample_cells(dense, value))
    ids = [r[0] for r in cells.select(F.explode(F.transform("l", lambda s: s["feature_id"])).alias("f")).distinct().orderBy("f").collect()]
    return cell_vectors(cells), ids


GRAM_FEATURES = 4096  # features up to which the products of all pairs of them are held; more must be selected first


def fold_products(d: DataFrame, p: int, piece: int = 1 << 13) -> dict[int, np.ndarray]:
    """A'A of A = [1, features, label] per fold of d(fold, features, label), in one pass.

    A task goes through its rows fold by fold and gives each fold's sums in pieces of fixed size."""
    w = p + 2
    pieces = -(-w * w // piece)

    def run(batches):
        fold, acc = None, None

        def out():
            flat = acc.ravel()
            return pa.RecordBatch.from_pydict({"at": pa.array([fold * pieces + i for i in range(pieces)], pa.int32()),
                                               "x": [flat[i * piece:(i + 1) * piece].tobytes() for i in range(pieces)]})

        for batch in batches:
            folds = batch.column("fold").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
            a = np.column_stack([np.ones(len(x)), x, batch.column("label").to_numpy()])
            for f in dict.fromkeys(folds.tolist()):
                if f != fold:
                    if fold is not None:
                        yield out()
                    fold, acc = f, np.zeros((w, w))
                part = a[folds == f]
                acc += part.T @ part
        if fold is not None:
            yield out()

    rows = d.select("fold", vector_to_array("features").alias("x"), "label").sortWithinPartitions("fold")
    got = summed_pieces(rows.mapInArrow(run, "at int, x binary"))
    return {f: np.concatenate([got[f * pieces + i] for i in range(pieces)]).reshape(w, w) for f in sorted({at // pieces for at in got})}


def elastic_nets(products: np.ndarray, reg: float, mix: float, tol: float = 1e-10, sweeps: int = 10_000) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, intercepts) of elastic nets, one per matrix of products (nets x w x w), by coordinate descent on all of them at once.

    Minimises |y - b - Z u|^2 / 2n + reg (mix |u|_1 + (1 - mix) |u|^2 / (2 sd(y))) over columns Z scaled to deviation 1, and gives
    coefficients of the columns as they were; columns without spread get 0."""
    n, k, w = products[:, 0, 0], len(products), products.shape[1]
    mean = products[:, 0, :] / n[:, None]
    cov = products / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    scale = np.sqrt(np.maximum(np.diagonal(cov, axis1=1, axis2=2), 0.0) * (n / np.maximum(n - 1, 1))[:, None])
    flat = scale <= 1e-12 * np.maximum(1.0, np.abs(mean))
    safe = np.where(flat, 1.0, scale)
    g = cov[:, 1:-1, 1:-1] / safe[:, 1:-1, None] / safe[:, None, 1:-1]
    c = np.where(flat[:, 1:-1], 0.0, cov[:, 1:-1, -1] / safe[:, 1:-1])
    ridge = reg * (1 - mix) / safe[:, -1]
    u, gu = np.zeros((k, w - 2)), np.zeros((k, w - 2))
    for _ in range(sweeps):
        most = np.zeros(k)
        for j in range(w - 2):
            own = g[:, j, j]
            r = c[:, j] - gu[:, j] + own * u[:, j]
            new = np.where(flat[:, j + 1], 0.0, np.sign(r) * np.maximum(np.abs(r) - reg * mix, 0.0) / np.maximum(own + ridge, 1e-300))
            step = new - u[:, j]
            if step.any():
                gu += step[:, None] * g[:, j, :]
                u[:, j] = new
                most = np.maximum(most, np.abs(step))
        if (most <= tol * safe[:, -1]).all():
            break
    else:
        raise RuntimeError(f"elastic net: coefficients still move after {sweeps} sweeps")
    coef = u / safe[:, 1:-1]
    return coef, mean[:, -1] - (coef * mean[:, 1:-1]).sum(1)


def r_squared(products: np.ndarray, coef: np.ndarray, intercept: float) -> float:
    """Of a model on the rows that the products were taken of, from the products alone."""
    beta = np.concatenate([[intercept], coef])
    n, yy, y = products[0, 0], products[-1, -1], products[0, -1]
    sse = yy - 2 * beta @ products[:-1, -1] + beta @ products[:-1, :-1] @ beta
    sst = yy - y * y / n
    return float(1 - sse / sst) if sst > 0 else 0.0


def _with_label(dense: DataFrame, meta: DataFrame, target: str, value: str) -> tuple[DataFrame, list]:
    v, ids = feature_vectors(dense, value)
    if len(ids) > GRAM_FEATURES:
        raise ValueError(f"{len(ids)} features: select at most {GRAM_FEATURES} first")
    return v.join(meta.filter(F.col(target).isNotNull()).select("sample_id", F.col(target).cast("double").alias("label")), "sample_id"), ids


def elastic_net_losgo(dense: DataFrame, meta: DataFrame, target: str, study: str, value: str = "clr", reg: float = 0.1, mix: float = 0.5,
                      max_folds: int = 10) -> tuple[DataFrame, DataFrame]:
    """(feature_id, mean_coefficient, folds), (fold, r2): elastic net fitted without one study (or study group) at a time.

    One pass sums the products of each fold's rows; a training set is the total less its fold, a score comes from the fold's own
    products. So no fold reads the rows again. See elastic_nets for the objective; at most GRAM_FEATURES features."""
    d, ids = _with_label(dense, meta, target, value)
    own = fold_products(d.join(group_folds(meta, study, max_folds).select("sample_id", "fold"), "sample_id"), len(ids))
    folds = list(own)
    total = sum(own.values())
    coef, intercept = elastic_nets(np.array([total - own[f] for f in folds]), reg, mix)
    kind, spark = dict(dense.dtypes)["feature_id"], dense.sparkSession
    mean = coef.mean(0)
    return (spark.createDataFrame([(i, float(m), len(folds)) for i, m in zip(ids, mean, strict=True)], f"feature_id {kind}, mean_coefficient double, folds int"),
            spark.createDataFrame([(int(f), r_squared(own[f], c, b)) for f, c, b in zip(folds, coef, intercept, strict=True)], "fold int, r2 double"))


def linear_discovery(dense: DataFrame, meta: DataFrame, target: str, value: str = "clr", n_top: int = 50, reg: float = 0.05) -> DataFrame:
    """Features with the largest nonzero coefficients of one elastic net, see elastic_nets."""
    d, ids = _with_label(dense, meta, target, value)
    products = fold_products(d.withColumn("fold", F.lit(0)), len(ids))
    coef, _ = elastic_nets(np.array(list(products.values())), reg, 0.5)
    rows = [(i, float(x)) for i, x in zip(ids, coef[0], strict=True) if x != 0]
    t = dense.sparkSession.createDataFrame(rows, f"feature_id {dict(dense.dtypes)['feature_id']}, coefficient double")
    return t.orderBy(F.abs("coefficient").desc(), "feature_id").limit(n_top)


def forest_importance(dense: DataFrame, labels: DataFrame, value: str = "clr", n_top: int = 50, trees: int = 20, seed: int = 42) -> DataFrame:
    """feature_id, importance of a random forest for labels(sample_id, group)."""
    v, ids = feature_vectors(dense, value)
    d = cut_lineage(v.join(labels, "sample_id"))
    d = StringIndexer(inputCol="group", outputCol="label").fit(d).transform(d)
    m = RandomForestClassifier(numTrees=trees, maxDepth=5, seed=seed).fit(d)
    imp = m.featureImportances.toArray()
    t = dense.sparkSession.createDataFrame([(i, float(x)) for i, x in zip(ids, imp)], f"feature_id {dict(dense.dtypes)['feature_id']}, importance double")
    return t.orderBy(F.desc("importance"), "feature_id").limit(n_top)


def batch_predictability(dense: DataFrame, batches: DataFrame, value: str = "clr", folds: int = 3, trees: int = 20, seed: int = 42) -> DataFrame:
    """fold, accuracy of predicting the batch on held-out samples (folds by a seeded hash of the sample)."""
    v = to_vectors(dense, value)
    d = cut_lineage(v.join(batches, "sample_id").withColumn("fold", F.pmod(F.xxhash64("sample_id", F.lit(seed)), F.lit(folds)).cast("int")))
    d = StringIndexer(inputCol="group", outputCol="label").fit(d).transform(d)
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    rows = []
    for f in range(folds):
        m = RandomForestClassifier(numTrees=trees, maxDepth=5, seed=seed).fit(d.filter(F.col("fold") != f))
        rows.append((f, float(ev.evaluate(m.transform(d.filter(F.col("fold") == f))))))
    return dense.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def panel_validation(dense: DataFrame, labels: DataFrame, studies: DataFrame, panel: DataFrame, value: str = "clr", max_folds: int = 5, seed: int = 42) -> DataFrame:
    """fold, train_score, test_score of a fixed feature panel with whole studies held out."""
    v = to_vectors(dense.join(small(panel.select("feature_id")), "feature_id", "left_semi"), value)
    d = cut_lineage(v.join(labels, "sample_id").join(group_folds(studies, "study", max_folds).select("sample_id", "fold"), "sample_id"))
    d = StringIndexer(inputCol="group", outputCol="label").fit(d).transform(d)
    rows = []
    for f in sorted(r[0] for r in d.select("fold").distinct().collect()):
        m = RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed).fit(d.filter(F.col("fold") != f))
        hit = F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)
        own = F.col("fold") == f
        rows.append((int(f), *m.transform(d).agg(F.avg(F.when(~own, hit)), F.avg(F.when(own, hit))).first()))
    return dense.sparkSession.createDataFrame(rows, "fold int, train_score double, test_score double")


def predict_environment(dense: DataFrame, meta: DataFrame, targets: list[str], value: str = "clr", min_samples: int = 100, clusters: int = 3, seed: int = 42) -> DataFrame:
    """target, n, r2 (mean over spatial folds): one forest regression per environment column with enough values."""
    v = to_vectors(dense, value)
    d = cut_lineage(v.join(spatial_folds(meta, clusters, seed), "sample_id").join(meta.select("sample_id", *targets), "sample_id"))
    counts = d.agg(*[F.count(t).alias(t) for t in targets]).first()
    rows = []
    for t in targets:
        if counts[t] < min_samples:
            continue
        k = d.filter(F.col(t).isNotNull()).withColumn("label", F.col(t).cast("double"))
        s = []
        for f in range(clusters):
            m = RandomForestRegressor(numTrees=10, maxDepth=4, seed=seed).fit(k.filter(F.col("fold") != f))
            s.append(RegressionEvaluator(metricName="r2").evaluate(m.transform(k.filter(F.col("fold") == f))))
        rows.append((t, counts[t], float(sum(s) / len(s))))
    return dense.sparkSession.createDataFrame(rows, "target string, n long, r2 double")


def shuffle_baseline(ab: DataFrame, labels: DataFrame, reps: int = 20, seed: int = 42) -> DataFrame:
    """real, mean_shuffled, p_value: best single-feature eta-squared against the same score with shuffled labels."""
    from meadow.operators.permute import maxima
    n = labels.count()
    k = labels.select("group").distinct().count()
    own, top = maxima(ab, labels, reps, "ftest", seed)
    ratio = lambda f: f * (k - 1) / (f * (k - 1) + (n - k))
    real = own.agg(ratio(F.max("statistic")).alias("real"))
    b = F.count_if(F.col("score") >= F.col("real") - 1e-12)
    shuffled = top.select(ratio(F.col("top")).alias("score")).crossJoin(F.broadcast(real))
    return shuffled.agg(F.max("real").alias("real"), F.avg("score").alias("mean_shuffled"), ((b + 1) / (reps + 1.0)).alias("p_value"))


# ---------------------------------------------------------------- across studies


def meta_analysis(ab: DataFrame, meta: DataFrame, study: str, target: str, n_top: int = 20, min_samples: int = 15) -> tuple[DataFrame, DataFrame]:
    """(consensus: feature_id, study_frequency, frequency_pct, avg_importance), (study, feature_id, importance, rank).

    Importance is eta-squared of the target's classes, for all studies and features in one grouped pass (absent = 0).
    """
    from pyspark.sql import Window as W
    m = meta.filter(F.col(study).isNotNull() & F.col(target).isNotNull()).select("sample_id", F.col(study).cast("string").alias("study"), F.col(target).cast("string").alias("g"))
    sg = m.groupBy("study", "g").agg(F.count(F.lit(1)).alias("n"))
    s = sg.groupBy("study").agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("k")).filter((F.col("N") >= min_samples) & (F.col("k") >= 2))
    x = ab.join(m, "sample_id").groupBy("study", "feature_id", "g").agg(F.sum("count").alias("sx"), F.sum(F.col("count") ** 2).alias("sxx"))
    x = x.join(small(sg), ["study", "g"])
    f = x.groupBy("study", "feature_id").agg(F.sum(F.col("sx") ** 2 / F.col("n")).alias("q"), F.sum("sx").alias("t"), F.sum("sxx").alias("ss")).join(small(s), "study")
    c = F.col("t") ** 2 / F.col("N")
    imp = f.select("study", "feature_id", F.coalesce(F.try_divide(F.col("q") - c, F.col("ss") - c), F.lit(0.0)).alias("importance"))
    top = imp.withColumn("rank", F.row_number().over(W.partitionBy("study").orderBy(F.round("importance", 9).desc(), "feature_id"))).filter(F.col("rank") <= n_top)
    top = cut_lineage(top)
    n = s.agg(F.count(F.lit(1)).alias("n_studies"))
    g = top.groupBy("feature_id").agg(F.count(F.lit(1)).alias("study_frequency"), F.sum("importance").alias("si")).crossJoin(F.broadcast(n))
    out = g.select("feature_id", "study_frequency", (F.col("study_frequency") / F.col("n_studies")).alias("frequency_pct"), (F.col("si") / F.col("n_studies")).alias("avg_importance"))
    return out.orderBy(F.desc("study_frequency"), F.round("avg_importance", 9).desc(), "feature_id").limit(n_top), top


def consensus_weighting(importance: DataFrame, consensus: DataFrame) -> DataFrame:
    """adjusted = importance x (frequency + 0.1); features outside the consensus count 0.05; universal from 0.5."""
    j = importance.join(consensus.select("feature_id", F.col("frequency_pct").alias("f")), "feature_id", "left")
    f = F.coalesce("f", F.lit(0.05))
    return j.select("feature_id", "importance", f.alias("meta_frequency"), (F.col("importance") * (f + 0.1)).alias("adjusted_importance"), (f >= 0.5).alias("is_universal"))


def consensus_two_lists(q_values: DataFrame, importances: DataFrame, q_limit: float = 0.05, percentile: float = 95.0) -> DataFrame:
    """Features with q <= limit and importance above its percentile; score = half -log10 q plus half importance."""
    cut = exact_quantiles(importances, [], "importance", {"cut": percentile / 100})
    top = importances.crossJoin(F.broadcast(cut)).filter("importance > cut").select("feature_id", "importance")
    j = q_values.filter(F.col("q_value") <= q_limit).join(top, "feature_id")
    return j.select("feature_id", (0.5 * -F.log10("q_value") + 0.5 * F.col("importance")).alias("combined_score"))


def facility_targets(meta: DataFrame, types: list[str], match: str = "facility_match", kind: str = "facility_type") -> DataFrame:
    """sample_id and one 0/1 column per facility type (None, Analog and unknown left out)."""
    m = F.coalesce(F.lower(F.col(match).cast("string")) == "true", F.lit(False))
    keep = [t for t in types if t not in ("None", "Analog", "unknown")]
    cols = [(m & F.coalesce(F.col(kind) == t, F.lit(False))).cast("int").alias(f"facility_match_{t.replace(' ', '_').lower()}") for t in keep]
    return meta.select("sample_id", *cols)


# Points of a strategy in which a feature was stable.
STRATEGY_POINTS = [("baseline", "Baseline", 1), ("batch_aware", "Batch-Aware", 3), ("lopocv", "LOPOCV", 5), ("spatial_cv", "Spatial-CV", 5), ("meta_aware", "Meta-Aware", 2)]


def evidence_synthesis(stability: DataFrame, significant: DataFrame) -> DataFrame:
    """target, taxon, score, evidence, confidence from stability(target, taxon, one boolean per strategy) and
    significant(target, taxon); scores under 4 are left out."""
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    score = sum((F.when(on(c), p).otherwise(0) for c, _, p in STRATEGY_POINTS), F.lit(0))
    names = F.concat_ws(" + ", *[F.when(on(c), F.lit(n)) for c, n, _ in STRATEGY_POINTS])
    s = significant.select("target", "taxon").distinct().withColumn("sig", F.lit(True))
    j = stability.join(s, ["target", "taxon"], "left").withColumn("score", score).filter("score >= 4")
    sig = on("sig")
    return j.select("target", "taxon", "score", F.concat(names, F.when(sig, " & Stat-Sig").otherwise("")).alias("evidence"),
                    F.when((F.col("score") >= 10) & sig, "Elite").when(F.col("score") >= 7, "High").otherwise("Moderate").alias("confidence"))


def overfit_gap(scores: DataFrame, limit: float = 0.15) -> DataFrame:
    """target, mean_train, mean_test, gap, status of scores(target, fold, train_score, test_score)."""
    gap = F.avg("train_score") - F.avg("test_score")
    return scores.groupBy("target").agg(F.avg("train_score").alias("mean_train"), F.avg("test_score").alias("mean_test"), gap.alias("gap")).withColumn(
        "status", F.when(F.col("gap") < limit, "PASS").otherwise("FAIL"))


def stable_features(selections: DataFrame, min_frequency: float = 0.4) -> DataFrame:
    """feature, frequency, mean_importance, phylum (second lineage part), label of selections(run, feature, importance)."""
    n = selections.select("run").distinct().agg(F.count(F.lit(1)).alias("n"))
    g = selections.groupBy("feature").agg(F.count_distinct("run").alias("c"), F.avg("importance").alias("mean_importance")).crossJoin(F.broadcast(n))
    g = g.withColumn("frequency", F.col("c") / F.col("n")).filter(F.col("frequency") >= min_frequency)
    phylum = F.when(F.col("feature").contains(";"), F.get(F.split("feature", ";"), F.lit(1))).otherwise("Unknown")
    return g.select("feature", "frequency", "mean_importance", phylum.alias("phylum"), F.replace(F.element_at(F.split("feature", "__"), -1), F.lit("_"), F.lit(" ")).alias("label"))
