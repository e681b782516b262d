"""Results that have no SQL twin, recomputed with NumPy and pandas."""

import itertools
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meadow.functions import tails
from meadow.operators import beta, qc, select, stats, text, traits
from meadow.operators.compositional import clr_dense

N, P = 60, 7


@pytest.fixture(scope="module")
def wide():
    g = np.random.default_rng(11)
    x = g.poisson(4, (N, P)).astype(float) * (g.random((N, P)) < 0.8)
    x[:, 0] = np.round(200 / (1 + np.arange(N)))  # falls where depth rises
    x[:, 1] = 20 + 5 * np.arange(N)
    x[:, 2] = np.where(np.arange(N) % 2 == 0, 9, 2) + g.poisson(1, N)
    return x


@pytest.fixture(scope="module")
def table(spark, wide):
    return spark.createDataFrame([(int(i), f"f{j}", float(wide[i, j])) for i, j in zip(*np.nonzero(wide))], "sample_id long, feature_id string, count double").cache()


@pytest.fixture(scope="module")
def meta(spark):
    g = np.random.default_rng(12)
    rows = [(i, "ab"[i % 2], float(g.normal() + i / 10), float(i % 7), float(g.normal())) for i in range(N)]
    return spark.createDataFrame(rows, "sample_id long, group string, u double, v double, w double").cache()


def spearman(x, y):
    """(rho, p) with average ranks and the t approximation."""
    rho = float(np.corrcoef(pd.Series(x).rank(), pd.Series(y).rank())[0, 1])
    if abs(rho) > 1 - 1e-12:
        return rho, 0.0
    df = len(x) - 2
    t = rho * math.sqrt(df / (1 - rho * rho))
    return rho, float(tails.beta_inc(df / 2, 0.5, np.array([df / (df + t * t)]))[0])


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_contaminants(spark, table, wide):
    got = rows(qc.contaminants_frequency(table), "feature_id")
    for j in range(P):
        rho, p = spearman(wide[:, j], wide.sum(1))
        want = abs(rho) if rho < 0 and p < 0.05 and (wide[:, j] > 0).sum() >= 5 else 0.0
        assert got[f"f{j}"]["freq_score"] == pytest.approx(want, abs=1e-9)
    assert got["f0"]["freq_score"] > 0.5
    names = spark.createDataFrame([(f"f{j}", "Bradyrhizobium" if j == 0 else "Geobacter") for j in range(P)], "feature_id string, genus string")
    names = names.withColumn("taxonomy", F.concat(F.lit("d__Bacteria;g__"), "genus"))
    db, ubiq = rows(qc.contaminants_database(names), "feature_id"), rows(qc.contaminants_ubiquity(table), "feature_id")
    for f, r in rows(qc.contaminants_combined(table, names), "feature_id").items():
        parts = [db[f]["db_score"] if f in db else 0.0, got[f]["freq_score"], ubiq[f]["ubiq_score"]]
        assert r["combined_score"] == pytest.approx(sum(parts) / 3) and r["n_methods_flagged"] == sum(x > 0.5 for x in parts)
        assert r["is_contaminant"] == (sum(parts) / 3 > 0.5)


def test_biomarkers_and_environment(spark, table, wide, meta):
    m = meta.toPandas().set_index("sample_id").sort_index()
    got = rows(select.biomarker_confidence(table, meta, ["u", "v", "w"], 0.9), "feature_id")
    for j in range(P):
        r = [spearman(wide[:, j], m[c].to_numpy()) for c in ("u", "v", "w")]
        links = sum(p < 0.05 for _, p in r)
        assert got[f"f{j}"]["links"] == links and got[f"f{j}"]["score"] == max(0, 100 - 20 * links)
        assert got[f"f{j}"]["status"] == ("REJECTED" if any(p < 0.05 and abs(rho) >= 0.9 for rho, p in r) else "PASSED")
    scores = table.select("sample_id", F.col("feature_id").alias("trait"), F.col("count").alias("score"))
    long = meta.unpivot("sample_id", ["u", "w"], "measure", "value")
    each, strength = traits.trait_environment(scores, long)
    each = {(r["trait"], r["measure"]): r for r in each.collect()}
    for c in ("u", "w"):
        found = []
        for j in range(P):
            on = wide[:, j] > 0
            rho, p = spearman(wide[on, j], m[c].to_numpy()[on])
            assert each[f"f{j}", c]["rho"] == pytest.approx(rho, abs=1e-9) and each[f"f{j}", c]["n"] == on.sum()
            found.append((abs(rho), p < 0.05))
        want = 0.4 * np.mean([s for _, s in found]) + 0.6 * max(r for r, _ in found)
        assert rows(strength, "measure")[c]["strength"] == pytest.approx(want, abs=1e-9)


def test_effects_with_tests(table, wide, meta):
    lab = meta.select("sample_id", "group")
    got = rows(stats.test_with_effect_size(table, lab, ("a", "b"), 0.05, 0.5), "feature_id")
    p = np.array([got[f"f{j}"]["p_value"] for j in range(P)])
    order = np.argsort(p)
    adj = np.empty(P)
    adj[order] = np.minimum.accumulate((p[order] * P / (np.arange(P) + 1))[::-1])[::-1]
    for j in range(P):
        a, b = wide[::2, j], wide[1::2, j]
        pooled = math.sqrt(((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (N - 2))
        d = (a.mean() - b.mean()) / pooled
        r = got[f"f{j}"]
        assert r["cohens_d"] == pytest.approx(d, abs=1e-9) and r["p_adj"] == pytest.approx(min(1, adj[j]), abs=1e-12)
        delta = np.sign(a[:, None] - b[None, :]).mean()
        assert r["cliffs_delta"] == pytest.approx(delta, abs=1e-9) and r["significant"] == (adj[j] < 0.05 and abs(d) >= 0.5)
    assert got["f2"]["significant"]
    both = rows(stats.compare_tests(table, lab, ("a", "b"), 99), "feature_id")
    t, perm = rows(stats.t_test(table, lab, ("a", "b")), "feature_id"), rows(stats.permutation_test(table, lab, 99, "ttest"), "feature_id")
    for f, r in both.items():
        assert (r["p_parametric"], r["p_perm"]) == (t[f]["p_value"], perm[f]["p_perm"]) and r["difference"] == pytest.approx(abs(r["p_parametric"] - r["p_perm"]))
        assert r["agree"] == ((r["p_parametric"] < 0.05) == (r["p_perm"] < 0.05))


def test_explained_variance_and_batches(spark, table, meta):
    dense = clr_dense(table)
    x = dense.toPandas().pivot(index="sample_id", columns="feature_id", values="clr").sort_index().to_numpy()
    m = meta.toPandas().sort_values("sample_id")
    design = m[["u", "v"]].to_numpy()
    design = design - design.mean(0)
    y = x - x.mean(0)
    fit = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    got = beta.rda_variance_columns(dense, meta, ["u", "v"]).first()["explained"]
    assert got == pytest.approx((fit ** 2).sum() / (y ** 2).sum(), rel=1e-9)
    score = np.linalg.svd(y, full_matrices=False)
    pc = y @ score[2][0]
    group = m["group"].to_numpy()
    between = sum((group == g).sum() * pc[group == g].mean() ** 2 for g in "ab")
    r = beta.batch_effect_score(table, meta.select("sample_id", "group")).first()
    assert r["eta_squared"] == pytest.approx(between / (pc ** 2).sum(), abs=1e-6)
    assert r["axis_variance"] == pytest.approx(score[1][0] ** 2 / (score[1] ** 2).sum(), rel=1e-6)
    assert r["recommendation"] == ("correct" if r["eta_squared"] > 0.3 else "check" if r["eta_squared"] > 0.1 else "none")
    report = beta.batch_report(table, meta.select("sample_id", "group"), meta.select("sample_id", F.col("v").cast("string").alias("group")), reps=19).first()
    top = 0.0
    for i in range(5):
        pc = y @ score[2][i]
        top = max(top, sum((group == g).sum() * pc[group == g].mean() ** 2 for g in "ab") / (pc ** 2).sum())
    assert report["max_axis_r2"] == pytest.approx(top, abs=1e-6)
    assert report["batch_to_biology"] == pytest.approx(report["batch_r2"] / report["biology_r2"])


@pytest.mark.parametrize(("p", "warning", "valid"), [(0.01, True, "false"), (0.2, True, "inconclusive"), (0.01, False, "true"), (0.2, False, "true")])
def test_validity(spark, p, warning, valid):
    got = beta.permanova_validity(spark.createDataFrame([(p,)], "p_value double"), spark.createDataFrame([(warning,)], "warning boolean")).first()
    assert (got["location_differs"], got["dispersion_differs"], got["valid"]) == (p < 0.05, warning, valid)


def test_spatial_folds_follow_places(spark):
    g = np.random.default_rng(1)
    at = [(50, 10), (-30, 140), (0, -80)]
    pts = [(i, float(at[i % 3][0] + g.normal()), float(at[i % 3][1] + g.normal())) for i in range(90)] + [(99, None, 1.0)]
    fold = {r["sample_id"]: r["fold"] for r in select.spatial_folds(spark.createDataFrame(pts, "sample_id int, lat double, lon double"), 3).collect()}
    assert len(fold) == 90 and all((fold[a] == fold[b]) == (a % 3 == b % 3) for a, b in itertools.combinations(range(90), 2))


def test_citations_near_mentions(spark):
    r = random.Random(2)
    bits = ["PRJNA 12", "prjna12", "PRJNA123", "Lee et al. 2019", "(Kim, 2020)", "[12]", "[3, 4]", "( 7 )", "soil", "was used.", "x" * 30, "\n\n", "2021", "Smith et al., 2001"]
    docs = [(i, " ".join(r.choice(bits) for _ in range(r.randint(0, 14)))) for i in range(150)] + [(900, ""), (901, None)]
    df = spark.createDataFrame(docs, "doc_id int, text string").withColumn("acc", F.lit("PRJNA 12"))
    got = rows(text.citations_near(df, "doc_id", "text", "acc"), "doc_id")
    some = 0
    for i, t in docs:
        if t is None:
            continue
        t = re.sub(r"(\w)\s+(\d+)", r"\1\2", re.sub(r"\s+", " ", t))
        zones = ["PRJNA12" + m[1] for m in re.finditer(r"PRJNA12(?=(.{0,40}))", t, re.I)]
        clues = {f"Author-Year clue: {m[1].strip()}" for z in zones for m in re.finditer(text.AUTHOR_YEAR, z)}
        clues |= {f"Numbered clue: {m[1]}" for z in zones for m in re.finditer(text.NUMBERED, z)}
        assert got[i]["mentions"] == len(zones) and got[i]["clues"] == sorted(clues), (i, t)
        some += bool(clues)
    assert some > 20


def test_elastic_nets_without_a_study(spark, table, wide):
    """Coefficients are the minimum of the stated objective (proximal steps in NumPy), and close to MLlib's; r2 is taken on the fold left out."""
    from pyspark.ml.regression import LinearRegression
    g = np.random.default_rng(21)
    dense = clr_dense(table)
    x = dense.toPandas().pivot(index="sample_id", columns="feature_id", values="clr").sort_index().to_numpy()
    y = x[:, 0] * 2 - x[:, 2] + g.normal(size=N) * 0.3 + 5
    m = spark.createDataFrame([(i, "xyz"[i % 3], float(y[i]) if i != 7 else None) for i in range(N)], "sample_id long, study string, y double")
    mean, scores = select.elastic_net_losgo(dense, m, "y", "study", reg=0.2, mix=0.5)
    fold = {r["sample_id"]: r["fold"] for r in select.group_folds(m, "study").collect()}
    r2, coefs = {r["fold"]: r["r2"] for r in scores.collect()}, []
    known = np.array([i for i in range(N) if i != 7])
    for f in range(3):
        train, test = known[[fold[i] != f for i in known]], known[[fold[i] == f for i in known]]
        sd, sy, n = x[train].std(0, ddof=1), y[train].std(ddof=1), len(train)
        z, t = (x[train] - x[train].mean(0)) / sd, y[train] - y[train].mean()
        u, step = np.zeros(P), n / np.linalg.norm(z, 2) ** 2 / 2
        for _ in range(20000):
            v = u - step * (-(z.T @ (t - z @ u)) / n + 0.2 * 0.5 / sy * u)
            u = np.sign(v) * np.maximum(np.abs(v) - step * 0.2 * 0.5, 0)
        coefs.append(u / sd)
        fit = y[train].mean() + (x[test] - x[train].mean(0)) @ coefs[-1]
        assert r2[f] == pytest.approx(1 - ((y[test] - fit) ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum(), abs=1e-6)
    got = [r["mean_coefficient"] for r in mean.orderBy("feature_id").collect()]
    assert got == pytest.approx(list(np.mean(coefs, axis=0)), abs=1e-6)
    v, ids = select.feature_vectors(dense, "clr")
    d = v.join(m.filter("y is not null").select("sample_id", F.col("y").alias("label")), "sample_id")
    ml = LinearRegression(regParam=0.3, elasticNetParam=0.5, maxIter=500, tol=1e-12).fit(d).coefficients.toArray()
    found = {r["feature_id"]: r["coefficient"] for r in select.linear_discovery(dense, m, "y", reg=0.3).collect()}
    assert [found.get(i, 0.0) for i in ids] == pytest.approx(list(ml), abs=5e-3) and 0 < len(found) < P
