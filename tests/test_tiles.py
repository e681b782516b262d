"""Tiles of pairs, permutations and clades against plain NumPy, with small blocks so that several are used."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meadow.operators import beta, geo, kernels, network, pairs, permute, select, stats, traits


@pytest.fixture(scope="module")
def counts():
    g = np.random.default_rng(5)
    x = g.poisson(3, (70, 45)).astype(float) * (g.random((70, 45)) < 0.4)
    x[:, 7], x[:, 8] = x[:, 3] * 2, np.where(x[:, 4] > 0, 0.0, 5.0)
    x[:, 9] = 4.0  # the same everywhere
    x[x.sum(1) == 0, 0] = 1.0
    return x


@pytest.fixture(scope="module")
def table(spark, counts):
    rows = [(f"s{i:02d}", int(j), float(counts[i, j])) for i, j in zip(*np.nonzero(counts))]
    return spark.createDataFrame(rows, "sample_id string, feature_id int, count double").repartition(7).cache()


@pytest.fixture(autouse=True)
def small_tiles(monkeypatch):
    whole = pairs.pair_tiles

    def cut(*args, **kw):
        return whole(*args, **{**kw, "rows_per_block": 16, "cols_per_chunk": 11})

    for m in (beta, network):
        monkeypatch.setattr(m, "pair_tiles", cut)


def keyed(df, a="a", b="b"):
    return {(r[a], r[b]): r for r in df.collect()}


def test_distances_of_every_pair(table, counts):
    name = lambda i: f"s{i:02d}"
    bc, ja = keyed(beta.bray_curtis(table)), keyed(beta.jaccard(table))
    assert len(bc) == len(ja) == 70 * 69 // 2
    for i, j in itertools.combinations(range(70), 2):
        x, y = counts[i], counts[j]
        assert math.isclose(bc[name(i), name(j)]["d"], 1 - 2 * np.minimum(x, y).sum() / (x.sum() + y.sum()), abs_tol=1e-12)
        both, either = ((x > 0) & (y > 0)).sum(), ((x > 0) | (y > 0)).sum()
        assert math.isclose(ja[name(i), name(j)]["d"], 1 - both / either, abs_tol=1e-12)


def test_places_and_columns(spark):
    r = np.random.default_rng(1)
    rows = [(i, float(r.uniform(-90, 90)), float(r.uniform(-180, 180)), None if i % 9 == 0 else float(i * i)) for i in range(50)]
    m = spark.createDataFrame(rows, "sample_id int, lat double, lon double, v double")
    km, col = keyed(beta.geo_distance(m)), keyed(beta.column_distance(m, "v"))
    for (i, la, oa, va), (j, lb, ob, vb) in itertools.combinations(rows, 2):
        p, q, dp, do = math.radians(la), math.radians(lb), math.radians(lb - la), math.radians(ob - oa)
        h = math.sin(dp / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(do / 2) ** 2
        assert math.isclose(km[i, j]["d"], 2 * 6371 * math.asin(math.sqrt(min(1, h))), abs_tol=1e-6)
        assert ((i, j) in col) == (va is not None and vb is not None) and (va is None or vb is None or col[i, j]["d"] == abs(va - vb))
    one = m.limit(1)
    assert beta.geo_distance(one).count() == 0 and beta.geo_distance(m.limit(0)).count() == 0


def test_correlations_above_a_threshold(table, counts):
    live = np.flatnonzero(counts.sum(0))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.corrcoef(counts.T)
    full = keyed(network.count_correlation(table))
    assert len(full) == len(live) * (len(live) - 1) // 2
    for (a, b), row in full.items():
        assert (row["r"] is None) == bool(np.isnan(r[a, b])) and (row["r"] is None or math.isclose(row["r"], r[a, b], abs_tol=1e-9))
    for t in (0.1, 0.3, 0.95):
        got = keyed(network.correlated_counts(table, t))
        want = {(a, b) for a, b in itertools.combinations(live.tolist(), 2) if abs(r[a, b]) >= t}
        assert set(got) == want and (3, 7) in want
    eff = network.effective_tests(table).first()["effective"]
    p = len(live)
    rr = np.nansum(np.triu(r[np.ix_(live, live)], 1) ** 2)
    assert math.isclose(eff, 1 + (p - 1) * (1 - ((p + 2 * rr) / p - 1) / p), rel_tol=1e-9)


def test_proportional_edges_are_those_of_the_full_table(table):
    full = network.proportionality(table).filter(F.abs("rho") >= 0.2)
    got = keyed(network.proportionality_edges(table, 0.2, 0.0), "src", "dst")
    want = keyed(full)
    assert set(got) == set(want) and all(math.isclose(got[k]["weight"], want[k]["rho"], rel_tol=1e-9) for k in want) and want


def test_pairs_leave_a_tile_early(counts):
    """Unrelated rows are given up before all columns are through; related ones never are."""
    g = np.random.default_rng(3)
    base = g.normal(size=(40, 600))
    base[1] = base[0] + 0.1 * g.normal(size=600)
    base -= base.mean(1, keepdims=True)
    base /= np.sqrt((base ** 2).sum(1, keepdims=True))
    left = []

    def reach(dot, rest, ha, hb):
        keep = np.abs(dot) + rest >= 0.9
        left.append(int(np.triu(keep, 1).sum()))
        return keep

    tile = pairs._Tile((0, 0), ("dot",), 0, reach)
    tile.heads[0] = np.arange(40), (base ** 2).sum(1)[:, None]
    for ch in range(12):
        cols = np.arange(ch * 50, ch * 50 + 50)
        rc, cc = np.divmod(np.arange(40 * 50), 50)
        tile.add({"ch": ch, "blk": 0, "rows": list(range(40)), "cols": cols.tolist(), "rc": rc.astype(np.int32).tobytes(), "cc": cc.astype(np.int32).tobytes(),
                  "v": base[:, cols].ravel().tobytes()})
    out = tile.close(lambda a, b, s, ha, hb: list(zip(a.tolist(), b.tolist(), s["dot"].tolist())))
    assert [(a, b) for a, b, _ in out] == [(0, 1)] and math.isclose(out[0][2], base[0] @ base[1], rel_tol=1e-12)
    assert left[5] < 40 * 39 // 4 and left[-1] == 1


# ---------------------------------------------------------------- permutations


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame([(f"s{i:02d}", "abc"[i % 3] if i % 10 else "a") for i in range(70)] + [("s99", None)], "sample_id string, group string")


def plain_statistics(table, groups, counts, reps, kind, seed=42):
    coded, design = permute.indexed_labels(groups, seed=seed)
    at = {r["sample_id"]: (r["idx"], r["code"]) for r in coded.collect()}
    order = [at[f"s{i:02d}"] for i in range(70)]
    own = np.array([c for _, c in order])[:, None]
    lab = np.column_stack([own, design.labels(np.array([i for i, _ in order]), 0, reps)])
    out = {}
    for j in np.flatnonzero(counts.sum(0)):
        v, st = counts[:, j], []
        for p in range(reps + 1):
            s = np.array([v[lab[:, p] == g].sum() for g in range(design.k)])
            if kind == "ttest":
                st.append(abs(s[0] / design.sizes[0] - s[1] / design.sizes[1]))
            else:
                q = (s ** 2 / design.sizes).sum()
                within = max((v ** 2).sum() - q, 0.0) / (70 - design.k)
                st.append(((q - v.sum() ** 2 / 70) / (design.k - 1)) / within if within > 1e-12 else np.nan)
        out[int(j)] = np.array(st)
    return out, lab


@pytest.mark.parametrize("kind", ["ftest", "ttest"])
def test_permutation_p_by_hand(spark, table, groups, counts, monkeypatch, kind):
    monkeypatch.setattr(permute, "RUN", 16)
    monkeypatch.setattr(permute, "AT_ONCE", 13)
    monkeypatch.setattr(permute, "ACCUMULATOR", 60 * 3 * 8 * 9)
    g = groups if kind == "ftest" else groups.withColumn("group", F.when(F.col("group") == "c", "b").otherwise(F.col("group")))
    want, lab = plain_statistics(table, g, counts, 59, kind)
    assert all(sorted(lab[:, p]) == sorted(lab[:, 0]) for p in range(60))
    got = {r["feature_id"]: r for r in stats.permutation_test(table, g, 59, kind).collect()}
    other = {r["feature_id"]: r for r in stats.permutation_test(table.repartition(1), g.repartition(9), 59, kind).collect()}
    assert set(got) == set(want) and got == other
    for j, st in want.items():
        if np.isnan(st[0]):
            continue
        assert math.isclose(got[j]["statistic"], st[0], rel_tol=1e-9, abs_tol=1e-12)
        over = st[1:] >= st[0] - abs(st[0]) * 1e-9
        assert math.isclose(got[j]["p_perm"], (over.sum() + 1) / 60)
    seq = {r["feature_id"]: r for r in permute.permutation_p(table, g, 59, kind, stop=5, first_pass=20).collect()}
    for j, st in want.items():
        if np.isnan(st[0]):
            continue
        hits = np.flatnonzero(st[1:] >= st[0] - abs(st[0]) * 1e-9)
        p, n = (5 / (hits[4] + 1), hits[4] + 1) if len(hits) >= 5 else ((len(hits) + 1) / 60, 59)
        assert math.isclose(seq[j]["p_perm"], p) and seq[j]["n_perm"] == n
    if kind == "ftest":
        tops = np.nanmax(np.array([st[1:] for st in want.values() if not np.isnan(st[0])]), axis=0)
        family = {r["feature_id"]: r["p_maxt"] for r in stats.maxt(table, g, 59).collect()}
        assert all(math.isclose(family[j], ((tops >= st[0] - abs(st[0]) * 1e-9).sum() + 1) / 60) for j, st in want.items() if not np.isnan(st[0]))
        base = select.shuffle_baseline(table, g.filter("group is not null"), 59).first()
        ratio = lambda f: f * 2 / (f * 2 + 67)
        real = max(ratio(st[0]) for st in want.values() if not np.isnan(st[0]))
        assert math.isclose(base["real"], real, rel_tol=1e-9) and math.isclose(base["mean_shuffled"], ratio(tops).mean(), rel_tol=1e-9)
        assert math.isclose(base["p_value"], ((ratio(tops) >= real - 1e-12).sum() + 1) / 60)


def test_permanova_by_hand(table, groups, counts):
    d = beta.bray_curtis(table)
    _, lab = plain_statistics(table, groups, counts[:, :1], 49, "ftest")
    q = np.array([[1 - 2 * np.minimum(x, y).sum() / (x.sum() + y.sum()) for y in counts] for x in counts]) ** 2
    sizes = np.bincount(lab[:, 0])
    f = []
    for p in range(50):
        within = sum(q[np.ix_(lab[:, p] == g, lab[:, p] == g)].sum() / 2 / sizes[g] for g in range(3))
        total = q.sum() / 2 / 70
        f.append(((total - within) / 2) / (within / 67))
    got = beta.permanova(d, groups.filter("group is not null"), 49, side=16).first()
    assert math.isclose(got["pseudo_f"], f[0], rel_tol=1e-9) and (got["n"], got["k"]) == (70, 3)
    assert math.isclose(got["p_value"], (sum(x >= f[0] * (1 - 1e-9) for x in f[1:]) + 1) / 50)


# ---------------------------------------------------------------- clades


def test_clade_signal_is_that_of_the_pair_table(spark):
    g = np.random.default_rng(9)
    ranks = ["r0", "r1", "r2", "r3", "r4", "r5", "r6"]
    rows = [(i, *[None if (k == 3 and i % 11 == 0) else f"x{int(g.integers(0, 2 + k % 2))}" for k in range(7)], float(g.integers(0, 4))) for i in range(90)]
    rows += [(100 + i, *rows[i][1:8], float(i)) for i in range(10)] + [(200, *rows[0][1:8], None)]
    t = spark.createDataFrame(rows, "feature_id int, " + ", ".join(f"{r} string" for r in ranks) + ", value double")
    known = t.filter("value is not null")
    pairs_ = {k: r["d"] for k, r in keyed(traits.taxonomic_distance(known, ranks)).items()}
    index = {r["feature_id"]: r["idx"] for r in kernels.dense_index(known.select("feature_id"), "feature_id").collect()}
    value = {r["feature_id"]: r["value"] for r in known.collect()}
    by_index = {index[f]: v for f, v in value.items()}

    def signal(v):
        x, y = zip(*[(d, abs(v[a] - v[b])) for (a, b), d in pairs_.items() if d > 0])
        return min(1.0, max(0.0, float(np.corrcoef(x, y)[0, 1])))

    image = kernels.permute_index(np.arange(len(index)), len(index), 19, 42)
    shuffled = [signal({f: by_index[int(image[index[f], r])] for f in value}) for r in range(19)]
    got = traits.clade_signal(t, t, ranks, reps=19, per_pass=8).first()
    assert math.isclose(got["signal"], signal(value), rel_tol=1e-9) and got["n_pairs"] == sum(d > 0 for d in pairs_.values())
    assert math.isclose(got["p_value"], (sum(s >= signal(value) - 1e-9 for s in shuffled) + 1) / 20)
    assert traits.clade_signal(t.limit(0), t, ranks, reps=0).first()["n_pairs"] == 0


# ---------------------------------------------------------------- ecotypes


def test_ecotypes_in_tasks_and_in_rounds_agree(spark, monkeypatch):
    g = np.random.default_rng(4)
    where = {i: (float(g.normal([0, 4, 8][i % 3], 0.5)), float(g.normal([0, 5, 0][i % 3], 0.5)), None if i % 17 == 0 else 1.0) for i in range(150)}
    rows = [(i, f) for f in range(12) for i in range(150) if g.random() < (0.9 if f < 4 else 0.3)] + [(i, 50) for i in range(5)]
    ab = spark.createDataFrame([(i, f, 1.0) for i, f in rows], "sample_id int, feature_id int, count double")
    meta = spark.createDataFrame([(i, *v) for i, v in where.items()], "sample_id int, u double, v double, w double")

    def run():
        prof, members = traits.ecotypes(ab, meta, ["u", "v", "w"])
        return ({(r["feature_id"], r["k"], r["ecotype"], r["size"], round(r["silhouette"], 9)) for r in prof.collect()},
                {(r["feature_id"], r["sample_id"]): r["ecotype"] for r in members.collect()})

    one = run()
    monkeypatch.setattr(traits, "IN_TASK", 60)
    assert run() == one
    monkeypatch.setattr(traits, "IN_TASK", 0)
    assert run() == one
    prof, members = one
    assert {f for f, *_ in prof} == set(range(12)) and {k for _, k, *_ in prof} <= {3, 4}
    assert all(i % 3 == j % 3 for f in range(4) for i, j in itertools.combinations([i for h, i in members if h == f], 2) if members[f, i] == members[f, j])


def test_ecotype_rounds_write_no_tables(spark, monkeypatch):
    """Many rounds over a large feature read its packed points; a table written per round made time grow with the rounds."""
    g = np.random.default_rng(6)
    meta = spark.createDataFrame([(i, *map(float, g.random(3))) for i in range(1500)], "sample_id int, u double, v double, w double")
    ab = meta.select("sample_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("feature_id"), F.lit(1.0).alias("count"))
    want = [{tuple(r) for r in t.collect()} for t in traits.ecotypes(ab, meta, ["u", "v", "w"], min_silhouette=0.0)]
    written, passes, cut, sums = [], [], traits.cut_lineage, traits._block_sums
    monkeypatch.setattr(traits, "IN_TASK", 0)
    monkeypatch.setattr(traits, "PACKED", 300)
    monkeypatch.setattr(traits, "cut_lineage", lambda df: written.append(1) or cut(df))
    monkeypatch.setattr(traits, "_block_sums", lambda *a: passes.append(1) or sums(*a))
    prof, members = traits.ecotypes(ab, meta, ["u", "v", "w"], min_silhouette=0.0)
    assert {tuple(r) for r in members.collect()} == want[1]
    assert sorted((*r[:4], *np.round(r[4:], 9)) for r in map(tuple, prof.collect())) == sorted((*r[:4], *np.round(r[4:], 9)) for r in want[0])
    assert len(passes) > 10 and len(written) <= 4


def test_rarefy_draws_only_where_a_draw_decides(spark):
    """A draw over one feature, or of all reads, is known; the generator was asked for each and refuses 10^9 reads."""
    from meadow.operators import alpha
    rows = [("one", "f", 3e9), ("few", "f", 2.0), ("few", "g", 3.0), *[("many", f"f{i}", 4.0) for i in range(300)]]
    ab = spark.createDataFrame(rows, "sample_id string, feature_id string, count double")
    got = alpha.rarefy(ab, 12).collect()
    assert {tuple(r) for r in got if r["sample_id"] != "many"} == {("one", "f", 12.0), ("few", "f", 2.0), ("few", "g", 3.0)}
    assert sum(r["count"] for r in got if r["sample_id"] == "many") == 12


def test_alpha_tests_read_the_values_once(spark):
    """Three tests over one table of values: what is behind the table is worked out once, not for each test and each pass."""
    from meadow.operators import alpha
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    base = spark.createDataFrame([(i, "m", float(i * 7 % 31)) for i in range(60)], "sample_id int, metric string, value double")
    meta = spark.createDataFrame([(i, float(i), i % 2 == 0, "abc"[i % 3]) for i in range(60)], "sample_id int, value double, flag boolean, `group` string")
    out = alpha.alpha_vs_metadata(base.mapInArrow(seen, base.schema), meta, ["value"], ["flag", "group"])
    assert out.count() == 3 and reads.value == 60


def test_redundancy_reads_the_dense_table_once(spark):
    g = np.random.default_rng(3)
    x, y = g.normal(size=(30, 2)), g.normal(size=(30, 4))
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    base = spark.createDataFrame([(i, j, float(y[i, j])) for i in range(30) for j in range(4)], "sample_id int, feature_id int, clr double")
    design = spark.createDataFrame([(i, *map(float, x[i])) for i in range(30)], "sample_id int, u double, v double")
    got = beta.rda_variance_columns(base.mapInArrow(seen, base.schema), design, ["u", "v"]).first()["explained"]
    cx, cy = x - x.mean(0), y - y.mean(0)
    fit = cx @ np.linalg.lstsq(cx, cy, rcond=None)[0]
    assert got == pytest.approx((fit ** 2).sum() / (cy ** 2).sum()) and reads.value == 120


def test_percentiles_read_the_table_once(spark):
    from meadow.operators import compositional
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    base = spark.createDataFrame([(i, "f", float(i + 1)) for i in range(40)], "sample_id int, feature_id string, count double")
    batches = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(40)], "sample_id int, batch string")
    got = {r["sample_id"]: r["count"] for r in compositional.percentile_normalize(base.mapInArrow(seen, base.schema), batches).collect()}
    # The value of rank r in its batch of 20 moves to position 39 r / 20 of the values 1 to 40.
    assert all(got[i] == pytest.approx(1 + 39 * (i // 2 + 1) / 20) for i in range(40)) and reads.value == 40


# ---------------------------------------------------------------- ranks, axes, outliers, patterns


def test_narrow_values_are_split(spark, monkeypatch):
    """A month of seconds lies in three octave steps; its buckets are split at quantiles and totals stay exact."""
    monkeypatch.setattr(kernels, "SPLIT_ROWS", 2000)
    g = np.random.default_rng(2)
    v = np.unique(g.integers(1_700_000_000, 1_702_600_000, 100_000)).astype(float)
    few = np.arange(50.0)
    rows = spark.createDataFrame([("a", float(x), 1) for x in v] + [("b", float(x), 2) for x in few], "k string, v double, w int")
    b, sums = kernels.bucketed(rows, ["k"], "v", "w")
    sizes = {(r["k"], r["_b"], r["_s"]): r["_t"] for r in sums.collect()}
    assert max(t for (k, _, _), t in sizes.items() if k == "a") < 0.05 * len(v) and sum(sizes.values()) == len(v) + 100
    spread = [(r["lo"], r["hi"]) for r in b.filter("k = 'a'").groupBy("_b", "_s").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_b", "_s").collect()]
    assert all(x[1] < y[0] for x, y in itertools.pairwise(spread))
    got = {(r["k"], r["v"]): r["cum"] for r in kernels.running_total(rows, ["k"], "v", "w").collect()}
    assert all(got["a", x] == i + 1 for i, x in enumerate(v)) and all(got["b", x] == 2 * (i + 1) for i, x in enumerate(few))


@pytest.mark.parametrize(("n", "p", "k"), [(60, 8, 3), (300, 120, 5), (40, 100, 4), (5, 3, 3)])
def test_axes_are_those_of_the_svd(spark, n, p, k):
    from pyspark.ml.linalg import Vectors
    g = np.random.default_rng(n)
    x = g.normal(size=(n, p)) * np.linspace(3, 0.5, p) + g.normal(size=p) * 5
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["sample_id", "features"]).repartition(5)
    scores, ratio = beta.pca(df, k)
    c = x - x.mean(0)
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    got = np.array([r["axes"] for r in sorted(scores.collect(), key=lambda r: r["sample_id"])])
    want = c @ vt[:k].T * np.sign(vt[range(k), np.abs(vt[:k]).argmax(1)])
    assert np.allclose(got, want, atol=1e-6) and np.allclose(ratio, (s ** 2 / (s ** 2).sum())[:k], atol=1e-9)


def test_axes_of_a_wide_clr_table_without_making_it(spark, monkeypatch):
    """More features than samples: the axes come from distances, as the dense table of all cells is too wide for one row."""
    g = np.random.default_rng(12)
    rows = [(i, j, float(g.integers(1, 60))) for i in range(20) for j in range(300) if g.random() < 0.2 + 0.03 * ((i + j) % 5)]
    ab = spark.createDataFrame(rows, "sample_id int, feature_id int, count double")
    some = spark.createDataFrame([(j,) for j in range(100, 400)], "feature_id int")
    want = [beta.pca(beta.to_vectors(beta.clr_dense(ab, f), "clr"), 3) for f in (None, some)]

    def made(*_):
        raise AssertionError("dense table made")

    monkeypatch.setattr(beta, "to_vectors", made)
    for f, (scores, ratio) in zip((None, some), want):
        got, share = beta.clr_pca(ab, 3, f)
        x, y = (np.array([r["axes"] for r in sorted(t.collect(), key=lambda r: r["sample_id"])]) for t in (got, scores))
        assert np.allclose(x, y, atol=1e-6) and np.allclose(share, ratio, atol=1e-9)


def test_outliers_that_hide_each_other(spark):
    from meadow.operators import qc
    g = np.random.default_rng(8)
    x = g.multivariate_normal([0, 0, 0], [[1, 0.9, 0], [0.9, 1, 0], [0, 0, 1]], 400)
    x[:80] = g.normal([2.5, -2.5, 6], 0.3, (80, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "sample_id int, a double, b double, c double")
    got = {r["sample_id"]: (r["distance2"], r["metadata_outlier"]) for r in qc.metadata_outliers(df, ["a", "b", "c"], 0.2).collect()}
    assert {i for i, (_, o) in got.items() if o == "OUTLIER"} == set(range(80))
    assert min(got[i][0] for i in range(80)) > 3 * max(got[i][0] for i in range(80, 400))
    mean, cov = qc.robust_fit(df, ["a", "b", "c"])
    assert np.allclose(mean, x[80:].mean(0), atol=0.1) and np.allclose(cov, np.cov(x[80:].T), atol=0.2)
    c = x - x.mean(0)
    classical = (c @ np.linalg.inv(np.cov(c.T)) * c).sum(1)
    assert (np.sort(classical)[-80:].min() < classical[:80].max()) and set(np.argsort(classical)[-80:]) != set(range(80))
    flat = spark.createDataFrame([(i, 1.0, float(i)) for i in range(30)], "sample_id int, a double, b double")
    assert qc.metadata_outliers(flat, ["a", "b"], 0.1).filter("metadata_outlier = 'OUTLIER'").count() <= 3


def test_wildcards_are_those_of_the_regex():
    import re
    import random
    r = random.Random(4)
    patterns = ["*", "a*", "*a", "ab*ba", "a*b*c", "**", "x**y", "abc"] + ["".join(r.choice("ab*c") for _ in range(r.randint(1, 6))) for _ in range(300)]
    table = [(p, f"f{i}") for i, p in enumerate(patterns) if "*" in p]
    known = traits.Wildcards(table)
    for _ in range(400):
        name = "".join(r.choice("abc") for _ in range(r.randint(0, 9)))
        want = sorted({f for p, f in table if re.fullmatch(".*".join(map(re.escape, p.split("*"))), name)})
        assert known.match(name) == want
    assert traits.Wildcards([]).match("a") == []


def test_bootstrap_by_hand(spark, table, groups, counts, monkeypatch):
    monkeypatch.setattr(permute, "RUN", 16)
    monkeypatch.setattr(permute, "AT_ONCE", 7)
    two = groups.filter("group in ('a', 'b')")
    coded, _ = permute.indexed_labels(two)
    at = {r["sample_id"]: (r["idx"], r["code"]) for r in coded.collect()}
    rows = [i for i in range(70) if f"s{i:02d}" in at]
    w = permute.poisson_weights(np.array([at[f"s{i:02d}"][0] for i in rows]), 40, 42)
    assert 0.9 < w.mean() < 1.1 and 0.8 < w.var() < 1.2
    code = np.array([at[f"s{i:02d}"][1] for i in rows])
    got = {r["feature_id"]: (r["lower"], r["upper"]) for r in stats.bootstrap_ci(table, groups, ("b", "a"), 40).collect()}
    for j, (low, high) in got.items():
        v, ds = counts[rows, j], []
        for r in range(40):
            part = [np.repeat(v[code == g], w[code == g, r].astype(int)) for g in (1, 0)]
            dev = sum(((x - x.mean()) ** 2).sum() for x in part)
            if dev > 1e-9:
                ds.append((part[0].mean() - part[1].mean()) / math.sqrt(dev / (len(part[0]) + len(part[1]) - 2)))
        assert (low is None and not ds) or np.allclose([low, high], np.quantile(ds, [0.025, 0.975]), atol=1e-9)
    assert len(got) == len(np.flatnonzero(counts[rows].sum(0)))


def test_crowded_cells_are_split(spark, monkeypatch):
    from meadow.operators import geo
    g = np.random.default_rng(6)
    pts = [(i, float(48 + g.normal() * 0.02), float(11 + g.normal() * 0.02)) for i in range(300)] + [(1000 + i, float(g.uniform(-90, 90)), float(g.uniform(-180, 180))) for i in range(50)]
    s = spark.createDataFrame(pts, "sample_id int, lat double, lon double")
    p = spark.createDataFrame([(i, la, lo) for i, la, lo in pts[::3]], "point_id int, lat double, lon double")
    whole = {(r["point_id"], r["sample_id"]): r["km"] for r in geo.samples_within_radius(s, p, 3.0).collect()}
    monkeypatch.setattr(geo, "CROWDED", 20)
    split = {(r["point_id"], r["sample_id"]): r["km"] for r in geo.samples_within_radius(s, p, 3.0).collect()}
    assert split == whole and len(whole) > 1000


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_mantel_by_hand(spark, monkeypatch, method):
    import pandas as pd
    g = np.random.default_rng(14)
    n = 23
    p, q = g.normal(size=(n, 2)), g.normal(size=n)
    x = np.abs(p[:, None, :] - p[None]).sum(2)
    y = np.round(np.abs(p[:, None, 0] - p[None, :, 0]) + np.abs(q[:, None] - q[None]), 1)
    pairs_ = list(itertools.combinations(range(n), 2))
    make = lambda m: spark.createDataFrame([(f"s{a:02d}", f"s{b:02d}", float(m[a, b])) for a, b in pairs_], "a string, b string, d double")
    if method == "spearman":
        for m in (x, y):
            v = pd.Series([m[a, b] for a, b in pairs_]).rank().to_numpy()
            for (a, b), r in zip(pairs_, v, strict=True):
                m[a, b] = m[b, a] = r
    index = {r["id"]: r["idx"] for r in kernels.dense_index(spark.createDataFrame([(f"s{i:02d}",) for i in range(n)], "id string"), "id").collect()}
    at = np.array([index[f"s{i:02d}"] for i in range(n)])
    back = np.argsort(at)
    image = kernels.permute_index(np.arange(n), n, 29, 42)
    corr = lambda to: np.corrcoef([x[a, b] for a, b in pairs_], [y[to[a], to[b]] for a, b in pairs_])[0, 1]
    own = corr(np.arange(n))
    want = (sum(abs(corr(back[image[at, r]])) >= abs(own) - 1e-12 for r in range(29)) + 1) / 30
    whole = beta._permuted_tiles
    monkeypatch.setattr(beta, "_permuted_tiles", lambda *a: whole(*a, cells=100))
    got = beta.mantel(make(x), make(y), method, 29).first()
    assert got["r"] == pytest.approx(own) and got["p_value"] == pytest.approx(want) and got["n_pairs"] == len(pairs_)
    monkeypatch.setattr(beta, "_permuted_tiles", lambda j, idx, m, n, reps, seed: beta._permuted_pairs(j, idx, n, reps, seed))
    assert beta.mantel(make(x), make(y), method, 29).first()["p_value"] == pytest.approx(want)


def test_pcoa_tells_close_values_apart(spark):
    """A flat spectrum: 60 unit vectors at right angles, a hair apart in length, so that power rounds would not settle."""
    n = 60
    x = np.diag(1 + np.arange(n) * 1e-4)
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    dist = spark.createDataFrame([(a, b, float(d[a, b])) for a in range(n) for b in range(a + 1, n)], "a int, b int, d double")
    coords, info = beta.pcoa(dist, 3, blocks=3)
    c = np.eye(n) - 1 / n
    want = np.sort(np.linalg.eigvalsh(c @ (-0.5 * d ** 2) @ c))[::-1][:3]
    assert [r["eigenvalue"] for r in info.orderBy("axis").collect()] == pytest.approx(list(want), rel=1e-9)
    got = np.array([r["axes"] for r in coords.orderBy("sample_id").collect()])
    assert np.allclose(got.T @ got, np.diag(want), atol=1e-7)


def test_chunks_of_a_tile_are_dealt_to_ranges(spark, table, counts, monkeypatch):
    """A tile with many columns is no longer one task's: with ranges of a few bytes the distances stay the same."""
    monkeypatch.setattr(pairs, "RANGE_BYTES", 2000)
    ids = [f"s{i:02d}" for i in range(len(counts))]
    t = counts.sum(1)
    out = beta.bray_curtis(table)
    got = {(r["a"], r["b"]): r["d"] for r in out.collect()}
    assert len(got) == len(ids) * (len(ids) - 1) // 2
    for (a, b), d in got.items():
        i, j = int(a[1:]), int(b[1:])
        assert d == pytest.approx(1 - 2 * np.minimum(counts[i], counts[j]).sum() / (t[i] + t[j]))
    got = {(r["a"], r["b"]): r["d"] for r in beta.jaccard(table).collect()}
    for (a, b), d in got.items():
        x, y = counts[int(a[1:])] != 0, counts[int(b[1:])] != 0
        assert d == pytest.approx(1 - (x & y).sum() / (x | y).sum())
    plan = out._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") >= 2


def test_points_spread_to_cells_are_not_broadcast(spark, tmp_path):
    """A small file of points makes 125 times as many rows of cells; these must not pass through the driver."""
    path = str(tmp_path / "points")
    spark.range(400).selectExpr("id AS facility_id", "'NRC' AS data_source", "id % 20 / 10.0 AS lat", "floor(id / 20) / 10.0 AS lon").write.parquet(path)
    points = spark.read.parquet(path)
    plan = geo.close_points(points, points, 50.0)._jdf.queryExecution().toString()
    assert "SortMergeJoin [_c" in plan[plan.index("== Physical Plan =="):]
    assert geo.dedup_facilities(points, 50.0).count() == 1


def test_adjust_p_windows_end_at_their_row(spark):
    """a window that ends at the last row is worked out anew for each row, so a family costs its square."""
    p = np.round(np.random.default_rng(3).random(3000) ** 3, 4)
    t = spark.createDataFrame([(i, int(i % 3), float(x)) for i, x in enumerate(p)], "test int, s int, p_value double")
    for method in ("fdr_bh", "fdr_by", "holm"):
        out = stats.adjust_p(t, method=method, strata=["s"])
        assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
        got = {r["test"]: r["p_adj"] for r in out.collect()}
        for s in range(3):
            at = np.arange(s, 3000, 3)
            v = np.sort(p[at])
            m, i = len(v), np.arange(1, len(v) + 1)
            if method == "holm":
                want = np.maximum.accumulate(v * (m - i + 1))
            else:
                want = np.minimum.accumulate((v * m * ((1 / i).sum() if method == "fdr_by" else 1) / i)[::-1])[::-1]
            # Equal p values share the value of their lowest (Holm) or highest (BH, BY) rank.
            at_rank = np.searchsorted(v, p[at], side="left" if method == "holm" else "right") - (method != "holm")
            np.testing.assert_allclose([got[int(t)] for t in at], np.minimum(want[at_rank], 1.0), rtol=1e-9)


def test_quantile_of_a_column_in_narrowing_ranges(spark, monkeypatch):
    """no histogram is written for the median of one column; crowded ranges are counted again in finer parts."""
    monkeypatch.setattr(kernels, "SORTED_HERE", 5)
    g = np.random.default_rng(6)
    for x in (g.normal(1e6, 1e-3, 500), np.repeat(7.0, 40), g.integers(-3, 4, 301).astype(float), np.array([2.5]), g.random(400) - 0.5):
        t = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            np.testing.assert_allclose(kernels.quantile(t, F.col("v"), q), np.quantile(x, q), rtol=1e-12)
    assert kernels.quantile(spark.createDataFrame([], "v double"), F.col("v"), 0.5) is None


def test_robust_fit_writes_its_rows_once(spark, monkeypatch):
    """a concentration step reads the rows and writes nothing."""
    from meadow.operators import qc
    written = []
    monkeypatch.setattr(qc, "cut_lineage", lambda df, own=qc.cut_lineage: written.append(1) or own(df))
    x = np.random.default_rng(8).normal(size=(300, 2))
    qc.robust_fit(spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double"), ["a", "b"])
    assert len(written) == 1


def test_close_points_deals_pairs_to_tasks(spark, monkeypatch):
    """the number of tasks follows the pairs to compare; an archive's place is joined once, whatever it holds."""
    monkeypatch.setattr(geo, "TASK_PAIRS", 50)
    g = np.random.default_rng(4)
    a, b = np.round(g.random((60, 2)) * 4, 2), np.round(g.random((30, 2)) * 4, 1)
    need = spark.createDataFrame([(i, float(x), float(y), None) for i, (x, y) in enumerate(a)], "sample_id int, lat double, lon double, accession string")
    arch = spark.createDataFrame([(i, float(b[i % 30][0]), float(b[i % 30][1]), "d" if i % 3 else None, "l" if i % 2 else None, "h" if i % 5 == 0 else None, f"s{i}")
                                  for i in range(150)], "archive_id int, lat double, lon double, collection_date string, location string, host string, site string")
    near = geo.close_points(need, arch, 120.0)
    assert near.rdd.getNumPartitions() > 4
    rows = arch.collect()
    out = geo.borrow_from_nearby(need.withColumn("site", F.lit(None).cast("string")), arch, 120.0, ["site"]).collect()
    assert len(out) == 60

    def km(p, q):
        x, y = np.radians(p), np.radians(q)
        h = math.sin((y[0] - x[0]) / 2) ** 2 + math.cos(x[0]) * math.cos(y[0]) * math.sin((y[1] - x[1]) / 2) ** 2
        return 2 * geo.EARTH_KM * math.asin(min(1.0, math.sqrt(h)))

    for r in out:
        here = [(km(a[r["sample_id"]], (q["lat"], q["lon"])), q) for q in rows]
        best = min(((-(1000 * (3 * (q["collection_date"] is not None) + 2 * (q["location"] is not None)) - d - 10 * (q["host"] is not None)), q["archive_id"])
                    for d, q in here if d <= 120.0), default=(0, None))
        assert r["donor"] == best[1]


def test_dense_cells_are_filled_where_a_sample_is(spark, table, counts, monkeypatch):
    """no grid of samples and feature chunks is shuffled to find the absent cells; a wide table still joins one."""
    from meadow.operators import compositional
    kept = spark.createDataFrame([(j,) for j in range(0, 50, 3)], "feature_id int")
    x = np.log(counts + 1)
    p = int((counts > 0).any(0).sum())
    x = x - x.sum(1, keepdims=True) / p
    narrow = compositional.clr_dense(table, kept)
    assert "_ch" not in narrow._jdf.queryExecution().toString()
    monkeypatch.setattr(compositional, "DENSE_FEATURES", 0)
    for out in (narrow, compositional.clr_dense(table, kept)):
        got = {(r["sample_id"], r["feature_id"]): r["clr"] for r in out.collect()}
        assert len(got) == 70 * 17 == out.count()
        for (s, j), v in got.items():
            own = x[int(s[1:]), j] if j < 45 else x[int(s[1:])][counts[int(s[1:])] == 0][0]
            assert abs(v - own) < 1e-12


def test_networks_read_their_table_once(spark, table):
    """what makes the table is not run again for heads, cells, counts and ranks."""
    for run in (lambda ab: network.proportionality_edges(ab, 0.05), lambda ab: network.spearman_network(ab, 20, 0.05)):
        seen = spark.sparkContext.accumulator(0)

        @F.udf("double")
        def counted(x, seen=seen):
            seen.add(1)
            return x

        run(table.withColumn("count", counted("count"))).collect()
        assert 0 < seen.value <= 2 * table.count()


def test_primer_pairs_are_dealt_to_tasks(spark, monkeypatch):
    """the pairs of a region came from one task, as the few primers that made them were put together in one partition."""
    from meadow.operators import joins
    monkeypatch.setattr(joins, "MEET", 32)
    monkeypatch.setattr(joins, "TASK_PAIRS", 1000)
    at = [(f"p{i}", "Forward primer" if i % 2 else " Reverse primer ", i % 90, i % 90 + 15) for i in range(600)]
    primers = spark.createDataFrame(at + [("far", "Forward primer", 900, 915), ("null", "Forward primer", None, 20)],
                                    "name string, direction string, position_start int, position_end int")
    regions = spark.createDataFrame([("V", 30, 60, 20), ("none", 2000, 3000, 5)], "region string, fwd_pos int, rev_pos int, leeway int")
    got = joins.primer_pairs(primers, regions).withColumn("_t", F.spark_partition_id()).collect()
    f = [(n, s) for n, d, s, e in at if d == "Forward primer" and s <= 50 and e >= 10]
    r = [(n, s) for n, d, s, e in at if d != "Forward primer" and s <= 80 and e >= 40]
    want = sorted(("V", n, s, m, t) for n, s in f for m, t in r if s < t)
    assert sorted(tuple(x)[:5] for x in got) == want
    sizes = [sum(x["_t"] == t for x in got) for t in {x["_t"] for x in got}]
    assert max(sizes) < len(got) / 4
    assert joins.primer_pairs(primers.limit(0), regions).count() == 0
