"""Permutation statistics by tiles: value tiles times one-hot label tiles, on accumulators of fixed size.

Samples have an index that does not depend on partitions (kernels.dense_index), features are dealt to blocks. The cells of a block and
a run of a thousand samples are packed into one row. A task takes the packed rows of a block in order and adds value tile @ one-hot
labels for all permutations at once; a permuted label is computed from the sample's index, so that no label table exists. When
the block's rows are through, statistics are taken and only counts leave the task.

With `stop` a feature leaves after that many exceedances (sequential Monte Carlo): passes of growing length read the blocks that
still have features. Where h exceedances came by permutation l, p is h / l, else (b + 1) / (B + 1); both are exact p values (Besag and
Clifford 1991).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meadow.operators.kernels import arrow_schema, dense_index, permute_index
from meadow.sources.tables import cut_lineage

RUN = 1024  # samples of a packed row
ACCUMULATOR = 32 << 20  # bytes of a task's sums
AT_ONCE = 64  # permutations whose one-hot labels are held at once
CLOSE = 1e-12


class Design:
    """Group sizes in code order, number of samples and the labels of any run of samples in any permutation."""

    def __init__(self, sizes: list[tuple[str, int]], seed: int):
        self.sizes = np.array([c for _, c in sizes], float)
        self.ends = np.cumsum([c for _, c in sizes])
        self.n, self.k, self.seed = int(self.ends[-1]) if len(sizes) else 0, len(sizes), seed

    def labels(self, index: np.ndarray, first: int, reps: int) -> np.ndarray:
        """Codes (samples x reps) of permutations first, first + 1, ..., as kernels.permuted_codes gives them."""
        return np.searchsorted(self.ends, permute_index(index, self.n, reps, self.seed, first), side="right").astype(np.int16)


def indexed_labels(labels: DataFrame, key: str = "sample_id", group: str = "group", seed: int = 42) -> tuple[DataFrame, Design]:
    """(key, idx, code) and the design; null groups are left out, groups are coded by name."""
    clean = labels.select(key, F.col(group).cast("string").alias("_g")).filter(F.col("_g").isNotNull())
    sizes = sorted((r["_g"], r["c"]) for r in clean.groupBy("_g").agg(F.count(F.lit(1)).alias("c")).collect())
    code = F.coalesce(*[F.when(F.col("_g") == g, F.lit(i)) for i, (g, _) in enumerate(sizes)]) if sizes else F.lit(0)
    return cut_lineage(dense_index(clean, key).select(key, "idx", code.alias("code"))), Design(sizes, seed)


def pack(ab: DataFrame, coded: DataFrame, value: str, per_block: int) -> DataFrame:
    """(blk, run, feats, fc, ic, gc, v): the cells of a block of features and a run of samples, each as one row."""
    j = ab.join(coded, "sample_id").select("feature_id", F.col(value).cast("double").alias("v"), "idx", "code")
    n_feats = ab.select("feature_id").distinct().count()
    blocks = max(1, -(-n_feats // per_block))
    j = j.select("*", F.pmod(F.xxhash64("feature_id"), F.lit(blocks)).cast("int").alias("blk"), F.floor(F.col("idx") / RUN).cast("int").alias("run"))
    kind = dict(ab.dtypes)["feature_id"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        fc, feats = pd.factorize(pdf["feature_id"], sort=True)
        ints = [x.astype(np.int32).tobytes() for x in (fc, pdf["idx"].to_numpy() % RUN, pdf["code"].to_numpy())]
        return pd.DataFrame([(pdf["blk"].iloc[0], pdf["run"].iloc[0], feats.tolist(), *ints, pdf["v"].to_numpy(float).tobytes())],
                            columns=["blk", "run", "feats", "fc", "ic", "gc", "v"])

    return cut_lineage(j.groupBy("blk", "run").applyInPandas(one, f"blk int, run int, feats array<{kind}>, fc binary, ic binary, gc binary, v binary"))


class _Block:
    """Sums of a block of features per permutation and group; the first `own` column block holds the given labels."""

    def __init__(self, blk: int, design: Design, first: int, reps: int):
        self.blk, self.design, self.first, self.reps = blk, design, first, reps
        self.feats: dict = {}
        self.sums = np.zeros((0, reps + 1, design.k))
        self.squares = np.zeros(0)
        self.only: set | None = None

    def add(self, r: dict) -> None:
        feats = [f for f in r["feats"] if self.only is None or f in self.only]
        for f in feats:
            self.feats.setdefault(f, len(self.feats))
        if not feats:
            return
        grow = len(self.feats) - len(self.sums)
        if grow:
            self.sums = np.concatenate([self.sums, np.zeros((grow, *self.sums.shape[1:]))])
            self.squares = np.concatenate([self.squares, np.zeros(grow)])
        at = np.array([self.feats.get(f, -1) for f in r["feats"]])[np.frombuffer(r["fc"], np.int32)]
        ic, code, v = np.frombuffer(r["ic"], np.int32), np.frombuffer(r["gc"], np.int32), np.frombuffer(r["v"])
        live = at >= 0
        at, ic, code, v = at[live], ic[live], code[live], v[live]
        tile, own = np.zeros((len(self.feats), RUN)), np.zeros(RUN, np.int16)
        np.add.at(tile, (at, ic), v)
        own[ic] = code
        self.squares += (tile * tile).sum(1)
        d = self.design
        index = np.minimum(np.arange(RUN, dtype=np.int64) + r["run"] * RUN, d.n - 1)
        self._product(tile, own[:, None], 0)
        for at_rep in range(0, self.reps, AT_ONCE):
            size = min(AT_ONCE, self.reps - at_rep)
            self._product(tile, d.labels(index, self.first + at_rep, size), 1 + at_rep)

    def _product(self, tile: np.ndarray, labels: np.ndarray, at: int) -> None:
        for g in range(self.design.k):
            self.sums[:, at:at + labels.shape[1], g] += tile @ (labels == g).astype(float)

    def statistics(self, kind: str) -> tuple[list, np.ndarray]:
        """(features, absolute mean difference or F per feature for the given labels and each permutation)."""
        d = self.design
        if kind == "ttest":
            return list(self.feats), np.abs(self.sums[:, :, 0] / d.sizes[0] - self.sums[:, :, 1] / d.sizes[1])
        q = (self.sums ** 2 / d.sizes).sum(2)
        t = self.sums[:, :1, :].sum(2)
        with np.errstate(divide="ignore", invalid="ignore"):
            f = ((q - t ** 2 / d.n) / (d.k - 1)) / (np.maximum(self.squares[:, None] - q, 0.0) / (d.n - d.k))
        return list(self.feats), np.where(np.isfinite(f), f, np.nan)


def _blocks(batches: Iterator[pa.RecordBatch], design: Design, first: int, reps: int) -> Iterator[_Block]:
    """The blocks of a partition sorted by (blk, run), each once it is whole. Rows of run -1 name the features that count."""
    block = None
    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            if block is None or block.blk != r["blk"]:
                if block is not None:
                    yield block
                block = _Block(r["blk"], design, first, reps)
            if r["run"] < 0:
                block.only = set(r["feats"])
            else:
                block.add(r)
    if block is not None:
        yield block


def _per_block(reps: int, k: int) -> int:
    return int(min(512, max(8, ACCUMULATOR // (8 * (reps + 1) * max(1, k)))))


def exceedances(packed: DataFrame, design: Design, kind: str, first: int, reps: int, only: DataFrame | None = None) -> DataFrame:
    """feature_id, blk, statistic, b, hits: exceedances among the permutations, and their places in order, 0 based.

    A permuted statistic counts when it is at least the given labels' one, up to rounding."""
    ddl = f"feature_id {dict(packed.dtypes)['feats'][6:-1]}, blk int, statistic double, b long, hits array<int>"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, design, first, reps):
            feats, st = block.statistics(kind)
            own = st[:, :1]
            over = st[:, 1:] >= own - np.abs(own) * CLOSE
            yield pa.RecordBatch.from_pydict({
                "feature_id": feats, "blk": [block.blk] * len(feats), "statistic": [None if np.isnan(x) else float(x) for x in own[:, 0]],
                "b": over.sum(1).tolist(), "hits": [np.flatnonzero(o).tolist() for o in over]}, schema)

    rows = packed
    if only is not None:
        left = only.groupBy("blk").agg(F.sort_array(F.collect_list("feature_id")).alias("feats"))
        none = F.lit(b"")
        heads = left.select("blk", F.lit(-1).alias("run"), "feats", *[none.alias(c) for c in ("fc", "ic", "gc", "v")])
        rows = packed.join(left.select("blk"), "blk", "left_semi").unionByName(heads)
    ordered = rows.repartition("blk").sortWithinPartitions("blk", "run")
    return ordered.mapInArrow(run, ddl)


def permutation_p(ab: DataFrame, labels: DataFrame, reps: int, kind: str = "ttest", seed: int = 42, value: str = "count", stop: int | None = None,
                  first_pass: int = 100) -> DataFrame:
    """feature_id, statistic, p_perm, n_perm (permutations that were looked at). Without `stop` every feature sees all of them."""
    coded, design = indexed_labels(labels, seed=seed)
    packed = pack(ab, coded, value, _per_block(reps if stop is None else min(reps, first_pass), design.k))
    if stop is None:
        e = exceedances(packed, design, kind, 0, reps)
        return e.select("feature_id", "statistic", ((F.col("b") + 1) / (reps + 1.0)).alias("p_perm"), F.lit(reps).alias("n_perm"))
    done, live, seen = None, None, 0
    while seen < reps:
        # All passes have the length of the first, for which the accumulators are sized.
        size = min(first_pass, reps - seen)
        e = exceedances(packed, design, kind, seen, size, live.select("blk", "feature_id") if live is not None else None)
        if live is not None:
            e = e.join(live.select("feature_id", F.col("b").alias("_before")), "feature_id").withColumn("before", F.col("_before")).drop("_before")
        else:
            e = e.withColumn("before", F.lit(0).cast("long"))
        e = cut_lineage(e.withColumn("b", F.col("b") + F.col("before")))
        at = F.get("hits", (F.lit(stop) - F.col("before") - 1).cast("int")) + 1 + seen
        over = e.filter(F.col("b") >= stop).select("feature_id", "statistic", (F.lit(float(stop)) / at).alias("p_perm"), at.alias("n_perm"))
        done = over if done is None else done.unionByName(over)
        live, seen = e.filter(F.col("b") < stop), seen + size
        if live.isEmpty():
            break
    rest = live.select("feature_id", "statistic", ((F.col("b") + 1) / (reps + 1.0)).alias("p_perm"), F.lit(seen).alias("n_perm"))
    return done.unionByName(rest)


def maxima(ab: DataFrame, labels: DataFrame, reps: int, kind: str = "ftest", seed: int = 42, value: str = "count") -> tuple[DataFrame, DataFrame]:
    """(feature_id, statistic), (perm, top): the largest statistic of each permutation over all features; a block gives one row of tops."""
    coded, design = indexed_labels(labels, seed=seed)
    packed = pack(ab, coded, value, _per_block(reps, design.k))
    ddl = f"feature_id {dict(ab.dtypes)['feature_id']}, statistic double, tops array<double>"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, design, 0, reps):
            feats, st = block.statistics(kind)
            own = st[:, 0]
            tops = np.fmax.reduce(st[:, 1:], axis=0) if len(feats) else np.full(reps, np.nan)
            yield pa.RecordBatch.from_pydict({"feature_id": [*feats, None], "statistic": [*[None if np.isnan(x) else float(x) for x in own], None],
                                              "tops": [*[None] * len(feats), tops.tolist()]}, schema)

    out = cut_lineage(packed.repartition("blk").sortWithinPartitions("blk", "run").mapInArrow(run, ddl))
    tops = out.filter("tops is not null").select(F.posexplode("tops").alias("perm", "top")).filter("not isnan(top)").groupBy("perm").agg(F.max("top").alias("top"))
    return out.filter("tops is null").select("feature_id", "statistic"), tops


# ---------------------------------------------------------------- bootstrap

# Cumulative Poisson(1) probabilities of 0, 1, ...
POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(range(1, k + 1))) for k in range(12)])


def poisson_weights(index: np.ndarray, reps: int, seed: int, first: int = 0) -> np.ndarray:
    """Counts (samples x reps) of how often a replicate draws a sample, from the sample's index and the replicate."""
    with np.errstate(over="ignore"):
        x = index.astype(np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93) + (np.arange(first, first + reps, dtype=np.uint64) + np.uint64(seed) * np.uint64(7919))[None, :] * np.uint64(0x9E3779B97F4A7C15)
        for shift in (31, 29, 32):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(30)
    u = (x >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.searchsorted(POISSON, u, side="right").astype(float)


def cohens_d(n: np.ndarray, s: np.ndarray, ss: np.ndarray) -> np.ndarray:
    """Difference of two means over the pooled deviation, from numbers, sums and sums of squares per group (last axis); nan where undefined."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, dev = s / n, ss - s * s / n
        pooled = np.sqrt(np.maximum(dev.sum(-1), 0.0) / (n.sum(-1) - 2))
        d = (mean[..., 0] - mean[..., 1]) / pooled
    return np.where((pooled > 1e-12) & np.isfinite(d), d, np.nan)


def bootstrap_d(ab: DataFrame, labels: DataFrame, groups: tuple[str, str], reps: int, confidence: float, seed: int) -> DataFrame:
    """feature_id, lower, upper: percentiles of Cohen's d (first less second group) over Poisson replicates.

    Value tiles and their squares times weight tiles of each group, on accumulators of fixed size; weights are computed from the
    samples' indexes, absent samples only count in the totals, which are summed run by run from the labels alone."""
    coded, design = indexed_labels(labels, seed=seed)
    order = [sorted(groups).index(g) for g in groups]
    packed = pack(ab, coded, "count", _per_block(reps, 4))

    def totals(pdf: pd.DataFrame) -> pd.DataFrame:
        w = poisson_weights(pdf["idx"].to_numpy(), reps, seed)
        return pd.DataFrame([(g, w[(pdf["code"] == g).to_numpy()].sum(0).tolist()) for g in range(2)], columns=["code", "n"])

    each = coded.groupBy(F.floor(F.col("idx") / RUN)).applyInPandas(totals, "code int, n array<double>")
    n = np.zeros((reps, 2))  # one number per replicate and group reaches the driver
    for r in each.select("code", F.posexplode("n").alias("rep", "n")).groupBy("rep", "code").agg(F.sum("n").alias("n")).collect():
        n[r["rep"], r["code"]] = r["n"]
    tail = (1 - confidence) / 2
    ddl = f"feature_id {dict(ab.dtypes)['feature_id']}, lower double, upper double"
    schema = arrow_schema(ddl)

    def done(feats: list, sums: np.ndarray) -> pa.RecordBatch:
        d = cohens_d(n[None, :, order], sums[:, :, order, 0], sums[:, :, order, 1])
        known = [x[~np.isnan(x)] for x in d]
        ends = [np.quantile(x, [tail, 1 - tail]).tolist() if len(x) else [None, None] for x in known]
        return pa.RecordBatch.from_pydict({"feature_id": feats, "lower": [e[0] for e in ends], "upper": [e[1] for e in ends]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk, feats, sums = None, {}, np.zeros((0, reps, 2, 2))
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                if blk is not None and r["blk"] != blk:
                    yield done(list(feats), sums)
                    feats, sums = {}, np.zeros((0, reps, 2, 2))
                blk = r["blk"]
                for f in r["feats"]:
                    feats.setdefault(f, len(feats))
                sums = np.concatenate([sums, np.zeros((len(feats) - len(sums), reps, 2, 2))])
                fc, ic, code, v = (np.frombuffer(r[c], np.int32) if c != "v" else np.frombuffer(r[c]) for c in ("fc", "ic", "gc", "v"))
                tile = np.zeros((len(feats), RUN))
                np.add.at(tile, (np.array([feats[f] for f in r["feats"]])[fc], ic), v)
                own = np.full(RUN, -1)
                own[ic] = code
                index = np.arange(RUN, dtype=np.int64) + r["run"] * RUN
                for first in range(0, reps, AT_ONCE):
                    w = poisson_weights(index, min(AT_ONCE, reps - first), seed, first)
                    for g in range(2):
                        on = w * (own == g)[:, None]
                        sums[:, first:first + w.shape[1], g, 0] += tile @ on
                        sums[:, first:first + w.shape[1], g, 1] += (tile * tile) @ on
        if blk is not None:
            yield done(list(feats), sums)

    return packed.repartition("blk").sortWithinPartitions("blk", "run").mapInArrow(run, ddl)
