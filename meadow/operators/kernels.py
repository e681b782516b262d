"""Shared kernels: distributed running totals, zero-aware ranks, exact quantiles, blocked pair sums, permutations.

All of them keep a hot key (one feature or group holding a large share of the rows) spread over many tasks: values are
aggregated to a histogram first (partial aggregation before the shuffle), and running totals are cut into
order-preserving value buckets, so no window ever holds a whole hot key.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from meadow.sources.tables import cut_lineage

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after checking that df has at most `limit` rows and `most_bytes` bytes; beyond either the plan
    shuffles. df is written first, so that what made it is not run once for the check and once for the join."""
    df = cut_lineage(df)

    def width(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.octet_length(F.to_json(F.struct(c)))
        return F.lit(8)

    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum((width(f) for f in df.schema.fields), F.lit(0)).cast("long")), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and size <= most_bytes else df


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input that has fewer partitions than the cluster has cores (one big row group) before work that is
    heavy per row; larger inputs are left as they are."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def value_bucket(value: Column, per_octave: int = 1024) -> Column:
    """A whole number that never falls when value grows: signed, `per_octave` steps in each power of two. Values that lie close
    together beside their size (dates in seconds) share few buckets; bucketed() splits those further."""
    v = value.cast("double")
    step = lambda x: F.floor(F.log2(x) * per_octave) + 10_000_000
    return F.when(v > 0, step(v)).when(v < 0, -step(-v)).otherwise(F.lit(0)).cast("long")


SPLIT_ROWS = 20_000  # rows of a bucket up to which it is one; beyond a thousandth of all rows, too
SPLITTERS = 255


def bucketed(hist: DataFrame, keys: list[str], value: str, weight: str, bucket: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """hist with (_b, _s), which never fall when value grows inside a key, and the weight of each (keys, _b, _s) as _t.

    A bucket with more than SPLIT_ROWS rows and a thousandth of all is split at quantiles of its own values, from a mergeable
    sketch; there are at most a thousand such buckets, so that their splitters are broadcast. All other rows have _s = 0."""
    b = hist.withColumn("_b", bucket if bucket is not None else value_bucket(F.col(value)))
    sums = cut_lineage(b.groupBy(*keys, "_b").agg(F.sum(weight).alias("_t"), F.count(F.lit(1)).alias("_k")))
    rows, most = sums.agg(F.coalesce(F.sum("_k"), F.lit(0)), F.coalesce(F.max("_k"), F.lit(0))).first()
    limit = max(SPLIT_ROWS, rows // 1000)
    if most <= limit:
        return b.withColumn("_s", F.lit(0)), sums.select(*keys, "_b", F.lit(0).alias("_s"), "_t")
    crowded = F.broadcast(sums.filter(F.col("_k") > limit).select(*keys, "_b"))
    at = [(i + 1) / (SPLITTERS + 1) for i in range(SPLITTERS)]
    cuts = b.join(crowded, [*keys, "_b"], "left_semi").groupBy(*keys, "_b").agg(F.percentile_approx(F.col(value).cast("double"), at, 10_000).alias("_cuts"))
    b = b.join(F.broadcast(cut_lineage(cuts)), [*keys, "_b"], "left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    b = b.withColumn("_s", F.when(F.col("_cuts").isNull(), 0).otherwise(below)).drop("_cuts")
    return b, b.groupBy(*keys, "_b", "_s").agg(F.sum(weight).alias("_t"))


def running_total(hist: DataFrame, keys: list[str], value: str, weight: str, out: str = "cum",
                  bucket: Column | None = None) -> DataFrame:
    """Inclusive running total of weight in rising value order within keys.

    Rows must be unique in (keys, value). The bucket totals give each bucket its offset; only one bucket of one key
    is ever sorted in one task, and crowded buckets are split (see bucketed).
    """
    b, sums = bucketed(hist, keys, value, weight, bucket)
    before = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_b", "_s").rowsBetween(W.unboundedPreceding, -1)
    offs = sums.select(*keys, "_b", "_s", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    inside = W.partitionBy(*keys, "_b", "_s").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    return (b.join(offs, [*keys, "_b", "_s"])
            .withColumn(out, F.sum(weight).over(inside) + F.col("_off"))
            .drop("_b", "_s", "_off"))


def value_ranks(df: DataFrame, keys: list[str], value: str, totals: DataFrame | None = None,
                n: int | None = None) -> DataFrame:
    """Average ranks of the distinct values: keys, value, cnt, rank.

    Absent rows are zeros: with `n` (rows per key) or `totals` (keys, n) the zero block of n - present rows sits
    below the positives and gets its own row with value 0. Without either, only the given rows are ranked.

    The histogram is used several times below, so it is written once (checkpoint) instead of being planned again.
    """
    hist = cut_lineage(df.groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("cnt")))
    if n is not None or totals is not None:
        present = hist.groupBy(*keys).agg(F.sum("cnt").alias("_p"))
        if totals is not None:
            present = totals.join(present, keys, "left").fillna(0, ["_p"])
        else:
            present = present.withColumn("n", F.lit(n))
        zeros = (present.filter(F.col("n") > F.col("_p"))
                 .select(*keys, F.lit(0.0).alias("value"), (F.col("n") - F.col("_p")).cast("long").alias("cnt")))
        hist = (hist.unionByName(zeros).groupBy(*keys, "value").agg(F.sum("cnt").alias("cnt")))
    run = running_total(hist, keys, "value", "cnt")
    return run.withColumn("rank", F.col("cum") - (F.col("cnt") - 1) / 2.0).drop("cum")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, qs: dict[str, float],
                    n: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles per key from the value histogram; `n` adds absent zeros as in value_ranks."""
    ranked = value_ranks(df.filter(F.col(value).isNotNull()), keys, value, n=n)
    size = ranked.groupBy(*keys).agg(F.sum("cnt").alias("_n"))
    run = ranked.withColumn("_hi", F.col("rank") + (F.col("cnt") - 1) / 2.0 - 1).withColumn(
        "_lo", F.col("_hi") - F.col("cnt") + 1)
    run = run.join(size, keys) if keys else run.crossJoin(F.broadcast(size))
    aggs = []
    for name, q in qs.items():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        at = lambda p: F.max(F.when((F.col("_lo") <= p) & (F.col("_hi") >= p), F.col("value")))
        frac = F.max(pos - F.floor(pos))
        low, high = at(F.floor(pos)), at(F.ceil(pos))
        aggs.append((low + (high - low) * frac).alias(name))
    return run.groupBy(*keys).agg(*aggs)


SORTED_HERE = 10_000  # rows of one value range up to which the driver sorts them


def quantile(df: DataFrame, value: Column, q: float) -> float | None:
    """Linear-interpolated quantile of one column: counts per value range say where its rows lie, and that range is counted again
    in finer parts until it is small or has one value. Nothing is written or shuffled but the counts."""
    x = df.select(value.cast("double").alias("v")).filter("v is not null")

    def ranges(rows: DataFrame, part: Column) -> list[tuple[float, float, int]]:
        found = rows.groupBy(part.alias("b")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("c")).collect()
        return sorted((r["lo"], r["hi"], r["c"]) for r in found)

    parts = ranges(x, value_bucket(F.col("v"), 64))
    pos = (sum(c for *_, c in parts) - 1) * q
    if not parts:
        return None

    def at(k: int, parts: list) -> float:
        while True:
            for lo, hi, c in parts:
                if k < c:
                    break
                k -= c
            if lo == hi:
                return lo
            rows = x.filter(F.col("v").between(lo, hi))
            if c <= SORTED_HERE:
                return sorted(r["v"] for r in rows.collect())[k]
            middle, width = lo / 2 + hi / 2, hi / 4096 - lo / 4096
            step = F.floor((F.col("v") - middle) / width) if width > 0 else F.lit(0)
            parts = ranges(rows, F.when(F.col("v") == lo, -1_000_000).when(F.col("v") == hi, 1_000_000).otherwise(step))

    low = at(math.floor(pos), parts)
    high = low if pos == math.floor(pos) else at(math.ceil(pos), parts)
    return low + (high - low) * (pos - math.floor(pos))


def dense_index(df: DataFrame, key: str, out: str = "idx", buckets: int = 1024) -> DataFrame:
    """0-based index in (hash, key) order, the same for any partitioning; key must be unique in df."""
    h = F.xxhash64(F.col(key))
    d = df.withColumn("_h", h).withColumn("_w", F.lit(1))
    b = F.shiftright(F.col("_h"), 64 - 10) if buckets == 1024 else F.pmod(F.col("_h"), F.lit(buckets))
    d = d.withColumn("_b", b)
    sums = d.groupBy("_b").agg(F.sum("_w").alias("_t"))
    offs = sums.select("_b", F.coalesce(
        F.sum("_t").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    w = W.partitionBy("_b").orderBy("_h", key)
    return (d.join(F.broadcast(offs), "_b")
            .withColumn(out, (F.row_number().over(w) - 1 + F.col("_off")).cast("long"))
            .drop("_b", "_off", "_h", "_w"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of rows that an Arrow function returns under this DDL."""
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def summed_pieces(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sums of the rows (at, x: doubles as binary) with equal `at`: one row per piece of a result reaches the driver."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": [pdf["at"].iloc[0]], "x": [np.sum([np.frombuffer(x) for x in pdf["x"]], axis=0).tobytes()]})

    return {r["at"]: np.frombuffer(r["x"]) for r in parts.groupBy("at").applyInPandas(add, "at int, x binary").collect()}


# ---------------------------------------------------------------- pairs


def _tile(part: pd.DataFrame, cols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row ids, dense tile) of the rows of one block."""
    code, ids = pd.factorize(part["r"])
    m = np.zeros((len(ids), width))
    m[code, cols] = part["v"].to_numpy()
    return np.asarray(ids), m


def _block_pairs(pdf: pd.DataFrame, want: tuple) -> pd.DataFrame:
    """Sums over one column chunk for every row pair of two blocks; dense work on a bounded tile."""
    i, j = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
    col, names = pd.factorize(pdf["c"])
    blk = pdf["blk"].to_numpy()
    la, ma = _tile(pdf[blk == i], col[blk == i], len(names))
    lb, mb = (la, ma) if i == j else _tile(pdf[blk == j], col[blk == j], len(names))
    if not len(la) or not len(lb):
        return pd.DataFrame({"a": [], "b": [], "shared": [], "dot": [], "mins": []})
    shared = (ma != 0).astype(np.float32) @ (mb != 0).astype(np.float32).T
    none = np.zeros(shared.shape)
    dot = ma @ mb.T if "dot" in want else none
    mins = np.stack([np.minimum(row, mb).sum(axis=1) for row in ma]) if "mins" in want else none
    ai, bi = np.nonzero(shared)
    if i == j:
        keep = ai < bi
        ai, bi = ai[keep], bi[keep]
    a, b = la[ai], lb[bi]
    flip = a > b
    return pd.DataFrame({"a": np.where(flip, b, a), "b": np.where(flip, a, b), "shared": shared[ai, bi].astype(float),
                         "dot": dot[ai, bi], "mins": mins[ai, bi]})


def pair_sums(df: DataFrame, row: str, col: str, value: str, rows_per_block: int = 256,
              cols_per_chunk: int = 2048, want: tuple = ("shared", "dot", "mins")) -> DataFrame:
    """For each row pair that shares a column: a, b (a < b), shared, dot, mins (sum of the smaller values).

    The matrix is cut into hashed row blocks and column chunks; one task gets one tile of at most about
    2 x rows_per_block x cols_per_chunk cells, however common a column is. Each cell is shipped once per row block
    instead of once per partner, so a column present in every row costs no N^2 shuffle. Tile sums are added per pair.
    `want` names the sums that are needed; the others stay 0.
    """
    n_rows, n_cols = df.agg(F.approx_count_distinct(row), F.approx_count_distinct(col)).first()
    nb = max(1, -(-int(n_rows) // rows_per_block))
    nc = max(1, -(-int(n_cols) // cols_per_chunk))
    kind = dict(df.dtypes)[row]
    cells = df.select(
        F.col(row).alias("r"), F.col(col).alias("c"), F.col(value).cast("double").alias("v"),
        F.pmod(F.xxhash64(row), F.lit(nb)).cast("int").alias("blk"),
        F.pmod(F.xxhash64(col), F.lit(nc)).cast("int").alias("ch"))
    tiles = (cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
             .withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other")).drop("other"))
    part = tiles.groupBy("bi", "bj", "ch").applyInPandas(
        lambda pdf: _block_pairs(pdf, want), f"a {kind}, b {kind}, shared double, dot double, mins double")
    if nc == 1:
        return part
    return part.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("shared", "dot", "mins")])


def all_pairs(ids: DataFrame, key: str, per_block: int = 512) -> DataFrame:
    """a, b (a < b) for every unordered pair of ids: the result of a full distance table, built as an equi join of id
    blocks so that its size is spread evenly over tasks."""
    u = cut_lineage(ids.select(key).distinct())
    nb = max(1, -(-u.count() // per_block))
    blk = F.pmod(F.xxhash64(key), F.lit(nb)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))
    a = u.select(F.col(key).alias("a"), blk.alias("bi"), every.alias("bj"))
    b = u.select(F.col(key).alias("b"), blk.alias("bj"), every.alias("bi"))
    return a.join(b, ["bi", "bj"]).filter("a < b").select("a", "b")


# ---------------------------------------------------------------- permutations


def _mix(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute_index(idx: np.ndarray, n: int, reps: int, seed: int, first: int = 0) -> np.ndarray:
    """reps pseudo-random permutations of 0..n-1 applied to idx: a Feistel network walked until inside the range.

    Each row computes its own images, so no permutation table is stored, broadcast or shuffled.
    """
    half = max(1, (max(2, int(n)) - 1).bit_length() + 1 >> 1)
    mask = np.uint64((1 << half) - 1)
    with np.errstate(over="ignore"):
        reps_key = (np.arange(first, first + reps, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        keys = _mix(reps_key, np.uint64(seed & 0xFFFFFFFF))[None, :]
        x = np.repeat(idx.astype(np.uint64)[:, None], reps, axis=1)
        keys = np.broadcast_to(keys, x.shape)
        todo = np.ones(x.shape, dtype=bool)
        while todo.any():
            v, k = x[todo], keys[todo]
            left, right = v >> np.uint64(half), v & mask
            for r in range(6):
                f = _mix(right + np.uint64(r * 7919), k) & mask
                left, right = right, left ^ f
            v = (left << np.uint64(half)) | right
            x[todo] = v
            todo[todo] = v >= np.uint64(n)
    return x.astype(np.int64)


def permuted_codes(labels: DataFrame, key: str, group: str, reps: int, seed: int = 42) -> tuple[DataFrame, list]:
    """(key, code, perms) where perms[r] is the group code of the key in permutation r, and the list of groups.

    Group sizes are kept exactly: groups own consecutive index ranges, and a permuted index falls in one of them.
    Only the group sizes (one row per group) reach the driver.
    """
    clean = labels.select(key, F.col(group).cast("string").alias("_g")).filter(F.col("_g").isNotNull())
    sizes = sorted((r["_g"], r["c"]) for r in clean.groupBy("_g").agg(F.count(F.lit(1)).alias("c")).collect())
    names = [g for g, _ in sizes]
    ends = np.cumsum([c for _, c in sizes])
    n = int(ends[-1]) if len(ends) else 0
    code = F.coalesce(*[F.when(F.col("_g") == g, F.lit(i)) for i, g in enumerate(names)]) if names else F.lit(0)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def images(idx: pd.Series) -> pd.Series:
        p = permute_index(idx.to_numpy(), n, reps, seed)
        return pd.Series(list(np.searchsorted(ends, p, side="right").astype(np.int32)))

    out = dense_index(clean, key).select(key, code.alias("code"), images("idx").alias("perms"))
    return out, sizes
