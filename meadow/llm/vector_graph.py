"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards. Each shard builds a graph by searching it for every new vector and
pruning what it finds, then answers its vectors' range queries: a greedy search from the shard's medoid, then an
expansion over all neighbours in range. Adjacency lists of all shards are united, and links that lead into another shard
are followed there until none is new. A sample of queries is compared with brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from meadow.llm.common import components, let, settle

SHARD = 1000  # vectors a cluster should hold, counted once
PART = 4096  # most vectors of one graph; a larger cluster is split by hash, and every two parts meet
SAMPLE = 20_000  # vectors from which the clusters are fitted
MOST_CLUSTERS = 4096
DEGREE, BEAM, ALPHA = 24, 64, 1.2
TWIN = 0.2  # squared distance up to which a neighbour is a near-copy; those take half of a list at most
AUDIT = 200  # queries of the recall audit


# --- Graph of one shard (unit vectors, NumPy) ---

def prune(point: np.ndarray, cand: np.ndarray, vecs: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Neighbours (rows x degree, -1 beyond) kept of the candidates (rows x any, -1 for none) of each point.

    The nearest candidate is kept, and those that lie ALPHA times closer to it than to the point go; and so on. When half
    of the list is near-copies, the rest is for others, so that a group of near-copies keeps its ways in and out."""
    out = np.full((len(point), degree), -1, np.int32)
    live = (cand >= 0) & (cand != point[:, None])
    c = vecs[np.maximum(cand, 0)]
    to_point = np.where(live, 2 - 2 * np.einsum("mcd,md->mc", c, vecs[point]), np.inf)
    between = 2 - 2 * (c @ c.transpose(0, 2, 1))
    rows = np.arange(len(point))
    for k in range(degree):
        best = np.argmin(np.where(live, to_point, np.inf), 1)
        have = live[rows, best]
        if not have.any():
            break
        out[have, k] = cand[have, best[have]]
        live &= ~(ALPHA ** 2 * between[rows, best] <= to_point) & (cand != cand[rows, best][:, None])
        if k + 1 == degree // 2:
            live &= to_point > TWIN
    return out


def greedy(vecs: np.ndarray, near: np.ndarray, start: int, queries: np.ndarray, radius: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beam search of all queries at once: ids of the beams, which nodes were seen, and which have a cosine >= radius."""
    m, n = len(queries), len(vecs)
    ids, sims = np.full((m, BEAM), -1, np.int32), np.full((m, BEAM), -np.inf)
    open_ = np.zeros((m, BEAM), bool)
    ids[:, 0], sims[:, 0], open_[:, 0] = start, queries @ vecs[start], True
    seen, hit = np.zeros((m, n), bool), np.zeros((m, n), bool)
    seen[:, start], hit[:, start] = True, sims[:, 0] >= radius
    q = np.arange(m)
    while len(q):
        at = np.argmax(np.where(open_[q], sims[q], -np.inf), 1)
        here = ids[q, at]
        open_[q, at] = False
        nb = near[here]
        new = (nb >= 0) & ~seen[q[:, None], nb]
        r, c = np.nonzero(new)
        s = np.full(nb.shape, -np.inf)
        s[r, c] = np.einsum("pd,pd->p", vecs[nb[r, c]], queries[q[r]])
        seen[q[r], nb[r, c]] = True
        hit[q[r], nb[r, c]] = s[r, c] >= radius
        all_s = np.concatenate([sims[q], s], 1)
        top = np.argsort(-all_s, 1, kind="stable")[:, :BEAM]
        sims[q] = np.take_along_axis(all_s, top, 1)
        ids[q] = np.take_along_axis(np.concatenate([ids[q], nb], 1), top, 1)
        open_[q] = np.take_along_axis(np.concatenate([open_[q], new], 1), top, 1) & np.isfinite(sims[q])
        q = q[open_[q].any(1)]
    return ids, seen, hit


def build(vecs: np.ndarray, seed: int = 42) -> tuple[np.ndarray, int]:
    """Adjacency (n x DEGREE, -1 beyond) and medoid. Vectors come in batches that double: each batch searches the graph so
    far, prunes what it finds, and its edges are returned by the other ends, pruned again where too many."""
    n = len(vecs)
    near = np.full((n, DEGREE), -1, np.int32)
    medoid = int(np.argmax(vecs @ vecs.mean(0)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.r_[medoid, order[order != medoid]].astype(np.int32)
    done = 1
    while done < n:
        batch = order[done:done + min(done, 256)]
        found, seen, twin = greedy(vecs, near, medoid, vecs[batch], 1 - TWIN / 2)
        sims = np.where(seen & ~twin, vecs[batch] @ vecs.T, -np.inf)
        far = np.argpartition(-sims, min(BEAM, n - 1), 1)[:, :BEAM].astype(np.int32)
        far[~np.isfinite(np.take_along_axis(sims, far, 1))] = -1
        both = np.concatenate([found, far, np.broadcast_to(batch, (len(batch), len(batch)))[:, :64]], 1)
        near[batch] = prune(batch, both, vecs)
        r, c = np.nonzero(near[batch] >= 0)
        to, back = near[batch[r], c], batch[r]
        near_sim = np.einsum("pd,pd->p", vecs[to], vecs[back])
        sort = np.lexsort((-near_sim, to))
        to, back = to[sort], back[sort]
        first = np.searchsorted(to, to)
        rank = np.arange(len(to)) - first
        ends, width = np.unique(to), min(int(rank.max()) + 1, 2 * DEGREE)
        extra = np.full((len(ends), width), -1, np.int32)
        ok = rank < width
        extra[np.searchsorted(ends, to[ok]), rank[ok]] = back[ok]
        for at in range(0, len(ends), 256):
            e = ends[at:at + 256]
            both = np.concatenate([near[e], extra[at:at + 256]], 1)
            both = np.where((both[:, :, None] == both[:, None, :]).argmax(2) == np.arange(both.shape[1]), both, -1)
            full = (both >= 0).sum(1) > DEGREE
            packed = np.take_along_axis(both, np.argsort(both < 0, 1, kind="stable"), 1)
            near[e[~full]] = packed[~full][:, :DEGREE]
            if full.any():
                near[e[full]] = prune(e[full], both[full], vecs)
        done += len(batch)
    return near, medoid


def in_range(vecs: np.ndarray, near: np.ndarray, medoid: int, queries: np.ndarray, radius: float) -> Iterator[tuple[int, np.ndarray]]:
    """For blocks of queries, the block's start and which nodes (block x nodes) have a cosine of at least `radius`, as far as the
    graph leads: from the greedy search on, all neighbours of nodes in range are looked at."""
    n = len(vecs)
    for at in range(0, len(queries), 256):
        part = queries[at:at + 256]
        _, seen, hit = greedy(vecs, near, medoid, part, radius)
        q, v = np.nonzero(hit)
        while len(q):
            next_ = []
            for k in range(0, len(q), 20000):
                nb = near[v[k:k + 20000]]
                qq = np.repeat(q[k:k + 20000], DEGREE)
                nb = nb.ravel()
                ok = nb >= 0
                qq, nb = qq[ok], nb[ok]
                fresh = ~seen[qq, nb]
                pair = np.unique(qq[fresh].astype(np.int64) * n + nb[fresh])
                qq, nb = np.divmod(pair, n)
                seen[qq, nb] = True
                good = np.einsum("pd,pd->p", vecs[nb], part[qq]) >= radius
                hit[qq[good], nb[good]] = True
                next_.append(pair[good])
            q, v = np.divmod(np.concatenate(next_), n)
        yield at, hit


# --- Tables ---

def units(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit): vectors divided by their length, in double; those that link with nothing are left out. Vectors of
    different lengths compare as if the shorter went on with zeros."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    v = vectors.select("vec_id", F.when(fine, e).alias("e")).filter("e is not null and size(e) > 0")
    # Divided by the largest component first, so that squares neither overflow nor vanish.
    top = lambda a: F.array_max(F.transform(a, lambda x: F.abs(x)))
    norm = lambda a: F.sqrt(F.aggregate(a, F.lit(0.0), lambda t, x: t + x * x))
    over = lambda a, by: let(by(a), lambda n: F.transform(a, lambda x: x / n))
    return v.filter(top(F.col("e")) > 0).select("vec_id", let(over(F.col("e"), top), lambda a: over(a, norm)).alias("unit"))


def _stack(col: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim))
    for k, v in enumerate(col):
        out[k, :len(v)] = v
    return out


def fit_clusters(reps: DataFrame, n: int, dim: int, seed: int = 42) -> np.ndarray:
    """Unit centroids by spherical k-means on at most SAMPLE vectors, one per SHARD vectors of the table."""
    k = int(min(MOST_CLUSTERS, max(1, -(-n // SHARD))))
    rows = reps.orderBy(F.xxhash64("rep", F.lit(seed))).limit(SAMPLE).select("unit").toPandas()
    x = _stack(rows["unit"], dim)
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        own = np.concatenate([np.argmax(x[a:a + 2000] @ c.T, 1) for a in range(0, len(x), 2000)])
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-12), c)
    return c


def deal(reps: DataFrame, centroids: np.ndarray, overlap: int) -> DataFrame:
    """(rep, unit, shards, shard, part, parts): each vector in its `overlap` nearest clusters; clusters above PART are split."""
    dim, take = centroids.shape[1], min(overlap, len(centroids))

    @F.pandas_udf("array<int>")
    def nearest(units_: pd.Series) -> pd.Series:
        sims = _stack(units_, dim) @ centroids.T
        top = np.argsort(-sims, 1, kind="stable")[:, :take]
        return pd.Series(list(top.astype(np.int32)), index=units_.index)

    dealt = settle(reps.select("rep", "unit", nearest("unit").alias("shards")), "dealt")
    one = dealt.select("rep", "unit", "shards", F.explode("shards").alias("shard"))
    sizes = dealt.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    sizes = F.broadcast(sizes)  # at most MOST_CLUSTERS rows
    return one.join(sizes, "shard").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))


_GRAPH = "shard int, part int, rep long, unit array<double>, near array<long>, links array<long>, medoid boolean"


def build_and_search(dealt: DataFrame, dim: int, radius: float) -> DataFrame:
    """One row per vector of each graph: its neighbours, and the vectors of the graph in range of it."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep")
        vecs, rep = _stack(pdf["unit"], dim), pdf["rep"].to_numpy()
        near, medoid = build(vecs)
        links: list[np.ndarray] = [np.empty(0, np.int64)] * len(rep)
        for at, hit in in_range(vecs, near, medoid, vecs, radius):
            for k in range(len(hit)):
                v = np.flatnonzero(hit[k])
                links[at + k] = rep[v[v != at + k]]
        return pd.DataFrame({"shard": pdf["shard"].to_numpy(), "part": pdf["part"].to_numpy(), "rep": rep, "unit": pdf["unit"].to_numpy(),
                             "near": [rep[x[x >= 0]] for x in near], "links": links, "medoid": np.arange(len(rep)) == medoid})

    # As many partitions as the session shuffles into, so that small rows with much work each are not put together.
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "shard", "part").groupBy("shard", "part").applyInPandas(run, _GRAPH)


def cross_parts(graph: DataFrame, dealt: DataFrame, dim: int, radius: float) -> DataFrame:
    """(a, b): links between the parts of split clusters; every part's vectors are queries to each other part's graph."""
    many = dealt.filter("parts > 1").select("shard", "part", "parts", "rep", "unit")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("part")))
    queries = many.select("shard", "part", "rep", "unit", other.alias("other")).select(
        "shard", F.col("other").alias("part"), F.col("part").alias("of"), "rep", "unit")
    parts = many.select("shard", "part", "parts").distinct().select("shard", "part", other.alias("of"))
    index = graph.join(parts, ["shard", "part"]).select("shard", "part", "of", "rep", "unit", "near", "medoid")

    def run(idx: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(idx) and len(qs):
            rep = idx["rep"].to_numpy()
            place = {r: i for i, r in enumerate(rep)}
            near = np.full((len(rep), DEGREE), -1, np.int32)
            for i, x in enumerate(idx["near"]):
                near[i, :len(x)] = [place[r] for r in x]
            for at, hit in in_range(_stack(idx["unit"], dim), near, int(np.argmax(idx["medoid"].to_numpy())), _stack(qs["unit"], dim), radius):
                q, v = np.nonzero(hit)
                out.append(pd.DataFrame({"a": qs["rep"].to_numpy()[at + q], "b": rep[v]}))
        return pd.concat(out) if out else pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})

    key = ["shard", "part", "of"]
    return index.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(run, "a long, b long")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cosine(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0))), F.lit(0.0), lambda t, x: t + x)


def follow(links: DataFrame, graph: DataFrame, dealt: DataFrame, radius: float) -> DataFrame:
    """Range expansion over the united adjacency lists: where a link leads to a vector that is also in another shard, that
    vector's neighbours which share no shard with the query are compared with it, until no link is new."""
    at = settle(dealt.select("rep", "unit", "shards").dropDuplicates(["rep"]), "places")
    united = settle(graph.select(F.col("rep").alias("v"), F.explode("near").alias("w")).distinct(), "adjacency")
    where = at.select("rep", "shards")
    new = links
    while new.limit(1).count():
        both = new.unionByName(new.select(F.col("b").alias("a"), F.col("a").alias("b")))
        out = both.join(where.select(F.col("rep").alias("a"), F.col("shards").alias("sa")), "a").join(
            where.select(F.col("rep").alias("b"), F.col("shards").alias("sb")), "b").filter(F.size(F.array_except("sb", "sa")) > 0)
        cand = out.select("a", "sa", F.col("b").alias("v")).join(united, "v").select("a", "sa", F.col("w").alias("b"))
        cand = cand.join(where.select(F.col("rep").alias("b"), F.col("shards").alias("sb")), "b").filter(~F.arrays_overlap("sa", "sb"))
        cand = _ordered(cand.select("a", "b")).join(links, ["a", "b"], "left_anti")
        u = at.select("rep", "unit")
        near = cand.join(u.select(F.col("rep").alias("a"), F.col("unit").alias("ua")), "a").join(
            u.select(F.col("rep").alias("b"), F.col("unit").alias("ub")), "b").filter(cosine(F.col("ua"), F.col("ub")) >= radius)
        new = settle(near.select("a", "b"), "followed")
        links = settle(links.unionByName(new), "links")
    return links


def audit(reps: DataFrame, links: DataFrame, dim: int, radius: float, seed: int = 7) -> float:
    """Share of the true links of AUDIT sampled vectors that was found; the truth by brute force over all vectors."""
    rows = reps.orderBy(F.xxhash64("rep", F.lit(seed))).limit(AUDIT).select("rep", "unit").toPandas()
    q, ids = _stack(rows["unit"], dim), rows["rep"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            k, j = np.nonzero(_stack(pdf["unit"], dim) @ q.T >= radius)
            a, b = ids[j], pdf["rep"].to_numpy()[k]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b]

    truth = settle(reps.select("rep", "unit").mapInPandas(run, "a long, b long").distinct(), "truth")
    n = truth.count()
    return truth.join(links, ["a", "b"], "left_semi").count() / n if n else 1.0


def near_groups(vectors: DataFrame, radius: float = 0.9, overlap: int = 2, least_recall: float = 0.95) -> DataFrame:
    """One row per vector row: vec_id, n_links, component_id, kept (vec_id = component_id).

    Equal vectors are one node, so copies never meet as pairs; they count as links of each other. Vectors that are null, empty,
    zero, or hold null or non-finite components have no links and are kept as their own component. If the audit finds less than
    `least_recall` of the sampled links, all is done again with one more overlapping cluster per vector. A null vec_id is a vector
    of its own without links. Repeated rows are copies. An empty table gives no rows. Other columns are ignored.
    """
    named = settle(units(vectors).filter("vec_id is not null"), "units")
    copies = settle(named.groupBy("unit").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    n, dim = copies.agg(F.count(F.lit(1)), F.max(F.size("unit"))).first()
    rows = vectors.select("vec_id")
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    centroids = fit_clusters(copies, n, dim)
    while True:
        dealt = deal(copies, centroids, overlap)
        graph = settle(build_and_search(dealt, dim, radius), "graph")
        pairs = graph.select(F.col("rep").alias("a"), F.explode("links").alias("b"))
        if dealt.filter("parts > 1").limit(1).count():
            pairs = pairs.unionByName(cross_parts(graph, dealt, dim, radius))
        links = follow(settle(_ordered(pairs), "links"), graph, dealt, radius)
        if overlap >= len(centroids) or audit(copies, links, dim, radius) >= least_recall:
            break
        overlap += 1
    ends = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    size = copies.select(F.col("rep").alias("other"), "copies")
    more = ends.join(size, "other").groupBy("rep").agg(F.sum("copies").alias("more"))
    roots = components(links).select(F.col("node").alias("rep"), "root")
    node = copies.join(more, "rep", "left").join(roots, "rep", "left").select(
        "unit", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = settle(named.join(node, "unit").select("vec_id", "n_links", "component_id").distinct(), "named")
    out = rows.join(linked, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      (F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id"))).alias("kept"))
