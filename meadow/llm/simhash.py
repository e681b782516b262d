"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints that differ in at most `radius` bits agree on at least one of radius + 1 blocks of bits. Each fingerprint is
rotated once per block so that the block leads; in Gray order all codes that share the leading block are neighbours.
A task sorts such a run by Gray rank and builds a tree over it: an upper node holds the bits that all codes below share
(mask and value). A query walks down, adds up the differences with each node's own bits, and leaves a whole
group as soon as the sum is above the radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from meadow.llm.common import components, settle

#: Most codes of one run; longer runs are split into parts and every two parts meet in a task of their own.
RUN = 4096
FANOUT = 16
SMALL = 24


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the ASCII-lower-cased words' shingles, repeats included; no words: 0."""
    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    s = b" ".join(w)
    ends = list(accumulate(len(x) + 1 for x in w))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    if len(w) < width:
        return digest(s, 42)
    ones, n = np.zeros(64, np.int64), len(w) - width + 1
    for at in range(0, n, 65536):
        h = np.array([digest(s[a:b - 1], 42) for a, b in zip(starts[at:min(n, at + 65536)], ends[at + width - 1:], strict=False)], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _coded(width: int) -> Callable[[str], Column]:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return of


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): fp the fingerprint as a signed long. Null and empty texts have 0."""
    return docs.select("doc_id", _coded(width)("text").alias("fp"))


def hex16(fp: str | Column = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayTree:
    """Tree of shared bit patterns over codes in Gray order; `levels` runs from the leaves' parents up to the roots."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes))]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        lows = highs = self.codes
        while True:
            cut = np.arange(0, len(lows), FANOUT)
            lows, highs = np.bitwise_and.reduceat(lows, cut), np.bitwise_or.reduceat(highs, cut)
            mask = ~(lows ^ highs)
            self.levels.append((mask, lows & mask))
            if len(lows) <= FANOUT:
                break

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, code index) that differ in at most `radius` bits."""
        mask, value = self.levels[-1]
        q, node = np.divmod(np.arange(len(queries) * len(mask)), len(mask))
        total = np.bitwise_count((queries[q] ^ value[node]) & mask[node]).astype(np.int16)
        for mask_below, value_below in [*self.levels[-2::-1], (None, self.codes)]:
            keep = total <= radius
            q, node, total, above = q[keep], node[keep], total[keep], mask[node[keep]]
            child = node[:, None] * FANOUT + np.arange(FANOUT)
            real = (child < len(value_below)).ravel()
            child, q = child.ravel()[real], np.repeat(q, FANOUT)[real]
            own = ~np.repeat(above, FANOUT)[real]  # bits that the node above has not counted
            if mask_below is not None:
                own &= mask_below[child]
            total = np.repeat(total, FANOUT)[real] + np.bitwise_count((queries[q] ^ value_below[child]) & own)
            node, mask = child, mask_below
        keep = total <= radius
        return q[keep], node[keep]


def _forest(codes: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of one run: each code and the smallest index of its component."""
    tree, n = GrayTree(codes), len(codes)
    label = np.arange(n)
    for at in range(0, n, 256):
        i, j = tree.within(tree.codes[at:at + 256], radius)
        i += at
        while True:
            i, j = i[(d := label[i] != label[j])], j[d]
            if not len(i):
                break
            low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
            np.minimum.at(label, high, low)
            while not np.array_equal(up := label[label], label):
                label = up
    k = np.flatnonzero(label != np.arange(n))
    return [(tree.codes[k], tree.codes[label[k]])] if len(k) else []


def _links(keys: np.ndarray, codes: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning links of all runs of equal keys."""
    out = []
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    for a, s in zip(first[size > SMALL], size[size > SMALL], strict=True):
        out += _forest(codes[a:a + s], radius)
    left = np.repeat(size <= SMALL, size)
    k, c = keys[left], codes[left]
    for step in range(1, SMALL):
        same = np.flatnonzero(k[step:] == k[:-step]) if len(k) > step else []
        if not len(same):
            break
        near = same[np.bitwise_count(c[same] ^ c[same + step]) <= radius]
        out.append((c[near], c[near + step]))
    return out


def near_links(fps: DataFrame, radius: int = 2, bits: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that span all components at `radius` differing bits.

    A block value that more than RUN codes share is split: a code gets one of p parts by hash and meets every part
    once, so no pair is lost and no task sees more than two parts.
    """
    codes = fps.select("fp").distinct()
    cuts = [round(i * bits / (radius + 1)) for i in range(radius + 2)]
    block = [F.shiftrightunsigned(F.shiftleft("fp", 64 - hi), 64 - hi + lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    runs = codes.select("fp", F.posexplode(F.array(*block)).alias("rot", "block"))
    runs = settle(runs.select("fp", F.xxhash64("rot", "block").alias("run")), "runs")
    long = (runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > RUN)
            .select("run", F.ceil(F.col("n") / RUN).cast("int").alias("parts")))
    runs = runs.join(settle(long, "long"), "run", "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    meets = F.when(F.col("parts").isNull(), F.array(F.col("run"))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.xxhash64("run", F.least(q, part), F.greatest(q, part))))
    rows = runs.select(F.explode(meets).alias("run"), "fp").repartition("run").sortWithinPartitions("run")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, codes = np.empty(0, np.int64), np.empty(0, np.uint64)
        for pdf in batches:
            keys = np.r_[keys, pdf["run"].to_numpy()]
            codes = np.r_[codes, pdf["fp"].to_numpy().view(np.uint64)]
            if len(keys) < 8 * RUN:
                continue
            done = int(np.searchsorted(keys, keys[-1]))
            yield from _frames(_links(keys[:done], codes[:done], radius))
            keys, codes = keys[done:], codes[done:]
        yield from _frames(_links(keys, codes, radius))

    return rows.mapInPandas(search, "a long, b long")


def _frames(links: list) -> Iterator[pd.DataFrame]:
    for a, b in links:
        yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def near_groups(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """One row per document row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Equal fingerprints are one code in the index, so copies never meet as pairs. Null and empty texts share the
    fingerprint zero and link like others. A null doc_id is no name for a component but links; where a component has
    no other id, component_id is null. Repeated rows give repeated rows; an empty table gives an empty result.
    """
    fps = settle(fingerprints(docs, width), "fingerprints")
    codes = settle(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "codes")
    roots = components(near_links(codes, radius))
    rooted = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lows, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", hex16().alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """Documents without near-copies: of each component the row with the smallest doc_id stays; columns as given.

    Of repeated rows with that doc_id the smallest text stays. Rows whose component has no id (null doc_id only) stay;
    a row without id in a component with one goes.
    """
    groups = near_groups(docs, width, radius)
    drop = groups.filter("doc_id is not null and doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(drop, "doc_id", "left_anti")
    gone = groups.filter("doc_id is null and component_id is not null").select("fingerprint").distinct()
    if gone.limit(1).count():
        own = docs.filter("doc_id is null").select(F.struct("*").alias("_row"), hex16(_coded(width)("text")).alias("fingerprint"))
        left = left.filter("doc_id is not null").unionByName(own.join(gone, "fingerprint", "left_anti").select("_row.*"))
    repeats = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null")
    if not repeats.limit(1).count():
        return left
    once = left.join(repeats.select("doc_id"), "doc_id", "left_anti")
    many = left.join(repeats.select("doc_id"), "doc_id", "left_semi")
    first = many.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("_r"))
    return once.select(*docs.columns).unionByName(first.select("doc_id", "_r.*").select(*docs.columns))
