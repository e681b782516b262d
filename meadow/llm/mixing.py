"""Mixing of sources to target weights by capped water-filling, and seeded whole and fractional repetitions.

Only DataFrame functions. A source's target is its weighted share of a budget of words. A source cannot give more than
`epochs` times its own size; what is above is dealt again over the others by weight until none is above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meadow.llm.common import WORD, numbered, settle

#: Hash buckets by which the documents of one source are ordered; a bucket is the unit that one window sorts.
BUCKETS = 65536
SALTS = 64


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Weights dealt in turn to the sources in code point order, null last. Input (source, source_size)."""
    ranked = numbered(sizes, [F.col("source").isNull(), F.col("source")], "pos")
    deal = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("pos") % len(weights) + 1).cast("int"))
    return ranked.select("source", "source_size", deal.alias("weight"))


def water_fill(sources: DataFrame, epochs: float = 3.0, share: float = 1.0) -> DataFrame:
    """Targets of (source, source_size, weight), adding `target` (double).

    Each round is one aggregate: what the clamped sources leave is divided by the weights of the free ones; sources
    that this puts above epochs * size are clamped for good. Rounds end when none is new, so at most one per source.
    The budget is `share` of all sizes; when every source is clamped, targets are the caps. Sources of size 0 get 0.
    Null or negative weights count as 0.
    """
    cap = F.col("source_size") * F.lit(float(epochs))
    w = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        clamped = w * F.lit(level) > cap
        kept, free, n_free = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)), F.sum(F.when(clamped, 0.0).otherwise(w)),
            F.count(F.when(~clamped & (w > 0), 1))).first()
        if not n_free:
            break
        higher = (budget - kept) / free
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(w * F.lit(level), cap))


def sample_mix(docs: DataFrame, sources: DataFrame, epochs: float = 3.0, seed: int = 42) -> DataFrame:
    """Words taken of every document. docs (doc_id, source, size, pick); sources (source, source_size, target).

    With r = target / source_size every document is taken floor(r) whole times. For the rest, documents of the source
    are put in the order of a seeded hash; they are taken once more until the source's words reach its target, and
    the document on the border gives only its first words. The order's running sum is made over hash buckets first
    (pre-aggregated), and only the bucket on the border is sorted row by row, so that a source with any share of the
    rows is summed in parallel.
    Adds source_size, target, whole (copies), part (words of the border or one more copy), taken (words).
    """
    same = lambda a, b: a["_src"].eqNullSafe(b["_src"])
    plan = sources.select(F.col("source").alias("_src"), "source_size", "target")
    plan = plan.withColumn("_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                           .otherwise(0).cast("long"))
    plan = plan.withColumn("_more", F.round(F.col("target")).cast("long") - F.col("_whole") * F.col("source_size"))
    d = docs.withColumnRenamed("source", "_src").withColumn("_hash", F.xxhash64("pick", F.lit(seed)))
    d = d.withColumn("_bucket", F.pmod("_hash", F.lit(BUCKETS)))
    sums = d.groupBy("_src", "_bucket").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("_src").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    cut = sums.join(plan, same(sums, plan)).drop(plan["_src"]).filter(
        (F.col("_from") < F.col("_more")) & (F.col("_from") + F.col("_n") > F.col("_more")))
    cut = cut.groupBy("_src").agg(F.min("_bucket").alias("_cut"), F.min("_from").alias("_cut_from"))
    # Buckets wholly below the target end before this one; without a border bucket all or none are taken.
    plan = plan.join(cut, same(plan, cut), "left").drop(cut["_src"])
    # Each source's line of the plan is there once per salt, so that a source with any share of the rows joins in many tasks.
    plan = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    d = d.withColumn("_salt", F.pmod("_bucket", F.lit(SALTS)).cast("long"))
    d = d.join(plan, same(d, plan) & (d["_salt"] == plan["_salt"])).drop(plan["_src"]).drop("_salt")
    border = F.col("_bucket").eqNullSafe(F.col("_cut"))
    inside = Window.partitionBy("_src", "_bucket").orderBy("_hash", "pick", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = d.filter(border).withColumn("_room", F.col("_more") - F.col("_cut_from")
                                       - F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("part", F.greatest(F.lit(0), F.least("size", "_room"))).drop("_room")
    rest = d.filter(~F.coalesce(border, F.lit(False))).withColumn(
        "part", F.when(F.col("_cut").isNull(), F.when(F.col("_more") > 0, F.col("size")).otherwise(0))
        .when(F.col("_bucket") < F.col("_cut"), F.col("size")).otherwise(0))
    out = rest.unionByName(edge).withColumnRenamed("_src", "source").withColumnRenamed("_whole", "whole")
    out = out.withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
    return out.drop("_hash", "_bucket", "_more", "_cut", "_cut_from")


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: float = 3.0, share: float = 1.0,
             seed: int = 42) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, whole, part, taken.

    Null texts have size 0, a null source is a source of its own, repeated rows count as often as they occur (the k-th
    of equal rows has its own place in the order only by chance of its equal hash, so totals do not depend on it), an
    empty table gives an empty plan. Other columns are ignored. Reruns agree: the order depends on doc_id and seed only.
    """
    narrow = settle(docs.select("doc_id", "source", words(F.col("text")).alias("size"),
                                F.col("doc_id").alias("pick")), "sizes")
    sizes = settle(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    sources = settle(water_fill(settle(cycled_weights(sizes, weights), "weights"), epochs, share), "targets")
    return sample_mix(narrow, sources, epochs, seed).drop("pick")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: float = 3.0, share: float = 1.0,
        seed: int = 42) -> DataFrame:
    """The mixed corpus with the columns of `docs`: every copy is a row; the border document is cut after `part` words.

    The cut text keeps its words, separated by single spaces; n_chars, if there, follows. Documents of which nothing
    is taken have no row; texts without words are kept once, as they weigh nothing.
    """
    key = F.xxhash64("doc_id", F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull(), words(F.col("text")))
    plan = mix_plan(docs, weights, epochs, share, seed)
    same = F.xxhash64("doc_id", F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull(), F.col("size"))
    plan = (plan.select(same.alias("_key"), F.col("size").alias("_size"), F.col("whole").alias("_whole"),
                        F.col("part").alias("_part"))
            .groupBy("_key").agg(F.max("_size").alias("_size"), F.max("_whole").alias("_whole"), F.max("_part").alias("_part")))
    d = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"), key.alias("_key")).join(plan, "_key")
    whole = F.when(F.col("_size") == 0, 1).otherwise(F.col("_whole") + (F.col("_part") == F.col("_size")).cast("long"))
    cut = (F.col("_part") > 0) & (F.col("_part") < F.col("_size"))
    copies = F.concat(F.array_repeat(F.lit(False), whole.cast("int")), F.array_repeat(F.lit(True), cut.cast("int")))
    d = d.select("_row", "_text", "_part", F.explode(copies).alias("_cut"))
    short = F.array_join(F.slice(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_part").cast("int")), " ")
    text = F.when(F.col("_cut"), short).otherwise(F.col("_text"))
    own = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        own["n_chars"] = F.when(F.col("_cut"), F.char_length(text).cast(kind)).otherwise(F.col("_row.n_chars"))
    return d.select(*[own.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
