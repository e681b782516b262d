"""Threshold-scaled document fingerprints; DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size follows the document, sketches
of parts merge by union, and two sketches of very unequal documents still tell how much of one the other contains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meadow.llm.common import WORD, let, settle

WIDTH = 5  # words of a shingle
FRACTION = 1 / 8  # of all hashes that are kept


def sketch(text: Column, width: int = WIDTH, fraction: float = FRACTION) -> Column:
    """Sorted distinct kept hashes (array<bigint>). A text with fewer words is one shingle. Where no hash is below the
    fraction, the smallest one is kept, so only a text without words (or null) has an empty sketch."""
    limit = int(fraction * 2**63)
    cut = lambda h: F.shiftrightunsigned(h, 1) < F.lit(limit)

    def hashes(words: Column) -> Column:
        last = F.greatest(F.size(words) - width, F.lit(0))
        at = lambda i: [F.coalesce(F.get(words, i + k), F.lit(0)) for k in range(width)]
        return F.when(F.size(words) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*at(i)))).otherwise(
            F.array().cast("array<bigint>"))

    def kept(all_hashes: Column) -> Column:
        low = F.sort_array(F.array_distinct(F.filter(all_hashes, cut)))
        least = F.filter(F.array(F.array_min(F.transform(all_hashes, lambda h: F.shiftrightunsigned(h, 1)))), lambda h: h.isNotNull())
        return let(low, lambda k: F.when(F.size(k) > 0, k).otherwise(F.transform(least, lambda h: F.shiftleft(h, 1))))

    words = F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    return let(words, lambda w: let(hashes(w), kept))


def merge(a: Column, b: Column) -> Column:
    """Sketch of the union of two documents' shingles."""
    return F.sort_array(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; two empty sketches: 1, one empty sketch: 0."""
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def likeness(a: Column, b: Column) -> Column:
    """The larger of the two containments: the share of the smaller sketch that the other has."""
    share = F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(share)


def spelled(kept: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, joined by hyphens."""
    return F.array_join(F.transform(kept, lambda h: F.hex(h)), "-")


def _key(doc_id: Column) -> list[Column]:
    return [doc_id.isNull().alias("_no"), F.coalesce(doc_id, F.lit(0)).alias("_id")]


def _chain(ids: DataFrame) -> DataFrame:
    """For each (_no, _id, n): who comes before it in descending order of ids (null last), as before_no, before_id, before_n.

    The order is a circle: before the first comes the last. Parts of a range partitioning are ordered on their own; only
    the table of their ends, one row per part, is ordered in one task."""
    down = [F.col("_no").asc(), F.col("_id").desc()]
    parts = settle(ids.repartitionByRange(*down).withColumn("_part", F.spark_partition_id()), "chain")
    me = F.struct(F.col("_no").alias("before_no"), F.col("_id").alias("before_id"), F.col("n").alias("before_n"))
    own = parts.withColumn("_b", F.lag(me).over(Window.partitionBy("_part").orderBy(*down)))
    order = F.struct(F.col("_no").cast("int"), -F.col("_id").cast("decimal(20,0)"))
    ends = parts.groupBy("_part").agg(F.max_by(me, order).alias("_last"))
    whole = Window.orderBy("_part")
    ends = ends.select("_part", F.coalesce(F.lag("_last").over(whole), F.last("_last").over(
        whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_prior"))
    return own.join(ends, "_part").withColumn("_b", F.coalesce("_b", "_prior")).select("_no", "_id", "_b.*")


def with_edits(docs: DataFrame, width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """doc_id, n_chars, edited, kept, edited_kept, next_kept, next_doc_id per document row (kept: sketches).

    The edited text is the text with its last floor(n/2) characters replaced by the first as many of the next document's
    (all, if it has fewer), the next one being that with the next smaller id; a null id comes last, after the last comes
    the first; a document alone is its own next. Null texts are empty. Rows that repeat an id are edited
    one by one and share a next document, of whose rows the one with the smallest text is taken. Other columns are ignored.
    """
    base = docs.select("doc_id", *_key(F.col("doc_id")), F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("kept", sketch(F.col("text"), width, fraction))
    sizes = docs.select(*_key(F.col("doc_id")), F.coalesce(F.char_length("text"), F.lit(0)).alias("n"))
    ids = settle(sizes.groupBy("_no", "_id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")), "ids")
    chain = settle(_chain(ids.select("_no", "_id", "n")), "before")
    dealt = base.repartition("_no", "_id")  # both uses read the same columns, so the texts are shuffled once
    heads = dealt.join(chain, ["_no", "_id"]).select(
        F.col("before_no").alias("_no"), F.col("before_id").alias("_id"),
        F.substring("text", F.lit(1), F.floor(F.col("before_n") / 2).cast("int")).alias("head"), F.col("kept").alias("next_kept"), F.col("doc_id").alias("next_doc_id"))
    if ids.filter("rows > 1").limit(1).count():
        heads = heads.groupBy("_no", "_id").agg(F.min(F.struct("head", "next_kept", "next_doc_id")).alias("_h")).select("_no", "_id", "_h.*")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")), F.substring(F.col("head"), F.lit(1), half))
    out = dealt.join(heads, ["_no", "_id"]).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "kept", "next_kept", "next_doc_id")
    return out.withColumn("edited_kept", sketch(F.col("edited"), width, fraction))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_doc_id; see with_edits."""
    return with_edits(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spelled(F.col("kept")).alias("fingerprint"),
        spelled(F.col("edited_kept")).alias("edited_fingerprint"), likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept")).alias("near_next"), "next_doc_id")
