"""Sharding by a hierarchical weighted hash tree; DataFrame functions only.

Shards hang in racks, racks in regions; a node weighs as much as the shards below it. A row goes down from the root: at each
level every child draws -ln(u) / weight, u hashed from the row's key and the child's name, and the smallest draw wins. A
child's draw depends on nothing but its own weight, so when weights change, rows move only into, out of or inside the
subtrees whose weights changed; two subtrees that keep their weights never exchange a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from meadow.llm.common import let, settle
from meadow.sources.tables import work_folder

#: A tree is a list of regions, a region a list of racks, a rack a list of shard weights; shards count from 0 in that order.
Tree = list[list[list[float]]]
#: Two regions of two racks of two shards.
EIGHT: Tree = [[[1.0, 1.0], [1.0, 1.0]], [[1.0, 1.0], [1.0, 1.0]]]
HEX = 13  # digits of a hash that make a draw: 52 bits, exact in a double


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard as a region of its own. The other regions keep their weights, so rows move only into it."""
    return [*tree, [[weight]]]


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, F.lit(name)).cast("binary")), 1, HEX), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(16 ** HEX))) / F.lit(float(weight))


def _descend(key: Column, nodes: list[tuple[str, float, Column]]) -> Column:
    """The value of the node with the smallest draw, the first of equals. Nodes (name, weight, value) of weight 0 draw nothing."""
    live = [n for n in nodes if n[1] > 0]
    if len(live) == 1:
        return live[0][2]
    draws = F.array(*[_draw(key, name, weight) for name, weight, _ in live])
    won = let(draws, lambda d: F.array_position(d, F.array_min(d)))
    # A chain of conditions, so that only the subtree that won is computed.
    return let(won, lambda at: F.coalesce(*[F.when(at == i, value) for i, (_, _, value) in enumerate(live, 1)]))


def shard(key: Column, tree: Tree) -> Column:
    """Shard (int) of a row by its key, a string that is not null. Weights are 0 or more, at least one of them above."""
    if not any(w > 0 for region in tree for rack in region for w in rack) or any(w < 0 for region in tree for rack in region for w in rack):
        raise ValueError("shard weights must be 0 or more, and one of them more")
    number, regions = 0, []
    for r, region in enumerate(tree):
        racks = []
        for k, rack in enumerate(region):
            leaves = [(f"{r}/{k}/{s}", w, F.lit(number + s)) for s, w in enumerate(rack)]
            number += len(rack)
            racks.append((f"{r}/{k}", sum(rack), leaves))
        regions.append((f"{r}", sum(w for _, w, _ in racks), racks))
    down = [(name, weight, _descend(key, [(n, w, _descend(key, leaves)) for n, w, leaves in racks if w > 0]))
            for name, weight, racks in regions if weight > 0]
    return _descend(key, down)


def place(docs: DataFrame, tree: Tree = EIGHT, id_col: str = "doc_id") -> DataFrame:
    """All rows and columns with `shard` (int), which the id and the tree decide. Null ids share one place.

    A column `shard` of the input is replaced. No row moves between tasks."""
    return docs.withColumn("shard", shard(F.coalesce(F.col(id_col).cast("string"), F.lit("")), tree))


def slots(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `slot` (long): positions from 0 without gaps within each shard, in the given order, nulls last.

    Rows are range-partitioned by the order and written; a shard's rows of one part are numbered there and get the count of its
    rows in the parts before. The only windows over a shard have one row per part."""
    keys = [F.col(c).asc_nulls_last() for c in order]
    parts = settle(rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "slots")
    sizes = parts.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("shard", "_part").orderBy(*keys))
    return (parts.withColumn("_own", own).join(starts, ["shard", "_part"])
            .withColumn("slot", (F.col("_start") + F.col("_own") - 1).cast("long")).drop("_part", "_own", "_start"))


def assignment(docs: DataFrame, tree: Tree = EIGHT) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: each document's place, now and with one more shard.

    size is the text's UTF-8 bytes (null: none) plus 1, text_crc32 unsigned; the law is `key`. Texts are read once and not
    moved. Null doc_ids share a shard; rows that repeat a doc_id lie in one shard in the order of size and checksum; a null text
    has the checksum of an empty one; an empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    grown = place(rows, grow(tree)).select("doc_id", "size", "text_crc32", F.col("shard").alias("grown_shard"))
    placed = slots(place(grown, tree), ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, tree: Tree = EIGHT, path: str | None = None, files: int = 8) -> str:
    """Writes whole rows as Parquet, one folder `shard=n` per shard, each in up to `files` files so that a shard of any weight is
    written by several tasks. Returns the folder, a fresh one in the shared folder if none is given."""
    path = path or work_folder(docs.sparkSession, "shards")
    placed = place(docs, tree)
    deal = F.pmod(F.xxhash64(*[F.col(c) for c in docs.columns if c in ("doc_id", "text")]), F.lit(files))
    placed.withColumn("_deal", deal).repartition("shard", "_deal").drop("_deal").write.partitionBy("shard").parquet(path)
    return path
