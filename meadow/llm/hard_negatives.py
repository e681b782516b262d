"""Hard-negative mining over Hilbert-ordered blocks of candidates with zone maps.

Candidates are written as Parquet in the order of a Hilbert curve, one row per block of about a thousand vectors, with the least and
greatest value of each dimension and label: the block's zone map. For an anchor, interval arithmetic on a zone map bounds the scores
a block can hold. Each search reads the anchor's own block first; the scores found there, and the window of scores that is
wanted, say which other blocks the anchor must read. What is not read cannot hold a result, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from meadow.llm import exact
from meadow.llm.common import settle

BLOCK = 1024  # vectors of a block
TILE = 256  # anchors that are carried together
PAGE = 256  # zone maps that are looked at together
AXES, DEPTH = 8, 6  # dimensions of the curve, those of the widest spread, and bits of each
LIMIT, WIDEST = 1 << 20, 4096  # of integer components and their number: scores, times the rows of a block, fit a long
LOW, HIGH = -(1 << 62), 1 << 62


def hilbert(cells: np.ndarray, depth: int) -> np.ndarray:
    """Position (int64) on the Hilbert curve of integer cells (rows x axes, each below 2 ** depth), after Skilling (2004)."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for bit in range(depth - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(axes):
            flip = (x[:, i] & q) != 0
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(flip, low, swap)
            x[:, i] ^= swap
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    for bit in range(depth - 1, 0, -1):
        turn ^= np.where(x[:, -1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn[:, None]
    out = np.zeros(len(x), np.int64)
    for bit in range(depth - 1, -1, -1):
        for i in range(axes):
            out = out << 1 | (x[:, i] >> bit & 1)
    return out


# --- Packed rows ---

_ROWS = "block long, n int, ids binary, labels binary, vecs binary, lo binary, hi binary, label_lo long, label_hi long"
_TILES = "tile long, n int, ids binary, labels binary, vecs binary, home binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _ints(raw: bytes, kind: str = "<i8", width: int | None = None) -> np.ndarray:
    x = np.frombuffer(raw, kind).astype(np.int64)
    return x if width is None else x.reshape(-1, width)


def spread_axes(rows: DataFrame, width: int) -> list[tuple[int, float, float]]:
    """(dimension, mean, deviation) of the AXES dimensions of the widest spread; tasks return one row of sums each."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(width), np.zeros(width)
        for b in batches:
            x = exact.matrix(b.column("q"), width).astype(float)
            n, s, ss = n + len(x), s + x.sum(0), ss + (x * x).sum(0)
        yield pa.RecordBatch.from_pydict({"n": [n], "s": [s.tolist()], "ss": [ss.tolist()]})

    found = rows.select("q").mapInArrow(sums, "n long, s array<double>, ss array<double>").filter("n > 0")
    each = found.select("n", F.posexplode(F.arrays_zip("s", "ss")).alias("at", "v"))
    stats = each.groupBy("at").agg(F.sum("n").alias("n"), F.sum("v.s").alias("s"), F.sum("v.ss").alias("ss")).collect()
    wide = sorted((-(r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2), r["at"], r["s"] / r["n"]) for r in stats)
    return [(at, mean, max(-var, 1e-9) ** 0.5) for var, at, mean in wide[:AXES]]


def write_blocks(rows: DataFrame, width: int) -> DataFrame:
    """The table of blocks of rows (vec_id, label, q, anchor), in Hilbert order. A range of the curve is cut into blocks by one
    task; rows of one place on the curve are ordered by vec_id and split like others."""
    axes = spread_axes(rows, width)
    dims, mean, dev = (np.array(a) for a in zip(*axes, strict=True))
    cells = 1 << DEPTH

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = (exact.matrix(b.column("q"), width)[:, dims] - mean) / dev
            at = hilbert(np.clip(np.floor(x * (cells / 6) + cells / 2), 0, cells - 1), DEPTH)
            yield b.append_column("place", pa.array(at, pa.int64()))

    def chop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, n = 0, [], 0
        base = TaskContext.get().partitionId() << 32

        def close(table: pa.Table) -> pa.RecordBatch:
            ids = table.column("vec_id").to_numpy()
            order = np.argsort(ids)
            labels, x = table.column("label").to_numpy()[order], exact.matrix(table.column("q"), width)[order]
            marks = table.column("anchor").to_numpy()[order].astype(np.int64)
            low, high = x.min(0), x.max(0)
            return _batch([(base + seq, len(ids), ids[order].astype("<i8").tobytes(), np.stack([labels, marks]).astype("<i8").tobytes(),
                            x.astype("<i4").tobytes(), low.astype("<i4").tobytes(), high.astype("<i4").tobytes(), int(labels.min()),
                            int(labels.max()))], _ROWS)

        for b in batches:
            held.append(b)
            n += b.num_rows
            while n >= BLOCK:
                table = pa.Table.from_batches(held)
                yield close(table.slice(0, BLOCK))
                held, n, seq = table.slice(BLOCK).to_batches(), n - BLOCK, seq + 1
        if n:
            yield close(pa.Table.from_batches(held))

    keyed = rows.select("vec_id", "label", "q", "anchor").mapInArrow(placed, "vec_id long, label long, q array<long>, anchor boolean, place long")
    keyed = keyed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
    return settle(keyed.mapInArrow(chop, _ROWS), "blocks")


def write_tiles(blocks: DataFrame, width: int) -> DataFrame:
    """Anchors packed by neighbouring blocks: ids, labels, vectors and the block each lies in."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, held, n = 0, [], 0
        base = TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            ids, labels, x, home = (np.concatenate(c) for c in zip(*held, strict=True))
            return _batch([(base + seq, len(ids), ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), x.astype("<i4").tobytes(),
                            home.astype("<i8").tobytes())], _TILES)

        for b in batches:
            for r in b.to_pylist():
                labels, marks = _ints(r["labels"]).reshape(2, -1)
                at = np.nonzero(marks)[0]
                for part in np.split(at, range(TILE, len(at), TILE)):
                    if n + len(part) > TILE:
                        yield close()
                        seq, held, n = seq + 1, [], 0
                    if len(part):
                        held.append((_ints(r["ids"])[part], labels[part], _ints(r["vecs"], "<i4", width)[part], np.full(len(part), r["block"])))
                        n += len(part)
        if held:
            yield close()

    return settle(blocks.select("block", "ids", "labels", "vecs").mapInArrow(pack, _TILES), "tiles")


def write_pages(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Zone maps packed by PAGE, each page with the bucket by which anchors meet it; and the number of buckets."""
    schema = "page long, blocks binary, lo binary, hi binary, label_lo binary, label_hi binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, base = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for at in range(0, b.num_rows, PAGE):
                part = b.slice(at, PAGE)
                ints = [part.column(c).to_numpy().astype("<i8").tobytes() for c in ("block", "label_lo", "label_hi")]
                zones = [b"".join(part.column(c).to_pylist()) for c in ("lo", "hi")]
                yield _batch([(base + seq, ints[0], *zones, *ints[1:])], schema)
                seq += 1

    zones = blocks.select("block", "lo", "hi", "label_lo", "label_hi")
    zones = zones.coalesce(max(1, min(zones.rdd.getNumPartitions(), blocks.count() // PAGE)))
    pages = settle(zones.mapInArrow(pack, schema), "pages")
    buckets = max(1, pages.count() // 4)
    return pages.withColumn("bucket", F.pmod(F.xxhash64("page"), F.lit(buckets))), buckets


# --- Which blocks to read, and reading them ---

def bounds(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of x with any vector between lo and hi of each zone."""
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    return exact.dot(up, lo) + exact.dot(down, hi), exact.dot(up, hi) + exact.dot(down, lo)


def choose(tiles: DataFrame, pages: DataFrame, buckets: int, width: int, same: bool) -> DataFrame:
    """(tile, block, mask): for each tile the blocks that some of its anchors must read, and which. tiles with the columns low and
    high, the windows of each anchor. The anchors' own blocks are left out, they are read before."""
    schema = "tile long, block long, mask binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                r = b.slice(at, 1).to_pylist()[0]
                block, first, last = (_ints(r[c]) for c in ("blocks", "label_lo", "label_hi"))
                least, most = bounds(_ints(r["vecs"], "<i4", width), _ints(r["lo"], "<i4", width), _ints(r["hi"], "<i4", width))
                label, home = _ints(r["labels"])[:, None], _ints(r["home"])[:, None]
                need = (first <= label) & (label <= last) if same else (first != label) | (label != last)
                need &= home != block
                inside = np.zeros_like(need)
                for low, high in zip(_ints(r["low"]).reshape(r["n"], -1).T, _ints(r["high"]).reshape(r["n"], -1).T, strict=True):
                    inside |= (most >= low[:, None]) & (least <= high[:, None]) & (low <= high)[:, None]
                need &= inside
                read = np.nonzero(need.any(0))[0]
                yield _batch([(r["tile"], int(block[i]), np.packbits(need[:, i]).tobytes()) for i in read], schema)

    every = tiles.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return every.join(pages, "bucket").mapInArrow(run, schema)


def own_blocks(tiles: DataFrame) -> DataFrame:
    """(tile, block, mask) of the blocks that the anchors lie in."""
    schema = "tile long, block long, mask binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tile, raw in zip(b.column("tile").to_pylist(), b.column("home").to_pylist(), strict=True):
                home = _ints(raw)
                yield _batch([(tile, int(h), np.packbits(home == h).tobytes()) for h in np.unique(home)], schema)

    return tiles.select("tile", "home").mapInArrow(run, schema)


def read(units: DataFrame, tiles: DataFrame, blocks: DataFrame, width: int, most: int, same: bool) -> DataFrame:
    """(tile, row, slot, anchor_id, score, vec_id): of each unit, anchor and window the first `most` rows of the block."""
    schema = "tile long, row int, slot int, anchor_id long, score long, vec_id long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                r = b.slice(at, 1).to_pylist()[0]
                rows = np.nonzero(np.unpackbits(np.frombuffer(r["mask"], np.uint8), count=r["n"]))[0]
                anchor, label = _ints(r["ids"])[rows], _ints(r["labels"])[rows]
                ids, x = _ints(r["b_ids"]), _ints(r["b_vecs"], "<i4", width)
                score = exact.dot(_ints(r["vecs"], "<i4", width)[rows], x)
                alike = _ints(r["b_labels"])[:len(ids)][None, :] == label[:, None]
                fits = alike & (ids[None, :] != anchor[:, None]) if same else ~alike
                n = len(ids)
                key = score * n + np.arange(n - 1, -1, -1)  # higher scores, then smaller ids: a block's ids are sorted
                first = min(most, n)
                out = []
                for slot, (low, high) in enumerate(zip(_ints(r["low"]).reshape(r["n"], -1)[rows].T, _ints(r["high"]).reshape(r["n"], -1)[rows].T, strict=True)):
                    ok = fits & (score >= low[:, None]) & (score <= high[:, None])
                    best = np.partition(np.where(ok, key, LOW * 2 + 1), n - first, axis=1)[:, n - first:]
                    i, j = np.nonzero(best > LOW * 2 + 1)
                    at_row, won = rows[i], best[i, j]
                    out.append((at_row, np.full(len(i), slot), anchor[i], won // n, ids[n - 1 - won % n]))
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                kinds = [np.int32, np.int32, np.int64, np.int64, np.int64]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cols[0]), r["tile"], np.int64)), *[pa.array(c.astype(k)) for c, k in zip(cols, kinds, strict=True)]],
                                                 names=[f.split()[0] for f in schema.split(", ")])

    held = tiles.select("tile", "n", "ids", "labels", "vecs", "low", "high")
    data = blocks.select("block", F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"), F.col("vecs").alias("b_vecs"))
    return units.join(held, "tile").join(data, "block").mapInArrow(run, schema)


def first_rows(found: DataFrame, most: int) -> DataFrame:
    """The first `most` rows of each anchor and window, with `rank` from 1: higher scores first, ties by vec_id."""
    order = Window.partitionBy("tile", "row", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def windowed(tiles: DataFrame, windows: DataFrame, slots: int) -> DataFrame:
    """Tiles with the columns low and high (rows x slots): from windows (tile, row, slot, lowest, highest); a window that is not
    given is empty. A tile has at most TILE x slots windows."""
    schema = f"{_TILES}, low binary, high binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                low, high = np.full((r["n"], slots), HIGH), np.full((r["n"], slots), LOW)
                for w in r["windows"] or []:
                    low[w["row"], w["slot"]], high[w["row"], w["slot"]] = w["lowest"], w["highest"]
                yield _batch([(*[r[f.split()[0]] for f in _TILES.split(", ")], low.astype("<i8").tobytes(), high.astype("<i8").tobytes())], schema)

    packed = windows.groupBy("tile").agg(F.collect_list(F.struct("row", "slot", "lowest", "highest")).alias("windows"))
    return settle(tiles.join(packed, "tile", "left").mapInArrow(run, schema), "windows")


def search(tiles: DataFrame, windows: DataFrame, slots: int, blocks: DataFrame, pages: tuple[DataFrame, int], width: int, most: int,
           same: bool) -> DataFrame:
    """The first `most` rows of each window: (tile, row, slot, anchor_id, score, vec_id, rank). Own blocks are read first; where
    they fill a window, its lowest score rises to the last of these, and fewer blocks can reach it."""
    wide = windowed(tiles, windows, slots)
    seeds = settle(read(own_blocks(wide), wide, blocks, width, most, same), "seeds")
    full = first_rows(seeds, most).filter(F.col("rank") == most).select("tile", "row", "slot", F.col("score").alias("_reached"))
    risen = windows.join(full, ["tile", "row", "slot"], "left").withColumn("lowest", F.greatest("lowest", "_reached")).drop("_reached")
    narrow = windowed(tiles, risen, slots)
    units = choose(narrow, *pages, width, same)
    found = read(units, narrow, blocks, width, most, same)
    return settle(first_rows(seeds.unionByName(found), most), "found")


def once(rows: DataFrame) -> DataFrame:
    """Of rows that repeat a vec_id the first by label and vector. Only ids are shuffled, and the rows that repeat."""
    twice = settle(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("vec_id"), "repeats")
    order = Window.partitionBy("vec_id").orderBy("label", "q")
    first = rows.join(twice, "vec_id", "left_semi").withColumn("_at", F.row_number().over(order)).filter("_at = 1").drop("_at")
    return rows.join(twice, "vec_id", "left_anti").unionByName(first)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, lowest: int = 50, highest: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors (vec_id, label, embedding).

    Scores are inner products of floor(scale * component). An anchor's positives are its first rows of the same label, itself left
    out; for each, the first rows of other labels count whose scores are `lowest` to `highest` percent of the positive's.
    Rows with a null vec_id, label or vector, or a null or non-finite component, take no part; of rows that repeat a vec_id the
    first by label and vector does. An empty table, or one without anchors, gives no rows. Other columns are ignored. Vectors
    must have one length, 4,096 at most, and components below 2 ** 20 after scaling (ValueError).
    """
    rows = vectors.filter("vec_id is not null and label is not null").select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows, width = exact.quantised(rows, "q", scale, LIMIT)
    if width > WIDEST:
        raise ValueError(f"{width} components are more than {WIDEST}")
    if not width:
        return rows.select(*[F.lit(0).cast(k).alias(c) for c, k in (("anchor_id", "long"), ("positive_id", "long"), ("rank", "int"),
                                                                    ("negative_id", "long"), ("positive_score", "long"), ("negative_score", "long"))]).limit(0)
    blocks = write_blocks(once(rows), width)
    tiles, pages = write_tiles(blocks, width), write_pages(blocks)
    every = tiles.select("tile", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("row"), F.lit(0).alias("slot"),
                         F.lit(LOW).alias("lowest"), F.lit(HIGH).alias("highest"))
    near = search(tiles, every, 1, blocks, pages, width, positives, True)
    near = near.select("tile", "row", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Whole numbers throughout: the lowest score is rounded up, the highest down.
    whole = lambda v: f"({v} - pmod({v}, 100)) div 100"
    windows = near.selectExpr("tile", "row", "slot", f"{whole(f'(positive_score * {lowest} + 99)')} AS lowest",
                              f"{whole(f'(positive_score * {highest})')} AS highest").filter("lowest <= highest")
    hard = search(tiles, windows, positives, blocks, pages, width, negatives, False)
    return hard.join(near, ["tile", "row", "slot"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                                                           F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
