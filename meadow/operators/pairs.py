"""Pair statistics by tiles: every pair of rows of a long (row, column, value) table, without a table of pairs in between.

Rows are dealt to blocks, columns to chunks. The cells of a block and chunk are packed into one row; what one row of the table
needs beside its cells (totals, means) travels as the head of its block. A task takes the packed rows of two blocks in the order of
chunks and adds their sums on two accumulators of fixed size, however many columns there are, and when it has seen all chunks
turns sums and heads into results. The packed rows are the only thing that is shuffled.

With a threshold a pair leaves the tile as soon as it cannot reach it: the products still to come are at most the root
of the product of what is left of both rows' squares (Cauchy-Schwarz). When a tile has no pair left, its chunks are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meadow.operators.kernels import arrow_schema
from meadow.sources.tables import cut_lineage

#: (ids a, ids b, sums by name, head columns of a, of b) of some pairs -> columns of the result.
Finish = Callable[[np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray, np.ndarray], pd.DataFrame]
#: (dot so far, bound of what is to come, head columns of a, of b) of a tile -> whether a pair can still count.
Reach = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


RANGE_BYTES = 32 << 20  # of packed cells of a tile up to which one task adds all of its chunks
MOST_PARTITIONS = 20_000


class _Tile:
    """Accumulators of two blocks (one block twice where i = j)."""

    def __init__(self, key: tuple[int, int], want: tuple[str, ...], norm: int | None, reach: Reach | None):
        self.key, self.want, self.norm, self.reach = key, want, norm, reach
        self.heads: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.sums: dict[str, np.ndarray] | None = None
        self.chunk, self.packed, self.alive = None, {}, None

    def add(self, r: dict) -> None:
        if r["ch"] < 0:
            ids = np.array(r["rows"], dtype=object) if r["rows"] and isinstance(r["rows"][0], str) else np.array(r["rows"])
            self.heads[r["blk"]] = ids, np.frombuffer(r["v"]).reshape(len(ids), -1)
            return
        if r["blk"] < 0:
            self._take(r["v"])
            return
        if r["ch"] != self.chunk:
            self._add_chunk()
            self.chunk = r["ch"]
        self.packed[r["blk"]] = r

    def _start(self) -> None:
        i, j = self.key
        self.index = {b: pd.Index(self.heads[b][0]) for b in {i, j}}
        shape = len(self.index[i]), len(self.index[j])
        self.sums = {w: np.zeros(shape) for w in self.want}
        self.left = {b: self.heads[b][1][:, self.norm].copy() for b in {i, j}} if self.reach else {}
        self.alive = np.ones(shape, bool)

    def _dense(self, block: int, columns: pd.Index) -> np.ndarray:
        m = np.zeros((len(self.index[block]), len(columns)))
        r = self.packed.get(block)
        if r is not None:
            at = self.index[block].get_indexer(pd.Index(r["rows"]))[np.frombuffer(r["rc"], np.int32)]
            m[at, columns.get_indexer(pd.Index(r["cols"]))[np.frombuffer(r["cc"], np.int32)]] = np.frombuffer(r["v"])
        return m

    def _add_chunk(self) -> None:
        packed = self.packed
        if not packed:
            return
        if self.sums is None:
            self._start()
        i, j = self.key
        if self.alive.any():
            columns = pd.Index(sorted({c for r in packed.values() for c in r["cols"]}))
            ma = self._dense(i, columns)
            mb = ma if i == j else self._dense(j, columns)
            # Only rows that are part of a pair that can still count are multiplied.
            ia, ib = np.flatnonzero(self.alive.any(1)), np.flatnonzero(self.alive.any(0))
            at = np.ix_(ia, ib)
            if "dot" in self.sums:
                self.sums["dot"][at] += ma[ia] @ mb[ib].T
            if "shared" in self.sums:
                self.sums["shared"][at] += (ma[ia] != 0).astype(float) @ (mb[ib] != 0).astype(float).T
            if "mins" in self.sums:
                self.sums["mins"][at] += np.stack([np.minimum(row, mb[ib]).sum(axis=1) for row in ma[ia]])
            if self.reach:
                for b, m in ((i, ma), (j, mb)) if i != j else ((i, ma),):
                    self.left[b] = np.maximum(self.left[b] - (m * m).sum(1), 0.0)
                rest = np.sqrt(np.outer(self.left[i], self.left[j]))
                self.alive &= self.reach(self.sums["dot"], rest, self.heads[i][1], self.heads[j][1])
        self.packed = {}

    def part(self) -> bytes | None:
        """The sums of the chunks seen so far."""
        self._add_chunk()
        return None if self.sums is None else np.stack([self.sums[w] for w in self.want]).tobytes()

    def _take(self, part: bytes) -> None:
        """Adds what part() gave of a range of chunks."""
        if self.sums is None:
            self._start()
        for w, x in zip(self.want, np.frombuffer(part).reshape(len(self.want), *self.alive.shape)):
            self.sums[w] += x

    def close(self, finish: Finish) -> pd.DataFrame | None:
        i, j = self.key
        if i not in self.heads or j not in self.heads:
            return None
        self._add_chunk()
        if self.sums is None:
            self._start()
        if self.reach:
            self.alive &= self.reach(self.sums["dot"], np.zeros(self.alive.shape), self.heads[i][1], self.heads[j][1])
        ids_a, ids_b = self.heads[i][0], self.heads[j][0]
        order = ids_a[:, None] < ids_b[None, :]
        at_a, at_b = np.nonzero(self.alive & order if i == j else self.alive)
        if not len(at_a):
            return None
        flip = ~order[at_a, at_b]
        a, b = np.where(flip, ids_b[at_b], ids_a[at_a]), np.where(flip, ids_a[at_a], ids_b[at_b])
        ha, hb = self.heads[i][1][at_a], self.heads[j][1][at_b]
        turn = flip[:, None]
        return finish(a, b, {w: s[at_a, at_b] for w, s in self.sums.items()}, np.where(turn, hb, ha), np.where(turn, ha, hb))


def pair_tiles(heads: DataFrame, cells: DataFrame | None, row: str, finish: Finish, schema: str, col: str = "", value: str = "",
               want: tuple[str, ...] = (), reach: Reach | None = None, norm: str | None = None, rows_per_block: int = 256,
               cols_per_chunk: int = 1024) -> DataFrame:
    """The rows that `finish` makes of all pairs a < b of the ids in heads (row, then numeric columns), tile by tile.

    cells (row, col, value) may be absent where a value is 0; ids that heads does not list are not allowed. `want` names the sums
    that are needed: dot, shared (columns where both are not 0), mins (of the smaller values). With `reach`, `norm` names the head
    column of the rows' sums of squares, and pairs that it gives up are left out.
    """
    columns = [c for c in heads.columns if c != row]
    heads = cut_lineage(heads.select(F.col(row).alias("r"), F.array(*[F.col(c).cast("double") for c in columns]).alias("h")))
    kind = dict(heads.dtypes)["r"]
    nb = max(1, -(-heads.count() // rows_per_block))
    block = F.pmod(F.xxhash64("r"), F.lit(nb)).cast("int")
    width = len(columns)
    ckind = dict(cells.dtypes)[col] if cells is not None else "int"
    packed_as = f"blk int, ch int, rows array<{kind}>, cols array<{ckind}>, rc binary, cc binary, v binary"

    def pack_heads(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("r")
        v = np.stack(pdf["h"].to_numpy()).astype(float) if width else np.zeros((len(pdf), 0))
        return pd.DataFrame([(pdf["blk"].iloc[0], -1, pdf["r"].tolist(), [], b"", b"", v.tobytes())], columns=["blk", "ch", "rows", "cols", "rc", "cc", "v"])

    def pack_cells(pdf: pd.DataFrame) -> pd.DataFrame:
        rc, rows = pd.factorize(pdf["r"])
        cc, cols = pd.factorize(pdf["c"])
        return pd.DataFrame([(pdf["blk"].iloc[0], pdf["ch"].iloc[0], rows.tolist(), cols.tolist(), rc.astype(np.int32).tobytes(),
                              cc.astype(np.int32).tobytes(), pdf["v"].to_numpy(float).tobytes())], columns=["blk", "ch", "rows", "cols", "rc", "cc", "v"])

    packed = heads.withColumn("blk", block).groupBy("blk").applyInPandas(pack_heads, packed_as)
    if cells is not None:
        n_cols = cells.agg(F.approx_count_distinct(col)).first()[0]
        nc = max(1, -(-int(n_cols) // cols_per_chunk))
        c = cells.select(F.col(row).alias("r"), F.col(col).alias("c"), F.col(value).cast("double").alias("v"),
                         F.pmod(F.xxhash64(col), F.lit(nc)).cast("int").alias("ch")).withColumn("blk", block)
        packed = packed.unionByName(c.groupBy("blk", "ch").applyInPandas(pack_cells, packed_as))
    packed = cut_lineage(packed)
    place = columns.index(norm) if norm else None

    def tiles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Tile]:
        """The tiles (or ranges of tiles) of a task, one after the other, when all their rows are in."""
        tile, last = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                key = r["bi"], r["bj"], r.get("g")
                if key != last:
                    if tile is not None:
                        yield tile
                    tile, last = _Tile(key[:2], want, place, reach), key
                tile.add(r)
        if tile is not None:
            yield tile

    arrow = arrow_schema(schema)

    def arrow_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles_of(batches):
            if (out := tile.close(finish)) is not None:
                yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    both = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    both = both.withColumns({"bi": F.least("blk", "other"), "bj": F.greatest("blk", "other")}).drop("other")
    # A tile is never cut by rows. One with more than RANGE_BYTES of cells (few rows, many columns) is dealt by chunks to ranges, which
    # give their sums; these meet by the tile. Pairs that leave a tile early need all of its chunks in one place.
    ranges, tiles = 1, nb * (nb + 1) // 2
    if cells is not None and not reach:
        size = packed.agg(F.coalesce(F.sum(F.octet_length("rc") + F.octet_length("cc") + F.octet_length("v")).cast("long"), F.lit(0))).first()[0]
        ranges = max(1, min(nc, -(-size * nb // (tiles * RANGE_BYTES))))
    if ranges > 1:
        def arrow_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for tile in tiles_of(batches):
                if (part := tile.part()) is not None:
                    yield pa.RecordBatch.from_pydict({"bi": pa.array([tile.key[0]], pa.int32()), "bj": pa.array([tile.key[1]], pa.int32()), "v": [part]})

        dealt = F.when(F.col("ch") < 0, F.sequence(F.lit(0), F.lit(ranges - 1))).otherwise(F.array(F.pmod("ch", F.lit(ranges))))
        each = both.withColumn("g", F.explode(dealt)).repartition(min(tiles * ranges, MOST_PARTITIONS), "bi", "bj", "g")
        sums = each.sortWithinPartitions("bi", "bj", "g", "ch", "blk").mapInArrow(arrow_parts, "bi int, bj int, v binary")
        none = {"blk": F.lit(-1), "ch": F.lit(0), "rows": F.array().cast(f"array<{kind}>"), "cols": F.array().cast(f"array<{ckind}>"), "rc": F.lit(b""), "cc": F.lit(b"")}
        both = both.filter("ch < 0").unionByName(sums.withColumns(none))
    return both.repartition("bi", "bj").sortWithinPartitions("bi", "bj", "ch", "blk").mapInArrow(arrow_run, schema)
