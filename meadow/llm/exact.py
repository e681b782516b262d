"""Exact integer arithmetic on vectors: quantised rows as Arrow batches, and products of integers on float64 BLAS by limbs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meadow.llm.common import settle

LIMB = 8  # bits of a limb: sums of up to 2 ** 36 products of two limbs stay below 2 ** 53, which a double holds exactly


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """float64 arrays l with x = sum of l[i] * 2 ** (i * LIMB); the last one keeps the sign. As many as the largest value needs."""
    out = []
    while np.abs(x).max(initial=0) > 1 << LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*out, x.astype(np.float64)]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int64 matrices, exact as long as the result fits int64: products of limbs are float64 BLAS calls below
    2 ** 53, and are put together in int64."""
    out = np.zeros((len(a), len(b)), np.int64)
    right = limbs(b)
    for i, x in enumerate(limbs(a)):
        for j, y in enumerate(right):
            out += (x @ y.T).astype(np.int64) << (LIMB * (i + j))
    return out


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds no null and no component that is not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, lambda x: bad(x.cast("double"))), F.lit(False))


def quantised(rows: DataFrame, vector: str, scale: int, limit: int) -> tuple[DataFrame, int]:
    """The rows of usable vectors, written with `vector` as array<long> of floor(scale * x), and their common length (0 if none).

    Raises ValueError if lengths differ or a component lies beyond `limit`, above which sums would not fit a long."""
    v = F.col(vector)
    fits = F.forall(v, lambda x: F.abs(F.lit(float(scale)) * x.cast("double")) < float(limit))
    kept = rows.filter(usable(v))
    longest, shortest, fit = kept.agg(F.max(F.size(v)), F.min(F.size(v)), F.min(fits)).first()
    if longest != shortest:
        raise ValueError(f"vectors have {shortest} to {longest} components")
    if fit is False:
        raise ValueError(f"{scale} * component must be below {limit}")
    q = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return settle(kept.withColumn(vector, q), "quantised"), longest or 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """The int64 matrix of an Arrow column of lists of one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), width)
