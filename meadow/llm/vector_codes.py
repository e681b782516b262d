"""Vector code compression: product codes with integer codebooks, every distance exact by limb-split matrix products.

Components become integers. A vector is cut into parts; a part is coded by its nearest codebook entry, the first of equals. Codebooks
are refined by rounds over all rows: tasks return sums and counts per entry, one small table a round. Squared distances are
|x|^2 - 2 x.c + |c|^2 in int64, their products from float64 BLAS on limbs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from meadow.llm import exact
from meadow.llm.common import settle

SCALE = 4096
HOT = 1000  # labels with at least this fraction of all rows are joined on their own; there are at most as many

Codebooks = list[list[list[int]]]  # part, entry, component


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each row, the lowest index of equals."""
    if not x.shape[1]:
        return np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    apart = (x * x).sum(1)[:, None] - 2 * exact.dot(x, entries) + (entries * entries).sum(1)[None, :]
    first = apart.argmin(1)
    return first, apart[np.arange(len(x)), first]


def _parts(batch: pa.RecordBatch, width: int, parts: int) -> list[np.ndarray]:
    return np.split(exact.matrix(batch.column("q"), width), parts, axis=1)


def initial(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the `entries` smallest vec_ids, ascending, null ids last and equal ids by their vectors; fewer rows give fewer entries."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    return [[list(map(int, part)) for part in book] for book in zip(*[np.split(np.array(r["q"], np.int64), parts) for r in first], strict=True)]


def refine(rows: DataFrame, books: Codebooks, width: int) -> Codebooks:
    """One round: every part goes to its nearest entry, each entry becomes its parts' floored mean; unused entries stay.

    Only sums per entry leave the tasks: parts x entries rows from each."""
    parts = len(books)
    arrays = [np.array(b, np.int64) for b in books]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros_like(a) for a in arrays]
        count = [np.zeros(len(a), np.int64) for a in arrays]
        for batch in batches:
            for p, x in enumerate(_parts(batch, width, parts)):
                at, _ = nearest(x, arrays[p])
                np.add.at(total[p], at, x)
                count[p] += np.bincount(at, minlength=len(arrays[p]))
        keys = [(p, e) for p in range(parts) for e in range(len(arrays[p])) if count[p][e]]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([p for p, _ in keys], pa.int32()), "entry": pa.array([e for _, e in keys], pa.int32()),
            "n": pa.array([int(count[p][e]) for p, e in keys], pa.int64()),
            "total": pa.array([total[p][e].tolist() for p, e in keys], pa.list_(pa.int64()))})

    found = rows.select("q").mapInArrow(sums, "part int, entry int, n long, total array<long>")
    each = found.select("part", "entry", "n", F.posexplode("total").alias("at", "value"))
    out = [[list(e) for e in book] for book in books]
    for r in each.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect():
        out[r["part"]][r["entry"]][r["at"]] = int(r["s"]) // r["n"]
    return out


def assign(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Adds code (two hex digits of the entry's index per part) and error (squared distances summed); q is left out."""
    parts = len(books)
    arrays = [np.array(b, np.int64) for b in books]
    kept = [f for f in rows.schema.fields if f.name != "q"]
    names = [f.name for f in kept]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = np.zeros((batch.num_rows, parts), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, x in enumerate(_parts(batch, width, parts)):
                at, apart = nearest(x, arrays[p])
                codes[:, p] = at
                error += apart
            text = codes.tobytes().hex()
            hexed = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(hexed, pa.string()), pa.array(error, pa.int64())],
                                             names=[*names, "code", "error"])

    schema = T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return rows.mapInArrow(coded, schema)


def digest(books: Codebooks) -> str:
    """Lowercase hex SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def decode(codes: DataFrame, books: Codebooks, code: str = "code", out: str = "vector", scale: int = SCALE) -> DataFrame:
    """Adds `out` (array<double>), the vector that a code stands for: entries of its parts divided by the scale. Null codes give null."""
    book = F.array(*[F.array(*[F.array(*[F.lit(x / scale) for x in e]) for e in b]) for b in books])
    at = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
    parts = F.flatten(F.array(*[F.get(F.get(book, p), at(p)) for p in range(len(books))]))
    return codes.withColumn(out, F.when(F.col(code).isNotNull(), parts))


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds label_error, the errors summed over equal labels (nulls are one label). Sums merge before the shuffle. Labels with a
    thousandth of all rows or more, at most a thousand labels, are joined by broadcast, so no task holds a hot label; the
    others by shuffle."""
    sums = settle(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"),
                                            F.count(F.lit(1)).alias("_n")), "labels")
    total = sums.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    sums = sums.withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    hot, cold = sums.filter(F.col("_n") * HOT >= total), sums.filter(F.col("_n") * HOT < total)
    first = rows.join(F.broadcast(hot), same).drop("_label", "_n")
    rest = rows.join(F.broadcast(hot.select("_label")), same, "left_anti")
    return first.unionByName(rest.join(cold, same).drop("_label", "_n"))


def encode(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every usable vector, and the final codebooks.

    Null vectors and vectors with a null or non-finite component are dropped. Null vec_ids are coded, and come last among those
    that start the codebooks; rows that repeat a vec_id are rows of their own, ordered by their vectors; an empty table gives no
    rows and no codebooks. Other columns are ignored. Vectors must have one length that the parts divide, at most 256
    entries, and components below 2 ** 25 after scaling (squared distances of 1,024 components then fit a long); ValueError otherwise.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code digit pair holds 1 to 256 entries")
    rows, width = exact.quantised(vectors.select("vec_id", "label", F.col("embedding").alias("q")), "q", scale, 1 << 25)
    if width % parts or width > 1024:
        raise ValueError(f"{parts} equal parts do not make {width} components")
    books = initial(rows, parts, entries)
    if not books:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    for _ in range(rounds):
        books = refine(rows, books, width)
    return settle(assign(rows, books, width), "codes"), books


def code_report(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector, see encode()."""
    coded, books = encode(vectors, parts, entries, rounds)
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
