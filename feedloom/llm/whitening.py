"""Embedding whitening from a bit-sliced scatter matrix.

Every entry c of a vector becomes the integer x = floor(scale * c). Rows are gathered in blocks; in a block each dimension is shifted by its least value, and every bit plane of the
shifted integers is packed across the rows into 64-bit words. The AND-popcount of two planes,
weighted by their powers of two, gives exact cross-products. Each task adds up its blocks as
integers and returns one row per entry of its matrix, cut into 32-bit limbs, which Spark sums.
The driver holds only the matrix, whose size is that of the vector's dimensions. It centres
the sums as integers, n * Q - S * S', before the division by n squared and the eigenvectors.

A second pass projects the rows and adds up what their covariance misses of the identity, a third
returns them; each reads the vectors once, nothing is shuffled but the small sums.

Defined results: vectors that are null, or hold null, NaN or infinite entries, or entries whose
integer does not fit 62 bits, take no part. All vectors must have one length: those of another
length than the most frequent (the longer of equals) take no part either. Repeated rows count
and are returned as often as they stand; a null id is kept. Components whose eigenvalue is zero
to double precision cannot be scaled and are left out, so a table of equal rows, of one row or
of none gives no row. Of the input, only the id is returned; its name must not be an output's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, lean

#: Entries in a block of rows, rows in it at most, and dimensions at most (the matrix is on the driver).
BLOCK_ENTRIES, BLOCK_ROWS, MAX_DIMENSIONS = 1 << 22, 1 << 16, 4096
_LIMB, _FIT = 32, float(1 << 62)
OUTPUT = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def integers(column: pa.Array, length: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the rows that take part, their floor(scale * c) as int64)."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False), -1)
    at = np.flatnonzero(sizes == length)
    if not len(at):
        return at, np.zeros((0, length), np.int64)
    starts = column.offsets.to_numpy()[at]
    values = column.values.to_numpy(zero_copy_only=False)  # null entries become NaN
    c = np.floor(values[(starts[:, None] + np.arange(length)).ravel()].reshape(len(at), length) * scale)
    with np.errstate(invalid="ignore"):
        good = (np.abs(c) < _FIT).all(axis=1)
    return at[good], c[good].astype(np.int64)


def cross_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(column sums, Y'Y) of a block of integers, exact, as arrays of Python integers.

    With u = y - least, the planes of u are AND-popcounted; the shift is undone as integers."""
    rows, d = y.shape
    least = y.min(axis=0)
    u = (y - least).astype(np.uint64)  # exact: both lie within 62 bits
    tops = u.max(axis=0)
    words = (rows + 63) // 64
    planes, dims, bits = [], [], []
    for j in range(d):
        for b in range(int(tops[j]).bit_length()):
            packed = np.packbits((u[:, j] >> np.uint64(b)).astype(np.uint8) & 1)
            planes.append(np.pad(packed, (0, words * 8 - len(packed))).view(np.uint64))
            dims.append(j)
            bits.append(b)
    base = [int(v) for v in least]
    if not planes:
        sums, inner = np.zeros(d, object), np.zeros((d, d), object)
    else:
        plane = np.stack(planes)
        p = len(plane)
        count = np.zeros((p, p), np.int64)
        for i in range(p):
            count[i, i:] = np.bitwise_count(plane[i:] & plane[i]).sum(axis=1, dtype=np.int64)
        count = np.maximum(count, count.T)
        exact = rows.bit_length() + 2 * (max(bits) + 1) >= 62
        weight = np.zeros((d, p), object if exact else np.int64)
        weight[dims, range(p)] = [1 << b for b in bits]
        counts = count.astype(object) if exact else count
        sums, inner = (weight @ np.diagonal(counts)).astype(object), (weight @ counts @ weight.T).astype(object)
    m = np.array(base, object)
    return sums + rows * m, inner + np.outer(sums, m) + np.outer(m, sums) + rows * np.outer(m, m)


def limbs(value: int) -> list[tuple[int, int]]:
    """(number, limb) of the non-zero 32-bit limbs of an integer, each with its sign."""
    sign, value, out, k = (-1 if value < 0 else 1), abs(value), [], 0
    while value:
        if low := value & ((1 << _LIMB) - 1):
            out.append((k, sign * low))
        value, k = value >> _LIMB, k + 1
    return out


def _blocks(batches: Iterator[pa.RecordBatch], length: int, scale: float) -> Iterator[np.ndarray]:
    most = max(64, min(BLOCK_ROWS, BLOCK_ENTRIES // length))
    held, rows = [], 0
    for b in batches:
        _, y = integers(b.column(0), length, scale)
        while len(y):
            take = y[:most - rows]
            held.append(take)
            rows, y = rows + len(take), y[len(take):]
            if rows == most:
                yield np.concatenate(held)
                held, rows = [], 0
    if rows:
        yield np.concatenate(held)


def scatter(vectors: DataFrame, length: int, scale: float) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, cross-products) of floor(scale * c) over the one column of ``vectors``, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, inner = 0, np.zeros(length, object), np.zeros((length, length), object)
        for y in _blocks(batches, length, scale):
            s, q = cross_products(y)
            n, sums, inner = n + len(y), sums + s, inner + q
        cells = [(-1, -1, n), *((-1, j, sums[j]) for j in range(length)),
                 *((i, j, inner[i, j]) for i in range(length) for j in range(i, length))] if n else []
        rows = [(i, j, k, low) for i, j, v in cells for k, low in limbs(int(v))]
        for lo in range(0, len(rows), 100_000):
            part = list(zip(*rows[lo:lo + 100_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.int32()),
                                              pa.array(part[3], pa.int64())], names=["i", "j", "limb", "v"])

    parts = vectors.mapInArrow(lean(run), "i int, j int, limb int, v long")
    # the driver gets a few numbers for each pair of dimensions, however many rows there are
    total = parts.groupBy("i", "j", "limb").agg(F.sum("v").alias("v")).collect()
    n, sums, inner = 0, np.zeros(length, object), np.zeros((length, length), object)
    for r in total:
        v = int(r["v"]) << (_LIMB * r["limb"])
        if r["j"] < 0:
            n += v
        elif r["i"] < 0:
            sums[r["j"]] += v
        else:
            inner[r["i"], r["j"]] += v
            if r["i"] != r["j"]:
                inner[r["j"], r["i"]] += v
    return n, sums, inner


def directions(n: int, sums: np.ndarray, inner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns, shares of the trace) of the first k components
    of the covariance, whose numerators are centred as integers and divided once."""
    length = len(sums)
    centred = n * inner - np.outer(sums, sums)
    cov = np.array([[int(centred[i, j]) / (n * n) for j in range(length)] for i in range(length)], float).reshape(length, length)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    trace = sum(int(centred[i, i]) for i in range(length)) / (n * n)
    some = e > trace * max(length, 1) * 2.0**-51
    return e[some], v[:, some], e[some] / trace if trace else e[some]


def _projected(y: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(whitened rows, sum over dimensions of (n * y - S) squared), the centring in integers."""
    big = len(y) and n.bit_length() + max(int(np.abs(y).max()), 1).bit_length() > 61
    if big or any(abs(s) >= 1 << 61 for s in sums):
        d = n * y.astype(object) - np.array(sums, object)
        squares = (d * d).sum(axis=1).tolist()
        return (d / n).astype(float) @ axes, squares
    d = n * y - np.array(sums, np.int64)
    if len(y) and y.shape[1] * int(np.abs(d).max()) ** 2 >= 1 << 63:
        wide = d.astype(object)
        return (d / n) @ axes, (wide * wide).sum(axis=1).tolist()
    return (d / n) @ axes, (d * d).sum(axis=1).tolist()


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 32, scale: float = 64.0) -> DataFrame:
    """One row per row that takes part and component (from 1, by falling eigenvalue): ``id``,
    component int, n long (rows fitted), deviation decimal(38,0) (exact sum over dimensions of
    (n * x - S) squared, null beyond 38 digits), whitened double, explained double, identity_error
    double. A constant added to every x changes none of these, as all are centred."""
    if id.lower() in OUTPUT:
        raise ValueError(f"the id column must not be named {id}")
    spark = df.sparkSession
    bounded_batches(spark)
    pair = df.select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    kind = pair.schema["id"].dataType
    empty = spark.createDataFrame([], T.StructType([
        T.StructField(id, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())]))
    common = (pair.where(F.size("vector") > 0).groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
                  .orderBy(F.desc("rows"), F.desc("length")).first())
    if common is None:
        return empty
    length = common["length"]
    if length > MAX_DIMENSIONS:
        raise ValueError(f"vectors have at most {MAX_DIMENSIONS} dimensions")
    n, sums, inner = scatter(pair.select("vector"), length, scale)
    if not n:
        return empty
    values, vectors, shares = directions(n, sums, inner, components)
    k = len(values)
    if not k:
        return empty
    axes, total = vectors / np.sqrt(values), [int(s) for s in sums]

    def misses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for y in _blocks(batches, length, scale):
            w, _ = _projected(y, n, total, axes)
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.full(k, -1), i]), pa.int32()), pa.array(np.concatenate([np.arange(k), j]), pa.int32()),
            pa.array(np.concatenate([first, second[i, j]]), pa.float64())], names=["i", "j", "v"])

    mean, square = np.zeros(k), np.zeros((k, k))
    for r in pair.select("vector").mapInArrow(lean(misses), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / n
        else:
            square[r["i"], r["j"]] = square[r["j"], r["i"]] = r["v"] / n
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, y = integers(b.column(1), length, scale)
            w, squares = _projected(y, n, total, axes)
            offsets = pa.array(np.arange(0, (len(at) + 1) * k, k), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([str(s) for s in squares], pa.string()),
                                              pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))], names=["id", "deviation", "w"])

    rows = pair.mapInArrow(lean(project), T.StructType([T.StructField("id", kind), T.StructField("deviation", T.StringType()),
                                                        T.StructField("w", T.ArrayType(T.DoubleType()))]))
    share = F.array(*[F.lit(float(s)) for s in shares])
    return (rows.select("id", F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), F.posexplode("w").alias("p", "whitened"))
                .select(F.col("id").alias(id), (F.col("p") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                        F.get(share, F.col("p")).alias("explained"), F.lit(error).alias("identity_error")))
