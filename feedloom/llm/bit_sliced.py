"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers, floor(SCALE * x). A block of rows keeps, for every component,
one bitmap per bit of its offset value. A query's score is the sum of its components' multiples
of those columns: slices are added with bitmap arithmetic (carry-save adders), a negative
component uses the complemented slices, and constant terms are the same for every row, so they
do not change the order. The top rows are selected from the most significant slice of the sum
downward; rows that tie at the k-th place are resolved by the smaller id, and the chosen rows'
scores are computed exactly.

Blocks of rows meet blocks of queries; each pair keeps at most k rows a query, and the best k
of those are the exact answer. No block holds more than BLOCK_ROWS rows.

Defined results: vectors that are null or hold null or non-finite components take no part, as
query or candidate, nor do rows without an id; shorter vectors count as padded with zeros; rows
that repeat a query's id are its own rows and are no candidates of it; scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, saved

SCALE = 64
BLOCK_ROWS = 65_536
#: Queries in a block: a thousandth of them, within these bounds.
LEAST_QUERIES, MOST_QUERIES = 128, 4096


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) per component as long; null if the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def _matrix(lists: pa.Array) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    """Booleans to a bitmap of 64-bit words, the first row in the lowest bit."""
    n = -(-len(bits) // 64) * 64
    return np.packbits(np.pad(bits, (0, n - len(bits))), bitorder="little").view(np.uint64)


class SlicedBlock:
    """Bit slices of a block of rows in rising order of id: row t of ``bits`` is the bitmap of
    bit ``bit[t]`` of component ``part[t]``, offset by the component's least value ``low``."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, depth: np.ndarray, bits: np.ndarray):
        self.ids, self.low = ids, low
        self.part = np.repeat(np.arange(len(low)), depth)
        self.bit = np.concatenate([np.arange(d) for d in depth] or [np.zeros(0, int)]).astype(np.int64)
        self.bits = bits
        begin = np.concatenate([[0], np.cumsum(depth)])
        self.slices = [list(bits[begin[d]:begin[d + 1]]) for d in range(len(low))]
        self.flipped = [[~s for s in one] for one in self.slices]
        self.every = _pack(np.ones(len(ids), bool))

    @staticmethod
    def build(ids: np.ndarray, values: np.ndarray) -> "SlicedBlock":
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        low = values.min(axis=0)
        offset = (values - low).astype(np.uint64)
        depth = np.array([int(x).bit_length() for x in offset.max(axis=0)], np.int64)
        bits = [_pack((offset[:, d] >> np.uint64(b)) & np.uint64(1) == 1) for d in range(len(low)) for b in range(depth[d])]
        return SlicedBlock(ids, low, depth, np.array(bits, np.uint64).reshape(len(bits), -(-len(ids) // 64)))

    def packed(self) -> dict:
        depth = np.bincount(self.part, minlength=len(self.low)).astype(np.int64)
        return {"ids": self.ids.tobytes(), "low": self.low.tobytes(), "depth": depth.tobytes(), "bits": self.bits.tobytes()}

    @staticmethod
    def unpacked(ids: bytes, low: bytes, depth: bytes, bits: bytes) -> "SlicedBlock":
        i, lo, d = (np.frombuffer(x, np.int64) for x in (ids, low, depth))
        return SlicedBlock(i, lo, d, np.frombuffer(bits, np.uint64).reshape(int(d.sum()), -(-len(i) // 64)))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products of some rows."""
        on = (self.bits[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
        return (query[self.part] << self.bit) @ on.astype(np.int64) + query @ self.low

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Bitmaps of the sum, least significant first. Per bit weight, three bitmaps of that
        weight make one of it and one of the next until one is left."""
        weights: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            columns = self.slices[d] if q > 0 else self.flipped[d]
            m = abs(q)
            for shift in range(m.bit_length()):
                if m >> shift & 1:
                    for b, one in enumerate(columns):
                        while len(weights) <= shift + b:
                            weights.append([])
                        weights[shift + b].append(one)
        out, w = [], 0
        while w < len(weights):
            todo = weights[w]
            if len(todo) > 1 and w + 1 == len(weights):
                weights.append([])
            while len(todo) > 2:
                a, b, c = todo.pop(), todo.pop(), todo.pop()
                x = a ^ b
                todo.insert(0, x ^ c)
                x &= c
                x |= a & b
                weights[w + 1].append(x)
            if len(todo) == 2:
                a, b = todo
                weights[w + 1].append(a & b)
                todo = [a ^ b]
            out.append(todo[0] if todo else np.zeros_like(self.every))
            w += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k rows but those of id ``own``."""
        width = len(self.low)
        query = np.pad(query, (0, max(0, width - len(query))))[:width]
        tied = self.every.copy()
        for r in range(np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")):
            tied[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
        chosen, have = np.zeros_like(tied), 0
        for s in reversed(self.score_slices(query)):
            high = tied & s
            n = int(np.bitwise_count(high).sum())
            if have + n > k:
                tied = high
            else:
                chosen |= high
                have += n
                tied &= ~s
                if have == k:
                    break
        rows = np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))
        if have < k:  # the boundary: equal scores, smaller ids first
            rows = np.concatenate([rows, np.flatnonzero(np.unpackbits(tied.view(np.uint8), bitorder="little"))[:k - have]])
        return self.ids[rows], self.scores(rows, query)


def _build(rows: pa.Table) -> pa.Table:
    block = SlicedBlock.build(rows["vec_id"].to_numpy(), _matrix(rows["v"]))
    return pa.table({c: pa.array([x], pa.binary()) for c, x in block.packed().items()})


def _gather(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("vec_id")
    values = _matrix(rows["v"])
    return pa.table({"qb": pa.array([rows["qb"][0].as_py()], pa.int32()),
                     "queries": pa.array([rows["vec_id"].to_numpy().tobytes()], pa.binary()),
                     "q": pa.array([values.tobytes()], pa.binary())})


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # one block of rows and one block of queries
                ids, low, depth, bits, queries, q = (b.column(c)[i].as_py() for c in range(6))
                block, own = SlicedBlock.unpacked(ids, low, depth, bits), np.frombuffer(queries, np.int64)
                values = np.frombuffer(q, np.int64).reshape(len(own), -1)
                found = [block.top(v, k, o) for o, v in zip(own.tolist(), values, strict=True)]
                yield pa.record_batch([pa.array(np.repeat(own, [len(f[0]) for f in found])),
                                       pa.array(np.concatenate([f[0] for f in found])),
                                       pa.array(np.concatenate([f[1] for f in found]).astype(np.int64))],
                                      ["query_id", "vec_id", "score"])
    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the exact k best rows of every query row."""
    bounded_batches(vectors.sparkSession)
    rows = saved(vectors.select(F.col(key).cast("long").alias("vec_id"), quantised(F.col(vector)).alias("v"),
                                F.coalesce(is_query, F.lit(False)).alias("is_query"))
                 .where(F.col("v").isNotNull() & F.col("vec_id").isNotNull()), "quantised")
    n, m = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    row_blocks = max(1, -(-n // BLOCK_ROWS))
    query_blocks = max(1, -(-m // min(MOST_QUERIES, max(LEAST_QUERIES, m // 1024))))
    at = lambda blocks: F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    index = saved(rows.select("vec_id", "v", at(row_blocks).alias("rb")).groupBy("rb").applyInArrow(
        _build, "ids binary, low binary, depth binary, bits binary"), "bit-slices")
    queries = rows.where("is_query").select("vec_id", "v", at(query_blocks).alias("qb")).groupBy("qb").applyInArrow(
        _gather, "qb int, queries binary, q binary")
    # every block of rows meets every block of queries: a grid of bounded pieces
    grid = index.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    found = (grid.join(queries, "qb").select("ids", "low", "depth", "bits", "queries", "q")
                 .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
