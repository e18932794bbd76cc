"""Order MinHash fingerprints: signatures whose agreement follows the edit distance.

A text's k-mers (``K`` code points, as bytes of UTF-32) are numbered by occurrence, so a
repeated k-mer counts as often as it stands. For each of ``M`` hash functions the ``L`` numbered
k-mers of least hash are selected, put back into the order in which they stand in the text, and
hashed as a tuple to 16 bits. Two texts agree in a place if the same k-mers were selected in the
same order, so a moved block lowers the agreement, which plain MinHash does not see. The
fingerprint is the M values as hexadecimal text; the likeness of two fingerprints is the share
of equal values.

Defined results: texts shorter than K give one k-mer of the whole text; null counts as the empty
text, whose fingerprint agrees with empty texts alone; a text with fewer than L k-mers gives
tuples of what there is. Long texts are hashed in pieces, so work memory is a small multiple of
the longest text. Rows without a key come first in the order of documents; rows that repeat a
key are ordered by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import bounded_batches
from .shingles import mix64

K, L, M = 6, 2, 64
#: Items are hashed in pieces of this many k-mers (M rows of 32-bit values each).
PIECE = 4096
_MULTIPLY = (mix64(np.arange(1, M + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)[:, None]
_FLIP = (mix64(np.arange(M + 1, 2 * M + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)[:, None]
_WORK = np.empty((M, PIECE), np.uint32)  # one Python worker runs one task at a time
_POSITION_BITS = 20
#: Blocks of neighbouring documents; the table of block heads has at most one row for each.
MAX_BLOCKS, LEAST_ROWS = 8192, 64


def _kmers(codes: np.ndarray) -> np.ndarray:
    """Hash of the k-mer at each place."""
    n = max(len(codes) - K + 1, 1)
    acc = np.full(n, len(codes) if len(codes) < K else K, np.uint64)
    for j in range(min(K, len(codes))):
        acc = (acc ^ codes[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return mix64(acc)


def _numbered(h: np.ndarray) -> np.ndarray:
    """32-bit hash of (k-mer, how many times it stood before)."""
    n = len(h)
    top = h >> np.uint64(_POSITION_BITS)
    if n < 1 << _POSITION_BITS:  # sort hash and place in one word
        order = np.sort((top << np.uint64(_POSITION_BITS)) | np.arange(n, dtype=np.uint64))
        value, place = order >> np.uint64(_POSITION_BITS), (order & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    else:
        place = np.argsort(top, kind="stable")
        value = top[place]
    again = np.flatnonzero(value[1:] == value[:-1]) + 1
    items = h.copy()
    if len(again):
        run = np.ones(n, np.int64)
        run[0] = 0
        run[again] = 0
        first = np.maximum.accumulate(np.where(run == 1, np.arange(n), 0))
        occurrence = (again - first[again]).astype(np.uint64)
        items[place[again]] = mix64(h[place[again]] + occurrence * np.uint64(0xD6E8FEB86659FD93))
    return (items >> np.uint64(32)).astype(np.uint32)


def sketch(text: str) -> np.ndarray:
    """M values of 16 bits."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = _kmers(codes)
    items = _numbered(h)
    rows, best_v, best_p = np.arange(M), [], []
    for at in range(0, len(items), PIECE):
        piece = items[None, at:at + PIECE]
        v = _WORK[:, :piece.shape[1]]
        np.bitwise_xor(piece, _FLIP, out=v)
        np.multiply(v, _MULTIPLY, out=v)
        for _ in range(min(L, v.shape[1])):
            p = v.argmin(axis=1)
            best_v.append(v[rows, p])
            best_p.append(p + at)
            v[rows, p] = 0xFFFFFFFF
    values, places = np.stack(best_v, axis=1), np.stack(best_p, axis=1)
    if values.shape[1] > L:  # least of all pieces; the earlier place wins a tie
        order = np.lexsort((places, values), axis=1)[:, :L]
        places = np.take_along_axis(places, order, axis=1)
    places = np.sort(places, axis=1)
    acc = np.full(M, places.shape[1], np.uint64)
    for j in range(places.shape[1]):
        acc = mix64(acc * np.uint64(31) + h[places[:, j]])
    return (acc >> np.uint64(48)).astype(np.uint16)


def fingerprint(values: np.ndarray) -> str:
    return values.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last quarter (rounded down) replaced by as much of the following text's start."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _ordered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(block, copy, doc_id, text): the documents in blocks of neighbouring ids; at each block's
    end (copy = 1) stands a copy of the document that follows it, the first after the last.

    Block bounds are quantiles of the ids, at most MAX_BLOCKS, so their table is bounded."""
    spark = docs.sparkSession
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    stats = plain.agg(F.count("doc_id").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    blocks = max(1, min(MAX_BLOCKS, stats["n"] // LEAST_ROWS))
    cuts = []
    if stats["n"]:
        shares = [float(i) / blocks for i in range(1, blocks)] or [0.5]
        cuts = plain.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(4 * MAX_BLOCKS))).first()[0]
    bounds = np.unique(np.array(cuts if blocks > 1 else [], np.int64))

    @F.arrow_udf(IntegerType())
    def block_of(ids: pa.Array) -> pa.Array:
        return pa.array((np.searchsorted(bounds, ids.to_numpy(), side="right") + 1).astype(np.int32))

    # block 0 holds the rows without an id
    keyed = plain.withColumn("block", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(
        block_of(F.coalesce("doc_id", F.lit(0)))))
    heads = keyed.groupBy("block").agg(F.min("doc_id").alias("head")).collect()  # at most MAX_BLOCKS + 2
    order = sorted((r["block"], r["head"]) for r in heads)
    copies = [(order[i - 1][0], b, h) for i, (b, h) in enumerate(order)]
    if not copies:
        return keyed.select("block", F.lit(0).alias("copy"), "doc_id", "text")
    to = spark.createDataFrame(copies, "before int, hb int, head long")
    both = keyed.join(F.broadcast(to), (F.col("block") == F.col("hb")) & F.col("doc_id").eqNullSafe(F.col("head")), "left")
    places = F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("copy")),
                     F.struct(F.col("before").alias("block"), F.lit(1).alias("copy")))
    return both.select(F.explode(places).alias("at"), "doc_id", "text").where(F.col("at.block").isNotNull()).select(
        "at.block", "at.copy", "doc_id", "text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, copy, doc_id, text); emits each document once its next is known."""
    held = None  # block, id, text, sketch
    done = None  # block that already has its closing copy

    def row(own, following, follow_sketch):
        other = edited(own[2], following)
        s = sketch(other)
        return (own[1], len(own[2]), hashlib.sha256(other.encode()).hexdigest(), fingerprint(own[3]), fingerprint(s),
                likeness(own[3], s), likeness(own[3], follow_sketch))

    for batch in batches:
        out = []
        for block, copy, key, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if copy and done == block:
                continue
            now = (block, key, text, sketch(text))
            if held is not None and held[0] == block:
                out.append(row(held, text, now[3]))
            held, done = (None, block) if copy else (now, done)
        if out:
            cols = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], COLUMNS)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and both likenesses.

    One shuffle of the texts: blocks of neighbouring ids are sorted and read as a stream."""
    bounded_batches(docs.sparkSession)
    rows = _ordered(docs, key, text).repartition("block").sortWithinPartitions("block", "copy", F.col("doc_id").asc_nulls_first(), "text")
    return rows.mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                     "edited_fingerprint string, near_edited double, near_next double")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row, without a shuffle."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([fingerprint(sketch(t or "")) for t in b.column(1).to_pylist()])],
                                  ["key", "fingerprint"])
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), text).mapInArrow(run, f"key {kind}, fingerprint string")
