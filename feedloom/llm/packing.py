"""Packing token sequences along a space-filling curve.

Each document's token ids are hashed into a vector of BINS counts, projected to DIMS dimensions
and mapped to cells of a grid; the Hilbert index of the cell is its key. Documents are range-
sorted by (key, id), so neighbours on the curve, which have similar vocabulary, stand together
and a key that many copies share is still spread over ranges. Every range is packed as a
stream: sequences of exactly ``length`` tokens are cut from the run of documents, and what is
left at the end of a range is cut into powers of two, which need no padding.

The bounds of the ranges come from a sample, as in Spark's own range partitioning, which would
encode every text a second time for it; they only balance the work, every document is packed.

Defined results: null and empty texts are the end token alone; a document may span sequences,
each token lies in exactly one piece; rows that repeat a doc_id are packed one by one, after
each other; rows without a doc_id come first within their key; an empty table gives no piece.
"""

from __future__ import annotations

import os
import re
import threading
import time
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, give_back_memory, lean
from .shingles import mix64

LENGTH, END = 2048, 1
BINS, DIMS, BITS = 1024, 4, 8
#: Words whose ids a Python worker remembers, at most.
REMEMBER = 650_000
#: Rows for each range whose keys set the range bounds (2,000 at least), and ranges for each shuffle partition.
SAMPLE_PER_RANGE, SAMPLE, RANGES_PER_PARTITION = 20, 2_000, 4
#: Characters that Python, but not the tokenizer, takes for white space.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_MARKS = ".,;:!?#$%&*|"
#: Beyond these letters, lower case may differ between Python and the tokenizer.
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


class Encoder:
    """Token ids of whole texts as little-endian 16- or 32-bit bytes.

    Words between white space are encoded on their own and remembered: the tokenizer composes,
    lowers and splits within them only (tests compare with whole texts)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Encode new words, joined by blanks in lines; tokens go back to words by their place."""
        lines = [words[i:i + 50] for i in range(0, len(words), 50)]
        new = {}
        for line, enc in zip(lines, self.tokenizer.encode_batch([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
            ends = np.cumsum([len(w) + 1 for w in line])
            ids = np.array(enc.ids, self.kind)
            word = np.searchsorted(ends, np.array([a for a, _ in enc.offsets], np.int64), side="right")
            cut = (np.searchsorted(word, np.arange(len(line) + 1)) * ids.itemsize).tolist()
            data = ids.tobytes()
            new.update((w, data[cut[i]:cut[i + 1]]) for i, w in enumerate(line))
        return new

    def _resolve(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of words that are not known. A word that ends in marks after a letter is its
        core's ids and the marks' ids, as the tokenizer splits there."""
        known, todo, parts = self.known, [], []
        for w in missing:
            core = w.rstrip(_MARKS)
            if len(core) < len(w) and core and core[-1].isalpha():
                parts.append((w, core, w[len(core):]))
            else:
                todo.append(w)
        todo += {x for p in parts for x in p[1:]}.difference(known, missing)
        new = self._learn(todo)
        for w, core, marks in parts:
            new[w] = (known.get(core) or new[core]) + (known.get(marks) or new[marks])
        return new

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; words that are new in the group are encoded together."""
        split: list[list[str] | bytes] = []
        for k, text in enumerate(texts):
            text = text or ""
            if k and text == texts[k - 1]:  # copies often stand together
                split.append(split[-1])
            elif _ODD_SPACE.search(text):
                split.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes())
            else:
                # lower case first, as the tokenizer does, so more words are known
                split.append((text.lower() if text.isascii() or not _BEYOND_LATIN.search(text) else text).split())
        known, full = self.known, len(self.known) >= REMEMBER
        missing = set().union(*(x for x in split if isinstance(x, list))).difference(known)
        new = self._resolve(missing) if missing else {}
        known.update(new)
        out: list[bytes] = []
        for k, words in enumerate(split):
            if k and words is split[k - 1]:
                out.append(out[-1])
            else:
                out.append(words if isinstance(words, bytes) else b"".join(map(known.__getitem__, words)))
        if full:  # no room: forget the group's new words
            for w in new:
                del known[w]
        return out

    def encode_all(self, texts: list[str | None], chars: int = 2_000_000) -> list[bytes]:
        """``encode`` over groups of texts of about ``chars`` characters: a word takes ten
        times its bytes while it is looked up."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= chars:
                out += self.encode(group)
                group, size = [], 0
        return out + self.encode(group)


_LOW = -(1 << 63)

_ENCODERS: dict[str, Encoder] = {}
_USED = [0.0]
#: Seconds after which a worker that encodes no more gives up its encoder.
IDLE = 25


def _rest() -> None:
    if time.monotonic() - _USED[0] >= IDLE - 0.5:
        _ENCODERS.clear()
        give_back_memory()


def _task_done() -> None:
    _USED[0] = time.monotonic()
    timer = threading.Timer(IDLE, _rest)
    timer.daemon = True
    timer.start()


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    _USED[0] = time.monotonic()
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _projection() -> np.ndarray:
    """BINS x DIMS of independent standard normals, from hashes of the cell number."""
    u = (mix64(np.arange(1, 2 * BINS * DIMS + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2.0**53
    a, b = np.maximum(u[:BINS * DIMS], 1e-12), u[BINS * DIMS:]
    return (np.sqrt(-2 * np.log(a)) * np.cos(2 * np.pi * b)).reshape(BINS, DIMS)


_PROJECTION = _projection()


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of cells (n, dims): the cells are turned into the
    curve's transposed Gray code axis by axis, and its bits are interleaved."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> b) & 1
    return out


def curve_key(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of rows of projected unit vectors, about standard normal per dimension."""
    cells = np.clip(0.5 * (1 + np.tanh(vectors * 0.8)) * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(cells)


def _bucket(curve: np.ndarray, doc: list, bounds: list[tuple[int, int]]) -> np.ndarray:
    """How many bounds (curve, id) are at most the row's."""
    keys = np.array([c for c, _ in bounds], np.int64)
    out = np.searchsorted(keys, curve, side="left")
    last = np.searchsorted(keys, curve, side="right")
    for i in np.flatnonzero(out < last):
        out[i] = bisect_right(bounds, (int(curve[i]), _LOW if doc[i] is None else doc[i]))
    return out


def _encode(path: str, bounds: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        place = (mix64(np.arange(enc.tokenizer.get_vocab_size(), dtype=np.uint64)) % np.uint64(BINS)).astype(np.int64)
        end = np.array([END], enc.kind).tobytes()
        for b in batches:
            coded, vectors = enc.encode_all(b.column(1).to_pylist()), np.zeros((b.num_rows, DIMS))
            for i, data in enumerate(coded):
                if i and data is coded[i - 1]:
                    vectors[i] = vectors[i - 1]
                    continue
                count = np.bincount(place[np.frombuffer(data, enc.kind)], minlength=BINS)
                vectors[i] = count @ _PROJECTION / max(np.sqrt(count @ count), 1.0)
            ids = [data + end for data in coded]
            curve = curve_key(vectors)
            bucket = _bucket(curve, b.column(0).to_pylist(), bounds)
            yield pa.record_batch([b.column(0), pa.array(bucket.astype(np.int32)), pa.array(curve), pa.array(ids, pa.binary())],
                                  ["doc_id", "bucket", "curve", "ids"])
        _task_done()
    return lean(run)


def _bounds(docs: DataFrame, tokenizer: str, ranges: int) -> list[tuple[int, int]]:
    """Range bounds (curve, id) from a sample that grows with the number of ranges; the driver
    holds two numbers for each of its rows."""
    n = docs.count()
    if not n or ranges < 2:
        return []
    share = min(1.0, max(SAMPLE, SAMPLE_PER_RANGE * ranges) / n)
    got = docs.sample(share, seed=17).mapInArrow(_encode(tokenizer, []), CODED).select("curve", F.coalesce("doc_id", F.lit(_LOW)).alias("id")).toArrow()
    curve, ids = got["curve"].to_numpy(), got["id"].to_numpy()
    order = np.lexsort((ids, curve))
    at = order[[len(order) * i // ranges for i in range(1, ranges)]] if len(order) >= ranges else order[1:]
    return list(zip(curve[at].tolist(), ids[at].tolist(), strict=True))


def _sizes(left: int) -> list[int]:
    """What is left over, as powers of two from the largest."""
    return [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


def _pack(kind: np.dtype, length: int):
    """Streams ranges. Pieces of the sequence being filled are held back, at most ``length``
    tokens of them, until it is full or its range ends. Sequences are numbered within ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number, filled, held = None, 0, 0, []
        out: list[tuple] = []

        def emit(doc, ids, start, total, sequence, offset):
            out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))

        def close():
            nonlocal number, filled, held
            sizes, offset = _sizes(filled), 0
            for doc, part, start, total in held:
                while len(part):
                    n = min(sizes[0] - offset, len(part))
                    emit(doc, part[:n], start, total, number, offset)
                    part, start, offset = part[n:], start + n, offset + n
                    if offset == sizes[0]:
                        sizes, offset, number = sizes[1:], 0, number + 1
            filled, held = 0, []

        for b in batches:
            for doc, at_range, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if at_range != bucket:
                    close()
                    bucket, number = at_range, at_range << 40
                ids, at = np.frombuffer(data, kind), 0
                while at < len(ids):
                    n = min(length - filled, len(ids) - at)
                    held.append((doc, ids[at:at + n], at, len(ids)))
                    filled, at = filled + n, at + n
                    if filled == length:
                        offset = 0
                        for d, part, start, total in held:
                            emit(d, part, start, total, number, offset)
                            offset += len(part)
                        number, filled, held = number + 1, 0, []
            if out:
                yield _pieces(out)
                out.clear()
        close()
        if out:
            yield _pieces(out)
    return run


CODED = "doc_id long, bucket int, curve long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                           [x.split()[0] for x in PIECES.split(", ")])


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """The pieces of all documents. ``tokenizer``: path of a tokenizers file on every executor.

    One shuffle, of token ids."""
    from tokenizers import Tokenizer

    bounded_batches(docs.sparkSession)
    kind = np.dtype("<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else "<u4")
    plain = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))
    coded = plain.mapInArrow(_encode(tokenizer, _bounds(plain, tokenizer, ranges)), CODED)
    # as many ranges to a partition, where hashing the numbers would put some together
    partitions = max(1, -(-ranges // RANGES_PER_PARTITION))
    return (coded.repartitionById(partitions, F.col("bucket") % partitions).sortWithinPartitions("bucket", "curve", "doc_id")
                 .select("doc_id", "bucket", "ids").mapInArrow(_pack(kind, length), PIECES))
