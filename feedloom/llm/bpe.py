"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut into units at white space that follows other text, where no match of the pattern
can go on; the pattern splits each distinct unit of a batch into pre-tokens. Tier one is a
minimal perfect hash of the vocabulary (levels of bit arrays whose ranks number the keys):
pre-tokens that are vocabulary entries are resolved by it at once, the stored entry being
compared. Tier two merges what is left: a heap of adjacent pairs, least rank first, over a
linked list of bytes, so a long pre-token costs n log n.

Every row is worked on alone, so rows need no shuffle and a lost executor repeats only its own
batches. Long texts are read in pieces, and a worker remembers a bounded number of units.

Defined results: null texts count as empty and have no ids; bytes that are not UTF-8 count as
U+FFFD; equal rows are encoded one by one; an empty table gives an empty table; a column of the
output's name (in any case) is replaced, other columns are kept. In decoding, null ids stay
null, and an id that is null or not in the vocabulary becomes U+FFFD.
"""

from __future__ import annotations

import base64
import functools
import heapq
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import bounded_batches, lean
from .shingles import byte_powers, mix64, raw_bytes

#: A rank file is sent to every executor; larger files are refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Units and pre-tokens a Python worker remembers before it forgets those not met again (it holds
#: twice as many at most, beside those of one piece), and bytes of text read at a time.
REMEMBER, PIECE = 300_000, 4 << 20
UNKNOWN = "�".encode()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAMMA = 2.0
_pack = struct.pack


def byte_hashes(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings body[at[i]:at[i + 1]]."""
    up, down = byte_powers(len(body) + 1)
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[:len(body)], out=sums[1:])
    return mix64((sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]] ^ (np.diff(at).astype(np.uint64) << np.uint64(40)))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: ``slots`` numbers the keys 0 to n - 1.

    Each level maps the keys left over to twice as many bits and keeps those alone on their
    bit; a key's number is the rank of its bit over all levels. Keys outside the set get some
    slot or -1."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.uint64, int, np.ndarray, np.ndarray]] = []
        base, left, seed = 0, keys, 0
        while len(left):
            seed += 1
            salt, size = mix64(np.array([seed], np.uint64))[0], int(len(left) * _GAMMA) + 1
            at = (mix64(left ^ salt) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            self.levels.append((salt, size, alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            left = left[~alone[at]]
            if seed > 200:
                raise ValueError("keys of a perfect hash must be distinct")

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for salt, size, alone, rank in self.levels:
            if not len(todo):
                break
            at = (mix64(keys[todo] ^ salt) % np.uint64(size)).astype(np.int64)
            hit = alone[at]
            out[todo[hit]] = rank[at[hit]]
            todo = todo[~hit]
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of least rank is merged first, the leftmost of
    equals. ``after[i]`` is where the part that starts at byte i ends and the next one starts;
    0 once byte i is inside a part. An entry of the heap is void if its two parts are gone."""
    n = len(piece)
    width = n.bit_length()
    low, mid = (1 << width) - 1, 2 * width
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    # an entry is (rank, start, end) packed into one integer, which compares like the triple
    heap = [r << mid | i << width | i + 2 for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        i, end = entry >> width & low, entry & low
        j = after[i]
        if j == 0 or j >= end or after[j] != end:
            continue
        after[i], after[j] = end, 0
        if end < n:
            before[end] = i
            far = after[end]
            r = get(piece[i:far])
            if r is not None:
                push(heap, r << mid | i << width | far)
        left = before[i]
        if left >= 0:
            r = get(piece[left:end])
            if r is not None:
                push(heap, r << mid | left << width | end)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Vocabulary:
    """A rank file (one ``base64 rank`` line per entry) and the pattern that splits texts."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        self.limit = max(self.ranks.values()) + 1
        entries = list(self.ranks)
        body = np.frombuffer(b"".join(entries), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(e) for e in entries])]).astype(np.int64)
        keys = byte_hashes(body, at)
        self.hash = PerfectHash(keys)
        order = np.argsort(self.hash.slots(keys))
        self.entry_at = pa.array([entries[i] for i in order], pa.binary())
        self.id_at = np.array([self.ranks[entries[i]] for i in order], np.int32)
        by_id = [UNKNOWN] * (self.limit + 1)
        for entry, rank in self.ranks.items():
            by_id[rank] = entry
        self.bytes_of = pa.array(by_id, pa.large_binary())
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def whole(self, pieces: list[bytes]) -> np.ndarray:
        """Ids of the pre-tokens that are entries of the vocabulary, -1 for the others."""
        at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        slots = self.hash.slots(byte_hashes(np.frombuffer(b"".join(pieces), np.uint8), at))
        stored = self.entry_at.take(pa.array(np.maximum(slots, 0)))
        same = pc.equal(stored, pa.array(pieces, pa.binary())).to_numpy(zero_copy_only=False)
        return np.where(same & (slots >= 0), self.id_at[np.maximum(slots, 0)], -1)

    def learn(self, units: list[bytes]) -> None:
        """Encode units and remember their ids as little-endian 32-bit bytes."""
        known, find = self.known, self.pattern.findall
        split = [[t.encode() for t in find(u.decode("utf-8", "replace"))] for u in units]
        pieces = []
        for p in dict.fromkeys(p for parts in split for p in parts):
            if p not in known:
                if (found := self.older.get(p)) is None:
                    pieces.append(p)
                else:
                    known[p] = found
        for piece, i in zip(pieces, self.whole(pieces).tolist() if pieces else [], strict=True):
            ids = (i,) if i >= 0 else merge(piece, self.ranks)
            known[piece] = _pack(f"<{len(ids)}i", *ids)
        for unit, parts in zip(units, split, strict=True):
            if len(parts) > 1:
                known[unit] = b"".join([known[p] for p in parts])
            elif unit not in known:  # bytes that are not UTF-8
                known[unit] = known[parts[0]]

    def encode_bytes(self, body: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each unit) of the units between the sorted ``cuts``."""
        view = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1,
                                                [None, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(body)])
        coded = view.dictionary_encode()
        units = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBER:  # what was not met since the last change is forgotten
            self.known, self.older = {}, self.known
        new = []
        for u in units:
            if u not in self.known:
                if (ids := self.older.get(u)) is None:
                    new.append(u)
                else:
                    self.known[u] = ids
        self.learn(new)
        parts = [self.known[u] for u in units]
        flat = np.frombuffer(b"".join(parts), "<i4")
        count = np.array([len(p) for p in parts], np.int64) // 4
        start = np.cumsum(count) - count
        at = coded.indices.to_numpy()
        counts = count[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(start[at] - (ends - counts), counts) + np.arange(total)], counts

    def encode_column(self, texts: pa.Array) -> pa.ListArray:
        body, at = raw_bytes(texts)
        ids, sizes, lo = [], np.zeros(len(texts), np.int64), 0
        while lo < len(body):
            cuts = unit_cuts(body, at, lo)
            got, counts = self.encode_bytes(body[lo:cuts[-1]], cuts - lo)
            ids.append(got)
            np.add.at(sizes, np.searchsorted(at, cuts[:-1], "right") - 1, counts)
            lo = int(cuts[-1])
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))

    def decode_column(self, ids: pa.Array) -> pa.Array:
        ids = ids.cast(pa.large_list(pa.int64()))
        at = ids.offsets.to_numpy().astype(np.int64)
        values = ids.values.slice(at[0], at[-1] - at[0]).fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.where((values >= 0) & (values < self.limit), values, self.limit)
        joined = self.bytes_of.take(pa.array(known))
        _, ends, data = joined.buffers()
        offsets = np.frombuffer(ends, np.int64)[:len(known) + 1] if len(known) else np.zeros(1, np.int64)
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [
            None, pa.py_buffer(np.ascontiguousarray(offsets[at - at[0]])), data if data is not None else pa.py_buffer(b"")])
        return pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def unit_cuts(body: np.ndarray, at: np.ndarray, lo: int) -> np.ndarray:
    """Cut positions of the next piece of ``body`` from ``lo`` on, first and last included: the
    starts of texts and the white space that follows a character that is none. The piece is
    about PIECE bytes long and ends at a cut."""
    size = PIECE
    while True:
        hi = min(lo + size, len(body))
        from_ = max(lo - 3, 0)
        b = body[from_:hi]
        space = _SPACE[b]
        cut = np.zeros(len(b), bool)
        cut[1:] = space[1:] & ~space[:-1]
        # characters beyond ASCII may be white space too: they end in 85 or A0 after C2, or
        # have three bytes, of which the first two are looked at
        cut[2:] &= ~((b[:-2] == 0xC2) & ((b[1:-1] == 0x85) | (b[1:-1] == 0xA0)))
        starts = at[np.searchsorted(at, lo, "right"):np.searchsorted(at, hi)]
        cut[3:] &= ~((b[:-3] >= 0xE1) & (b[:-3] <= 0xE3) & ((b[1:-2] == 0x80) | (b[1:-2] == 0x81) | (b[1:-2] == 0x9A)))
        cut[starts - from_] = True
        cut[:lo - from_ + 1] = False
        cuts = np.flatnonzero(cut) + from_
        if hi == len(body):
            return np.concatenate([[lo], cuts, [hi]])
        if len(cuts):
            return np.concatenate([[lo], cuts])
        size *= 2


@functools.lru_cache(maxsize=2)
def _vocabulary(data: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(data, pattern)


def send_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file as a broadcast; only the driver needs the path."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary has at most {MAX_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def _mapped(df: DataFrame, column: str, out: str, kind: T.DataType, keep: Sequence[str] | None, work) -> DataFrame:
    """``df`` (its columns ``keep``) with the column ``out`` that ``work`` makes of ``column``."""
    bounded_batches(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() != out.lower()]
    spot = [c.lower() for c in df.columns].index(column.lower())
    spots = [df.columns.index(c) for c in kept]
    schema = T.StructType([df.schema[i] for i in spots] + [T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in spots), work(b.column(spot))], names=[*kept, out])

    return df.mapInArrow(lean(run), schema)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids",
           keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``, by default all) with the token ids of ``text`` as array<int>."""
    sent = send_vocabulary(df.sparkSession, path)
    return _mapped(df, text, out, T.ArrayType(T.IntegerType()), keep,
                   lambda column: _vocabulary(sent.value, pattern).encode_column(column))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded",
           keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``, by default all) with the bytes that the ids stand for."""
    sent = send_vocabulary(df.sparkSession, path)
    return _mapped(df, ids, out, T.BinaryType(), keep,
                   lambda column: _vocabulary(sent.value, pattern).decode_column(column))
