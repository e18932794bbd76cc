"""Prefix trie of conversations: union-find over the LCP edges of sorted neighbours.

Each turn is a 24-byte record: 16 bytes of the SHA-256 of role and text, and the text's length in
code points. A conversation is the string of its records; equal strings are one sequence with a
number of members and a smallest one, so copies of any number are one row. Sequences are sorted
by a range partitioning and written with the depth (turns in common, LCP) to both neighbours.

The sorted rows are then read in blocks, the partitions of the method. In a block, the edges
between neighbours are taken in descending depth, and union-find merges their components: every
merge creates (or, at equal depth, widens) a branching node, whose sums are those of its parts.
Chains of nodes without branches stay contracted until they are written out. Nodes that reach
beyond the block, the prefixes its outer rows share with their neighbours, are written as
partial sums under the hash of their prefix and merged across blocks by one aggregation; every
figure is a sum or least value over sequences once the depth to the global predecessor is known.

Figures of a node of depth d over the sequences s below it, where m are members, L(i) code points of
the first i turns, a the depth shared with the predecessor (-1 for the first), b with the successor:
members sum m; childless nodes count b < len(s); children count a <= d < len(s); saved tokens
are the sum of m * (L(len s) - L(d - 1)) less that of L(len s) - L(max(a, d - 1)).

Defined results: rows without an id take no part; turns are ordered by turn (null first), equal
ones by role and then by the hash of the text; null role or text is empty; repeated rows are
repeated turns; extra columns are not read. A conversation without turns is a member of the
root only. An empty table gives no node. One conversation is held by one task as 24 bytes a
turn, its texts are not; a group of copies of any size is not held by any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, drop_saved, lean, saved, small

RECORD = 24
#: Turns in a block of sorted sequences, at most (a single longer sequence is a block).
BLOCK_TURNS = 200_000
#: Conversations whose ids are joined at a time for the digest of a group of copies.
ID_BLOCK = 4096
NOTHING = hashlib.sha256(b"").hexdigest()
#: Open nodes that may be broadcast to their children.
BROADCAST_NODES = 100_000
NODE = ("open boolean, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def records(df: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, turns): per conversation the hexadecimal records of its turns in order."""
    t = df.select(F.col(id).cast("long").alias("id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                  F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("id").isNotNull())
    digest = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256), 1, 32)
    record = F.concat(digest, F.lpad(F.hex(F.length("text").cast("long")), 16, "0"))
    one = t.select("id", F.struct(F.col("turn").isNotNull().alias("given"), "turn", "role", record.alias("record")).alias("t"))
    return one.groupBy("id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda x: x["record"]).alias("turns"))


def start_length(id: Column) -> Column:
    """Turns that a rebuilt conversation takes from the head of its hundred."""
    return (F.crc32(id.cast("string")) % 6).cast("int")


def joined(turns: Column) -> Column:
    """The sequence of hexadecimal records."""
    return F.unhex(F.array_join(turns, ""))


def rebuild(conversations: DataFrame) -> DataFrame:
    """(id, seq) of (id, turns): the first ``start_length`` turns come from conversation
    id - id % 100, the others are the conversation's own. At most 199 ids share a head."""
    heads = conversations.where(F.col("id") % 100 == 0).select(F.col("id").alias("head"), F.slice("turns", 1, 5).alias("start"))
    own = conversations.withColumn("head", F.col("id") - F.col("id") % 100).withColumn("h", start_length(F.col("id")))
    start = F.coalesce(F.slice("start", F.lit(1), F.col("h")), F.array().cast("array<string>"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "head", "left").select("id", joined(F.concat(start, rest)).alias("seq"))


def digests(members: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending ids of each key, joined by commas. Ids are joined in
    blocks of neighbouring ones first; the blocks of a key then pass through one hash in order,
    without being held."""
    blocks = members.groupBy("key", F.floor(F.col("id") / ID_BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            out = []
            for key, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if key == last:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ids.encode())
            yield _pairs(out)
        if state is not None:
            yield _pairs([(last, state.hexdigest())])

    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(lean(run), "key binary, ends string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                      names=["key", "ends"])


def sequences(rebuilt: DataFrame) -> DataFrame:
    """(seq, members, least, ends): one row per distinct sequence."""
    keyed = rebuilt.select("id", "seq", F.unhex(F.sha2("seq", 256)).alias("key"))
    groups = keyed.groupBy("key", "seq").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("least"))
    return groups.join(digests(keyed.select("key", "id")), "key").select("seq", "members", "least", "ends")


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b)) // RECORD
    if a[:n * RECORD] == b[:n * RECORD]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo * RECORD:mid * RECORD] == b[lo * RECORD:mid * RECORD]:
            lo = mid
        else:
            hi = mid
    return lo


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted sequences of a partition with their place and the turns shared with the row before
    and after; null at the partition's ends."""
    part, pos, held, shared = TaskContext.get().partitionId(), 0, None, None
    for b in batches:
        out = []
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held is not None:
                after = common_turns(held[0], row[0])
                out.append((part, pos, *held, shared, after))
                pos, shared = pos + 1, after
            held = row
        yield _placed(out)
    if held is not None:
        yield _placed([(part, pos, *held, shared, None)])


_PLACED = [("part", pa.int32()), ("pos", pa.int64()), ("seq", pa.binary()), ("members", pa.int64()), ("least", pa.int64()),
           ("ends", pa.string()), ("before", pa.int64()), ("after", pa.int64())]


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_PLACED)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _PLACED, strict=True)], names=[n for n, _ in _PLACED])


def edge_depths(placed: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """For each sort partition with rows, the turns its first sequence shares with the last of
    the partition before (-1 for the very first), and its last with the first after. The
    driver holds two numbers for each partition."""
    spark = placed.sparkSession
    ends = placed.where(F.col("before").isNull() | F.col("after").isNull())
    parts = sorted(r["part"] for r in ends.select("part").distinct().collect())
    before, after = {p: -1 for p in parts[:1]}, {p: -1 for p in parts[-1:]}
    if len(parts) > 1:
        follows = F.broadcast(spark.createDataFrame(list(zip(parts, parts[1:], strict=False)), "part int, next int"))
        last = ends.where(F.col("after").isNull()).join(follows, "part").select("part", "next", F.col("seq").alias("a"))
        first = ends.where(F.col("before").isNull()).select(F.col("part").alias("next"), F.col("seq").alias("b"))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                shared = [common_turns(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared, pa.int64())], names=["part", "next", "d"])

        pairs = last.join(first, "next").select("part", "next", "a", "b")
        for r in pairs.mapInArrow(compare, "part int, next int, d long").collect():
            after[r["part"]], before[r["next"]] = r["d"], r["d"]
    return before, after


class Forest:
    """The nodes of one block: sorted neighbouring sequences (seq, members, least, ends, before, after)."""

    def __init__(self, rows: list[tuple]):
        self.rows, n = rows, len(rows)
        self.lengths = [len(r[0]) // RECORD for r in rows]
        self.sums = [np.concatenate([[0], np.cumsum(np.frombuffer(r[0], ">u8").reshape(-1, RECORD // 8)[:, 2].astype(np.int64))]).tolist()
                     if r[0] else [0] for r in rows]
        self.root = list(range(n))     # union-find over rows
        self.top = list(range(n))      # of a component's root: its node
        # a node: depth, first row, members, least id, childless nodes, children, code points of
        # members, code points that its rows have beyond what they share with their predecessors
        self.nodes: list[list[int]] = []
        self.parent: list[int] = []
        for i, (_, m, least, _, a, b) in enumerate(rows):
            total = self.sums[i][-1]
            length = self.lengths[i]
            self.nodes.append([length, i, m, least, int(b < length), 0, m * total, total - self.sums[i][max(a, 0)]])
            self.parent.append(-1)
        for depth, i in sorted(((rows[i][5], i) for i in range(n - 1)), key=lambda e: (-e[0], e[1])):
            self._union(i, i + 1, depth)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def _union(self, i: int, j: int, depth: int) -> None:
        x, y = self._find(i), self._find(j)
        a, b = self.top[x], self.top[y]
        left, right = self.nodes[a], self.nodes[b]
        if left[0] != depth:  # a merge creates a branching node, at equal depth it widens the left one
            self.nodes.append([depth, left[1], left[2], left[3], left[4], 0, left[6], left[7]])
            self.parent[a] = len(self.parent)
            self.parent.append(-1)
            a = self.parent[a]
            left = self.nodes[a]
        self.parent[b] = a
        left[2] += right[2]
        left[3] = min(left[3], right[3])
        left[4] += right[4]
        left[5] += 1  # the right part begins a child here
        left[6] += right[6]
        left[7] += right[7]
        self.root[y] = x
        self.top[x] = a

    def write(self) -> list[tuple]:
        """NODE rows: closed nodes, and partial sums of the open ones."""
        rows, out = self.rows, []
        # prefixes this long reach beyond the block
        self.left, self.right = _prefix_hashes(rows[0][0], rows[0][4] + 1), _prefix_hashes(rows[-1][0], rows[-1][5] + 1)
        below, node = set(), len(rows) - 1  # the nodes that hold the last row
        while node >= 0:
            below.add(node)
            node = self.parent[node]
        for v, (depth, f, m, least, leaves, children, weight, beyond) in enumerate(self.nodes):
            up = self.parent[v]
            top = self.nodes[up][0] if up >= 0 else -1
            a, length, ends, sums = rows[f][4], self.lengths[f], rows[f][3], self.sums[f]
            for d in range(top + 1, depth + 1):
                children_here = int(a <= d < length) + (children if d == depth else 0)
                saved_here = weight - m * sums[max(d - 1, 0)] - (beyond - (sums[max(a, d - 1, 0)] - sums[max(a, 0)]))
                key = self._open_key(v, d, below)
                over = up if d - 1 == top else v  # what the node of depth d - 1 is part of
                above = self._open_key(over, d - 1, below) if d else None
                least_above = None if d == 0 or above is not None else self.nodes[over][3]
                out.append((key is not None, key, above, d, least, least_above, m, children_here, leaves, saved_here,
                            ends if d == length else None))
        return out

    def _open_key(self, v: int, d: int, below: set[int]) -> bytes | None:
        """The prefix hash of node v, taken at depth d, if it reaches beyond the block."""
        if self.nodes[v][1] == 0 and d < len(self.left):
            return self.left[d]
        return self.right[d] if v in below and d < len(self.right) else None


def _prefix_hashes(seq: bytes, count: int) -> list[bytes]:
    """Hashes of the first ``count`` prefixes, from no turn on."""
    out, state = [], hashlib.sha256()
    for i in range(count):
        if i:
            state.update(seq[(i - 1) * RECORD:i * RECORD])
        out.append(state.copy().digest()[:16])
    return out


def _blocks(batches: Iterator[pa.RecordBatch], before: dict[int, int], after: dict[int, int], most: int) -> Iterator[list[tuple]]:
    """Runs of sequences that follow each other, with both depths known."""
    rows, turns, place = [], 0, None
    for b in batches:
        for part, pos, seq, m, least, ends, a, z in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if rows and (place != (part, pos) or turns >= most):
                yield rows
                rows, turns = [], 0
            rows.append((seq, m, least, ends, before[part] if a is None else a, after[part] if z is None else z))
            turns, place = turns + len(seq) // RECORD + 1, (part, pos + 1)
    if rows:
        yield rows


_NODE_KINDS = [pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]
_NODE_NAMES = [f.split(" ")[0] for f in NODE.split(", ")]


def trie(rebuilt: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Nodes of the prefix trie of (id, seq): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = rebuilt.sparkSession
    bounded_batches(spark)
    ordered = sequences(rebuilt).repartitionByRange(F.col("seq")).sortWithinPartitions("seq")
    kinds = "part int, pos long, seq binary, members long, least long, ends string, before long, after long"
    placed = saved(ordered.mapInArrow(lean(neighbours), kinds), "trie-sorted")
    before, after = edge_depths(placed)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, before, after, block_turns):
            rows = Forest(block).write()
            for lo in range(0, len(rows), 20_000):
                columns = zip(*rows[lo:lo + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _NODE_KINDS, strict=True)], names=_NODE_NAMES)

    nodes = saved(placed.mapInArrow(lean(grow), NODE), "trie-nodes")
    drop_saved(placed)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = nodes.where("open").groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"))
    least = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    every = nodes.where(~F.col("open")).unionByName(merged.withColumn("open", F.lit(True)))
    return every.join(small(least, BROADCAST_NODES), "parent", "left").select(
        "conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
