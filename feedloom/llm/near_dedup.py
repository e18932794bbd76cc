"""MinHash near-duplicates through a multi-index Hamming join.

A document's set is its distinct five-word shingles. Its signature has ``CHUNKS * WIDTH``
symbols, each the low ``b`` = 16 bits of one MinHash. The Hamming distance of two signatures
is the number of symbols that differ. By the pigeonhole principle two signatures within
``CHUNKS * (ERRORS + 1) - 1`` symbols agree in some chunk up to ``ERRORS`` symbols, so
enumerating every choice of ``ERRORS`` left-out symbols of every chunk as an index key
guarantees that all such pairs meet under a key. With 14 chunks of 5 symbols and one error
that is every pair within 27 of 70 symbols, and a pair of Jaccard similarity 0.75 (expected
distance 17.5) shares a key with probability 1 - 8e-7.

Equal sets are one class from the start, so copies are never paired. Shingles that stand in one
candidate's set only can be in no intersection, which bounds every pair's similarity from three
numbers; pairs that cannot reach 0.75 are never made. Under each key, members are first compared with the key's smallest member; confirmed links are merged into components.
Only keys that still hold several components are looked at again. There, shingles of many
holders (heavy) and of few (light) are told apart: two documents can be similar by their heavy
shingles alone, and then meet under the key, or they share a light one, and then meet under
that; either way only pairs of different components with one outside the key's largest one
are made. Under a key, one of the two must hold six sevenths of its shingles as heavy ones, or
their heavy shingles cannot reach 0.75; so documents of one template that all differ by more are
never paired. Every pair made is confirmed on the full sets, whatever its signatures' distance.

Defined results: null or blank texts have an empty set, link to nothing and are kept; of rows
that share a doc_id each has the component of its own text, and links of texts that the id itself
represents are joined; keep_one decides such rows by their texts; rows without a doc_id
join no links, have a null component_id and are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, drop_saved, lean, saved
from .components import components
from .shingles import mix64, shingles

SHINGLE = 5
CHUNKS, WIDTH, ERRORS = 14, 5, 1
SYMBOLS = CHUNKS * WIDTH
#: A shingle is light if at most so many of the documents in open keys hold it.
LIGHT = 16
#: Hash parts of the heavy shingles' numbers.
PARTS = 16
_H = [f"h{i}_" for i in range(PARTS)]
#: Ids of texts to read again for confirmation are broadcast up to this many; else joined.
BROADCAST_IDS = 1_000_000
_SEEDS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64)) | np.uint64(1)


def _ranges(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    return counts, np.concatenate([[0], np.cumsum(counts)])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        row, h = shingles(batch.column(2), SHINGLE)
        counts, at = _ranges(row, n)
        full = np.flatnonzero(counts)
        cls, sig = np.zeros((n, 2), np.uint64), np.zeros((n, SYMBOLS), np.uint16)
        if len(full):
            starts = at[full]
            cls[full, 0] = np.add.reduceat(h, starts)
            cls[full, 1] = np.add.reduceat(mix64(h ^ np.uint64(0xA5A5A5A5)), starts)
            for j in range(SYMBOLS):
                sig[full, j] = (mix64(np.minimum.reduceat(h * _SEEDS[j], starts)) & np.uint64(0xFFFF)).astype(np.uint16)
        cls[:, 1] ^= counts.astype(np.uint64) << np.uint64(40)
        some = counts == 0
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts.astype(np.int64)),
                               pa.array([None if e else c.tobytes() for e, c in zip(some, cls, strict=True)], pa.binary()),
                               pa.array([None if e else s.tobytes() for e, s in zip(some, sig, strict=True)], pa.binary())],
                              ["doc_id", "text_hash", "n_shingles", "cls", "sig"])


def _plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(text).alias("text"))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, sig) per row: cls is a 128-bit digest of the set,
    null if the set is empty."""
    bounded_batches(docs.sparkSession)
    return _plain(docs, key, text).mapInArrow(
        lean(_signatures), "doc_id long, text_hash long, n_shingles long, cls binary, sig binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index keys of each class: every chunk with every choice of left-out symbols."""
    for batch in batches:
        n = batch.num_rows
        sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(n, SYMBOLS).astype(np.uint64)
        keys = np.empty((n, CHUNKS * WIDTH), np.uint64)
        for c in range(CHUNKS):
            part = sig[:, c * WIDTH:(c + 1) * WIDTH]
            terms = mix64(part + (np.arange(1, WIDTH + 1, dtype=np.uint64) << np.uint64(20)))
            total = terms.sum(axis=1, dtype=np.uint64)
            for j in range(WIDTH):  # ERRORS = 1: one symbol may differ
                keys[:, c * WIDTH + j] = mix64(total - terms[:, j] + np.uint64(c * WIDTH + j + 1))
        node = np.repeat(batch.column(0).to_numpy(), CHUNKS * WIDTH)
        yield pa.record_batch([pa.array(node), pa.array(keys.ravel().view(np.int64))], ["node", "key"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, h = shingles(batch.column(1), SHINGLE)
        _, at = _ranges(row, batch.num_rows)
        lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
        yield pa.record_batch([batch.column(0), lists], ["node", "items"])


def _node_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, items): the full sets of some nodes (node, text_hash), from the texts again."""
    # nodes is a saved table: its files hold the count
    few = F.broadcast(nodes) if nodes.count() <= BROADCAST_IDS else nodes
    rows = docs.join(few, (docs["doc_id"] == nodes["node"]) & (docs["text_hash"] == nodes["text_hash"]))
    return rows.select("node", "text").mapInArrow(lean(_sets), "node long, items array<long>")


def _bounds(sets: DataFrame) -> DataFrame:
    """(node, n, c): size of a node's set, and how many of its shingles stand in another
    candidate's set as well. No intersection is larger than c. A shingle that stands in one
    set only names its node by the minimum, so one aggregation finds c."""
    lone = (sets.select("node", F.explode("items").alias("item")).groupBy("item")
                .agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node")).where(F.col("df") == 1)
                .groupBy("node").agg(F.count(F.lit(1)).alias("lone")))
    sizes = sets.groupBy("node").agg(F.min(F.size("items")).alias("n"), F.max(F.size("items")).alias("most"),
                                     F.count(F.lit(1)).alias("sets"))
    # a doc_id with several texts keeps the widest bound
    c = F.when(F.col("sets") == 1, F.col("n") - F.coalesce("lone", F.lit(0))).otherwise(F.col("most"))
    return sizes.join(lone, "node", "left").select("node", "n", c.cast("int").alias("c"))


def _split_items(sets: DataFrame, open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shingles of the nodes in open keys, split by how many of these nodes hold them.

    heavy: (node, n, h0, h1, ..., strong) with the numbers of a node's shingles that more than LIGHT
    nodes hold, by PARTS hash parts; the sum of two nodes' smaller numbers bounds their heavy
    intersection. light: (node, component, out, item) of the others that two nodes hold."""
    nodes = open_.groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.max("out").alias("out"))
    nodes = saved(nodes, "open-nodes")
    items = saved(sets.join(nodes, "node").select("node", "component", "out", F.explode("items").alias("item")), "open-items")
    held = items.groupBy("item").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    marked = saved(items.join(held, "item"), "open-items")
    part = F.pmod("item", F.lit(PARTS))
    many = marked.where(F.col("df") > LIGHT).groupBy("node").agg(*(F.count_if(part == i).cast("int").alias(h) for i, h in enumerate(_H)))
    heavy = nodes.join(many, "node", "left").select("node", "n", *(F.coalesce(h, F.lit(0)).alias(h) for h in _H))
    return saved(heavy.withColumn("strong", _strong()), "heavy"), marked.where(F.col("df") <= LIGHT).drop("df")


def _light_pairs(heavy: DataFrame, light: DataFrame) -> DataFrame:
    """Pairs of different components that share a light shingle and may be similar: their
    intersection is at most their light overlap, counted here, and the smaller heavy count. A
    light shingle has at most LIGHT holders, so the pairs grow with the rows."""
    x = light.where("out").select("item", F.col("node").alias("x"), F.col("component").alias("cx"))
    y = light.select("item", F.col("node").alias("y"), F.col("component").alias("cy"), F.col("out").alias("oy"))
    w = (x.join(y, "item").where((F.col("cx") != F.col("cy")) & ((F.col("x") < F.col("y")) | ~F.col("oy")))
          .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("w")))
    for v in "ab":
        w = w.join(heavy.select(F.col("node").alias(v), *(F.col(c).alias(c + v) for c in ("n", *_H))), v)
    return w.where(_reaches(F.col("w") + _heavy_bound())).select("a", "b")


def _reaches(common):
    """Whether sets of na and nb shingles with at most ``common`` in common can be similar."""
    return common * 100 >= (F.col("na") + F.col("nb") - common) * 75


def _possible():
    return _reaches(F.least("ca", "cb", "na", "nb"))


def _heavy_bound():
    return reduce(add, (F.least(f"{h}a", f"{h}b") for h in _H))


def _strong():
    """Whether a set can be similar by its h heavy shingles alone to a set of its size. Of two
    similar sets one can: 7 * h >= 3 * (na + nb) holds for the h of both, so the smaller set has
    7 * h >= 6 * n."""
    return reduce(add, map(F.col, _H)) * 7 >= F.col("n") * 6


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b): pairs whose full sets have 100 * intersection >= 75 * union."""
    left = saved(pairs.distinct(), "pairs").join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    ok = common * 100 >= (F.size("x") + F.size("y") - common) * 75
    return saved(both.where(ok).select("a", "b"), "confirmed")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    plain = _plain(docs, key, text)
    sigs = saved(signatures(docs, key, text), "signatures")
    # one node per distinct set: the smallest doc_id that has it, with a text to read it from
    least = F.min(F.struct("doc_id", "text_hash", "sig"))
    reps = saved(sigs.where(F.col("cls").isNotNull() & F.col("doc_id").isNotNull())
                     .groupBy("cls").agg(least.alias("r"))
                     .select("cls", F.col("r.doc_id").alias("node"), "r.text_hash", "r.sig"), "classes")
    keys = reps.select("node", "sig").mapInArrow(lean(_keys), "node long, key long")
    many = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = saved(keys.join(many.select("key"), "key"), "shared-keys")
    nodes = saved(reps.select("node", "text_hash").join(shared.select("node").distinct(), "node", "left_semi"), "candidates")
    sets = saved(_node_sets(plain, nodes), "sets")
    # candidates that can be similar to any other
    bounds = _bounds(sets).where(F.col("c") * 100 >= F.col("n") * 75)
    member = saved(shared.join(bounds, "node"), "members")
    drop_saved(shared)

    def side(df: DataFrame, x: str, *more, numbers=("n", "c")) -> DataFrame:
        return df.select("key", *(F.col(c).alias(f"{c}{x}") for c in ("node", *numbers)), *more)

    heads = side(member.groupBy("key").agg(F.min_by(F.struct("node", "n", "c"), "node").alias("h"))
                       .select("key", "h.*"), "a")
    star = (side(member, "b").join(heads, "key").where((F.col("nodea") != F.col("nodeb")) & _possible())
            .select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")))
    found = saved(components(_confirm(star, sets)), "components")
    # keys that still hold several components: who is outside a key's largest one meets the others
    member = saved(member.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "members")
    sizes = member.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    tops = (sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("top"),
                                     F.count(F.lit(1)).alias("parts")).where(F.col("parts") > 1))
    open_ = saved(member.drop("c").join(tops.select("key", "top"), "key")
                        .withColumn("out", F.col("component") != F.col("top")), "open-keys")
    heavy, light = _split_items(sets, open_)
    open_ = open_.drop("n").join(heavy, "node")
    left = lambda rows: side(open_.where(rows), "a", F.col("component").alias("ca_"), numbers=("n", *_H))
    right = lambda rows: side(open_.where(rows), "b", F.col("component").alias("cb_"), (F.col("out") & F.col("strong")).alias("twin"),
                              numbers=("n", *_H))
    out, strong = F.col("out"), F.col("strong")
    # one with another component outside the largest; one is strong: in a pair of twins the smaller id comes first
    by_key = left(out & strong).join(right(F.lit(True)), "key").unionByName(left(out & ~strong).join(right(~out & strong), "key"))
    by_key = (by_key.where((F.col("ca_") != F.col("cb_")) & _reaches(_heavy_bound()) & ((F.col("nodea") < F.col("nodeb")) | ~F.col("twin")))
                    .select(F.least("nodea", "nodeb").alias("a"), F.greatest("nodea", "nodeb").alias("b")))
    more = _confirm(by_key.unionByName(_light_pairs(heavy, light)), sets)
    final = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = reps.select("cls", "node").join(final, "node", "left").select(
        F.col("cls").alias("_cls"), F.coalesce("component", "node").alias("component"))
    out = sigs.join(named, sigs["cls"] == named["_cls"], "left")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component_id.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per group of near-duplicates: the row of its smallest id. Of equal
    rows, or rows of one id and linked texts, one is kept, of the smallest text; rows of one id and
    texts that are not linked are different documents; rows without an id are kept."""
    marked = F.coalesce(F.xxhash64(text), F.lit(0))
    differ = (docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(marked).alias("lo"), F.max(marked).alias("hi"))
                  .where(F.col("lo") != F.col("hi")))
    if not differ.isEmpty():
        return _keep_by_text(docs, key, text)
    ids = near_duplicates(docs, key, text).where(F.col("kept") & F.col("doc_id").isNotNull())
    rows = _beside(docs, F.col(key), ids.select(F.col("doc_id").alias("kept")).distinct())
    twice = rows.where(F.col("kept").isNotNull()).groupBy("kept").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return rows.select("row.*") if twice.isEmpty() else _first_rows(rows, key, text)


def _beside(docs: DataFrame, own, kept: DataFrame) -> DataFrame:
    """(row, kept): rows of ``docs``, each one struct, that ``kept`` names by ``own`` or that have no key."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), own.alias("own"))
    return rows.join(kept, F.col("own") == F.col("kept"), "left").where(F.col("kept").isNotNull() | F.col("own").isNull()).drop("own")


def _keep_by_text(docs: DataFrame, key: str, text: str) -> DataFrame:
    """keep_one where ids repeat with different texts: every id and text is a document of its own."""
    own = F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key), F.col(text), F.col(text).isNull()))
    named = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(text).alias("_text"), own.alias("_own"))
    groups = near_duplicates(named, "_own", "_text").select(F.col("doc_id").alias("_own"), "component_id").distinct()
    order = F.struct("_id", F.xxhash64("_text"))
    kept = named.join(groups, "_own").groupBy("component_id").agg(F.min_by("_own", order).alias("kept")).select("kept")
    return _first_rows(_beside(docs, own, kept), key, text)


def _first_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    lone = rows.where(F.col("kept").isNull()).select("row.*")
    row = F.col("row")
    picked = rows.where(F.col("kept").isNotNull()).groupBy("kept").agg(
        F.min_by("row", F.struct(row.getField(text).alias("t"), row.getField(key).alias("k"), row.alias("r"))).alias("row")).select("row.*")
    return lone.unionByName(picked)
