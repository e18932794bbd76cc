"""Mixing sources to target weights by cube-method balanced sampling.

A document's size is its number of words. Sources share ``epochs`` times all sizes by weight;
no target exceeds ``cap`` times its source's size, and the excess is shared again by weight
(water filling). With t = target / size of its source, every document is taken floor(t) times
and once more with probability t - floor(t). Who gets the extra copy is drawn by the cube
method: within blocks of a source, the probabilities of three open documents move along the
null space of the balancing equations (documents, words) until one of them is 0 or 1, so both
totals hold exactly. Each block leaves at most six open documents; blocks of open documents
are joined and moved again, level by level, until one small landing problem a source is left:
at most 13 open documents, of which the rounding nearest to the target is taken.

Defined results: m rows equal in (doc_id, source, size) are one unit; of the m * (t - floor(t))
extra copies it expects, the whole number is given outright and only the fraction is drawn, so
a unit of any number of rows meets its share; the extra copies go to its first rows, told
apart by their place in the table. A null text has size 0; the null source is a source of its own and sorts last; an empty table
gives an empty result. All draws are hashes of the rows, so reruns agree at any partitioning.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import number_within
from .common import bounded_batches, drop_saved, saved, word_count

EPS = 1e-9
#: Mean number of units in a block of the flight phase.
BLOCK = 2048
#: Units of spaced sizes that a source's last block and any other block leave open.
LANDING, SPARED = 11, 4
#: The table of sources is broadcast up to this many rows; else it is joined.
BROADCAST_SOURCES = 100_000


def source_targets(sized: DataFrame, weights: Sequence[float], epochs: float, cap: float) -> DataFrame:
    """(source, source_size, units, target) from one row per document with source and size.

    Water filling in closed form: in rising order of cap * size / weight a prefix of the
    sources is capped, and the rest share what is left by weight. The window has one row per
    source, after aggregation."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("units"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.array(*(F.lit(float(x)) for x in weights))
    per = per.withColumn("_w", F.get(w, F.pmod(rank, F.lit(len(weights)))))
    per = per.withColumns({"_top": F.col("source_size") * float(cap), "_r": F.col("source_size") * float(cap) / F.col("_w")})
    every = Window.partitionBy()
    before = Window.orderBy("_r", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * float(epochs) - F.coalesce(F.sum("_top").over(before), F.lit(0.0))
    share = F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    per = per.withColumn("_level", left / share)
    level = F.max(F.when(F.col("_level") <= F.col("_r"), F.col("_level"))).over(every)
    return per.select("source", "source_size", "units",
                      F.least(F.col("_top"), F.coalesce(level * F.col("_w"), F.col("_top"))).alias("target"))


def _flight(p: np.ndarray, a: np.ndarray, rng: np.random.Generator, keep: int = 0) -> np.ndarray:
    """Move probabilities ``p`` along the null space of ``a`` (columns: units, words), three
    open units at a time, until at most two are open or no move is left. ``keep`` units of
    spaced sizes, the smaller ones, do not take part: they are left for the landing."""
    p, draw = p.copy(), iter(rng.random(2 * len(p) + 8))
    start = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    spared = start[np.unique(np.linspace(0.3 * len(start), len(start) - 1, keep).astype(int))] if keep and len(start) else []
    todo, open_ = iter(start[~np.isin(start, spared)].tolist()), []
    while True:
        while len(open_) < 3 and (k := next(todo, None)) is not None:
            open_.append(k)
        if len(open_) == 3:
            (m1, w1), (m2, w2), (m3, w3) = (a[k] for k in open_)
            u = [m2 * w3 - m3 * w2, m3 * w1 - m1 * w3, m1 * w2 - m2 * w1]
            if not any(u):
                u = [m2, -m1, 0.0]
        elif len(open_) == 2 and a[open_[0], 0] * a[open_[1], 1] == a[open_[0], 1] * a[open_[1], 0]:
            u = [a[open_[1], 0], -a[open_[0], 0]]
        else:
            return p
        up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(open_, u, strict=True) if x)
        down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(open_, u, strict=True) if x)
        step = up if next(draw) * (up + down) < down else -down
        for k, x in zip(open_, u, strict=True):
            p[k] += step * x
            p[k] = 0.0 if p[k] < EPS else 1.0 if p[k] > 1 - EPS else p[k]
        open_ = [k for k in open_ if 0 < p[k] < 1]


def _land(p: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Solve the landing problem over the at most LANDING + 2 open units: of all their
    roundings the one nearest in words, then in documents, then with the fewest taken."""
    at = np.flatnonzero((p > 0) & (p < 1))
    if len(at):
        every = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
        off = np.abs((every - p[at]) @ a[at])
        p = p.copy()
        p[at] = every[np.lexsort((np.arange(len(every)), every.sum(axis=1), off[:, 0], off[:, 1]))[0]]
    return p


def _move(last: bool):
    def block(t: pa.Table) -> pa.Table:
        t = t.sort_by([("size", "descending"), ("unit", "ascending"), ("copies", "ascending")])
        a = np.column_stack([np.ones(len(t)), t["size"].to_numpy().astype(float)])
        seed = zlib.crc32(f"{t['source'][0].as_py()}|{t['block'][0].as_py()}|{len(t)}".encode())
        p = _flight(t["p"].to_numpy(), a, np.random.default_rng(seed), LANDING if last else SPARED)
        p = _land(p, a) if last else p
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(p))
    return block


def draw_extra(units: DataFrame) -> DataFrame:
    """``units`` (source, unit, size, copies, p, blocks) with ``p`` moved to 0 or 1.

    ``blocks`` is the number of blocks of the unit's source. Every level is a grouped job over
    blocks of bounded size; only open units go on to the next level."""
    done, level = [], units.withColumn("block", F.pmod(F.xxhash64("unit", "size"), F.col("blocks")))
    while True:
        most = level.agg(F.max("blocks")).first()[0] or 1
        out = saved(level.groupBy("source", "block").applyInArrow(_move(most <= 1), level.schema), "mix-level")
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(out.where(~open_))
        if most <= 1:
            break
        fewer = F.ceil(F.col("blocks") / F.lit(BLOCK // 8))
        level = out.where(open_).withColumn("blocks", fewer).withColumn("block", F.pmod("block", "blocks"))
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id",
        weights: Sequence[float] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, source, size) -> source_size, target, copies, whole, extra: each of the unit's ``copies``
    rows is taken ``whole`` times, and ``extra`` of them once more."""
    bounded_batches(docs.sparkSession)
    sized = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    rows = saved(sized.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-units")
    each = rows.select("source", (F.col("size") * F.col("copies")).alias("size"), "copies")
    per = source_targets(each, weights, epochs, cap)
    per = saved(per, "mix-targets")
    per_b = F.broadcast(per) if per.count() <= BROADCAST_SOURCES else per
    per_b = per_b.withColumnRenamed("source", "_source")
    t = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(t + EPS)
    # extra copies that the unit's rows expect together: the whole part is given, the rest drawn
    expected = F.greatest(t - whole, F.lit(0.0)) * F.col("copies")
    given = F.floor(expected + EPS)
    left = F.greatest(expected - given, F.lit(0.0))
    # an id in text form names the unit for order and draws; nulls have a name too
    unit = F.coalesce(F.col("key").cast("string"), F.lit("null"))
    both = (rows.join(per_b, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                .withColumns({"whole": whole, "given": given, "p": F.when(left < EPS, 0.0).otherwise(left),
                              "unit": unit, "blocks": F.ceil(F.col("units") / F.lit(BLOCK))}))
    extra = draw_extra(both)
    drop_saved(rows)
    return extra.select("key", "source", "size", "source_size", "target", "copies", F.col("whole").cast("long").alias("whole"),
                        (F.col("given") + F.round("p")).cast("long").alias("extra"))


def decide(sized: DataFrame, mixed: DataFrame, source: str = "source", key: str = "doc_id") -> DataFrame:
    """``sized`` (with key, source and a column size) with source_size, target and n, how often the
    mix takes the row, by its unit's decision of ``mix``. Columns of those names are replaced.

    A unit whose rows are not all taken alike has its rows numbered, in two levels, so one that
    holds a third of all rows is spread over tasks."""
    kept = [c for c in sized.columns if c.lower() not in ("source_size", "target", "n")]
    rows = sized.select(F.struct(*kept).alias("row"), F.col(key).alias("k"), F.col(source).alias("s"), F.col("size").alias("z"))

    def joined(units: DataFrame) -> DataFrame:
        return rows.join(units, F.col("k").eqNullSafe(F.col("key")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("z") == F.col("size")))

    def out(df: DataFrame, n) -> DataFrame:
        return df.select(*[F.col("row").getField(c).alias(c) for c in kept], "source_size", "target", n.alias("n"))

    some = (F.col("extra") > 0) & (F.col("extra") < F.col("copies"))
    alike = out(joined(mixed.where(~some)), F.col("whole") + (F.col("extra") > 0).cast("long"))
    split = mixed.where(some)
    if split.isEmpty():
        return alike
    placed = saved(joined(split).withColumn("place", F.monotonically_increasing_id())
                   .withColumn("u", F.xxhash64("k", "s", "z", F.col("k").isNull(), F.col("s").isNull())), "mix-split")
    numbered = number_within(placed, ["u", "z"], "place")
    return alike.unionByName(out(numbered, F.col("whole") + (F.col("rn") <= F.col("extra")).cast("long")))


def mixture(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **weights) -> DataFrame:
    """``docs`` with every document as often as the mix takes it; columns as they were."""
    names, own = docs.columns, "_words"
    sized = docs.select(F.struct(*names).alias("_doc"), F.col(key).alias("_k"), F.col(source).alias("_s"),
                        word_count(F.col(text)).alias("size"))
    out = decide(sized, mix(docs, text, source, key, **weights), "_s", "_k")
    return out.select(F.explode(F.array_repeat("_doc", F.col("n").cast("int"))).alias(own)).select(f"{own}.*")
