"""Line dedup by distinct-site spread (Spark functions only).

Every distinct line of a document counts for the document's site. A HyperLogLog sketch per
line hash estimates on how many sites the line stands; sketches merge by aggregation, so a
line that a third of all documents share costs one small sketch per task. Lines whose
estimate lies near the threshold get an exact distinct count. Lines on ``min_sites`` sites or
more are cross-site boilerplate and are taken out of every document that has a line of its own,
whatever their share; a document without one is a copy as a whole, which is for the
near-duplicate step: it is left as it is and marked ``only_boilerplate``.

Defined results: a null text stays null with no lines; empty lines are never boilerplate; a
null site counts as one site of its own; repeated rows and clashing extra columns are kept,
columns named like the three added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Sketches have 2^LG_K registers: a relative standard error of 1.04 / 64 = 1.6 %.
LG_K = 12
#: Estimates within this share of the threshold (six standard errors) are counted exactly.
MARGIN = 0.1
#: The boilerplate table is broadcast up to this many lines (8 bytes each); else joined.
BROADCAST_LINES = 1_000_000


def _hash(line: Column) -> Column:
    return F.xxhash64(line)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = 10) -> DataFrame:
    """(line_hash) of the lines on at least ``min_sites`` distinct sites; exact."""
    # "+" marks a given site, so the null site ("-") has a value of its own
    own = F.coalesce(F.concat(F.lit("+"), F.col(site)), F.lit("-")).alias("site")
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col(text)), lambda x: x != ""), _hash))
    rows = docs.select(F.explode(hashes).alias("line_hash"), own)
    spread = saved(rows.groupBy("line_hash")
                       .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
                       .where(F.col("sites") >= min_sites * (1 - MARGIN) - 1), "line-spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + MARGIN) + 1).select("line_hash")
    near = spread.where(F.col("sites") <= min_sites * (1 + MARGIN) + 1).select("line_hash")
    exact = (rows.join(_bounded(near, spread), "line_hash", "left_semi").distinct()
                 .groupBy("line_hash").agg(F.count(F.lit(1)).alias("n"))
                 .where(F.col("n") >= min_sites).select("line_hash"))
    return sure.unionByName(exact)


def _bounded(lines: DataFrame, counted: DataFrame) -> DataFrame:
    return F.broadcast(lines) if counted.count() <= BROADCAST_LINES else lines


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", key: str = "doc_id",
                       min_sites: int = 10) -> DataFrame:
    """``docs`` with the cleaned ``text`` and the columns n_lines, removed_lines (long), only_boilerplate."""
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ("n_lines", "removed_lines", "only_boilerplate")))
    bad = saved(boilerplate_lines(docs, text, site, min_sites), "boilerplate")
    hashes = F.array_distinct(F.transform(_lines(F.col(text)), _hash))
    held = (docs.select(F.col(key).alias("key"), F.explode(hashes).alias("line_hash"))
                .join(_bounded(bad, bad), "line_hash")
                .groupBy("key").agg(F.collect_set("line_hash").alias("bad")))
    # the row is one struct, so no column of it can clash with those of the work
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("own_key"), F.col(text).alias("body"))
    both = rows.join(held, F.col("own_key").eqNullSafe(F.col("key")), "left").drop("key", "own_key")
    both = both.withColumn("bad", F.coalesce("bad", F.array().cast("array<bigint>")))
    lines = _lines(F.col("body"))
    is_bad = lambda x: F.array_contains(F.col("bad"), F.xxhash64(x))
    n_bad = F.when(F.size("bad") > 0, F.size(F.filter(lines, is_bad))).otherwise(0).cast("long")
    own_line = F.exists(lines, lambda x: x.rlike(r"[^\x09-\x0D\x20]") & ~is_bad(x))
    both = both.withColumns({"n_bad": n_bad, "whole": (F.size("bad") > 0) & ~own_line,
                             "lines": F.when(F.col("body").isNull(), 0).otherwise(F.size(lines)).cast("long")})
    cut = (F.col("n_bad") > 0) & ~F.col("whole")
    cleaned = F.when(cut, F.array_join(F.filter(lines, lambda x: ~is_bad(x)), "\n")).otherwise(F.col("body"))
    return both.select(*[cleaned.alias(c) if c.lower() == text.lower() else F.col("row").getField(c).alias(c) for c in docs.columns],
                       F.col("lines").alias("n_lines"), F.when(cut, F.col("n_bad")).otherwise(0).cast("long").alias("removed_lines"),
                       F.col("whole").alias("only_boilerplate"))
