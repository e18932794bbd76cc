"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a map-side combined minimum and an equi-join on the node, so a hub with a third
of all links is split by the skew join; nothing is collected. Each round is written to the
shared scratch folder. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_saved, saved


def _star(e: DataFrame, large: bool) -> DataFrame:
    """e: (a, b) with a > b. Large star links larger neighbours to the smallest one; small
    star links a node and its smaller neighbours to the smallest one."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.inline(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                             F.struct(F.col("a").alias("a"), F.col("m").alias("b")))))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): links is (a, b); the component is the smallest node reachable.
    Nodes without a link do not appear."""
    e = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where(F.col("a") > F.col("b")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        e, old = saved(_star(_star(e, True), False), "links"), e
        drop_saved(old)
        # equal edge sets have equal sums; a star forest maps onto itself
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
