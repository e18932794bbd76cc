"""Row numbering inside groups that stays spread when one group holds a third of all rows.

A plain ``row_number().over(Window.partitionBy(group).orderBy(...))`` sends a whole group
to one task. Both helpers here number rows in two levels: bounded sub-groups are numbered
by their own windows, and a small table of sub-group sizes (one row per sub-group) gives
each sub-group its offset.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_of


#: Groups that the sketch reports, counters it keeps, and rows of a hot group in a bucket.
HOT_GROUPS, HOT_COUNTERS, BUCKET_ROWS = 100, 10_000, 65_536


def hot_rows(df: DataFrame, group: Sequence[str], more_than: int) -> Column:
    """How many rows the row's group has, if it is a frequent one of more than ``more_than`` rows, else
    null. A frequent-item sketch of the group keys (map-side, of bounded size) is read once as a
    scalar; a group it does not report holds less than one row in HOT_GROUPS."""
    sketch = df.select(F.xxhash64(*group).alias("h")).agg(
        F.expr(f"map_from_entries(transform(filter(approx_top_k(h, {HOT_GROUPS}, {HOT_COUNTERS}), x -> x.count > {more_than}L), "
               f"x -> struct(x.item, x.count)))")).scalar()
    return F.try_element_at(sketch, F.xxhash64(*group))


def hot_buckets(df: DataFrame, group: Sequence[str], least: int, bucket_rows: int = BUCKET_ROWS) -> Column:
    """How many buckets a row's group is dealt over: ``least``, or for the most frequent groups as
    many as their size needs."""
    rows = hot_rows(df, group, least * bucket_rows)
    return F.coalesce(F.ceil(rows / F.lit(bucket_rows)), F.lit(least)).cast("bigint")


def number_within(df: DataFrame, group: Sequence[str], order: str, buckets: int = 64,
                  out: str = "rn", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """1-based numbering of rows inside each group, skew-safe.

    Rows are spread over ``buckets`` sub-groups by hash of ``order``, those of a hot group over
    one per ``bucket_rows`` rows (``hot_buckets``); each sub-group is numbered by its own window
    (bounded work per task), and a small table of sub-group sizes gives each sub-group its
    offset. The numbering is deterministic but for the number of a hot group's buckets, which
    follows its size: by (bucket, order)."""
    b = df.withColumn("_b", F.pmod(F.xxhash64(col_of(order)), hot_buckets(df, group, buckets, bucket_rows)))
    local = b.withColumn("_lrn", F.row_number().over(Window.partitionBy(*group, "_b").orderBy(order)))
    sizes = b.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (local.join(offs, [*group, "_b"], "inner")
                 .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("bigint"))
                 .drop("_b", "_lrn", "_off"))


def _in_blocks(df: DataFrame, group: Sequence[str], order: str, block: int, ties: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows numbered inside their block (``_lrn``) with the rows of the group before it (``_off``),
    partitioned by the returned columns. A group is one block, but for hot groups of more than
    ``block`` rows, whose blocks are ``block`` consecutive ``order`` values. Only those need a table of
    sizes: where there are none, the sizes are empty and their join is dropped at run time."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])
    rows = df.withColumn("_hot", known & hot_rows(df, group, block).isNotNull())
    # plain, never null join keys keep the window's partitioning through the join
    of_order = F.coalesce(F.floor(col_of(order) / F.lit(block)).cast("bigint"), F.lit(-2**63).cast("bigint"))
    rows = rows.withColumn("_blk", F.when(F.col("_hot"), of_order).otherwise(F.lit(0).cast("bigint")))
    keys = [*group, "_hot", "_blk"]
    local = rows.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys).orderBy(order, *ties)))
    sizes = rows.where("_hot").groupBy(*[F.col(c).alias(f"_s_{c}") for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(*[f"_s_{c}" for c in group]).orderBy("_s__blk")
              .rowsBetween(Window.unboundedPreceding, -1))
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = [local[c] == offs[f"_s_{c}"] for c in keys]
    # a hot block that is not among the sizes would be numbered wrong: it ends the job
    off = F.when(F.col("_hot"), F.coalesce("_off", F.raise_error("a hot block without its size").cast("bigint"))).otherwise(F.lit(0))
    return local.join(offs, same, "left").withColumn("_off", off).drop(*[f"_s_{c}" for c in keys]), keys


def number_in_order(df: DataFrame, group: Sequence[str], order: str, out: str = "rn",
                    block: int = 65536, ties: Sequence[str] = ()) -> DataFrame:
    """Exact 1-based ``row_number`` by numeric ``order`` inside each group, skew-safe.

    Sub-groups of a hot group are blocks of ``block`` consecutive ``order`` values, so rows keep
    their true order: a row's number is its number inside its block plus the sizes of all
    earlier blocks of the group. Other groups, and those with a null key, are one window.
    ``order`` with ``ties`` should be unique within a group, as for ``row_number``. Null orders
    come first."""
    numbered, _ = _in_blocks(df, group, order, block, ties)
    return (numbered.withColumn(out, (F.col("_off") + F.col("_lrn")).cast("bigint"))
                    .drop("_hot", "_blk", "_lrn", "_off"))


def arrays_in_order(df: DataFrame, group: Sequence[str], order: str, items: Sequence[str], size: int,
                    block: int = 65536, ties: Sequence[str] = ()) -> DataFrame:
    """The rows of each group as arrays ``items`` of at most ``size`` structs, in order, each with
    ``start``, the rows of its group before it. The numbering's own partitioning serves the
    arrays, so rows are shuffled once; arrays end at the blocks of a hot group."""
    numbered, keys = _in_blocks(df, group, order, block, ties)
    part = F.floor((F.col("_lrn") - 1) / F.lit(size)).alias("_part")
    item = F.struct("_lrn", *items)
    arrays = numbered.groupBy(*keys, part).agg(F.array_sort(F.collect_list(item)).alias("_all"), F.min(F.col("_off")).alias("_off"))
    return arrays.select(*group, (F.col("_off") + F.col("_part") * size).cast("bigint").alias("start"),
                         F.transform("_all", lambda x: F.struct(*[x[c].alias(c) for c in items])).alias("items"))
