"""Key-based paging (O3) over a table written in the requested order.

The table is range-partitioned and sorted by the order and written as one folder per range, with
the number of rows of each. A page is found from the running counts of the ranges, so it
reads the one or two ranges it lies in, whatever its number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .query import sort_requested

RANGE = "_range"


def write_ordered(df: DataFrame, keys: Sequence[tuple[str, str]], path: str, ranges: int | None = None) -> None:
    """Write ``df`` in the order of ``keys`` ((column, asc or desc), nulls last; the last should be
    unique, rows equal in all keys have no fixed order) for ``read_page``. ``ranges`` defaults to
    the shuffle width; a key that many rows share is split by the keys after it."""
    order = [F.col(k).desc_nulls_last() if d.lower() == "desc" else F.col(k).asc_nulls_last() for k, d in keys]
    ranged = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    # the number of the task that writes a range is its place in the order
    ranged.sortWithinPartitions(*order).withColumn(RANGE, F.spark_partition_id()).write.partitionBy(RANGE).parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(f"{path}/rows")
    rows.groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(f"{path}/counts")


def read_page(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[tuple[str, str]], page: int, size: int) -> DataFrame:
    """Page ``page`` (from 0) of ``size`` rows of the table of ``schema``; empty beyond the last.
    The driver reads one count per range."""
    schema = T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])
    if page < 0 or size < 1:
        raise ValueError("pages are numbered from 0 and hold a row at least")
    counts = sorted((r[RANGE], r["rows"]) for r in spark.read.parquet(f"{path}/counts").collect())
    first, before, wanted, skipped = page * size, 0, [], 0
    for number, n in counts:
        if before + n > first and before < first + size:
            if not wanted:
                skipped = before
            wanted.append(number)
        before += n
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    if not wanted:
        return rows.where(F.lit(False)).drop(RANGE)
    inside = rows.where(F.col(RANGE).isin(wanted))
    return sort_requested(inside, [(RANGE, "asc"), *keys]).offset(first - skipped).limit(size).drop(RANGE)
