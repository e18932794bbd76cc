"""Access to the given tables and the fixed parameters every registered query shares."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPREAD_ALL = os.environ.get("FEEDLOOM_SPREAD_ALL") == "1"

# The explicit "now" of every registered query (never the wall clock).
AS_OF = "2026-01-20 12:00:00"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    ``spread=True`` marks queries whose work is per-row text / regex / date parsing. Their scans
    are dealt over ``spark.feedloom.spreadPartitions`` partitions if the session sets that (a
    local run over one-file tables does); by default a scan's own splits are kept."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = df.sparkSession.conf.get("spark.feedloom.spreadPartitions", None)
    # a hash of the first two columns: deterministic on retry, and one key's rows are split
    return df.repartition(int(n), *df.columns[:2]) if n and (spread or _SPREAD_ALL) else df


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows that take long each, dealt evenly over all cores. Parquet files are read by whole
    row groups of up to a million rows, so a scan may give a few tasks all the rows."""
    scan = df.rdd.getNumPartitions()
    return df.repartition(max(scan, 3 * df.sparkSession.sparkContext.defaultParallelism))
