"""Shared helpers of the training-data operators: scratch tables and bounded batches."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Python workers can import this package, and Arrow batches are cut by bytes, so very long
    texts do not add up in a worker."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get("spark.feedloom.arrowBatch", None) is None:
        spark.conf.set(key, str(2 * 1024 * 1024))
        spark.conf.set("spark.feedloom.arrowBatch", "2m")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: its lineage is cut there,
    so a lost executor never repeats the work above it."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._feedloom_path = path
    return out


def drop_saved(df: DataFrame) -> None:
    """Delete a superseded scratch table that ``saved`` wrote."""
    path = getattr(df, "_feedloom_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only when a count proves that the frame has at most ``rows`` rows."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def give_back_memory() -> None:
    """Return freed memory of this Python worker to the system: workers live on between tasks
    and operators, and would hold the most that any of them needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A mapInArrow function that gives memory back at the end of its task."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back_memory()
    return wrapped
