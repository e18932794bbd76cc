"""Incremental ingestion of new captures with Structured Streaming.

New capture files are read as a stream, each item is emitted once per key while its
duplicates are inside the watermark (``dropDuplicatesWithinWatermark``: state is bounded
by the watermark), the same column transforms as the batch path are applied, and the
result lands in a file sink whose commit log lives in the checkpoint folder, so a restarted
or partially failed run neither loses nor repeats output. Repeats that arrive after the
watermark are settled by the batch ``dedupe_records`` (U2).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def incremental_feed(spark: SparkSession, in_path: str, schema: T.StructType, out_path: str,
                     checkpoint: str, watermark: str, key: Sequence[str], event_time: str = "captured_at",
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "parquet", max_files_per_trigger: int | None = None,
                     available_now: bool = True, options: dict | None = None) -> StreamingQuery:
    """Start the stream and return its handle (call ``awaitTermination`` for a run-once job).

    ``transform`` runs first (the batch field logic); ``event_time`` must then be a
    TIMESTAMP column (a zone-less TIMESTAMP_NTZ is cast: watermarks need the zoned type).
    ``options`` go to the file source (e.g. ``pathGlobFilter`` to pick capture files).
    """
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.load(in_path)
    if transform is not None:
        src = transform(src)
    if isinstance(src.schema[event_time].dataType, T.TimestampNTZType):
        src = src.withColumn(event_time, F.col(event_time).cast("timestamp"))
    deduped = src.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(list(key))
    w = (deduped.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def emit_once(spark: SparkSession, in_path: str, schema: T.StructType, out_path: str, checkpoint: str, key: Sequence[str],
              event_time: str = "captured_at", transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet",
              max_files_per_trigger: int | None = None, options: dict | None = None) -> StreamingQuery:
    """S1 without a time limit: every key is emitted once ever, by its earliest row of the batch
    that brings it first (ties: the smallest row).

    Each micro-batch is reduced to a row per key by a map-side combined aggregation, joined
    against the keys emitted by earlier batches, and what is new is written to the batch's own
    folder ``out_path/batch=<id>``. A batch that is repeated after a failure leaves its own
    folder out of the comparison and overwrites it, so output is neither lost nor repeated.
    The stream keeps no state in memory: what was emitted is the table itself, of which a batch
    reads the key columns only. Null keys are keys like others.
    """
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.load(in_path)
    if transform is not None:
        src = transform(src)
    kind, key = src.schema, list(key)

    def merge(batch: DataFrame, batch_id: int) -> None:
        row = F.struct(*[F.col(c) for c in batch.columns])
        first = batch.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)]).agg(
            F.min_by(row, F.struct(F.col(event_time), row)).alias("_row"))
        seen = emitted(batch.sparkSession, out_path, kind).where(F.col("batch") != batch_id).select(
            *[F.col(k).alias(f"_seen{i}") for i, k in enumerate(key)])
        same = [F.col(f"_key{i}").eqNullSafe(F.col(f"_seen{i}")) for i in range(len(key))]
        new = first.join(seen, same, "left_anti").select("_row.*")
        new.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return src.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def emitted(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """The rows that ``emit_once`` wrote, with their ``batch``; ``schema`` is that of its output."""
    path = spark._jvm.org.apache.hadoop.fs.Path(out_path)
    kind = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(out_path)
