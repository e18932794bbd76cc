"""Registered query: incremental feed (S1) over the events captures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming.feed import emit_once, emitted, incremental_feed
from .registry import query


def _transform(df):
    # the batch field logic, applied to the stream: capture time, item key = (user, type, hour)
    return df.select("event_id", F.col("ts").cast("timestamp").alias("captured_at"), "user_id", "event_type",
                     F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))


@query("S1_incremental_feed", """
SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events""")
def q_s1(spark, sf):
    """Reads the capture files in place (the events file of the table folder). All of them
    arrive in one micro-batch here, so every key is emitted exactly once; only the key
    columns are returned (which duplicate is kept is not compared)."""
    run = uuid.uuid4().hex
    out = scratch_path(spark, f"incremental_feed/{run}/out")
    ckpt = scratch_path(spark, f"incremental_feed/{run}/checkpoint")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    q = incremental_feed(spark, sf, schema, out, ckpt, "1 hour", ["user_id", "event_type", "hour"],
                         transform=_transform, options={"pathGlobFilter": "events.parquet"})
    q.awaitTermination()
    res = spark.read.parquet(out)
    return res.select("user_id", "event_type", F.col("hour").cast("timestamp_ntz").alias("hour"))


@query("S1_feed_once", """
SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events""")
def q_s1_once(spark, sf):
    """The events arrive in several files, one per trigger, so keys repeat in later batches, most
    of them far beyond any watermark; each is emitted once."""
    run = uuid.uuid4().hex
    base = scratch_path(spark, f"incremental_feed/{run}")
    events = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    events.repartition(4, "event_id").write.parquet(f"{base}/in")
    q = emit_once(spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/checkpoint", ["user_id", "event_type", "hour"],
                  transform=_transform, max_files_per_trigger=1)
    q.awaitTermination()
    res = emitted(spark, f"{base}/out", _transform(events.limit(0)).schema)
    return res.select("user_id", "event_type", F.col("hour").cast("timestamp_ntz").alias("hour"))
