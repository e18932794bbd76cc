"""The streamed availableNow output equals the batch result on the same files."""

import os
import tempfile

from pyspark.sql import functions as F

from feedloom.streaming.feed import emit_once, emitted, incremental_feed


def test_stream_equals_batch(spark, sf_dir):
    root = tempfile.mkdtemp(prefix="feedloom-stream-")
    src = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("ts", "captured_at")
    inp = os.path.join(root, "in")
    # two capture files arriving one after another
    src.filter("event_id % 2 = 0").write.parquet(inp + "/a")
    src.filter("event_id % 2 = 1").write.parquet(inp + "/b")
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    q = incremental_feed(spark, inp + "/*", src.schema, out, ck, "1000 days", ["user_id", "event_type"],
                         max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(out).select("user_id", "event_type")
    batch = src.select("user_id", "event_type").distinct()
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
    # a second run over the same folder emits nothing new (checkpointed)
    q2 = incremental_feed(spark, inp + "/*", src.schema, out, ck, "1000 days", ["user_id", "event_type"])
    q2.awaitTermination()
    assert spark.read.parquet(out).count() == streamed.count()
    assert F is not None


def test_a_repeat_after_any_time_is_not_emitted_again(spark, tmp_path):
    inp, out, ck = (str(tmp_path / p) for p in ("in", "out", "ck"))
    kind = "k string, captured_at timestamp, v int"

    def arrive(rows):
        spark.createDataFrame(rows, "k string, t string, v int").select("k", F.col("t").cast("timestamp").alias("captured_at"), "v") \
            .coalesce(1).write.mode("append").parquet(inp)

    def run():
        q = emit_once(spark, inp, spark.createDataFrame([], kind).schema, out, ck, ["k"], max_files_per_trigger=1)
        q.awaitTermination()
        return sorted((r["k"] or "", r["v"]) for r in emitted(spark, out, spark.createDataFrame([], kind).schema).collect())

    arrive([("a", "2020-01-01", 2), ("a", "2019-01-01", 1), ("b", "2020-01-01", 3), (None, "2020-01-01", 4), ("a", "2019-01-01", 1)])
    first = run()
    assert first == [("", 4), ("a", 1), ("b", 3)]
    arrive([("a", "2031-01-01", 9), ("c", "2001-01-01", 5), (None, "2030-01-01", 9)])  # years past the first batch
    assert run() == [*first, ("c", 5)]
    assert run() == [*first, ("c", 5)]  # nothing arrives
    # the last batch is repeated, as after a failure before its commit
    import os
    for name in os.listdir(ck + "/commits"):
        if name.strip(".").split(".")[0] == "1":
            os.remove(f"{ck}/commits/{name}")
    assert run() == [*first, ("c", 5)]
    assert not os.path.exists(f"{ck}/state")  # nothing is kept by the stream itself
