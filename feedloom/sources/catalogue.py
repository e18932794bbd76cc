"""A catalogue addressed by (version, key), stored as immutable Parquet folders and manifests.

``data/<commit>/_v=<version>/_b=<bucket>`` holds the rows of one partition as one commit wrote
them. A manifest is a small JSON file that names the folder of every partition and the marks
of the change logs applied so far; ``manifest/<number>.json`` with the highest number is the
current snapshot. A commit writes new folders for the partitions it changes, then publishes the
next manifest by one rename that fails if the number is taken. So readers see a whole snapshot
or the one before it, a job killed before the rename changes nothing, partitions without
changes are neither read nor written, and data and marks move together.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("key", T.StringType()),
                    T.StructField("content", T.StringType()), T.StructField("content_hash", T.StringType())])


class CommitConflict(RuntimeError):
    """Another commit was published since the snapshot that this one started from."""


@dataclass(frozen=True)
class Manifest:
    """One snapshot: ``parts`` maps "version/bucket" to its folder below the root."""

    number: int = 0
    buckets: int = 1
    parts: dict[str, str] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _files(spark, root), _path(spark, root, "manifest")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The current manifest, or the one of ``number``; an empty one where none was published."""
    if number is None:
        number = max(_numbers(spark, root), default=0)
    if number == 0:
        return Manifest()
    stream = _files(spark, root).open(_path(spark, root, "manifest", f"{number:012d}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Manifest(**json.loads(text))


def publish(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Make ``manifest`` the current one: write it aside, then rename it to its number."""
    fs = _files(spark, root)
    aside = _path(spark, root, "manifest", f".{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(manifest.__dict__).encode()))
    finally:
        out.close()
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(options, 1)
    none[0] = options.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    to = _path(spark, root, "manifest", f"{manifest.number:012d}.json")
    if fs.exists(to):
        fs.delete(aside, False)
        raise CommitConflict(f"snapshot {manifest.number} was published by another commit")
    context.rename(aside, to, none)


def bucket(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_parts(spark: SparkSession, root: str, manifest: Manifest, parts: list[str] | None = None) -> DataFrame:
    """Rows of the partitions ``parts`` (all by default) of a snapshot."""
    folders = [f"{root}/{manifest.parts[p]}" for p in (sorted(manifest.parts) if parts is None else parts) if p in manifest.parts]
    return spark.read.schema(ROW).parquet(*folders) if folders else spark.createDataFrame([], ROW)


def read_catalogue(spark: SparkSession, root: str, versions: list[int] | None = None, number: int | None = None) -> DataFrame:
    """(version, key, content, content_hash) of the current snapshot or snapshot ``number``; only
    the folders of ``versions`` are listed and read."""
    manifest = read_manifest(spark, root, number)
    parts = None if versions is None else [p for p in sorted(manifest.parts) if int(p.split("/")[0]) in versions]
    return read_parts(spark, root, manifest, parts)


def commit(spark: SparkSession, root: str, delta: DataFrame, base: Manifest | None = None, marks: dict[str, int] | None = None,
           buckets: int = 1) -> Manifest:
    """Apply ``delta`` (version, key, content; a null content removes the row) to the snapshot
    ``base`` (the current one by default) and publish the result with ``marks``.

    ``delta`` has one row per (version, key) and is read twice, so callers materialise it; rows
    without a version or key have no address and are left out. The driver collects the names of
    the changed partitions only; ``buckets``, kept from the first commit on, cuts a large version
    into so many partitions."""
    base = read_manifest(spark, root) if base is None else base
    if base.number:
        buckets = base.buckets
    placed = delta.select(F.col("version").cast("int").alias("version"), "key", "content", bucket("key", buckets).alias("_b")) \
        .where(F.col("version").isNotNull() & F.col("key").isNotNull())
    changed = [f"{r[0]}/{r[1]}" for r in placed.select("version", "_b").distinct().collect()]
    parts = dict(base.parts)
    if changed:
        kept = read_parts(spark, root, base, changed).join(placed.select("version", "key"), ["version", "key"], "left_anti")
        added = placed.where(F.col("content").isNotNull()).select("version", "key", "content", F.sha2("content", 256).alias("content_hash"))
        rows = kept.unionByName(added).withColumn("_v", F.col("version")).withColumn("_b", bucket("key", buckets))
        folder = f"data/{uuid.uuid4().hex}"
        # AQE splits a partition that holds most rows and joins small ones
        rows.hint("rebalance", "_v", "_b").write.partitionBy("_v", "_b").parquet(f"{root}/{folder}")
        fs = _files(spark, root)
        for p in changed:
            version, b = p.split("/")
            name = f"{folder}/_v={version}/_b={b}"
            if fs.exists(_path(spark, root, name)):
                parts[p] = name
            else:  # its last row was removed
                parts.pop(p, None)
    done = replace(base, number=base.number + 1, buckets=buckets, parts=parts, marks={**base.marks, **(marks or {})})
    publish(spark, root, done)
    return done


def vacuum(spark: SparkSession, root: str, keep: int = 2, min_age_seconds: float = 86_400) -> int:
    """Delete manifests before the last ``keep`` and data folders that none of those names, if
    they are older than ``min_age_seconds`` (a running commit's are younger). Returns the
    number of folders deleted."""
    fs, numbers = _files(spark, root), _numbers(spark, root)
    kept = [read_manifest(spark, root, n) for n in numbers[-keep:]]
    for n in numbers[:-keep]:
        fs.delete(_path(spark, root, "manifest", f"{n:012d}.json"), False)
    named = {p.split("/")[1] for m in kept for p in m.parts.values()}
    before, gone, data = (time.time() - min_age_seconds) * 1000, 0, _path(spark, root, "data")
    for s in fs.listStatus(data) if fs.exists(data) else []:
        if s.getPath().getName() not in named and s.getModificationTime() <= before:
            gone += fs.delete(s.getPath(), True)
    return gone
