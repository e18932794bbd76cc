"""The whole sync as a replay of an ordered change log on the versioned catalogue.

A log row is (seq, path, op, content, old_path): op A, M, D or R (rename from ``old_path``). The
mark of each log, the last sequence applied, is published in the same manifest as the data, so a
batch that was applied is a no-op when it comes again and one that was killed is applied as
a whole by the next run. A batch joins the catalogue's keys and hashes with the keys it
touches; contents are read only in the partitions that change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import catalogue as store
from .quality import Rule
from .sync import blocklist, change_report, materialize, place_items, with_renames

#: The path class whose rows the catalogue holds; the others (documents, schemas, workflows)
#: are the receiving side's own and are left as they are (M5, M7).
DEFINITION = r"^definitions/v([0-9]+)/([^/]+)\.yml$"
LOG = "seq long, path string, op string, content string, old_path string"


@dataclass(frozen=True)
class SyncResult:
    """What a batch did: the published snapshot, the changes (version, key, status, both_added,
    old_hash, new_hash), keys to review in other versions (M12), and counts by status."""

    manifest: store.Manifest
    changes: DataFrame
    backports: DataFrame
    report: DataFrame


def net_changes(log: DataFrame, current: DataFrame) -> DataFrame:
    """M2, M4-M7: the last state that ``log`` gives each (version, key), against ``current``
    (version, key, content_hash): A, M or D. Upstream content wins over a local edit of a
    definition, also where both sides added it (``both_added``); rows that already are as
    the log leaves them are no change. A rename removes the old path and adds the new one.
    At equal seq the removal comes first, then the larger content wins."""
    one = lambda path, op, content, order: F.struct(
        F.col(path).alias("path"), F.lit(op).alias("op") if isinstance(op, str) else op.alias("op"), content.alias("content"),
        F.lit(order).alias("order"))
    here = one("path", F.when(F.col("op") == "R", F.lit("A")).otherwise(F.col("op")), F.col("content"), 1)
    there = one("old_path", "D", F.lit(None).cast("string"), 0)
    steps = log.select("seq", F.explode(F.when(F.col("op") == "R", F.array(there, here)).otherwise(F.array(here))).alias("s")).select("seq", "s.*")
    steps = steps.where(F.col("path").rlike(DEFINITION)).select(
        F.regexp_extract("path", DEFINITION, 1).cast("int").alias("version"), F.regexp_extract("path", DEFINITION, 2).alias("key"), "seq", "order", "op",
        F.when(F.col("op") != "D", F.coalesce("content", F.lit(""))).alias("content"))
    last = steps.groupBy("version", "key").agg(
        F.max(F.struct("seq", "order", "content", "op")).alias("s"), F.bool_or(F.col("op") == "A").alias("was_added"))
    j = last.select("version", "key", "was_added", F.col("s.op").alias("op"), F.col("s.content").alias("content")).join(
        current.select("version", "key", F.col("content_hash").alias("old_hash")), ["version", "key"], "left")
    new_hash = F.when(F.col("op") != "D", F.sha2("content", 256))
    status = (F.when((F.col("op") == "D") & F.col("old_hash").isNotNull(), F.lit("D"))
              .when((F.col("op") != "D") & F.col("old_hash").isNull(), F.lit("A"))
              .when((F.col("op") != "D") & (F.col("old_hash") != new_hash), F.lit("M")))
    return (j.select("version", "key", status.alias("status"), F.coalesce((status == "M") & F.col("was_added"), F.lit(False)).alias("both_added"),
                     "old_hash", new_hash.alias("new_hash"), "content")
             .where(F.col("status").isNotNull()))


def replay(spark: SparkSession, root: str, log: DataFrame, source: str, rule_sets: Mapping[int, Sequence[Rule]], next_version: int,
           blocked: DataFrame | None = None, pairs: DataFrame | None = None, max_changes: int | None = None) -> SyncResult | None:
    """Apply the rows of ``log`` after the mark of ``source`` to the catalogue at ``root`` as one
    commit; None, without a commit, when there are none.

    1. range: rows with a seq above the mark (M3);
    2. net changes against the current snapshot (M2, M4-M7), computed once; more than
       ``max_changes`` are refused before anything is written (O6);
    3. added keys of ``blocked`` are dropped (M8); keys that an added item replaces (``pairs``
       key, replaced) leave every version, and the batch (M9);
    4. added and modified items go to the version whose rules they pass (M10); a modified item
       that moves leaves its old row at its old version (M11);
    5. a removed key leaves every version (M13), unless the batch adds or modifies it in
       another one: that is a move;
    6. changed partitions and the new mark are published together (A16); keys that also
       stand in a version the batch did not touch are returned for review (M12).
    """
    base = store.read_manifest(spark, root)
    rows = log.where(F.col("seq") > F.lit(base.marks.get(source, -(2**63))))
    mark = rows.agg(F.max("seq")).first()[0]
    if mark is None:
        return None
    held = store.read_parts(spark, root, base).select("version", "key", "content_hash")
    changes = materialize(net_changes(rows.where(F.col("seq") <= mark), held))
    if max_changes is not None:
        from .query import cap_guard
        cap_guard(changes, max_changes, "changes")
    if blocked is not None:
        changes = blocklist(changes, blocked)
    items = changes.where(F.col("status") != "D")
    removed = changes.where(F.col("status") == "D").select("version", "key")
    gone = removed.select("key").distinct().join(items.select("key"), "key", "left_anti")
    if pairs is not None:
        out = pairs.where(F.col("key") != F.col("replaced")).join(changes.where(F.col("status") == "A").select("key"), "key", "left_semi") \
            .select(F.col("replaced").alias("key")).distinct()
        items = items.join(out, "key", "left_anti")
        gone = gone.unionByName(out).distinct()
    placed = place_items(items, rule_sets, next_version)
    upserts = placed.select(F.col("to_version").alias("version"), "key", "content")
    leaving = held.select("version", "key").join(gone, "key", "left_semi").unionByName(removed).distinct()
    deletes = leaving.join(upserts, ["version", "key"], "left_anti").withColumn("content", F.lit(None).cast("string"))
    delta = materialize(upserts.unionByName(deletes))
    manifest = store.commit(spark, root, delta, base, {source: mark})
    touched = delta.select(F.col("version").alias("other_version"), "key")
    backports = items.select("key", "version").join(held.select("key", F.col("version").alias("other_version")), "key") \
        .where(F.col("version") != F.col("other_version")).join(touched, ["other_version", "key"], "left_anti")
    address = F.concat(F.lit("v"), F.col("version").cast("string"), F.lit("/"), F.col("key"))
    report = change_report(with_renames(changes.select(address.alias("key"), "status", "old_hash", "new_hash")))
    return SyncResult(manifest, changes.drop("content"), backports.select("key", "version", "other_version"), report)
