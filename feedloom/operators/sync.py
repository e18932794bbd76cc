"""Catalogue snapshot sync (M1-M16, G2-G5, U3-U4) as DataFrame joins.

A snapshot is ``(version, key, content, content_hash)``. Every step is a join or an
aggregation keyed by ``key`` (or by content hash), so the whole sync is one lazy plan
ending in one write. Pairing by content hash never emits all pairs within a hash group:
rows are numbered inside their group with a skew-safe two-level numbering and paired 1:1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of
from .numbering import number_within
from .quality import Rule, failures


def content_hash(c) -> Column:
    return F.sha2(col_of(c), 256)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and cut its lineage.

    The change set is read by several later steps (renames, block list, versions, report);
    without this each of them would rescan and rejoin both snapshots. ``checkpoint`` writes
    to ``spark.checkpoint.dir`` (shared storage on a cluster), so a lost executor does not
    force the full outer join to run again."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# ----------------------------------------------------------------------------- M1, M2


def snapshot_diff(old: DataFrame, new: DataFrame, key: str | Sequence[str] = "key") -> DataFrame:
    """M1: two snapshots -> A / M / D per key (unchanged keys dropped). A catalogue that holds
    a key in several versions is compared by ``key=("version", "key")``.
    One full outer join on the key (sort-merge, shuffled by key)."""
    key = [key] if isinstance(key, str) else list(key)
    o = old.select(*key, F.col("content_hash").alias("old_hash"), F.col("content").alias("old_content"))
    n = new.select(*key, F.col("content_hash").alias("new_hash"), F.col("content").alias("new_content"))
    j = o.join(n, key, "full_outer")
    status = (F.when(F.col("old_hash").isNull(), F.lit("A"))
              .when(F.col("new_hash").isNull(), F.lit("D"))
              .when(F.col("old_hash") != F.col("new_hash"), F.lit("M")))
    return j.withColumn("status", status).filter(F.col("status").isNotNull())


def rename_detect(diff: DataFrame, key: str = "key") -> DataFrame:
    """M2: a removed key and an added key with the same content are a rename (R).

    Removed and added rows are numbered together, per (content hash, side), by one
    skew-safe two-level numbering; rows of the two sides with the same number form a pair
    (a group of at most two rows, so the final step is a small aggregation, not a join).
    Many copies of one content therefore give min(removed, added) pairs, never all pairs.
    Returns ``(old_key, new_key, content_hash)``."""
    d = diff.filter(F.col("status") == "D").select(F.col(key).alias("_k"), F.col("old_hash").alias("content_hash"),
                                                   F.lit("D").alias("_side"))
    a = diff.filter(F.col("status") == "A").select(F.col(key).alias("_k"), F.col("new_hash").alias("content_hash"),
                                                   F.lit("A").alias("_side"))
    n = number_within(d.unionByName(a), ["content_hash", "_side"], "_k")
    pairs = n.groupBy("content_hash", "rn").agg(
        F.max(F.when(F.col("_side") == "D", F.col("_k"))).alias("old_key"),
        F.max(F.when(F.col("_side") == "A", F.col("_k"))).alias("new_key"))
    return (pairs.filter(F.col("old_key").isNotNull() & F.col("new_key").isNotNull())
                 .select("old_key", "new_key", "content_hash"))


def with_renames(diff: DataFrame, key: str = "key") -> DataFrame:
    """M1 + M2: statuses A / M / D / R; a rename replaces its D row and A row by one R row
    keyed by the new key (with ``renamed_from``).

    The rename pairs are used once: each pair becomes two marker rows (drop the old key,
    turn the new key into R) that meet the change set in a single left join."""
    r = rename_detect(diff, key)
    marks = r.select(F.explode(F.array(
        F.struct(F.col("old_key").alias(key), F.lit("drop").alias("_mark"),
                 F.lit(None).cast("string").alias("_from")),
        F.struct(F.col("new_key").alias(key), F.lit("R").alias("_mark"), F.col("old_key").alias("_from")))
    ).alias("m")).select("m.*")
    j = diff.select(key, "status").join(marks, key, "left")
    return (j.filter(F.col("_mark").isNull() | (F.col("_mark") != "drop"))
             .select(key, F.coalesce(F.col("_mark"), F.col("status")).alias("status"),
                     F.col("_from").alias("renamed_from")))


# ----------------------------------------------------------------------------- M3, M4


def incremental_range(df: DataFrame, seq: str, mark: Column) -> DataFrame:
    """M3: only items after the last applied mark, oldest first. ``mark`` is a scalar
    Column (a literal or ``marks_df.scalar()``); an item equal to the mark is already
    applied."""
    return df.filter(F.col(seq) > mark).orderBy(seq)


def count_range(df: DataFrame, seq: str, mark: Column) -> DataFrame:
    """Number of items since the mark."""
    return df.filter(F.col(seq) > mark).agg(F.count(F.lit(1)).alias("n"))


def apply_changes(base: DataFrame, changes: DataFrame, key: str = "key") -> DataFrame:
    """M4: base + ordered changes -> current state. Latest change per key wins (``max_by``
    over ``seq``, aggregated map-side first); a final ``D`` removes the key."""
    b = base.select(key, F.lit(0).cast("bigint").alias("seq"), F.lit("A").alias("op"), "content")
    c = changes.select(key, F.col("seq").cast("bigint"), "op", "content")
    last = (b.unionByName(c).groupBy(key)
              .agg(F.max_by(F.struct("op", "content", "seq"), "seq").alias("_l")))
    return (last.filter(F.col("_l.op") != "D")
                .select(key, F.col("_l.content").alias("content"), F.col("_l.seq").alias("seq")))


# ----------------------------------------------------------------------------- M5-M9


def conflict_policy(ours: DataFrame, theirs: DataFrame, classes: Mapping[str, str],
                    key: str = "key", path: str = "path",
                    upstream: Sequence[str] = ("definitions",)) -> DataFrame:
    """M5: for keys present on both sides with different content, the winner by class of
    path (``classes``: name -> path pattern, first match wins): classes in ``upstream`` take
    ``theirs``, every other class (docs, workflows, schemas, unmatched) keeps ``ours``."""
    o = ours.select(key, path, F.col("content").alias("ours"))
    t = theirs.select(key, F.col("content").alias("theirs"))
    j = o.join(t, key, "inner").filter(F.col("ours") != F.col("theirs"))
    cls = F.lit("other")
    for name, pattern in reversed(list(classes.items())):
        cls = F.when(F.col(path).rlike(pattern), F.lit(name)).otherwise(cls)
    j = j.withColumn("path_class", cls)
    win = F.when(F.col("path_class").isin(list(upstream)), F.lit("theirs")).otherwise(F.lit("ours"))
    return (j.withColumn("winner", win)
             .withColumn("content", F.when(F.col("winner") == "theirs", F.col("theirs")).otherwise(F.col("ours"))))


def both_added(base: DataFrame, ours: DataFrame, theirs: DataFrame, key: str = "key") -> DataFrame:
    """M6: keys added on both sides (absent from base) take the upstream content."""
    o = ours.join(base.select(key), key, "left_anti").select(key)
    t = theirs.join(base.select(key), key, "left_anti").select(key, "content")
    return t.join(o, key, "left_semi")


def path_class_filter(df: DataFrame, col: str, drop: str | None = None, keep: str | None = None) -> DataFrame:
    """M7: drop unwanted file kinds (``drop`` pattern), keep only the allow-list (``keep``)."""
    c = F.col(col)
    out = df
    if drop:
        out = out.filter(~c.rlike(drop))
    if keep:
        out = out.filter(c.rlike(keep))
    return out


def blocklist(diff: DataFrame, blocked: DataFrame, key: str = "key") -> DataFrame:
    """M8: added keys on the block list are removed; existing keys stay."""
    added = diff.filter(F.col("status") == "A").join(blocked.select(key), key, "left_anti")
    return diff.filter(F.col("status") != "A").unionByName(added)


def replaces(df: DataFrame, pairs: DataFrame, key: str = "key") -> DataFrame:
    """M9: an item that replaces others removes them in every version (anti join on key)."""
    gone = pairs.select(F.col("replaced").alias(key)).distinct()
    return df.join(gone, key, "left_anti")


# ----------------------------------------------------------------------------- M10-M13


def relocate_version(df: DataFrame, key: str, version: str, rule_sets: Mapping[int, Sequence[Rule]],
                     next_version: int) -> DataFrame:
    """An item failing its version's rules moves to its best passing version, or to
    ``next_version`` (flagged) when none passes. All rule sets run in one projection."""
    passes = {v: F.size(failures(rs)) == 0 for v, rs in rule_sets.items()}
    best = F.greatest(*[F.when(p, F.lit(v)) for v, p in passes.items()], F.lit(0))
    own_ok = F.lit(None).cast("boolean")
    for v, p in passes.items():
        own_ok = F.when(F.col(version) == v, p).otherwise(own_ok)
    own_ok = F.coalesce(own_ok, F.lit(False))
    to = F.when(own_ok, F.col(version)).when(best > 0, best).otherwise(F.lit(next_version))
    return df.select(key, F.col(version).alias("from_version"), to.alias("to_version"),
                     (~own_ok & (best == 0)).alias("flagged"))


def bump_keeps_old(moves: DataFrame, status: str = "status", key: str = "key") -> DataFrame:
    """A moved *modified* item keeps its old version row as well; a moved *new* item
    exists only at its new version. Returns ``(key, version)`` rows to keep."""
    moved = moves.select(key, F.col("to_version").alias("version"))
    keep_old = (moves.filter((F.col(status) == "M") & (F.col("to_version") != F.col("from_version")))
                     .select(key, F.col("from_version").alias("version")))
    return moved.unionByName(keep_old)


def backport_candidates(versions: DataFrame, changed: DataFrame, current: int, key: str = "key") -> DataFrame:
    """Changed keys that also exist in another version."""
    other = versions.filter(F.col("version") != current).select(key, F.col("version").alias("other_version"))
    return changed.select(key).distinct().join(other, key, "inner")


def cascade_remove(versions: DataFrame, removed: DataFrame, key: str = "key") -> DataFrame:
    """A removed key is removed from every version."""
    return versions.join(removed.select(key).distinct(), key, "left_anti")


# ----------------------------------------------------------------------------- M14-M16, G, U


def change_report(diff: DataFrame) -> DataFrame:
    """Counts per status (lists come from ``change_list``)."""
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def change_list(diff: DataFrame, key: str = "key") -> DataFrame:
    """The sorted list of keys per status, as rows (never one giant array)."""
    return diff.select("status", key).orderBy("status", key)


def collect_summary(diff: DataFrame, key: str = "key") -> DataFrame:
    """Per status: how many keys, first and last key (bounded summary row)."""
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"),
                                      F.max(key).alias("last_key"))


def nothing_to_do(diff: DataFrame) -> bool:
    """An empty change set is a success without any write."""
    return diff.isEmpty()


def unresolved_guard(conflicts: DataFrame) -> None:
    """Refuse to publish while conflicts remain (reads at most one row)."""
    if not conflicts.isEmpty():
        raise RuntimeError("unresolved conflicts remain; refusing to publish")


def distinct_sorted(df: DataFrame, key: str) -> DataFrame:
    """Unique sorted keys."""
    return df.select(key).dropDuplicates().orderBy(key)


def unique_items(df: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """G3 as rows: items occurring more than once in their group."""
    return df.groupBy(*group, item).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keys_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys in both."""
    return a.intersect(b)


def keys_except(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: keys only in ``a`` (set semantics, like ``comm -23`` on sorted unique lists)."""
    return a.subtract(b)


# ----------------------------------------------------------------------------- the whole sync


def run_sync(old: DataFrame, new: DataFrame, out_path: str, rule_sets: Mapping[int, Sequence[Rule]],
             next_version: int, blocked: DataFrame | None = None, pairs: DataFrame | None = None,
             key: str = "key", max_changes: int | None = None) -> DataFrame | None:
    """One sync run, as one plan ending in one write (returns the per-status report, or
    None when there is nothing to do).

    Catalogues are addressed by (version, key), and one that holds an address twice is refused.

    1. change set: full outer join of the snapshots, computed once (``materialize``), hashes only;
    2. guards: nothing to do -> no write (M15); more than ``max_changes`` -> refuse (O6);
    3. block list: added keys on it are dropped (M8);
    4. replaces: keys replaced by an item that was added and not blocked disappear in every
       version (M9);
    5. versions: an added or modified item goes to its best passing version or
       ``next_version`` (M10), and a *modified* one that moves keeps its old row at its old
       version (M11); unchanged items stay where they are;
    6. write: the whole catalogue, partitioned by version (A16), so a version that ends empty
       leaves no rows behind.
    """
    from ..sources.sinks import write_records

    at = ["version", key]
    for side, name in ((old, "old"), (new, "new")):
        if not side.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"the {name} catalogue holds a (version, {key}) twice")
    diff = materialize(snapshot_diff(old, new, at).select(*at, "status", "old_hash", "new_hash"))
    if nothing_to_do(diff):
        return None
    if max_changes is not None:
        from .query import cap_guard
        cap_guard(diff, max_changes, "changes")
    status = diff.select(*at, "status")
    if blocked is not None:
        status = blocklist(status, blocked, key)
    added = status.filter(F.col("status") == "A").select(key)
    items = new.join(status.filter(F.col("status").isin("A", "M")), at, "inner")
    unchanged = new.join(diff.select(*at), at, "left_anti")
    if pairs is not None:
        pairs = pairs.join(added, key, "left_semi")
        items, unchanged = replaces(items, pairs, key), replaces(unchanged, pairs, key)
    gone = diff.filter(F.col("status") == "D").select(key).join(items.select(key), key, "left_anti")
    unchanged = cascade_remove(unchanged, gone, key)
    # a moved item takes the place of whatever stands at its new version
    placed = place_items(items, rule_sets, next_version, key)
    moved = placed.select(F.col("to_version").alias("version"), key)
    kept_old = (placed.filter((F.col("to_version") != F.col("version")) & (F.col("status") == "M")).select(*at)
                      .join(old.select(*at, "content"), at, "inner"))
    rows = (unchanged.select(*at, "content").unionByName(kept_old.select(*at, "content")).join(moved, at, "left_anti")
            .unionByName(placed.select(F.col("to_version").alias("version"), key, "content")))
    write_records(rows.select(key, "version", "content"), out_path, ["version"], "overwrite", dynamic=False)
    return change_report(status)


def place_items(items: DataFrame, rule_sets: Mapping[int, Sequence[Rule]], next_version: int, key: str = "key") -> DataFrame:
    """M10 over whole item rows: ``items`` with their ``to_version``, one row per (to_version,
    key). Where several versions of a key come to stand at one, the item that was there wins,
    then the one of the highest version."""
    passes = {v: F.size(failures(rs)) == 0 for v, rs in rule_sets.items()}
    best = F.greatest(*[F.when(p, F.lit(v)) for v, p in passes.items()], F.lit(0))
    own_ok = F.lit(False)
    for v, p in passes.items():
        own_ok = F.when(F.col("version") == v, p).otherwise(own_ok)
    to = F.when(own_ok, F.col("version")).when(best > 0, best).otherwise(F.lit(next_version)).cast("int")
    others = [c for c in items.columns if c != key]
    row = F.struct(*others)
    return (items.withColumn("to_version", to).groupBy("to_version", key)
                 .agg(F.max_by(row, F.struct(F.col("version") == F.col("to_version"), "version")).alias("_r"))
                 .select("to_version", key, "_r.*"))
