"""Versioned catalogue commits and the replay of change logs."""

import os

import pytest
from pyspark.sql import functions as F

from feedloom.operators import quality as L
from feedloom.operators import sync as M
from feedloom.operators import sync_flow
from feedloom.sources import catalogue as store

def rules():
    required = L.dq_required("content", "content")
    return {10: [required], 11: [required, L.dq_value_pattern("content", "v10 only", negate=True, path="content")]}


DELTA = "version int, key string, content string"


def held(spark, root, **kw):
    return sorted((r["version"], r["key"], r["content"]) for r in store.read_catalogue(spark, root, **kw).collect())


def log_of(spark, rows):
    return spark.createDataFrame([(*r, None)[:5] if len(r) < 5 else r for r in rows], sync_flow.LOG)


def def_path(version, key):
    return f"definitions/v{version}/{key}.yml"


def test_commits_replace_only_changed_partitions(spark, tmp_path):
    root = str(tmp_path / "c")
    assert held(spark, root) == []
    first = store.commit(spark, root, spark.createDataFrame([(10, "a", "x"), (11, "a", "x"), (11, "b", "y"), (None, "n", "x"), (11, None, "x")], DELTA))
    second = store.commit(spark, root, spark.createDataFrame([(11, "b", None), (11, "c", "z")], DELTA), marks={"log": 5})
    assert held(spark, root) == [(10, "a", "x"), (11, "a", "x"), (11, "c", "z")]
    assert held(spark, root, versions=[10]) == [(10, "a", "x")]
    assert held(spark, root, number=1) == [(10, "a", "x"), (11, "a", "x"), (11, "b", "y")]
    assert second.parts["10/0"] == first.parts["10/0"] and second.parts["11/0"] != first.parts["11/0"] and second.marks == {"log": 5}
    third = store.commit(spark, root, spark.createDataFrame([(10, "a", None)], DELTA))
    assert "10/0" not in third.parts and held(spark, root) == [(11, "a", "x"), (11, "c", "z")]
    assert {r[0] for r in store.read_catalogue(spark, root).where("key = 'c'").select("content_hash").collect()} == {
        spark.range(1).select(M.content_hash(F.lit("z"))).first()[0]}


def test_buckets_cut_a_version(spark, tmp_path):
    root = str(tmp_path / "c")
    rows = spark.range(200).select(F.lit(11).alias("version"), F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("string").alias("content"))
    first = store.commit(spark, root, rows, buckets=8)
    second = store.commit(spark, root, rows.where("key = 'k7'").withColumn("content", F.lit("new")), buckets=2)
    assert len(first.parts) == 8 and second.buckets == 8
    assert sum(second.parts[p] != first.parts[p] for p in first.parts) == 1 and len(held(spark, root)) == 200


def test_killed_and_competing_commits_leave_the_snapshot(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    base = store.commit(spark, root, spark.createDataFrame([(11, "a", "x")], DELTA))
    with monkeypatch.context() as m:
        m.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            sync_flow.replay(spark, root, log_of(spark, [(1, def_path(11, "a"), "M", "y")]), "up", rules(), 12)
    assert held(spark, root) == [(11, "a", "x")] and store.read_manifest(spark, root) == base
    assert sync_flow.replay(spark, root, log_of(spark, [(1, def_path(11, "a"), "M", "y")]), "up", rules(), 12).manifest.marks == {"up": 1}
    with pytest.raises(store.CommitConflict):
        store.commit(spark, root, spark.createDataFrame([(11, "a", "late")], DELTA), base)
    assert held(spark, root) == [(11, "a", "y")]
    assert store.vacuum(spark, root, keep=1) == 0
    assert store.vacuum(spark, root, keep=1, min_age_seconds=-60) == 3  # the first, the killed and the late commit's
    assert held(spark, root) == [(11, "a", "y")] and len(os.listdir(root + "/data")) == 1


def test_replay_applies_every_step(spark, tmp_path):
    root = str(tmp_path / "c")
    store.commit(spark, root, spark.createDataFrame(
        [(10, "two", "old"), (11, "two", "old"), (11, "mod", "x"), (10, "dead", "x"), (11, "dead", "x"), (10, "victim", "x"), (11, "victim", "x"),
         (11, "from", "same text"), (11, "local", "edited here"), (10, "moves", "x"), (11, "still", "x")], DELTA))
    log = log_of(spark, [
        (1, def_path(11, "two"), "M", "first"), (2, def_path(11, "two"), "M", "second"),
        (3, def_path(11, "mod"), "M", "v10 only"),                       # moves to 10, the old row stays at 11
        (4, def_path(11, "dead"), "D", None),                            # leaves both versions
        (5, def_path(11, "new"), "A", "fresh"), (6, def_path(11, "bad"), "A", "fresh"),
        (7, def_path(11, "empty"), "A", ""),                             # passes no version
        (8, def_path(11, "to"), "R", "same text", def_path(11, "from")),
        (9, def_path(11, "local"), "A", "theirs"),                       # added on both sides
        (10, def_path(10, "moves"), "D", None), (11, def_path(11, "moves"), "A", "x"),
        (12, "README.md", "M", "docs"), (13, "definitions/v11/schema.json", "M", "{}"), (14, ".github/workflows/x.yml", "A", "x"),
        (15, def_path(11, "brief"), "A", "x"), (16, def_path(11, "brief"), "D", None), (17, def_path(11, "still"), "M", "x"),
        (18, def_path(11, "odd"), "A", "v10 only")])
    blocked = spark.createDataFrame([("bad",)], "key string")
    pairs = spark.createDataFrame([("new", "victim"), ("bad", "two"), ("new", "new")], "key string, replaced string")
    result = sync_flow.replay(spark, root, log, "up", rules(), 12, blocked, pairs)
    want = [(10, "mod", "v10 only"), (10, "odd", "v10 only"), (10, "two", "old"), (11, "local", "theirs"), (11, "mod", "x"), (11, "moves", "x"),
            (11, "new", "fresh"), (11, "still", "x"), (11, "to", "same text"), (11, "two", "second"), (12, "empty", "")]
    assert held(spark, root) == want
    assert {r["status"]: r["n"] for r in result.report.collect()} == {"A": 3, "M": 3, "D": 1, "R": 2}
    assert [r["key"] for r in result.changes.where("both_added").collect()] == ["local"]
    assert [tuple(r) for r in result.backports.collect()] == [("two", 11, 10)]
    assert result.manifest.marks == {"up": 18}
    # the same rows again, and rows before the mark, are no batch
    assert sync_flow.replay(spark, root, log, "up", rules(), 12, blocked, pairs) is None
    assert store.read_manifest(spark, root) == result.manifest and held(spark, root) == want
    # rows that change nothing move the mark and keep every partition
    same = sync_flow.replay(spark, root, log_of(spark, [(19, def_path(11, "two"), "M", "second")]), "up", rules(), 12)
    assert same.manifest.parts == result.manifest.parts and same.manifest.marks == {"up": 19} and same.changes.count() == 0
    with pytest.raises(RuntimeError, match="more than 1"):
        sync_flow.replay(spark, root, log_of(spark, [(20, def_path(11, "p"), "A", "x"), (21, def_path(11, "q"), "A", "x")]), "up", rules(), 12, max_changes=1)
    assert held(spark, root) == want


def test_run_sync_holds_versions_apart(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, DELTA).withColumn("content_hash", M.content_hash("content"))
    old = make([(10, "k", "a"), (11, "k", "b"), (10, "gone", "x"), (11, "gone", "x")])
    new = make([(10, "k", "a"), (11, "k", "c"), (10, "gone", "x")])
    out = str(tmp_path / "out")
    M.run_sync(old, new, out, rules(), 12)
    assert sorted((r["version"], r["key"], r["content"]) for r in spark.read.parquet(out).collect()) == [(10, "k", "a"), (11, "k", "c")]
    with pytest.raises(ValueError, match="twice"):
        M.run_sync(old.unionByName(old), new, out, rules(), 12)
