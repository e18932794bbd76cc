"""Plan checks: native operators stay in the JVM, dimensions broadcast, windows are keyed."""

from feedloom.plans import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_native_and_broadcasts(spark, sf_dir):
    p = plan(queries()["nav_search"](spark, sf_dir))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    assert "TakeOrderedAndProject" in p


def test_scan_prunes_columns(spark, sf_dir):
    df = queries()["Q12_filter_contains"](spark, sf_dir)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p or \
        "ReadSchema: struct<doc_id:bigint,source:string,text:string>" in p


def test_windows_are_partitioned(spark, sf_dir):
    for key in ("A9_carry_header", "O4_top_per_group", "A3_json_rows"):
        p = plan(queries()[key](spark, sf_dir))
        assert "SinglePartition" not in p, key


def test_native_chain_has_no_python(spark, sf_dir):
    for key in ("F1_re_replace", "F22_fuzzytime", "N1_to_bytes", "B10_field_chain", "L14_report_all"):
        p = plan(queries()[key](spark, sf_dir))
        assert "Python" not in p, key


def test_top_k_is_cut_map_side(spark, sf_dir):
    p = plan(queries()["O4_top_per_group"](spark, sf_dir))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_category_maps_broadcast(spark, sf_dir):
    for key in ("C1_map_category", "C2_map_category_multi", "C9_category_rename"):
        p = plan(queries()[key](spark, sf_dir))
        assert "BroadcastHashJoin" in p, key
        assert "SortMergeJoin" not in p, key


def test_sync_diff_is_one_full_outer_join(spark, sf_dir):
    p = plan(queries()["M1_snapshot_diff"](spark, sf_dir))
    assert "Scan ExistingRDD" in p or "FullOuter" in p  # checkpointed change set


def test_scans_are_spread_only_when_the_session_says_so(spark, sf_dir):
    from feedloom.plans.tables import table
    assert "Exchange" not in plan(table(spark, sf_dir, "events", spread=True))
    spark.conf.set("spark.feedloom.spreadPartitions", "4")
    try:
        assert "Exchange" in plan(table(spark, sf_dir, "events", spread=True))
        assert "Exchange" not in plan(table(spark, sf_dir, "events"))
    finally:
        spark.conf.unset("spark.feedloom.spreadPartitions")


def test_overlap_joins_have_no_nested_loop(spark, sf_dir):
    for key in ("A14_route_paths", "Q10_filter_category", "C6_default_categories"):
        p = plan(queries()[key](spark, sf_dir))
        assert "NestedLoop" not in p and "Cartesian" not in p, key


def test_a_page_reads_its_ranges_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from feedloom.operators import paging
    df = spark.range(10_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 7).alias("v"))
    keys = [("v", "desc"), ("id", "asc")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paging.write_ordered(df, keys, str(tmp_path / "p"), ranges=16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = sorted(((r["v"], r["id"]) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for page, size in ((0, 10), (37, 25), (0, 10_000), (999, 10), (1000, 10), (3, 3000)):
        got = paging.read_page(spark, str(tmp_path / "p"), df.schema, keys, page, size)
        assert [(r["v"], r["id"]) for r in got.collect()] == rows[page * size:page * size + size]
    one = paging.read_page(spark, str(tmp_path / "p"), df.schema, keys, 100, 10)
    files = {f.rsplit("_range=", 1)[1].split("/")[0] for f in one.inputFiles()}
    assert "PartitionFilters: [isnotnull(_range" in plan(one) or "PartitionFilters: [_range" in plan(one), plan(one)
    assert len(files) == 16  # what is listed; the filter leaves the page's own
    paging.write_ordered(df.limit(0), keys, str(tmp_path / "e"))
    assert paging.read_page(spark, str(tmp_path / "e"), df.schema, keys, 0, 5).count() == 0


def test_paths_meet_requests_once(spark):
    from feedloom.sources.extract import route_paths
    req = spark.createDataFrame([(1, [5, 6, 5, None]), (1, [5, 6, 5, None]), (2, None), (3, [])], "r int, req_categories array<bigint>")
    paths = spark.createDataFrame([("both", [6, 5]), ("none", [9]), ("any", None), ("empty", []), ("null", [None])], "p string, path_categories array<bigint>")
    got = sorted((r["r"], r["p"]) for r in route_paths(req, paths).collect())
    assert got == [(1, "any"), (1, "any"), (1, "both"), (1, "both"), (2, "any"), (3, "any")]
