"""Inputs that broke the operators once: kept as cases of their own."""

import datetime as dt

from pyspark.sql import functions as F

from feedloom.functions import chain as C
from feedloom.functions import dates as D
from feedloom.functions import normalise as N
from feedloom.operators import fields as B
from feedloom.operators import quality as L
from feedloom.operators import query as Q
from feedloom.operators import sync as M
from feedloom.operators.numbering import number_in_order
from feedloom.sources import extract as X

AS_OF = "2026-01-20 12:00:00"


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r["r"] for r in df.select("i", expr.alias("r")).orderBy("i").collect()]


def test_now_is_a_word_and_bare_times_take_the_given_day(spark):
    at = dt.datetime(2026, 1, 20, 12, 0)
    assert values(spark, ["unknown", "known issue", "now", "just now"], D.f_timeago("x", AS_OF)) == [None, None, at, at]
    got = values(spark, ["unknown", "12:30", "T12:30", "9:05 pm", "2026-01-02T03:04:05Z"], D.f_fuzzytime("x", AS_OF))
    assert got == [None, dt.datetime(2026, 1, 20, 12, 30), dt.datetime(2026, 1, 20, 12, 30), dt.datetime(2026, 1, 20, 21, 5),
                   dt.datetime(2026, 1, 2, 3, 4, 5)]


def test_small_epochs(spark):
    got = values(spark, ["86400", "0", "1700000000", "1700000000000"], D.to_timestamp_any("x", [], AS_OF))
    assert [g.isoformat() for g in got] == ["1970-01-02T00:00:00", "1970-01-01T00:00:00", "2023-11-14T22:13:20", "2023-11-14T22:13:20"]


def test_size_separators_and_overflow(spark):
    got = values(spark, ["1,5 GB", "1.234,56 MB", "1,234.5 KB", "1,024 KiB", "1.5 GB", "1.234.567 B", "99999 PB", "x"], N.to_bytes("x"))
    assert got == [int(1.5 * 2**30), round(1234.56 * 2**20), round(1234.5 * 1024), 2**20, int(1.5 * 2**30), 1234567, None, None]


def test_case_value_is_one_form_for_all_sizes(spark):
    for extra in ({}, {f"k{i}": str(i) for i in range(12)}):
        mapping = {"a": None, "B": "first", "b": "second", "*": "else", **extra}
        assert values(spark, ["a", "b", "z", None], B.case_value("x", mapping)) == [None, "first", "else", "else"]


def test_bad_values_do_not_end_a_job(spark):
    df = spark.createDataFrame([("t", "n/a")], "title string, seeders string")
    assert B.canonical_project(df).first()["seeders"] is None
    m = spark.createDataFrame([({"True": "1", "true": "2", "x": "3"},)], "m map<string,string>")
    assert m.select(L.normalise_keys("m").alias("m")).first()["m"] == {"true": "1", "x": "3"}
    raw = spark.createDataFrame([(b"ok \xc3\xa9", "UTF-8"), (b"bad \xff!", "UTF-8"), ("Фильм".encode("cp1251"), "windows-1251")],
                                "b binary, c string")
    got = raw.select(X.decode_charset("b", F.col("c")).alias("t")).select("t", X.malformed("t").alias("m")).collect()
    assert [(r["t"], r["m"]) for r in got] == [("ok é", False), ("bad \ufffd!", True), ("Фильм", False)]


def test_repeated_xml_attributes_are_lists(spark):
    body = ('<rss><channel><item><title>t</title><attr name="category" value="1"/><attr name="category" value="2"/>'
            '<attr name="size" value="5"/></item></channel></rss>')
    df = spark.createDataFrame([(body,)], "body string")
    schema = "channel STRUCT<item: ARRAY<STRUCT<title: STRING, attr: ARRAY<STRUCT<_name: STRING, _value: STRING>>>>>"
    r = X.xml_rows(df, "body", schema, "channel.item", pairs="attr").first()
    assert r.attrs == {"category": ["1", "2"], "size": ["5"]}


def test_ties_are_decided_by_the_row(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 5, "c")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, o int, v string").coalesce(1)
        assert Q.first_per_group(df, ["k"], "o").first()["v"] == "a"
        assert Q.dedupe_records(df, ["k"], prefer="o").first()["v"] == "c"
        assert L.resolve_version(df, "k", "o", 9, "v").first()["v"] == "c"


def test_accents_and_lists_of_allowed_values(spark):
    assert values(spark, ["\u1ebf e\u0301 É"], C.f_diacritics("x")) == ["e e E"]
    assert values(spark, ["Czarna komedia / Drama, x"], C.f_validate("x", "Czarna Komedia, drama")) == ["Czarna komedia,Drama"]
    assert values(spark, ["the cat,AND"], C.f_validate("x", "the,and")) == ["the,AND"]


def test_entities_are_decoded_in_one_pass(spark):
    import html
    rows = ["&#8211;x&eacute;", "&#38;lt; &amp;lt; &amp;amp;", "&#x1F600;&#39;", "&nosuch; &#0; &#55296; & &;", "", "no", "a &copy;&nbsp;b &hearts;"]
    got = values(spark, rows, C.f_htmldecode("x", full=True))
    keep = {3: rows[3]}
    assert got == [keep.get(i, html.unescape(r)) for i, r in enumerate(rows)]
    assert values(spark, [None], C.f_htmldecode("x", full=True)) == [None]


def test_rules_by_source_fold_in_order(spark):
    df = spark.createDataFrame([("a", "x1"), ("b", "x1"), (None, "x1")], "source string, t string")
    rules = spark.createDataFrame([("a", 2, "y", "z"), ("a", 1, "x", "y")], "source string, seq int, pattern string, replacement string")
    assert sorted(r["t"] for r in C.cleanup_titles_by_source(df, "t", rules).collect()) == ["x1", "x1", "z1"]


def test_unreadable_values_are_reported_whole(spark):
    df = spark.createDataFrame([(1, "x" * 500)], "k int, body string")
    assert L.load_failure(df, "k", "body").first()["value"] == "x" * 500


def test_events_of_other_and_null_types_keep_their_rows(spark):
    df = spark.createDataFrame([("view",), ("odd",), (None,)], "t string")
    assert [r["path_id"] for r in X.tag_paths(df, "t", {"view": 1}).collect()] == [1, None, None]


def test_numbers_run_on_over_blocks_and_ties(spark):
    df = spark.range(250).select((F.lit(1)).alias("g"), (F.col("id") / 2).cast("int").alias("o"), F.col("id").alias("t"))
    got = number_in_order(df, ["g"], "o", block=16, ties=["t"]).orderBy("t").collect()
    assert [r["rn"] for r in got] == list(range(1, 251))


def test_a_parent_in_parts_numbers_its_children_through(spark):
    df = spark.createDataFrame([("k", 0, ["a", "b"]), ("k", 100, ["c"])], "key string, start long, items array<string>")
    got = {r["child"]: r["pos"] for r in X.nested_rows(df, "items", ["key"], start="start").collect()}
    assert got == {"a": 1, "b": 2, "c": 101}


def test_a_snapshot_with_versions_does_not_differ_from_itself(spark):
    snap = spark.createDataFrame([(10, "k", "a", "h1"), (11, "k", "b", "h2")], "version int, key string, content string, content_hash string")
    assert M.snapshot_diff(snap, snap, ("version", "key")).count() == 0
    changed = spark.createDataFrame([(10, "k", "a", "h1"), (11, "k", "c", "h3")], snap.schema)
    assert [(r["version"], r["status"]) for r in M.snapshot_diff(snap, changed, ("version", "key")).collect()] == [(11, "M")]


def test_sync_moves_changed_items_only_and_leaves_no_stale_version(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "version int, key string, content string").withColumn(
        "content_hash", M.content_hash("content"))
    rules = {10: [L.dq_required("content", "content")],
             11: [L.dq_required("content", "content"), L.dq_value_pattern("content", "v10 only", negate=True, path="content")]}
    old = make([(10, "a", "x"), (11, "same", "v10 only"), (11, "victim", "x"), (11, "mod", "x")])
    new = make([(11, "same", "v10 only"), (11, "victim", "x"), (11, "mod", "v10 only"), (11, "new", "x"), (11, "blocked", "x")])
    blocked = spark.createDataFrame([("blocked",)], "key string")
    pairs = spark.createDataFrame([("blocked", "victim"), ("same", "mod")], "key string, replaced string")
    out = str(tmp_path / "out")
    M.run_sync(make([(9, "z", "x")]), make([(9, "z", "x"), (10, "a", "x")]), out, rules, 12)
    M.run_sync(old, new, out, rules, 12, blocked=blocked, pairs=pairs)
    got = {(r["version"], r["key"]) for r in spark.read.parquet(out).collect()}
    assert got == {(11, "same"), (11, "victim"), (10, "mod"), (11, "mod"), (11, "new")}


def test_orders_and_customers_beyond_one_payload(spark, tmp_path):
    import duckdb

    from feedloom.plans import oracle_sql, queries
    from tests.test_oracle import _digest
    spark.range(2500).select((F.col("id") * 3).alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
                             F.lit("1-URGENT").alias("o_orderpriority")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(250).select(F.lit(0).cast("long").alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"),
                            F.lit("R").alias("l_returnflag")).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(2).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("m").alias("c_mktsegment"),
                          F.lit(1.0).alias("c_acctbal")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    for key in ("A5_nested_rows", "A6_nested_rows_guard", "A10_row_count_guard", "A15_flatten_documents", "A15_flatten_filters", "L11_dq_nested"):
        df = queries()[key](spark, str(tmp_path))
        cur = con.execute(oracle_sql()[key])
        assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest([d[0] for d in cur.description], cur.fetchall()), key
