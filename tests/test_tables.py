"""Table-level operators: extraction, fields, query, sync and quality on small frames."""

from pyspark.sql import functions as F

from feedloom.operators import query as Q
from feedloom.operators import quality as L
from feedloom.operators import sync as M
from feedloom.operators.fields import required_field
from feedloom.sources import extract as A


def test_carry_header(spark):
    rows = [("p", 1, "d1", None), ("p", 2, None, "a"), ("p", 3, None, "b"), ("p", 4, "d2", None), ("p", 5, None, "c"),
            ("q", 1, None, "z")]
    df = spark.createDataFrame(rows, "payload string, pos int, hdr string, title string")
    out = A.carry_header(df, ["payload"], "pos", F.col("hdr"), "date", block_rows=2)
    got = sorted((r.payload, r.pos, r.date) for r in out.collect())
    assert got == [("p", 2, "d1"), ("p", 3, "d1"), ("p", 5, "d2"), ("q", 1, None)]


def test_row_count_guard_and_nested_guard(spark):
    df = spark.createDataFrame([("a", 0, []), ("b", 2, [1, 2])], "k string, total int, kids array<int>")
    assert [r.k for r in A.row_count_guard(df, "total").collect()] == ["b"]
    kept = A.nested_rows_guard(df, "kids", ["k"], keep_empty=True).collect()
    dropped = A.nested_rows_guard(df, "kids", ["k"], keep_empty=False).collect()
    assert len(kept) == 3 and len(dropped) == 2


def test_merge_following_rows_window_and_dense_agree(spark):
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(5)], "c int, turn int, text string")
    a = A.merge_following_rows(df, ["c"], "turn", 1, "text", dense_from=0).orderBy("record").collect()
    b = A.merge_following_rows(df, ["c"], "turn", 1, "text").orderBy("record").collect()
    assert [r.merged for r in a] == [r.merged for r in b] == ["t0 t1", "t2 t3", "t4"]


def test_required_field_splits_rows(spark):
    df = spark.createDataFrame([("a", "1"), ("", "2"), (None, None)], "title string, seeders string")
    good, bad = required_field(df, ["title", "seeders"])
    assert good.count() + bad.count() == df.count()
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing: title", "missing: title,seeders"]


def test_top_per_group_matches_plain_window(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")]
    got = Q.top_per_group(li, ["l_returnflag"], order, 5, salt_buckets=4)
    from pyspark.sql import Window
    ref = li.withColumn("rank", F.row_number().over(Window.partitionBy("l_returnflag").orderBy(*order))).filter("rank <= 5")
    cols = ["l_returnflag", "rank", "l_orderkey", "l_linenumber"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, ref.select(cols).collect()))


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([("h", 1, 5), ("h", 2, 9), ("g", 3, 1)], "k string, id int, score int")
    once = Q.dedupe_records(df, ["k"], prefer="score")
    twice = Q.dedupe_records(once, ["k"], prefer="score")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("g", 3, 1), ("h", 2, 9)]


def test_cap_guard(spark):
    import pytest
    df = spark.range(60)
    assert Q.cap_guard(spark.range(10), 50) == 10
    with pytest.raises(RuntimeError):
        Q.cap_guard(df, 50)


def test_diff_apply_roundtrip(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "key string, content string")
    new = spark.createDataFrame([("a", "1"), ("b", "22"), ("d", "4")], "key string, content string")
    h = M.content_hash(F.col("content"))
    diff = M.snapshot_diff(old.withColumn("content_hash", h), new.withColumn("content_hash", h))
    assert sorted((r.key, r.status) for r in diff.collect()) == [("b", "M"), ("c", "D"), ("d", "A")]
    changes = diff.select("key", F.lit(1).alias("seq"),
                          F.when(F.col("status") == "D", "D").otherwise("M").alias("op"),
                          F.col("new_content").alias("content"))
    applied = M.apply_changes(old, changes)
    assert sorted((r.key, r.content) for r in applied.collect()) == sorted((r.key, r.content) for r in new.collect())


def test_rename_pairs_one_to_one_with_copies(spark):
    rows = [("o1", "D", "h", None), ("o2", "D", "h", None), ("n1", "A", None, "h"), ("n2", "A", None, "h"),
            ("n3", "A", None, "h")]
    diff = spark.createDataFrame(rows, "key string, status string, old_hash string, new_hash string")
    r = M.rename_detect(diff).collect()
    assert len(r) == 2 and len({x.old_key for x in r}) == 2 and len({x.new_key for x in r}) == 2


def test_nothing_to_do_and_guard(spark):
    import pytest
    empty = spark.createDataFrame([], "key string, status string")
    assert M.nothing_to_do(empty)
    M.unresolved_guard(empty)
    with pytest.raises(RuntimeError):
        M.unresolved_guard(spark.createDataFrame([("k", "M")], "key string, status string"))


def test_report_first_follows_rule_order(spark):
    df = spark.createDataFrame([(1, "", "xx"), (2, "ok", "en")], "id int, title string, lang string")
    rules = [L.dq_enum("lang", ["en"], "lang"), L.dq_required("title", "title")]
    first = L.report_first(df, "id", rules).collect()
    assert [(r.id, r.rule) for r in first] == [(1, "enum")]
    assert L.check(df, "id", rules).count() == 2


def test_best_version_and_missing_rules(spark):
    df = spark.createDataFrame([(1, "t", "en"), (2, "t", "xx"), (3, "", "en")], "id int, title string, lang string")
    sets = {1: [L.dq_required("title")], 2: [L.dq_required("title"), L.dq_enum("lang", ["en"])]}
    got = {r.id: (r.best_version, r.top_fails) for r in L.best_version(df, "id", sets).collect()}
    assert got == {1: (2, False), 2: (1, True), 3: (0, True)}


def test_numbering_matches_row_number(spark):
    from pyspark.sql import Window

    from feedloom.operators.numbering import number_in_order, number_within
    df = spark.createDataFrame([(g, i * 7 % 101) for g in ("a", "b") for i in range(101)] + [("c", 5)],
                               "g string, o int")
    got = number_in_order(df, ["g"], "o", block=8)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, got.select("g", "o", "rn").collect())) == sorted(map(tuple, ref.collect()))
    nw = number_within(df, ["g"], "o", buckets=4)
    per = {}
    for r in nw.collect():
        per.setdefault(r.g, []).append(r.rn)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in per.values())


def test_cleanup_titles_by_source(spark):
    from feedloom.functions.chain import cleanup_titles_by_source
    rules = spark.createDataFrame([("a", 1, r"(?i)season (\d)", "S0$1"), ("a", 2, "S0", "s0"),
                                   ("b", 1, "x", "y")], "source string, seq int, pattern string, replacement string")
    df = spark.createDataFrame([("a", "Show Season 2"), ("b", "xx"), ("c", "Season 3")], "source string, title string")
    got = {r.source: r.title for r in cleanup_titles_by_source(df, "title", rules).collect()}
    assert got == {"a": "Show s02", "b": "yy", "c": "Season 3"}


def test_html_cells_and_xml_pairs(spark):
    from feedloom.sources.extract import html_rows, xml_rows
    html = "<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>"
    df = spark.createDataFrame([(1, html)], "id int, body string")
    rows = html_rows(df, "body", r"<tr>.*?</tr>", keep=["id"], cells=r"<td[^>]*>(.*?)</td>").collect()
    assert [(r.pos, r.cells) for r in rows] == [(1, ["a", "1"]), (2, ["b", "2"])]
    xml = '<rss><channel><item><title>t</title><attr name="size" value="5"/></item></channel></rss>'
    x = spark.createDataFrame([(xml,)], "body string")
    schema = "channel STRUCT<item: ARRAY<STRUCT<title: STRING, attr: ARRAY<STRUCT<_name: STRING, _value: STRING>>>>>"
    r = xml_rows(x, "body", schema, "channel.item", pairs="attr").collect()[0]
    assert r.attrs == {"size": ["5"]} and r.item.title == "t"


def test_irregular_parser_agrees_with_regex_on_regular_markup(spark, sf_dir):
    from feedloom.operators.fields import select_field
    from feedloom.sources.extract import html_rows, html_rows_irregular
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    slow = html_rows_irregular(pages, "html", "li", ["page_id"]).select("page_id", "pos", "text")
    fast = html_rows(pages, "html", r'<li><a href="[^"]*">[^<]*</a></li>', keep=["page_id"]).select(
        "page_id", "pos", select_field("element").alias("text"))
    assert sorted(map(tuple, slow.collect())) == sorted(map(tuple, fast.collect()))
