"""Values that were read wrongly once: dates, sizes, counts, links, settings, summaries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.functions import dates as D
from feedloom.functions import normalise as N
from feedloom.operators import catalog as C
from feedloom.operators import quality as L
from feedloom.plans.q_normalise import REFERENCES

AS_OF = "2026-01-15 12:00:00"  # a Thursday


def values(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", column.alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


def test_sizes(spark):
    texts = ["x264 700 MB", "S01 1.2 GB", "1 234 MB", "-5 MB", "2012 700 MB", "700-800 MB", "12 345 678 B", "5 bananas", "1,5 GB", "x264", "", None,
             "1 024 KiB", "Size: 1.5 TB / 3 files"]
    m = 1024 ** 2
    assert values(spark, texts, N.to_bytes("x")) == [700 * m, round(1.2 * 1024 ** 3), 1234 * m, None, 700 * m, 800 * m, 12345678, 5, 1536 * m, 264,
                                                    None, None, 1024 * 1024, 3 * 1024 ** 4 // 2]


def test_a_size_reads_its_text_once(spark):
    steps = spark.range(1).select(F.concat(F.lit("Show "), "id", F.lit(" MB")).alias("x")).select(N.to_bytes("x").alias("v"))
    plan = steps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Show ") == 1 and plan.count("Б") < 20
    assert values(spark, ["700 МБ", "1,5 гб x", "5 Б", "5 Бит", "-5 КБ", "1\u00a0234 КБ", "5 MB."], N.to_bytes("x")) == [
        700 * 1024 ** 2, 3 * 1024 ** 3 // 2, 5, 5, None, 1234 * 1024, 5 * 1024 ** 2]


def test_coarse_scans_are_dealt_over_all_cores(spark, tmp_path):
    from feedloom.plans.q_normalise import q_n1_text
    spark.range(100).selectExpr("id AS p_partkey", "CAST(1 AS INT) AS p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    sizes = q_n1_text(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in sizes) == 100


def test_counts(spark):
    texts = ["1.5k", "12 of 30", "-5", "9" * 30, "1,234 seeders", "2m", "1 234", "1.234.567", "n/a", None, "7.9", "x3y"]
    assert values(spark, texts, N.to_count("x")) == [1500, 12, -5, None, 1234, 2_000_000, 1234, 1234567, 0, 0, 7, 3]


def test_days_and_dates(spark):
    formats = ["dddd, d MMMM yyyy", "dddd d MMM yyyy HH:mm"]
    texts = ["Friday, 13 June 2014", "Monday 2 Feb 2015 10:00", "yesterdays news", "Monday", "last Monday 10:00", "Yesterday, 6:00 AM", "today at 23:15",
             "Friday the 13th", "todayish", "1,5 hours ago", "1,500 mins ago", "2 days, 4 hours ago"]
    d = dt.datetime
    assert values(spark, texts, D.f_fuzzytime("x", AS_OF, formats)) == [
        d(2014, 6, 13), d(2015, 2, 2, 10), None, d(2026, 1, 12), d(2026, 1, 12, 10), d(2026, 1, 14, 6), d(2026, 1, 15, 23, 15), None, None,
        d(2026, 1, 15, 10, 30), d(2026, 1, 14, 11), d(2026, 1, 13, 8)]


def test_formats_by_source(spark):
    specs = spark.createDataFrame([("a", 1, "dd/MM/yyyy", None, None), ("a", 2, "MM/dd/yyyy", None, None), ("b", 1, "d MMM yyyy HH:mm", "+03:00", "ru"),
                                   (None, 1, "yyyy", None, None), ("c", 1, None, None, None)],
                                  "source string, seq int, format string, zone string, lang string")
    rows = [("a", "03/04/2020"), ("a", "12/31/2020"), ("a", "x"), ("b", "5 мая 2017 18:41"), ("c", "2020"), (None, "2020"), ("zz", "2020"), ("a", None),
            ("a", "03/04/2020")]
    df = spark.createDataFrame([(i, *r, "mine") for i, r in enumerate(rows)], "i int, source string, t string, Parsed string")
    got = D.parse_by_source(df, "t", specs)
    assert got.columns == ["i", "source", "t", "parsed"]
    d = dt.datetime
    assert [r["parsed"] for r in sorted(got.collect())] == [
        d(2020, 4, 3), d(2020, 12, 31), None, d(2017, 5, 5, 15, 41), None, None, None, None, d(2020, 4, 3)]
    none = D.parse_by_source(df, "t", specs.limit(0))
    assert none.count() == len(rows) and none.where("parsed is not null").count() == 0


@pytest.mark.parametrize("base", ["http://a/b/c/d;p?q"])
def test_references(spark, base):
    got = values(spark, [r for r, _ in REFERENCES], N.resolve_reference("x", base))
    assert got == [w.replace("@", "http://a") for _, w in REFERENCES]
    links = ["../a", "mailto:a@b", "?page=2", "a/b", "/a", "//other/x", "https://z/", None, "magnet:?xt=1"]
    assert values(spark, links, N.resolve_url("x", "https://h.example/dir/")) == [
        "https://h.example/a", "mailto:a@b", "https://h.example/dir/?page=2", "https://h.example/dir/a/b", "https://h.example/a", "https://other/x",
        "https://z/", None, "magnet:?xt=1"]
    assert values(spark, ["g", "?y", ""], N.resolve_reference("x", "http://a")) == ["http://a/g", "http://a?y", "http://a"]


def test_settings_keep_user_values_and_rows(spark):
    defaults = spark.createDataFrame([("s", "sort", "time"), ("s", "user", ""), ("s", "user", ""), ("t", "sort", "time")], "source string, name string, default string")
    user = spark.createDataFrame([("s", "sort", "bogus"), ("s", "user", "me"), ("t", "sort", "size")], "source string, name string, user_value string")
    options = spark.createDataFrame([("s", "sort", "time"), ("s", "sort", "size"), ("s", "sort", "size"), ("t", "sort", "size")],
                                    "source string, name string, opt_key string")
    for o, want in ((options, "time"), (None, "bogus")):
        got = C.filtered_settings(defaults, user, options=o)
        assert sorted((r["source"], r["name"], r["value"]) for r in got.collect()) == [
            ("s", "sort", want), ("s", "user", "me"), ("s", "user", "me"), ("t", "sort", "size")]


def test_null_groups_are_not_totals(spark):
    items = spark.createDataFrame([(1, None), (2, None), (3, "a")], "k int, g string")
    errors = items.where("k = 1").select("k")
    got = {(r["g"], r["level"]): (r["total"], r["errors"]) for r in L.validation_summary(items, errors, "k", "g").collect()}
    assert got == {(None, 0): (2, 1), ("a", 0): (1, 0), (None, 1): (3, 1)}
    assert L.validation_summary(items, errors, "k").first()["level"] == 1
    levels = sorted((r["g"] or "", r["level"], r["n"]) for r in C.source_profile(items, ["g"]).collect())
    assert levels == [("", 0, 2), ("", 1, 3), ("a", 0, 1)]
    assert C.source_profile(items, ["g"], cube=False).where(F.col("level") == 0).count() == 2


def test_literals_that_every_match_holds():
    from feedloom.functions.chain import required_literal
    cases = {r"(?i)\btoken\b": "token", r"TOKEN = ": "token = ", r"[0-9]+": None, r"a|b": None, r"colou?r": "colo", r"ab*c": "a", r"x+y": "x",
             r"\[HD\] (foo|bar) long end": " long end", r"(?u)k": None, r"a{2}bc": "bc", r"\Qa\E": None, r"[a\]b]xy": "xy", r"[]a]xy": "xy", r"[^]]zz": "zz",
             r"\p{L}+end": "end", r"\x41Bq": "bq", r"": None, None: None, r"S(\d+)E(\d+)": "s", r"(abc)?d": "d", r"é.ÀBC": "bc", r"a(?=long)b": "a"}
    assert {p: required_literal(p) for p in cases} == cases


def test_a_thousand_rules_fold_like_all_of_them(spark):
    import re

    from feedloom.functions import chain as C
    rules = [("a", i, rf"(?i)\bword{i}\b", f"w{i + 1}ord") for i in range(1000)] + [("a", 1000, r"w(\d+)ord", "[$1]"), ("b", 1, "x", "word7"), ("b", 2, "word7", "y")]
    texts = ["Word3 and WORD999 wordx", "none", "", None, "word1word", "word12 word12"]
    df = spark.createDataFrame([(s, t) for s in ("a", "b", None) for t in texts], "source string, t string")
    got = C.cleanup_titles_by_source(df, "t", spark.createDataFrame(rules, "source string, seq int, pattern string, replacement string"), out="o").collect()
    for r in got:
        want = r["t"]
        for s, _, p, rep in rules:
            if want is not None and s == r["source"]:
                want = re.sub(p, rep.replace("$1", r"\1"), want)
        assert r["o"] == want, r


def test_hot_groups_get_buckets_by_their_size(spark):
    from feedloom.operators.numbering import hot_buckets, number_within
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("g"), F.col("id").alias("k"))
    sized = {r["hot"]: r["n"] for r in df.select((F.col("g") == -1).alias("hot"), hot_buckets(df, ["g"], 4, 20).alias("n")).distinct().collect()}
    assert sized == {True: 50, False: 4}
    got = number_within(df, ["g"], "k", buckets=4, bucket_rows=20)
    assert sorted(r["rn"] for r in got.where("g = -1").collect()) == list(range(1, 1001)) and got.where("g <> -1 and rn <> 1").count() == 0
    assert number_within(df.limit(0), ["g"], "k").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Subquery")[0]


def test_variants_fold_and_null_titles_are_rejected(spark):
    from feedloom.operators import fields as B
    df = spark.createDataFrame([("", "b", None, "2020-01-02", "1", "p"), ("a", "b", "2021-01-01", "2020-01-02", "x", "p"), (None, None, "bad", None, None, "p")],
                               "title string, title_alt string, date_x string, date string, seeders string, _private string")
    good, bad = B.canonical_records(df)
    assert [(r["title"], str(r["date"]), r["seeders"]) for r in good.collect()] == [("b", "2020-01-02 00:00:00", 1)]
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["missing: seeders", "missing: title,seeders"]
    with pytest.raises(ValueError, match="outside"):
        B.canonical_project(df.withColumn("nothing_like", F.lit(1)))


def test_arrays_in_order_cut_hot_and_null_groups(spark):
    from feedloom.operators.numbering import arrays_in_order, number_in_order
    rows = [("hot", i * 3 % 401) for i in range(401)] + [("a", 7), ("a", 5)] + [(None, i) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, o int")
    got = {}
    for r in arrays_in_order(df, ["g"], "o", ["o"], 10, block=32).collect():
        assert 0 < len(r["items"]) <= 10
        got.setdefault(r["g"], []).append((r["start"], [x["o"] for x in r["items"]]))
    for g, parts in got.items():
        whole = []
        for start, part in sorted(parts):
            assert start == len(whole)
            whole += part
        assert whole == sorted(o for h, o in rows if h == g)
    assert set(got) == {"hot", "a", None}
    numbered = number_in_order(df, ["g"], "o", block=32).collect()
    assert sorted((r["g"] or "", r["o"]) for r in numbered) == sorted((g or "", o) for g, o in rows)
    assert all(r["rn"] == r["o"] + 1 for r in numbered if r["g"] != "a")
    assert arrays_in_order(df.limit(0), ["g"], "o", ["o"], 10).count() == 0


def test_entities_of_any_length_and_without_semicolon(spark):
    from feedloom.functions import chain as C
    cases = {"&#00000038;x": "&x", "&#x0000026;": "&", "&#38 &#x41g &#65b": "& Ag Ab", "a &amp b &copy": "a & b \u00a9", "&#150;&#x80;&#129;": "\u2013\u20ac\u0081",
             "?a=1&copy=2&regions=3": "?a=1&copy=2&regions=3", "&#99999999999999999999;&#x110000;&#xFFFFFFFFFFFF;": "&#99999999999999999999;&#x110000;&#xFFFFFFFFFFFF;",
             "&#;&#x;": "&#;&#x;", "&CounterClockwiseContourIntegral;&NotEqualTilde;": "\u2233\u2242\u0338", "&amp;lt;": "&lt;"}
    df = spark.createDataFrame(list(cases.items()), "x string, want string")
    for r in df.select("want", C.f_htmldecode("x", full=True).alias("got")).collect():
        assert r["got"] == r["want"]


def test_every_named_entity_is_decoded(spark):
    from html.entities import html5

    from feedloom.functions import chain as C
    names = [(f"&{n}", t) for n, t in html5.items()]
    df = spark.createDataFrame(names, "x string, want string")
    assert df.where(C.f_htmldecode("x", full=True) != F.col("want")).count() == 0


def test_tagging_reads_the_input_once(spark):
    from feedloom.operators import fields as B
    from feedloom.operators import query as Q
    df = spark.createDataFrame([("a", "b"), ("", None), (None, "b")], "x string, y string")
    assert [r["reject_reason"] for r in B.tag_required(df, ["x", "y"]).collect()] == [None, "missing: x,y", "missing: x"]
    good, bad = B.required_field(df, ["x", "y"])
    assert (good.columns, good.count(), bad.count()) == (["x", "y"], 1, 2)
    preds = [("one", F.col("x") == "a"), ("two", F.col("y") == "b")]
    assert [r["error_rule"] for r in Q.tag_errors(df, preds).collect()] == ["one", None, "two"]
    assert [r["error_rule"] for r in Q.tag_errors(df, []).collect()] == [None] * 3


def test_entities_beside_marks_and_of_many_kinds(spark):
    from feedloom.functions import chain as CH
    many = "".join(f"&#{i};" for i in range(0x4E00, 0x4E00 + 200)) * 2
    texts = ["&&#35;35;&amp;lt;", "\ufdd0&lt;\ufdd1&amp;", "&#xFDD0;&amp;lt;&#xFDD1;&lt;", many, "$1\\&amp;&ampx&amp;&amp", "none", "", None, "a & b"]
    assert values(spark, texts, CH.f_htmldecode("x", full=True)) == [
        "&#35;&lt;", "\ufdd0<\ufdd1&", "\ufdd0&lt;\ufdd1<", "".join(map(chr, range(0x4E00, 0x4E00 + 200))) * 2, "$1\\&&ampx&&", "none", "", None, "a & b"]
    once = spark.range(1).select(F.concat(F.lit("Show "), "id").alias("x")).select(CH.f_htmldecode("x", full=True).alias("v"))
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Show ") == 1  # the text, perhaps dear to make, is made once
