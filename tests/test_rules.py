"""Rule constructors and category operators on small frames."""

from pyspark.sql import functions as F

from feedloom.operators import catalog as C
from feedloom.operators import quality as L
from feedloom.operators.query import filter_category


def _rules(spark, rows, schema, rules):
    df = spark.createDataFrame(rows, schema)
    return sorted((r.id, r.path, r.rule, r.value) for r in L.check(df, "id", rules).collect())


def test_type_enum_pattern_uri(spark):
    got = _rules(spark, [(1, "12", "a", "https://x.example/p"), (2, "1.5", "z", "/rel"), (3, "true", "b", None)],
                 "id int, n string, e string, u string",
                 [L.dq_type("n", "int|boolean", "n"), L.dq_enum("e", ["a", "b"], "e"),
                  L.dq_value_pattern("e", "^[a-y]$", path="e"), L.dq_uri("u", "u")])
    assert got == [(2, "e", "enum", "z"), (2, "e", "pattern", "z"), (2, "n", "type", "1.5"), (2, "u", "uri", "/rel")]


def test_map_rules_and_normalised_keys(spark):
    df = spark.createDataFrame([(1, {"k": "1", "True": "x"}), (2, {"k": "2"})], "id int, m map<string,string>")
    rules = [L.dq_unknown_keys("m", ["k"], "m"), L.dq_key_pattern("m", [r"^[a-z]+$"], "m"),
             L.dq_map_values("m", "int", "m")]
    got = sorted((r.id, r.rule, r.value) for r in L.check(df, "id", rules).collect())
    assert got == [(1, "key_pattern", "True"), (1, "map_values", "True"), (1, "unknown_keys", "True")]
    norm = df.select(F.array_sort(F.map_keys(L.normalise_keys("m"))).alias("k")).collect()
    assert [r.k for r in norm] == [["k", "true"], ["k"]]


def test_one_of_conditional_nested(spark):
    df = spark.createDataFrame([(1, "a", None, ["x", "y", "x"]), (2, None, None, []), (3, "a", "b", ["q"])],
                               "id int, a string, b string, xs array<string>")
    rules = [L.dq_one_of("a", "b"),
             L.dq_conditional(F.col("a").isNotNull(), L.dq_unique_items("xs", "xs")),
             L.dq_nested("xs", "no_x", "xs", lambda x: x == "x", lambda x: x)]
    got = sorted((r.id, r.path, r.rule) for r in L.check(df, "id", rules).collect())
    assert got == [(1, "xs", "unique_items"), (1, "xs/1", "no_x"), (1, "xs/3", "no_x"),
                   (2, "one_of", "one_of"), (3, "one_of", "one_of")]


def test_validation_summary_rollup(spark):
    items = spark.createDataFrame([(1, "en"), (2, "en"), (3, "fr")], "id int, lang string")
    errors = spark.createDataFrame([(2, "t", "required"), (2, "l", "enum")], "id int, path string, rule string")
    got = {r.lang: (r.total, r.errors, r.success) for r in L.validation_summary(items, errors, "id", "lang").collect()}
    assert got == {"en": (2, 1, 1), "fr": (1, 0, 1), None: (3, 1, 2)}


def test_category_closure_and_parent_filter(spark):
    cats = spark.createDataFrame([(5000, "TV"), (5040, "TV/HD"), (2000, "Movies"), (2040, "Movies/HD")],
                                 "cat_code bigint, cat_name string")
    cl = {(r.parent_code, r.child_code) for r in C.category_closure(cats).collect()}
    assert cl == {(5000, 5000), (5000, 5040), (2000, 2000), (2000, 2040)}
    recs = spark.createDataFrame([(1, [5040]), (2, [2040]), (3, [100123]), (4, None)], "id int, categories array<bigint>")
    assert sorted(r.id for r in filter_category(recs, [5000]).collect()) == [1]
    assert sorted(r.id for r in filter_category(recs, [2040, 100123]).collect()) == [2, 3]


def test_multi_map_never_multiplies(spark):
    recs = spark.createDataFrame([("s", "1", 10), ("s", "2", 11)], "source string, site_id string, n int")
    cmap = spark.createDataFrame([("s", "1", 5040), ("s", "1", 2040), ("s", "1", 5040)],
                                 "source string, site_id string, cat_code bigint")
    out = C.map_category_multi(recs, cmap).collect()
    assert len(out) == 2
    assert {r.site_id: r.categories for r in out} == {"1": [2040, 5040], "2": None}
    assert C.custom_code is not None
    code = recs.select(C.custom_code(F.col("site_id")).alias("c")).collect()
    assert all(100000 <= r.c < 1000000 for r in code)


def test_category_rename_rules(spark):
    df = spark.createDataFrame([("console/xbox one",), ("Books/ebook",), ("Console/WiiWare/VC",)], "n string")
    got = [r.n for r in df.select(C.category_rename("n").alias("n")).collect()]
    assert got == ["console/XBox One", "Books/EBook", "Console/Wiiware"]
