"""Element intervals of irregular pages."""

from pyspark.sql import functions as F

from feedloom.sources import elements as E


def shape(html):
    text, found = E.parse_page(html)
    return [(e["tag"], e["depth"], e["nth"], e["nth_of_tag"], text[e["text_from"]:e["text_to"]]) for e in found]


def test_missing_end_tags():
    assert shape("<ul><li>a<li>b<ul><li>c</ul>d<li>e</ul>f") == [
        ("ul", 0, 1, 1, "abcde"), ("li", 1, 1, 1, "a"), ("li", 1, 2, 2, "bcd"), ("ul", 2, 1, 1, "c"), ("li", 3, 1, 1, "c"), ("li", 1, 3, 3, "e")]
    assert shape("<table><tr><td>1<td>2<table><tr><td>in</table><tr><th>3</table>") == [
        ("table", 0, 1, 1, "12in3"), ("tr", 1, 1, 1, "12in"), ("td", 2, 1, 1, "1"), ("td", 2, 2, 2, "2in"), ("table", 3, 1, 1, "in"), ("tr", 4, 1, 1, "in"),
        ("td", 5, 1, 1, "in"), ("tr", 1, 2, 2, "3"), ("th", 2, 1, 1, "3")]
    assert shape("<p>a<b>b<p>c</p>d<div>e") == [("p", 0, 1, 1, "ab"), ("b", 1, 1, 1, "b"), ("p", 0, 2, 2, "c"), ("div", 0, 3, 1, "e")]
    assert shape("<dl><dt>a<dd>b<dt>c</dl><select><option>x<option>y</select>") == [
        ("dl", 0, 1, 1, "abc"), ("dt", 1, 1, 1, "a"), ("dd", 1, 2, 1, "b"), ("dt", 1, 3, 2, "c"), ("select", 0, 2, 1, "xy"), ("option", 1, 1, 1, "x"),
        ("option", 1, 2, 2, "y")]


def test_odd_markup():
    assert shape("") == shape(None) == [] and shape("no tags < here") == []
    assert shape("</p><br>a<!-- <i>x --><script>if (a<b) '</p><i>'</script><img alt='>'>b</nosuch><I>c") == [
        ("br", 0, 1, 1, ""), ("img", 0, 2, 1, ""), ("i", 0, 3, 1, "c")]
    _, (e,) = E.parse_page("""<a HREF=/x?a=1&amp;b=2 title="a > b" title='second' data-x = 'é' checked>t""")
    assert dict(e["attrs"]) == {"href": "/x?a=1&b=2", "title": "a > b", "data-x": "é", "checked": ""}
    _, (e,) = E.parse_page("<a title='" + "x>" * 50_000 + "'>t")
    assert len(dict(e["attrs"])["title"]) == 100_000
    text, found = E.parse_page("<div>" * 3000 + "x")
    assert text == "x" and found[-1]["depth"] == 2999 and all(e["end"] == 3000 for e in found)


def test_rows_children_and_has(spark):
    html = "<table id=a><tr><td>x<td class=k>y<tr><td>z</table><ul><li>1<ul><li>2</ul></ul>"
    pages = spark.createDataFrame([(1, html), (2, None), (1, html)], "p int, elements string").withColumnRenamed("elements", "h")
    got = E.page_elements(pages, "h", ["p"])
    rows = E.rows_of(got, "tr", ["p"], within="table").select(
        "p", "pos", E.has(F.col("elements"), F.col("e"), "td", "class", "k").alias("k"),
        F.transform(E.children_of(F.col("elements"), F.col("e")), lambda c: E.text_of(c)).alias("cells"))
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 1, True, ["x", "y"]), (1, 1, True, ["x", "y"]), (1, 2, False, ["z"]), (1, 2, False, ["z"])]
    assert E.rows_of(got, "li", ["p"], outermost=True).count() == 2 and E.rows_of(got, "li", ["p"]).count() == 4
    assert E.rows_of(got, "td", ["p"], within="ul").count() == 0


def test_a_batch_is_parsed_in_slices(spark):
    import pyarrow as pa
    sizes = list(E._slices(pa.array([None, "", "<a>", "<p>" * E.SLICE_CHARS, "<b>é"] + ["<i>" * 1000] * 200)))
    assert sizes[:2] == [(0, 3), (3, 1)] and sizes[2][0] == 4 and len(sizes) == 5 and sum(n for _, n in sizes) == 205
    assert list(E._slices(pa.array([], pa.string()))) == []

    class Taken:  # stands for the frame: the function that Spark would send to its workers
        sparkSession, schema = spark, spark.range(1).selectExpr("id AS p", "'' AS h").schema
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run
    html = "<tr><td>x" * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array([html] * 300)], names=["p", "h"])
    out = list(E.page_elements(Taken(), "h", ["p"])(iter([batch])))
    assert len(out) > 5 and max(len(b) for b in out) * len(html) <= E.SLICE_CHARS
    assert [k for b in out for k in b.column(0).to_pylist()] == list(range(300)) and all(len(e) == 2000 for b in out for e in b.column(2))


def test_elements_take_little_more_room_than_their_markup(spark):
    import tracemalloc

    import pyarrow as pa

    class Taken:  # as above
        sparkSession, schema = spark, spark.range(1).selectExpr("id AS p", "'' AS h").schema
        select = lambda self, *_: self
        mapInArrow = lambda self, run, _: run
    html = "<p>ab<b class=k>c</b>" * 20_000  # one long page stands alone in its slice
    run = E.page_elements(Taken(), "h", ["p"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([None, html, "<i>x"])], names=["p", "h"])
    tracemalloc.start()
    try:
        out = list(run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 * len(html)
    got = [dict(zip(("p", "text", "elements"), r.values(), strict=True)) for b in out for r in b.to_pylist()]
    assert [(r["p"], len(r["text"]), len(r["elements"])) for r in got] == [(1, 0, 0), (2, 60_000, 40_000), (3, 1, 1)]
    assert [r["elements"] for r in got] == [E.parse_page(h)[1] for h in (None, html, "<i>x")]
    assert got[1]["elements"][-1] == {"start": 99_997, "end": 99_999, "depth": 1, "tag": "b", "attrs": [("class", "k")], "parent": 99_995, "nth": 1,
                                      "nth_of_tag": 1, "text_from": 59_999, "text_to": 60_000}
