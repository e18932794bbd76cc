"""Registered queries: payload scans and row extraction (A1-A17) and the flagship slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chain import f_querystring, f_split
from ..operators.catalog import map_category
from ..operators.fields import select_attribute, select_field
from ..operators.query import filter_contains, limit_top, sort_requested
from ..sources.extract import html_rows
from .fixtures import (
    CATEGORY_SQL,
    PAGE_SECTION_MAP_SQL,
    PART_TYPE_MAP_SQL,
    category_df,
    page_section_map_df,
    part_type_map_df,
)
from .registry import query
from .tables import table

NAV_ITEM = r'<li><a href="[^"]*">[^<]*</a></li>'

# SQL fragments shared by the oracles (DuckDB / RE2 syntax)
SQL_STRIP = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))"
SQL_ATTR = "regexp_extract({x}, '\\b{name}\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"


def nav_links(spark: SparkSession, sf: str) -> DataFrame:
    """pages -> nav list items with position, href, text, section and page number."""
    # page-level fields are computed once per page, before the list items are exploded
    pages = table(spark, sf, "pages", spread=True).select(
        "page_id", "html", f_split(f_split("url", "?", 0), "/", 3).alias("site_id"),
        f_querystring("url", "page").alias("page"))
    rows = html_rows(pages, "html", NAV_ITEM, keep=["page_id", "site_id", "page"])
    return rows.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"),
        select_attribute("element", "href").alias("href"),
        select_field("element").alias("title"),
        "site_id", "page", F.lit("pages").alias("source"))


SQL_NAV_LINKS = f"""
WITH r AS (
  SELECT page_id, url, unnest(m) AS element, unnest(range(1, len(m) + 1)) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '{NAV_ITEM}') AS m FROM pages)
)
SELECT page_id, CAST(pos AS BIGINT) AS pos,
       {SQL_ATTR.format(x='element', name='href')} AS href,
       {SQL_STRIP.format(x='element')} AS title,
       split_part(split_part(url, '?', 1), '/', 4) AS site_id,
       regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
       'pages' AS source
FROM r
"""


def nav_search(spark: SparkSession, sf: str, keyword: str = "the", n: int = 100) -> DataFrame:
    """Flagship slice: nav links -> chain -> category map (broadcast) -> contains filter
    -> top-n by (page desc, position)."""
    recs = nav_links(spark, sf)
    recs = map_category(recs, page_section_map_df(spark), on=("source", "site_id"), how="left")
    recs = recs.join(F.broadcast(category_df(spark)), "cat_code", "left")
    recs = filter_contains(recs, "title", keyword)
    recs = sort_requested(recs, [("page_id", "desc"), ("pos", "asc")])
    return limit_top(recs, n).select("page_id", "pos", "href", "title", "site_id", "page",
                                     "cat_code", "cat_name", "descr")


SQL_NAV_SEARCH = f"""
WITH l AS ({SQL_NAV_LINKS}),
m AS (SELECT * FROM {PAGE_SECTION_MAP_SQL}),
c AS (SELECT * FROM {CATEGORY_SQL})
SELECT l.page_id, l.pos, l.href, l.title, l.site_id, l.page,
       CAST(m.cat_code AS BIGINT) AS cat_code, c.cat_name, m.descr
FROM l LEFT JOIN m ON l.source = m.source AND l.site_id = m.site_id
       LEFT JOIN c ON m.cat_code = c.cat_code
WHERE contains(l.title, 'the')
ORDER BY l.page_id DESC, l.pos ASC
LIMIT 100
"""

query("nav_search", SQL_NAV_SEARCH)(nav_search)
query("A2_html_rows", SQL_NAV_LINKS)(nav_links)


# ----------------------------------------------------------------------------- A1


@query("A1_scan_payloads", """
SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars, 'text/html' AS content_type FROM pages""")
def q_a1(spark, sf):
    from ..sources.extract import scan_payloads
    schema = "page_id BIGINT, url STRING, html STRING"  # declared, never inferred
    df = scan_payloads(spark, f"{sf}/pages.parquet", "parquet", schema)
    return df.select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"),
                     F.lit("text/html").alias("content_type"))


@query("A2_html_irregular", r"""
WITH plain AS (SELECT page_id, regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'), '<!--.*?-->', '', 'gs') AS h FROM pages),
cut AS (SELECT page_id, string_split(h, '<p>') AS parts FROM plain),
p AS (SELECT page_id, unnest(range(1, len(parts))) AS pos, unnest(parts[2:]) AS part FROM cut),
t AS (SELECT page_id, pos, regexp_replace(regexp_extract(part, '^(.*?)(?:</p>|</article>|</div>|</footer>|<div|<h[1-6]|<ul|<table|<footer|$)', 1, 's'), '<[^>]*>', '', 'g') AS x FROM p)
SELECT page_id, pos, CAST(length(trim(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
       '&amp;', '&'), chr(32) || chr(9) || chr(10) || chr(13))) AS BIGINT) AS n_chars FROM t""")
def q_a2_irregular(spark, sf):
    """One row per <p> of every page, most of which hold one without an end tag."""
    from ..sources.extract import html_rows_irregular
    pages = table(spark, sf, "pages", spread=True).select("page_id", "html")
    return html_rows_irregular(pages, "html", "p", ["page_id"]).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.length("text").cast("bigint").alias("n_chars"))


def _blocks_of(df, key, per, item):
    """Rows rendered by ``item`` and joined in order, ``per`` neighbouring keys a page."""
    return df.groupBy(F.floor(F.col(key) / per).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), item.alias("x")))), lambda s: s["x"]), "").alias("items"))


@query("A2_unclosed_cells", """
SELECT p_partkey // 50 AS block, row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) AS pos, CAST(p_partkey AS VARCHAR) AS row_key,
       p_name || ' & co' AS first_cell, p_brand AS second_cell, 'a > ' || p_type AS second_title, CAST(p_size AS VARCHAR) AS last_cell, p_size % 2 = 0 AS marked
FROM part""")
def q_a2_cells(spark, sf):
    """Tables whose rows and cells have no end tags: attributes, nth and last cells, ``:has``."""
    from ..sources import elements as E
    p = table(spark, sf, "part")
    mark = F.when(F.col("p_size") % 2 == 0, "<img class=free src='/x.png'>").otherwise("")
    row = F.concat(F.lit("<tr data-k="), F.col("p_partkey").cast("string"), F.lit("><td><b>"), F.col("p_name"), F.lit("</b> &amp; co"), mark,
                   F.lit('<TD title="a > '), F.col("p_type"), F.lit('">'), F.col("p_brand"), F.lit("<td>"), F.col("p_size").cast("string"))
    pages = _blocks_of(p, "p_partkey", 50, row).select("block", F.concat(
        F.lit("<!-- <tr><td>no --><table><thead><tr><th>Key<th>Name<tbody>"), "items", F.lit("</table><script>var t='<tr><td>';</script>")).alias("html"))
    rows = E.rows_of(E.page_elements(pages, "html", ["block"]), "tr", ["block"], within="tbody")
    e, every = F.col("e"), F.col("elements")
    rows = rows.withColumn("cells", E.children_of(every, e, "td"))
    cell = lambda n: F.element_at("cells", n)
    return rows.select("block", F.col("pos").cast("bigint").alias("pos"), F.element_at(e["attrs"], F.lit("data-k")).alias("row_key"),
                       E.text_of(cell(1)).alias("first_cell"), E.text_of(cell(2)).alias("second_cell"),
                       F.element_at(cell(2)["attrs"], F.lit("title")).alias("second_title"), E.text_of(cell(-1)).alias("last_cell"),
                       E.has(every, e, "img", "class", "free").alias("marked"))


@query("A2_nested_lists", """
WITH c AS (SELECT c_custkey // 100 AS block, c_custkey // 10 % 10 AS grp, c_custkey, c_name, c_mktsegment FROM customer),
g AS (SELECT block, grp, count(*) AS n FROM c GROUP BY block, grp)
SELECT c.block, row_number() OVER (PARTITION BY c.block, c.grp ORDER BY c.c_custkey) AS inner_pos,
       dense_rank() OVER (PARTITION BY c.block ORDER BY c.grp) AS outer_pos, g.n AS inner_items,
       '/c/' || CAST(c_custkey AS VARCHAR) || '?a=1&b=2' AS href, c_name AS title, c_mktsegment AS note
FROM c JOIN g ON g.block = c.block AND g.grp = c.grp""")
def q_a2_lists(spark, sf):
    """Lists in list items, no item closed: the outer rows, their inner rows, links and text."""
    from ..sources import elements as E
    k = F.col("c_custkey")
    inner = F.concat(F.lit("<li class='c'><a href='/c/"), k.cast("string"), F.lit("?a=1&amp;b=2'>"), F.col("c_name"), F.lit("</a> <i>"),
                     F.col("c_mktsegment"), F.lit("</i>"))
    c = table(spark, sf, "customer")
    groups = _blocks_of(c, "c_custkey", 10, inner).select(F.col("block").alias("g"), F.concat(F.lit("<li>group<ul>"), "items", F.lit("</ul>")).alias("x"))
    pages = _blocks_of(groups, "g", 10, F.col("x")).select("block", F.concat(F.lit("<ul id=top>"), "items", F.lit("</ul><p>end")).alias("html"))
    outer = E.rows_of(E.page_elements(pages, "html", ["block"]), "li", ["block"], outermost=True)
    every, e = F.col("elements"), F.col("e")
    nested = outer.withColumn("rows", E.descendants(every, e, "li")).select(
        "block", "page_text", "elements", F.col("pos").alias("outer_pos"), F.size("rows").alias("n"), F.posexplode("rows").alias("i", "r"))
    r = F.col("r")
    link = F.get(E.descendants(every, r, "a"), F.lit(0))
    return nested.select("block", (F.col("i") + 1).cast("bigint").alias("inner_pos"), F.col("outer_pos").cast("bigint").alias("outer_pos"),
                         F.col("n").cast("bigint").alias("inner_items"), F.element_at(link["attrs"], F.lit("href")).alias("href"),
                         E.text_of(link).alias("title"), E.text_of(F.get(E.descendants(every, r, "i"), F.lit(0))).alias("note"))


# ----------------------------------------------------------------------------- A3-A7

# Payloads are rendered per (key, block of 1000 ids): bounded size, like a result page.
PAGE_BLOCK = 1000


@query("A3_json_rows", f"""
SELECT user_id, event_id // {PAGE_BLOCK} AS page,
       row_number() OVER (PARTITION BY user_id, event_id // {PAGE_BLOCK} ORDER BY event_id) AS pos,
       event_id AS id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""")
def q_a3(spark, sf):
    from ..sources.extract import json_rows
    e = table(spark, sf, "events")
    item = F.struct(F.col("event_id").alias("id"), "event_type",
                    F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    payload = (e.groupBy("user_id", F.floor(F.col("event_id") / PAGE_BLOCK).alias("page"))
                .agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("data"))).alias("body")))
    schema = "data ARRAY<STRUCT<id: BIGINT, event_type: STRING, k: BIGINT>>"
    rows = json_rows(payload, "body", "data", schema, keep=["user_id", "page"])
    return rows.select("user_id", "page", F.col("pos").cast("bigint").alias("pos"), "item.*")


def _xml_escape(c):
    from ..functions.chain import f_htmlencode
    return f_htmlencode(c)


XML_SCHEMA = ("channel STRUCT<item: ARRAY<STRUCT<guid: BIGINT, title: STRING, "
              "enclosure: STRUCT<_url: STRING, _length: BIGINT>, attr: ARRAY<STRUCT<_name: STRING, _value: STRING>>>>>")


@query("A4_xml_rows", f"""
SELECT p_brand AS brand, p_partkey // 100 AS block,
       row_number() OVER (PARTITION BY p_brand, p_partkey // 100 ORDER BY p_partkey) AS pos,
       p_partkey AS guid, p_name AS title, 'https://parts.example/' || CAST(p_partkey AS VARCHAR) || '.torrent' AS link,
       CAST(p_size AS BIGINT) AS length, CAST(p_size AS VARCHAR) AS size, p_type AS type
FROM part""")
def q_a4(spark, sf):
    from ..sources.extract import xml_pairs, xml_rows
    p = table(spark, sf, "part")
    item_xml = F.concat(
        F.lit("<item><guid>"), F.col("p_partkey").cast("string"), F.lit("</guid><title>"), _xml_escape(F.col("p_name")),
        F.lit('</title><enclosure url="https://parts.example/'), F.col("p_partkey").cast("string"),
        F.lit('.torrent" length="'), F.col("p_size").cast("string"), F.lit('"/><attr name="size" value="'),
        F.col("p_size").cast("string"), F.lit('"/><attr name="type" value="'), _xml_escape(F.col("p_type")),
        F.lit('"/></item>'))
    feed = (p.groupBy(F.col("p_brand").alias("brand"), F.floor(F.col("p_partkey") / 100).alias("block"))
             .agg(F.array_sort(F.collect_list(F.struct("p_partkey", item_xml.alias("x")))).alias("items"))
             .select("brand", "block", F.concat(F.lit("<rss><channel>"),
                                                F.array_join(F.transform("items", lambda i: i["x"]), ""),
                                                F.lit("</channel></rss>")).alias("body")))
    rows = xml_rows(feed, "body", XML_SCHEMA, "channel.item", keep=["brand", "block"])
    pairs = xml_pairs(F.col("item.attr"))  # name -> values
    return rows.select("brand", "block", F.col("pos").cast("bigint").alias("pos"),
                       F.col("item.guid").alias("guid"), F.col("item.title").alias("title"),
                       F.col("item.enclosure._url").alias("link"), F.col("item.enclosure._length").alias("length"),
                       F.try_element_at(pairs, F.lit("size"))[0].alias("size"), F.try_element_at(pairs, F.lit("type"))[0].alias("type"))


NESTED_SCHEMA = ("results ARRAY<STRUCT<key: BIGINT, priority: STRING, start: BIGINT, "
                 "items: ARRAY<STRUCT<l_linenumber: INT, l_quantity: DOUBLE>>>>")


CHILDREN_PER_PAYLOAD = 100


def _order_payloads(spark, sf, returned_only: bool):
    """Nested-JSON payloads of orders with their lines: one payload per order and 100 lines,
    by the lines' number in the order. Each payload carries how many lines come before it.
    An order holding a third of all lines is numbered in blocks, spread over many tasks."""
    from ..operators.numbering import arrays_in_order
    o = table(spark, sf, "orders", spread=True).select("o_orderkey", "o_orderpriority")
    li = table(spark, sf, "lineitem", spread=True)
    if returned_only:
        li = li.filter(F.col("l_returnflag") == "R")
    kids = arrays_in_order(li.select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], "l_linenumber",
                           ["l_linenumber", "l_quantity"], CHILDREN_PER_PAYLOAD, ties=["l_quantity"])
    j = o.join(kids, o.o_orderkey == kids.l_orderkey, "left")
    items = F.coalesce("items", F.array().cast("array<struct<l_linenumber:int,l_quantity:double>>"))
    body = F.to_json(F.struct(F.array(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority"),
                                               F.coalesce("start", F.lit(0)).alias("start"), items.alias("items"))).alias("results")))
    return j.select("o_orderkey", F.size(items).alias("total"), body.alias("body"))


@query("A5_nested_rows", """
SELECT o_orderkey AS key, o_orderpriority AS priority,
       row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_quantity) AS pos, l_linenumber, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def q_a5(spark, sf):
    from ..sources.extract import json_rows, nested_rows
    pay = _order_payloads(spark, sf, returned_only=False)
    res = json_rows(pay, "body", "results", NESTED_SCHEMA, pos="rpos", item="r")
    kids = nested_rows(res.select("r.key", "r.priority", "r.start", "r.items"), "items", ["key", "priority"], start="start")
    return kids.select("key", "priority", F.col("pos").cast("bigint").alias("pos"),
                       "child.l_linenumber", "child.l_quantity")


@query("A6_nested_rows_guard", """
SELECT o_orderkey AS key,
       CASE WHEN l_linenumber IS NULL THEN NULL
            ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_quantity) END AS pos,
       l_linenumber
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l ON o_orderkey = l_orderkey""")
def q_a6(spark, sf):
    from ..sources.extract import json_rows, nested_rows_guard
    pay = _order_payloads(spark, sf, returned_only=True)
    res = json_rows(pay, "body", "results", NESTED_SCHEMA, pos="rpos", item="r")
    kids = nested_rows_guard(res.select("r.key", "r.start", "r.items"), "items", ["key"], keep_empty=True, start="start")
    return kids.select("key", F.col("pos").cast("bigint").alias("pos"), "child.l_linenumber")


@query("A7_unwrap_attribute", """
SELECT p_partkey AS id, p_name AS name, p_brand AS brand, CAST(p_size AS BIGINT) AS size FROM part""")
def q_a7(spark, sf):
    from ..sources.extract import unwrap_attribute
    p = table(spark, sf, "part")
    body = F.to_json(F.struct(F.struct(F.col("p_partkey").alias("id"),
                                       F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"),
                                                F.col("p_size").cast("bigint").alias("size")).alias("attributes"))
                              .alias("data")))
    parsed = p.select(F.from_json(body, "data STRUCT<id: BIGINT, attributes: STRUCT<name: STRING, brand: STRING, "
                                        "size: BIGINT>>").alias("j"))
    return unwrap_attribute(parsed.select("j.data.id", "j.data.attributes"), "attributes", keep=["id"])


# ----------------------------------------------------------------------------- A8-A12


@query("A8_merge_following_rows", """
SELECT conv_id, turn // 2 AS record, min(turn) AS turn, string_agg(text, ' ' ORDER BY turn) AS merged,
       count(*) AS n_rows
FROM conversations GROUP BY conv_id, turn // 2""")
def q_a8(spark, sf):
    from ..sources.extract import merge_following_rows
    c = table(spark, sf, "conversations")
    return merge_following_rows(c, ["conv_id"], "turn", after=1, text="text", dense_from=0).select(
        "conv_id", F.col("record").cast("bigint").alias("record"), "turn", "merged", "n_rows")


@query("A9_carry_header", """
WITH h AS (SELECT event_id, user_id, event_type,
                  CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') END AS hdr FROM events)
SELECT event_id, user_id, event_type, header_date FROM (
  SELECT *, last_value(hdr IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header_date
  FROM h) WHERE hdr IS NULL""")
def q_a9(spark, sf):
    from ..sources.extract import carry_header
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    hdr = F.when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd"))
    return carry_header(e, ["user_id"], "event_id", hdr, "header_date").select(
        "event_id", "user_id", "event_type", "header_date")


@query("A10_row_count_guard", """
SELECT o_orderkey AS key, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_quantity) AS pos, l_linenumber
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'""")
def q_a10(spark, sf):
    from ..sources.extract import json_rows, nested_rows, row_count_guard
    pay = row_count_guard(_order_payloads(spark, sf, returned_only=True), "total")
    res = json_rows(pay, "body", "results", NESTED_SCHEMA, pos="rpos", item="r")
    kids = nested_rows(res.select("r.key", "r.start", "r.items"), "items", ["key"], start="start")
    return kids.select("key", F.col("pos").cast("bigint").alias("pos"), "child.l_linenumber")


_PRE_STEPS = [("re_replace", r"(?s)<script\b[^>]*>.*?</script>", ""),
              ("re_replace", r"(?s)<style\b[^>]*>.*?</style>", ""),
              ("re_replace", r"(?s)<!--.*?-->", "")]


@query("A11_preprocess_payload", """
WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html,
             '(?s)<script\\b[^>]*>.*?</script>', '', 'g'), '(?s)<style\\b[^>]*>.*?</style>', '', 'g'),
             '(?s)<!--.*?-->', '', 'g') AS body FROM pages)
SELECT page_id, CAST(len(regexp_extract_all(body, '<p>')) AS BIGINT) AS n_paragraphs,
       CAST(length(body) AS BIGINT) AS n_chars
FROM c""")
def q_a11(spark, sf):
    from ..sources.extract import preprocess_payload
    p = preprocess_payload(table(spark, sf, "pages", spread=True).select("page_id", "html"), "html", _PRE_STEPS)
    return p.select("page_id", F.size(F.regexp_extract_all("html", F.lit("<p>"), 0)).cast("bigint").alias("n_paragraphs"),
                    F.length("html").cast("bigint").alias("n_chars"))


# a charset column: Cyrillic and Central European text in the charsets that feeds use
_CHARSETS = ["windows-1251", "ISO-8859-2", "windows-1250", "UTF-8"]
_SAMPLES = ["Фильм", "Żółw", "Łódź", "日本"]


@query("A12_decode_per_row", """
SELECT event_id, ['Фильм', 'Żółw', 'Łódź', '日本'][event_id % 4 + 1] || ' ' || coalesce(event_type, '') AS decoded, false AS malformed
FROM events""")
def q_a12_per_row(spark, sf):
    from ..sources.extract import decode_charset, malformed
    e = table(spark, sf, "events").select("event_id", "event_type")
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(pick(_SAMPLES), F.lit(" "), F.coalesce("event_type", F.lit("")))
    e = e.withColumn("charset", pick(_CHARSETS))
    e = e.withColumn("bytes", F.call_function("encode", text, F.col("charset")))
    e = e.withColumn("decoded", decode_charset("bytes", F.col("charset")))
    return e.select("event_id", "decoded", malformed("decoded").alias("malformed"))


@query("A12_decode_charset", "SELECT doc_id, text AS utf16, text AS utf8 FROM documents")
def q_a12(spark, sf):
    from ..sources.extract import decode_charset
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", decode_charset(F.encode("text", "UTF-16LE"), "UTF-16LE").alias("utf16"),
                    decode_charset(F.encode("text", "UTF-8"), "UTF-8").alias("utf8"))


# ----------------------------------------------------------------------------- A13-A17

_TYPES = ["view", "click", "signup", "purchase", "error"]


@query("A13_fan_in_paths", """
SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                 WHEN 'purchase' THEN 4 WHEN 'error' THEN 5 END AS path_id, event_type, user_id
FROM events""")
def q_a13(spark, sf):
    from ..sources.extract import tag_paths
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    return tag_paths(e, "event_type", {t: i + 1 for i, t in enumerate(_TYPES)}).select(
        "event_id", "path_id", "event_type", "user_id")


_PATHS = [(1, [5000, 5030, 5040]), (2, [2000, 2040, 2045]), (3, None)]


@query("A14_route_paths", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL}),
r AS (SELECT p_partkey, list(m.cat_code) FILTER (WHERE m.cat_code IS NOT NULL) AS cats
      FROM part LEFT JOIN m ON p_type = m.site_id GROUP BY p_partkey),
p AS (SELECT * FROM (VALUES (1, [5000, 5030, 5040]), (2, [2000, 2040, 2045]), (3, NULL)) AS t(path_id, path_categories))
SELECT r.p_partkey, CAST(p.path_id AS BIGINT) AS path_id FROM r JOIN p
  ON p.path_categories IS NULL OR list_has_any(r.cats, p.path_categories)""")
def q_a14(spark, sf):
    from ..operators.catalog import map_category_multi
    from ..sources.extract import route_paths
    part = table(spark, sf, "part").select("p_partkey", F.lit("parts").alias("source"), F.col("p_type").alias("site_id"))
    req = map_category_multi(part, part_type_map_df(spark)).select(
        "p_partkey", F.col("categories").alias("req_categories"))
    paths = spark.createDataFrame(_PATHS, "path_id bigint, path_categories array<bigint>")
    return route_paths(req, paths).select("p_partkey", "path_id")


DOCUMENT_SCHEMA = (
    "key STRING, version INT, content STRUCT<id: STRING, name: STRING, type: STRING, language: STRING, "
    "encoding: STRING, links: ARRAY<STRING>, mappings: ARRAY<STRUCT<id: STRING, cat: STRING, descr: STRING, "
    "is_default: BOOLEAN>>, modes: MAP<STRING, ARRAY<STRING>>, settings: ARRAY<STRUCT<name: STRING, type: STRING, "
    "label: STRING, default: STRING, options: MAP<STRING, STRING>>>, fields: MAP<STRING, STRUCT<selector: STRING, "
    "attribute: STRING, text: STRING, optional: BOOLEAN, default: STRING, filters: ARRAY<STRUCT<name: STRING, "
    "args: ARRAY<STRING>>>>>, replaces: ARRAY<STRING>>")


MAPPINGS_PER_DOCUMENT = 1000


def documents_nested(spark, sf):
    """Definition-like documents as JSON lines, built from orders + customer: one document
    per customer and 1000 orders, by the order's number in the customer, so no document grows
    with the data; a document's mappings count from 1. The numbering has two levels."""
    from ..operators.numbering import number_in_order
    o = table(spark, sf, "orders", spread=True).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    o = number_in_order(o, ["o_custkey"], "o_orderkey").withColumn("blk", F.floor((F.col("rn") - 1) / MAPPINGS_PER_DOCUMENT))
    m = (o.groupBy("o_custkey", "blk")
          .agg(F.array_sort(F.collect_list(F.struct(
              F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("id"),
              F.col("o_orderpriority").alias("cat"), F.col("o_orderstatus").alias("descr"),
              (F.col("o_orderstatus") == "F").alias("is_default")))).alias("maps")))
    j = m.join(c, m.o_custkey == c.c_custkey, "inner")
    key = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("-"), F.col("blk").cast("string"))
    filt = F.array(F.struct(F.lit("re_replace").alias("name"), F.array(F.lit("\\s+"), F.lit(" ")).alias("args")),
                   F.struct(F.lit("trim").alias("name"), F.array().cast("array<string>").alias("args")))
    content = F.struct(
        key.alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit("private")).otherwise(F.lit("public")).alias("type"),
        F.lit("en-US").alias("language"), F.lit("UTF-8").alias("encoding"),
        F.array(F.concat(F.lit("https://c"), F.col("c_custkey").cast("string"), F.lit(".example/"))).alias("links"),
        F.transform("maps", lambda x: x.dropFields("k")).alias("mappings"),
        F.create_map(F.lit("search"), F.array(F.lit("q")), F.lit("tv-search"),
                     F.array(F.lit("q"), F.lit("season"), F.lit("ep"))).alias("modes"),
        F.array(F.struct(F.lit("sort").alias("name"), F.lit("select").alias("type"), F.lit("Sort").alias("label"),
                         F.lit("time").alias("default"),
                         F.create_map(F.lit("time"), F.lit("created"), F.lit("size"), F.lit("size")).alias("options"))
                ).alias("settings"),
        F.create_map(F.lit("title"), F.struct(F.lit("td a").alias("selector"), F.lit(None).cast("string").alias("attribute"),
                                              F.lit(None).cast("string").alias("text"), F.lit(False).alias("optional"),
                                              F.lit(None).cast("string").alias("default"), filt.alias("filters"))
                     ).alias("fields"),
        F.array().cast("array<string>").alias("replaces"))
    doc = F.struct(key.alias("key"), F.lit(11).alias("version"), content.alias("content"))
    return j.select(F.to_json(doc).alias("json"))


@query("A15_flatten_documents", f"""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT 'c' || o_custkey || '-' || (i // {MAPPINGS_PER_DOCUMENT}) AS key, i % {MAPPINGS_PER_DOCUMENT} + 1 AS pos,
       CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS cat, o_orderstatus AS descr,
       o_orderstatus = 'F' AS is_default
FROM n WHERE o_custkey IN (SELECT c_custkey FROM customer)""")
def q_a15(spark, sf):
    from ..sources.extract import flatten_documents
    docs = documents_nested(spark, sf).select(F.from_json("json", DOCUMENT_SCHEMA).alias("d")).select("d.*")
    parts = flatten_documents(docs, "key", "content")
    return parts["mappings"].select("key", F.col("pos").cast("bigint").alias("pos"), "id", "cat", "descr", "is_default")


@query("A15_flatten_filters", f"""
SELECT key, 'title' AS field, pos, filter FROM
  (SELECT DISTINCT 'c' || o_custkey || '-' || ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)
          // {MAPPINGS_PER_DOCUMENT}) AS key
   FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) k,
  (VALUES (CAST(1 AS BIGINT), 're_replace'), (CAST(2 AS BIGINT), 'trim')) AS f(pos, filter)""")
def q_a15_filters(spark, sf):
    from ..sources.extract import flatten_documents
    docs = documents_nested(spark, sf).select(F.from_json("json", DOCUMENT_SCHEMA).alias("d")).select("d.*")
    parts = flatten_documents(docs, "key", "content")
    return parts["filters"].select("key", "field", F.col("pos").cast("bigint").alias("pos"), "filter")


_DOCS_SQL = f"""
WITH n AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // {MAPPINGS_PER_DOCUMENT} AS blk FROM orders),
k AS (SELECT DISTINCT o_custkey AS c, 'c' || o_custkey || '-' || blk AS key FROM n WHERE o_custkey IN (SELECT c_custkey FROM customer))"""


def _child(name, *columns):
    def build(spark, sf):
        from ..sources.extract import flatten_documents
        docs = documents_nested(spark, sf).select(F.from_json("json", DOCUMENT_SCHEMA).alias("d")).select("d.*")
        out = flatten_documents(docs, "key", "content")[name]
        if "pos" in columns:
            out = out.withColumn("pos", F.col("pos").cast("bigint"))
        return out.select(*columns)
    return build


query("A15_flatten_links", _DOCS_SQL + """
SELECT key, CAST(1 AS BIGINT) AS pos, 'https://c' || c || '.example/' AS link FROM k""")(_child("links", "key", "pos", "link"))
query("A15_flatten_modes", _DOCS_SQL + """
SELECT key, mode, param FROM k, (VALUES ('search', 'q'), ('tv-search', 'q'), ('tv-search', 'season'), ('tv-search', 'ep')) AS m(mode, param)""")(
    _child("modes", "key", "mode", "param"))
query("A15_flatten_settings", _DOCS_SQL + """
SELECT key, CAST(1 AS BIGINT) AS pos, 'sort' AS name, 'select' AS type, 'Sort' AS label, 'time' AS default FROM k""")(
    _child("settings", "key", "pos", "name", "type", "label", "default"))
query("A15_flatten_options", _DOCS_SQL + """
SELECT key, 'sort' AS setting, opt_key, opt_value FROM k, (VALUES ('time', 'created'), ('size', 'size')) AS o(opt_key, opt_value)""")(
    _child("options", "key", "setting", "opt_key", "opt_value"))
query("A15_flatten_fields", _DOCS_SQL + """
SELECT key, 'title' AS field, 'td a' AS selector, CAST(NULL AS VARCHAR) AS attribute, FALSE AS optional FROM k""")(
    _child("fields", "key", "field", "selector", "attribute", "optional"))


@query("A16_write_records", """
SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS user_sum FROM events GROUP BY event_type""")
def q_a16(spark, sf):
    import uuid

    from ..session import scratch_path
    from ..sources.sinks import write_records
    out = scratch_path(spark, f"write_records/{uuid.uuid4().hex}")
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    write_records(e, out, ["event_type"], "overwrite")
    back = spark.read.parquet(out)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("user_id").cast("bigint").alias("user_sum"))


@query("A17_scan_keyvalue", """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents),
t AS (SELECT doc_id, line_no, trim(line) AS line FROM l)
SELECT * FROM (
  SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, trim(split_part(line, '=', 1)) AS key,
         trim(substr(line, strpos(line, '=') + 1)) AS value
  FROM t WHERE NOT starts_with(line, '#') AND contains(line, '=')) WHERE key <> ''""")
def q_a17(spark, sf):
    from ..sources.extract import scan_keyvalue
    d = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    kv = scan_keyvalue(d, "text", keep=["doc_id"])
    return kv.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "key", "value")


# --------------------------------------------------------------------------- skew-safe paths, small blocks


@query("A8_merge_numbered", """
SELECT conv_id, turn // 2 AS record, min(turn) AS turn, string_agg(text, ' ' ORDER BY turn) AS merged,
       count(*) AS n_rows
FROM conversations GROUP BY conv_id, turn // 2""")
def q_a8_numbered(spark, sf):
    """A8 without dense positions: rows are numbered by the exact two-level numbering with
    blocks of 2 turns, so a conversation spans several blocks and the offsets matter."""
    from ..sources.extract import merge_following_rows
    c = table(spark, sf, "conversations")
    return merge_following_rows(c, ["conv_id"], "turn", after=1, text="text", block=2).select(
        "conv_id", F.col("record").cast("bigint").alias("record"), "turn", "merged", "n_rows")


@query("A9_carry_header_blocks", """
WITH h AS (SELECT event_id, user_id, event_type,
                  CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') END AS hdr FROM events)
SELECT event_id, user_id, event_type, header_date FROM (
  SELECT *, last_value(hdr IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header_date
  FROM h) WHERE hdr IS NULL""")
def q_a9_blocks(spark, sf):
    """A9 with blocks of 64 event ids: most headers are carried in from earlier blocks
    through the per-block table, the path a huge payload takes."""
    from ..sources.extract import carry_header
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    hdr = F.when(F.col("event_type") == "signup", F.date_format("ts", "yyyy-MM-dd"))
    return carry_header(e, ["user_id"], "event_id", hdr, "header_date", block_rows=64).select(
        "event_id", "user_id", "event_type", "header_date")


# --------------------------------------------------------------------------- file sources


def _scratch(spark, name):
    import uuid

    from ..session import scratch_path
    return scratch_path(spark, f"{name}/{uuid.uuid4().hex}")


@query("A1_scan_xml_files", """
SELECT p_partkey AS guid, p_name AS title, p_brand AS brand, CAST(p_size AS BIGINT) AS size FROM part""")
def q_a1_xml(spark, sf):
    """Bulk XML capture files read with the XML source and a declared row schema
    (``rowTag``), no inference. A capture file holds one feed document: one per brand and
    block of 1000 part keys, so no document grows with the data."""
    from ..functions.chain import f_htmlencode
    from ..sources.extract import scan_payloads
    p = table(spark, sf, "part")
    item = F.concat(F.lit("<item><guid>"), F.col("p_partkey").cast("string"), F.lit("</guid><title>"),
                    f_htmlencode(F.col("p_name")), F.lit("</title><brand>"), f_htmlencode(F.col("p_brand")),
                    F.lit("</brand><size>"), F.col("p_size").cast("string"), F.lit("</size></item>"))
    doc = F.concat(F.regexp_replace("p_brand", "[^0-9A-Za-z]", "_"), F.lit("_"),
                   F.floor(F.col("p_partkey") / 1000).cast("string"))
    feeds = (p.groupBy(doc.alias("doc"))
              .agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("x")))).alias("items"))
              .select("doc", F.concat(F.lit("<rss><channel>"), F.array_join(F.transform("items", lambda i: i["x"]), ""),
                                      F.lit("</channel></rss>")).alias("value")))
    path = _scratch(spark, "xml_files")
    # one file per feed document: the XML reader takes one root element per file
    feeds.repartition("doc").write.mode("overwrite").partitionBy("doc").text(path)
    schema = "guid BIGINT, title STRING, brand STRING, size BIGINT"
    return scan_payloads(spark, path, "xml", schema, rowTag="item").select("guid", "title", "brand", "size")


@query("A1_scan_json_lines", """
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def q_a1_json(spark, sf):
    """JSON-lines capture files read with a declared schema (bad lines would land in the
    corrupt-record column instead of failing the job)."""
    from ..sources.extract import scan_payloads
    e = table(spark, sf, "events")
    path = _scratch(spark, "json_lines")
    e.select(F.to_json(F.struct("event_id", "user_id", "event_type",
                                F.get_json_object("props", "$.k").cast("bigint").alias("k"))).alias("value")) \
        .write.mode("overwrite").text(path)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING, k BIGINT, _corrupt_record STRING"
    df = scan_payloads(spark, path, "json", schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    return df.select("event_id", "user_id", "event_type", "k")
