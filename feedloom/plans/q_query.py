"""Registered queries: search predicates (Q1-Q18), ordering and paging (O1-O4, O6),
unions and dedupe (U1-U2), per-group picks (W3-W4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise as N
from ..operators import query as Q
from ..operators.catalog import map_category_multi
from .fixtures import CAPABILITIES_SQL, PART_TYPE_MAP_SQL, capabilities_df, part_type_map_df
from .registry import query
from .tables import table

FIRST_LINE = r"^([^\n]*)"


def _doc_records(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", F.regexp_extract("text", FIRST_LINE, 1).alias("title"), "text", "lang", "source")


# ----------------------------------------------------------------------------- Q1-Q9


@query("Q1_search_q", r"""
WITH d AS (SELECT doc_id, regexp_extract(text, '^([^\n]*)', 1) AS title FROM documents)
SELECT doc_id, title FROM d JOIN documents USING (doc_id) WHERE contains(lower(text), 'the') AND contains(lower(text), 'of')""")
def q_q1(spark, sf):
    return Q.search_q(_doc_records(spark, sf), "The  OF", "text").select("doc_id", "title")


def _episode_records(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.format_string("Show S%02dE%02d", (F.col("user_id") % 10).cast("int"),
                                                (F.col("event_id") % 30).cast("int")).alias("title"))


@query("Q2_search_episode", """
SELECT event_id, printf('Show S%02dE%02d', user_id % 10, event_id % 30) AS title
FROM events WHERE user_id % 10 = 3 AND event_id % 30 = 7""")
def q_q2(spark, sf):
    return Q.search_episode(_episode_records(spark, sf), 3, 7, "title")


def _id_records(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.col("p_partkey").alias("imdbid"), (F.col("p_partkey") * 10).alias("doubanid"),
                    F.col("p_name").alias("title"))


@query("Q3_search_by_id", """
SELECT 'imdb' AS branch, p_partkey FROM part WHERE p_partkey = 42
UNION ALL SELECT 'douban' AS branch, p_partkey FROM part WHERE p_partkey * 10 = 70
UNION ALL SELECT 'keywords' AS branch, p_partkey FROM part WHERE contains(lower(p_name), 'widget')""")
def q_q3(spark, sf):
    r = _id_records(spark, sf)
    a = Q.search_by_id(r, {"imdbid": 42, "doubanid": 70, "q": "widget"}).select(F.lit("imdb").alias("branch"), "p_partkey")
    b = Q.search_by_id(r, {"doubanid": 70, "q": "widget"}).select(F.lit("douban").alias("branch"), "p_partkey")
    c = Q.search_by_id(r, {"q": "Widget"}).select(F.lit("keywords").alias("branch"), "p_partkey")
    return a.unionByName(b).unionByName(c)


def _music_records(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.col("p_brand").alias("artist"), F.col("p_type").alias("album"),
                    F.col("p_name").alias("title"))


@query("Q4_search_music", """
SELECT 'artist_album' AS branch, p_partkey FROM part WHERE lower(p_brand) = 'brand#2' AND lower(p_type) = 'small'
UNION ALL SELECT 'keywords' AS branch, p_partkey FROM part WHERE contains(lower(p_name), 'red')""")
def q_q4(spark, sf):
    r = _music_records(spark, sf)
    a = Q.search_music(r, {"artist": "Brand#2", "album": "SMALL"}).select(F.lit("artist_album").alias("branch"), "p_partkey")
    b = Q.search_music(r, {"artist": "", "q": "red"}).select(F.lit("keywords").alias("branch"), "p_partkey")
    return a.unionByName(b)


@query("Q5_search_book", """
SELECT p_partkey FROM part WHERE contains(lower(p_name), 'widget') AND lower(p_brand) = 'brand#4'""")
def q_q5(spark, sf):
    p = table(spark, sf, "part")
    r = p.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("author"))
    return Q.search_book(r, {"title": "Widget", "author": "brand#4"}).select("p_partkey")


@query("Q6_search_genre_year", """
SELECT o_orderkey FROM orders
WHERE (lower(substr(o_orderpriority, 3)) = 'urgent' OR lower(o_orderstatus) = 'urgent') AND year(o_orderdate) = 1997""")
def q_q6(spark, sf):
    o = table(spark, sf, "orders")
    r = o.select("o_orderkey", F.array(F.col("o_orderstatus"), F.substr("o_orderpriority", F.lit(3))).alias("genre"),
                 F.year("o_orderdate").alias("year"))
    return Q.search_genre_year(r, "Urgent", 1997).select("o_orderkey")


@query("Q7_latest_when_empty", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey ASC LIMIT 50""")
def q_q7(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return Q.latest_when_empty(o, "", "o_orderdate", "o_orderkey", 50)


@query("Q8_empty_inputs", """
SELECT event_id, CASE WHEN value > 50 THEN 'k,q,type' ELSE 'k,type' END AS kept_keys FROM events""")
def q_q8(spark, sf):
    e = table(spark, sf, "events")
    m = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"),
                     F.lit("q"), F.when(F.col("value") > 50, F.col("value").cast("string")).otherwise(F.lit("")),
                     F.lit("type"), F.col("event_type"))
    return e.select("event_id", F.array_join(F.array_sort(F.map_keys(Q.empty_inputs(m))), ",").alias("kept_keys"))


# our own rule: numbered parts are spelt out
_REWRITE = [("re_replace", r"(?i)\bpart#(\d+)/(\d+)\b", "volume $2 part $1"),
            ("tolower",),
            ("re_replace", r"[^\w\s]+", " "),
            ("re_replace", r"\s+", " "),
            ("trim",)]


@query("Q9_keyword_rewrite", r"""
WITH q AS (SELECT conv_id, turn, text || ' Show part#' || CAST(turn % 9 AS VARCHAR) || '/' || CAST(conv_id % 9 AS VARCHAR) AS q
           FROM conversations)
SELECT conv_id, turn, trim(regexp_replace(regexp_replace(lower(regexp_replace(q, '(?i)\bpart#(\d+)/(\d+)\b', 'volume \2 part \1', 'g')),
       '[^\w\s]+', ' ', 'g'), '\s+', ' ', 'g')) AS keywords
FROM q""")
def q_q9(spark, sf):
    c = table(spark, sf, "conversations", spread=True)
    qf = c.select("conv_id", "turn", F.concat(F.col("text"), F.lit(" Show part#"), (F.col("turn") % 9).cast("string"),
                                              F.lit("/"), (F.col("conv_id") % 9).cast("string")).alias("q"))
    return Q.keyword_rewrite(qf, "q", _REWRITE).select("conv_id", "turn", "keywords")


# ----------------------------------------------------------------------------- Q10-Q18


def _part_categories(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.lit("parts").alias("source"), F.col("p_type").alias("site_id"))
    return map_category_multi(p, part_type_map_df(spark))


@query("Q10_filter_category", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL}),
r AS (SELECT p_partkey, list_sort(list(DISTINCT m.cat_code) FILTER (WHERE m.cat_code IS NOT NULL)) AS cats
      FROM part LEFT JOIN m ON p_type = m.site_id GROUP BY p_partkey)
SELECT p_partkey, array_to_string(cats, ',') AS categories FROM r
WHERE list_has_any(cats, [2045]) OR len(list_filter(cats, lambda c: c // 1000 * 1000 = 5000)) > 0""")
def q_q10(spark, sf):
    r = Q.filter_category(_part_categories(spark, sf), [5000, 2045])
    return r.select("p_partkey", F.array_join("categories", ",").alias("categories"))


@query("Q11_filter_freeleech", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R'""")
def q_q11(spark, sf):
    li = table(spark, sf, "lineitem")
    pct = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    r = li.select("l_orderkey", "l_linenumber", "l_partkey",
                  N.volume_factors(pct, flags=F.col("l_returnflag") == "R").alias("downloadvolumefactor"))
    return Q.filter_freeleech(r, True).select("l_orderkey", "l_linenumber", "l_partkey")


@query("Q12_filter_contains", "SELECT doc_id, source FROM documents WHERE contains(text, 'token')")
def q_q12(spark, sf):
    d = table(spark, sf, "documents", spread=True).select("doc_id", "source", "text")
    return Q.filter_contains(d, "text", "token").select("doc_id", "source")


@query("Q13_filter_row_shape", r"""
SELECT page_id FROM pages
WHERE regexp_matches(html, '<nav>') AND regexp_matches(html, '<footer>')
  AND NOT regexp_matches(url, 'spam-farm') AND starts_with(url, 'https://')""")
def q_q13(spark, sf):
    p = table(spark, sf, "pages", spread=True).select("page_id", "url", "html")
    r = Q.filter_row_shape(p, "html", has=["<nav>", "<footer>"])
    r = Q.filter_row_shape(r, "url", has_not=["spam-farm"], prefix="https://")
    return r.select("page_id")


@query("Q14_andmatch", """
SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'ere') AND contains(lower(strip_accents(text)), 'de')""")
def q_q14(spark, sf):
    return Q.andmatch(_doc_records(spark, sf), "text", "Ère, DE").select("doc_id")


@query("Q15_andmatch_prefix", """
SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'tion')""")
def q_q15(spark, sf):
    return Q.andmatch_prefix(_doc_records(spark, sf), "text", "tion enfants pour", 4).select("doc_id")


def _text_index(spark, sf):
    import uuid

    from ..operators import keyword_index
    from ..session import scratch_path
    d = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    path = scratch_path(spark, f"keyword_index/{uuid.uuid4().hex}")
    keyword_index.write_index(d, "doc_id", "text", path)
    return keyword_index, d, path


@query("Q1_search_q_indexed", """
SELECT doc_id FROM documents WHERE contains(lower(text), 'theat') AND contains(lower(text), 'of')""")
def q_q1_indexed(spark, sf):
    index, d, path = _text_index(spark, sf)
    return index.indexed_search_q(d, "doc_id", "text", path, "TheaT  of").select("doc_id")


@query("Q14_andmatch_indexed", """
SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'ementere') AND contains(lower(strip_accents(text)), 'elle')""")
def q_q14_indexed(spark, sf):
    """Both words are intersected through the postings of their rarest trigrams."""
    index, d, path = _text_index(spark, sf)
    return index.indexed_andmatch(d, "doc_id", "text", path, "Ementère; elle").select("doc_id")


@query("Q15_andmatch_prefix_indexed", """
SELECT doc_id FROM documents WHERE contains(lower(strip_accents(text)), 'erenth')""")
def q_q15_indexed(spark, sf):
    index, d, path = _text_index(spark, sf)
    return index.indexed_andmatch(d, "doc_id", "text", path, "erenthoust and more", 6).select("doc_id")


@query("Q16_capability_filter", f"""
WITH c AS (SELECT * FROM {CAPABILITIES_SQL})
SELECT e.event_type AS source, count(*) AS n_events
FROM events e JOIN (SELECT DISTINCT source FROM c WHERE mode = 'tv-search' AND list_has_all(params, ['q', 'season'])) s
  ON e.event_type = s.source
GROUP BY e.event_type""")
def q_q16(spark, sf):
    capable = Q.capability_filter(capabilities_df(spark), "tv-search", ["q", "season"])
    e = table(spark, sf, "events").select(F.col("event_type").alias("source"))
    return e.join(F.broadcast(capable), "source", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n_events"))


@query("Q17_required_params", f"""
WITH c AS (SELECT * FROM {CAPABILITIES_SQL} WHERE mode = 'movie-search'),
s AS (SELECT event_type AS source, count(*) AS n_events FROM events GROUP BY event_type)
SELECT s.source, c.params IS NULL AS skip,
  array_to_string(list_sort(list_filter(['imdbid', 'q'], lambda p: list_contains(coalesce(c.params, []), p))), ',') AS used,
  array_to_string(list_sort(list_filter(['imdbid', 'q'], lambda p: NOT list_contains(coalesce(c.params, []), p))), ',') AS ignored,
  s.n_events
FROM s LEFT JOIN c ON s.source = c.source""")
def q_q17(spark, sf):
    e = table(spark, sf, "events")
    sources = e.groupBy(F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("n_events"))
    r = Q.required_params(capabilities_df(spark), "movie-search", {"q": "x", "imdbid": 5, "season": None}, sources)
    return r.select("source", "skip", "used", "ignored", "n_events")


@query("Q18_error_rows", """
SELECT page_id, CASE WHEN contains(url, 'spam-farm') THEN 'spam' WHEN NOT contains(html, '<article>') THEN 'no_article' END
       AS error_rule
FROM pages""")
def q_q18(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    return Q.tag_errors(p, [("spam", F.col("url").contains("spam-farm")),
                            ("no_article", ~F.col("html").contains("<article>"))]).select("page_id", "error_rule")


# ----------------------------------------------------------------------------- O, U, W


@query("O1_sort_requested", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey""")
def q_o1(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.sort_requested(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")])


@query("O2_limit_top", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def q_o2(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return Q.limit_top(Q.sort_requested(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")]), 100)


@query("O3_page_offset", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 150""")
def q_o3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return Q.page_offset(Q.sort_requested(o, [("o_orderdate", "desc"), ("o_orderkey", "asc")]), 3, 50)


@query("O3_page_by_ranges", """
WITH n AS (SELECT count(*) // 50 // 2 AS page FROM events)
SELECT event_id, value, event_type FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 50 OFFSET (SELECT page * 50 FROM n)""")
def q_o3_ranges(spark, sf):
    """The middle page of all events, read from the ranges it lies in."""
    import uuid

    from ..operators import paging
    from ..session import scratch_path
    e = table(spark, sf, "events").select("event_id", "value", "event_type")
    path, keys = scratch_path(spark, f"paging/{uuid.uuid4().hex}"), [("value", "desc"), ("event_id", "asc")]
    paging.write_ordered(e, keys, path)
    return paging.read_page(spark, path, e.schema, keys, e.count() // 50 // 2, 50)


@query("O4_top_per_group", """
SELECT l_returnflag, rank, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                                                                  l_partkey, l_suppkey) AS rank
  FROM lineitem) WHERE rank <= 3""")
def q_o4(spark, sf):
    li = table(spark, sf, "lineitem", spread=True).select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey",
                                             "l_suppkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
             F.col("l_suppkey")]
    r = Q.top_per_group(li, ["l_returnflag"], order, 3)
    return r.select("l_returnflag", F.col("rank").cast("bigint").alias("rank"), "l_orderkey", "l_linenumber",
                    "l_extendedprice")


@query("O6_cap_guard", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_o6(spark, sf):
    e = table(spark, sf, "events")
    types = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    Q.cap_guard(types, 50, "event types")
    return types


@query("U1_union_sources", """
SELECT event_id, event_type, CASE WHEN event_type IN ('view', 'click') THEN value END AS value,
       CASE WHEN coalesce(event_type NOT IN ('view', 'click'), true) THEN props END AS props
FROM events""")
def q_u1(spark, sf):
    e = table(spark, sf, "events")
    a = e.filter(F.col("event_type").isin("view", "click")).select("event_id", "event_type", "value")
    b = e.filter(~F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))).select("event_id", "event_type", "props")
    return Q.union_sources([a, b]).select("event_id", "event_type", "value", "props")


@query("U2_dedupe_records", """
SELECT sha256(text) AS content_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY sha256(text)""")
def q_u2(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    rows = d.select(F.sha2("text", 256).alias("content_hash"), "doc_id", (-F.col("doc_id")).alias("_pref"))
    copies = rows.groupBy("content_hash").agg(F.count(F.lit(1)).alias("copies"))
    # the same exchange by hash serves both sides
    return Q.dedupe_records(rows, ["content_hash"], prefer="_pref").join(copies, "content_hash").select("content_hash", "doc_id", "copies")


@query("W3_first_per_group", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, min(o_orderdate) AS o_orderdate
FROM orders GROUP BY o_custkey""")
def q_w3(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    o = o.withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    return Q.first_per_group(o, ["o_custkey"], "_ord").select("o_custkey", "o_orderkey", "o_orderdate")


@query("W4_nth_position", """
WITH c AS (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS cells FROM pages)
SELECT page_id, cells[2] AS second, cells[-1] AS last, cells[9] AS ninth FROM c""")
def q_w4(spark, sf):
    p = table(spark, sf, "pages")
    cells = F.regexp_extract_all("html", F.lit(r'<li><a href="[^"]*">([^<]*)</a></li>'), 1)
    return p.select("page_id", Q.nth_position(cells, 2).alias("second"), Q.nth_position(cells, -1).alias("last"),
                    Q.nth_position(cells, 9).alias("ninth"))


@query("O4_top_per_group_two_phase", """
SELECT l_returnflag, rank, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                                                                  l_partkey, l_suppkey) AS rank
  FROM lineitem) WHERE rank <= 25""")
def q_o4_two_phase(spark, sf):
    """O4 through the salted two-phase path (used above the planner's group-limit threshold)."""
    li = table(spark, sf, "lineitem", spread=True).select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey",
                                                          "l_suppkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
             F.col("l_suppkey")]
    r = Q.top_per_group(li, ["l_returnflag"], order, 25, two_phase=True)
    return r.select("l_returnflag", F.col("rank").cast("bigint").alias("rank"), "l_orderkey", "l_linenumber",
                    "l_extendedprice")
