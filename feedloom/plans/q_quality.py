"""Registered queries: data-quality rules (L1-L20), summary (G1) and error order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as L
from .q_extract import DOCUMENT_SCHEMA, MAPPINGS_PER_DOCUMENT, NAV_ITEM, documents_nested
from .registry import query
from .tables import table

TITLE = r"^([A-Z][^.\n]*)"
SQL_DOCS = r"""(SELECT doc_id, regexp_extract(text, '^([A-Z][^.\n]*)', 1) AS title, lang, source, n_chars, text
               FROM documents)"""


def _docs(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", F.regexp_extract("text", TITLE, 1).alias("title"), "lang", "source", "n_chars", "text")


def _props(spark, sf):
    e = table(spark, sf, "events")
    m = F.from_json("props", "map<string,string>")
    extra = F.when(F.col("event_type") == "click", F.create_map(F.lit("type"), F.lit("x"))) \
        .otherwise(F.create_map().cast("map<string,string>"))
    return e.select("event_id", "event_type", "value", "user_id", F.map_concat(m, extra).alias("props"))


# ----------------------------------------------------------------------------- L1-L13


@query("L1_dq_required", f"""
SELECT doc_id, 'title' AS path, 'required' AS rule, CAST(NULL AS VARCHAR) AS value FROM {SQL_DOCS} d WHERE title = ''""")
def q_l1(spark, sf):
    return L.check(_docs(spark, sf), "doc_id", [L.dq_required("title", "title")])


@query("L2_dq_type", """
SELECT event_id, 'value' AS path, 'type' AS rule, CAST(value AS VARCHAR) AS value FROM events
WHERE NOT regexp_matches(CAST(value AS VARCHAR), '^\\s*[+-]?[0-9]+\\s*$')""")
def q_l2(spark, sf):
    e = table(spark, sf, "events")
    rules = [L.dq_type(F.get_json_object("props", "$.k"), "int", "props.k"), L.dq_type("value", "int|boolean", "value")]
    return L.check(e, "event_id", rules)


@query("L3_dq_enum", """
SELECT event_id, 'event_type' AS path, 'enum' AS rule, event_type AS value FROM events
WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase')""")
def q_l3(spark, sf):
    e = table(spark, sf, "events")
    return L.check(e, "event_id", [L.dq_enum("event_type", ["view", "click", "signup", "purchase"], "event_type")])


@query("L4_dq_unknown_keys", """
SELECT event_id, 'props' AS path, 'unknown_keys' AS rule, 'type' AS value FROM events WHERE event_type = 'click'""")
def q_l4(spark, sf):
    return L.check(_props(spark, sf), "event_id", [L.dq_unknown_keys("props", ["k", "q"], "props")])


@query("L5_dq_key_pattern", """
SELECT event_id, 'props' AS path, 'key_pattern' AS rule, 'type' AS value FROM events WHERE event_type = 'click'""")
def q_l5(spark, sf):
    return L.check(_props(spark, sf), "event_id", [L.dq_key_pattern("props", [r"^[a-z]$", r"^q_\w+$"], "props")])


@query("L6_dq_unique_items", f"""
WITH h AS (SELECT page_id, regexp_extract_all(html, '{NAV_ITEM}') AS items FROM pages)
SELECT page_id, 'nav/items' AS path, 'unique_items' AS rule, CAST(len(items) AS VARCHAR) AS value FROM h
WHERE len(items) <> len(list_distinct(items))""")
def q_l6(spark, sf):
    """Lists inside one document (here: a page's nav items) must not repeat."""
    p = table(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit(NAV_ITEM), 0).alias("items"))
    return L.check(p, "page_id", [L.dq_unique_items("items", "nav/items")])


@query("L7_dq_one_of", """
SELECT o_orderkey, 'one_of' AS path, 'one_of' AS rule,
       CAST((o_orderstatus = 'F')::INT + (o_orderpriority LIKE '1%')::INT AS VARCHAR) AS value
FROM orders WHERE (o_orderstatus = 'F')::INT + (o_orderpriority LIKE '1%')::INT <> 1""")
def q_l7(spark, sf):
    o = table(spark, sf, "orders")
    a = F.when(F.col("o_orderstatus") == "F", F.lit("finished"))
    b = F.when(F.col("o_orderpriority").startswith("1"), F.lit("urgent"))
    return L.check(o, "o_orderkey", [L.dq_one_of(a, b)])


@query("L8_dq_conditional", """
SELECT event_id, 'value' AS path, 'min_value' AS rule, CAST(value AS VARCHAR) AS value
FROM events WHERE event_type = 'purchase' AND value <= 10""")
def q_l8(spark, sf):
    e = table(spark, sf, "events")
    rule = L.dq_conditional(F.col("event_type") == "purchase",
                            L.dq_rule("min_value", "value", F.col("value") <= 10, F.col("value")))
    return L.check(e, "event_id", [rule])


@query("L9_dq_value_pattern", f"""
SELECT doc_id, 'text' AS path, 'pattern' AS rule, text AS value FROM {SQL_DOCS} d
WHERE NOT regexp_matches(text, '^[A-Z][a-z]')
UNION ALL
SELECT doc_id, 'text' AS path, 'not_pattern' AS rule, text AS value FROM {SQL_DOCS} d
WHERE regexp_matches(text, 'token')""")
def q_l9(spark, sf):
    d = _docs(spark, sf)
    return L.check(d, "doc_id", [L.dq_value_pattern("text", r"^[A-Z][a-z]"),
                                 L.dq_value_pattern("text", "token", negate=True)])


@query("L10_dq_uri", f"""
WITH r AS (SELECT page_id, unnest(m) AS element, unnest(range(1, len(m) + 1)) AS pos
           FROM (SELECT page_id, regexp_extract_all(html, '{NAV_ITEM}') AS m FROM pages)),
l AS (SELECT page_id, pos, regexp_extract(element, 'href="([^"]*)"', 1) AS href FROM r
      UNION ALL SELECT page_id, 0, url FROM pages)
SELECT page_id, CAST(pos AS BIGINT) AS pos, 'href' AS path, 'uri' AS rule, href AS value FROM l
WHERE NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')""")
def q_l10(spark, sf):
    from ..sources.extract import html_rows
    p = table(spark, sf, "pages").select("page_id", "url", "html")
    links = html_rows(p, "html", NAV_ITEM, keep=["page_id"]).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.regexp_extract("element", r'href="([^"]*)"', 1).alias("href"))
    links = links.unionByName(p.select("page_id", F.lit(0).cast("bigint").alias("pos"), F.col("url").alias("href")))
    return L.check(links, ["page_id", "pos"], [L.dq_uri("href", "href")])


@query("L11_dq_nested", f"""
WITH n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT 'c' || o_custkey || '-' || (i // {MAPPINGS_PER_DOCUMENT}) AS key, 'mappings/' || (i % {MAPPINGS_PER_DOCUMENT} + 1) AS path,
       'descr_enum' AS rule, o_orderstatus AS value, o_orderstatus AS status
FROM n WHERE o_custkey IN (SELECT c_custkey FROM customer) AND o_orderstatus NOT IN ('F', 'O')""")
def q_l11(spark, sf):
    docs = documents_nested(spark, sf).select(F.from_json("json", DOCUMENT_SCHEMA).alias("d")).select("d.*")
    rule = L.dq_nested(F.col("content.mappings"), "descr_enum", "mappings",
                       lambda m: ~m["descr"].isin("F", "O"), lambda m: m["descr"])
    return L.check(docs, "key", [rule]).withColumn("status", F.col("value"))


@query("L12_dq_map_values", """
SELECT event_id, 'props' AS path, 'map_values' AS rule, 'type' AS value FROM events WHERE event_type = 'click'""")
def q_l12(spark, sf):
    return L.check(_props(spark, sf), "event_id", [L.dq_map_values("props", "int", "props")])


@query("L13_normalise_keys", """
SELECT event_id, CASE WHEN value > 50 THEN 'k,true' ELSE 'false,k' END AS keys,
       CASE WHEN value > 50 THEN 'true,' || event_type ELSE event_type || ',true' END AS vals
FROM events""")
def q_l13(spark, sf):
    e = table(spark, sf, "events")
    m = F.create_map(F.when(F.col("value") > 50, F.lit("True")).otherwise(F.lit("False")), F.col("event_type"),
                     F.lit("k"), F.lit("True"))
    n = L.normalise_keys(m, lower_bool_values=True)
    ks = F.array_sort(F.map_keys(n))
    vals = F.transform(ks, lambda k: F.element_at(n, k))
    return e.select("event_id", F.array_join(ks, ",").alias("keys"), F.array_join(vals, ",").alias("vals"))


# ----------------------------------------------------------------------------- L14-L20, G1, O5


def _doc_rules():
    return [L.dq_required("title", "title"),
            L.dq_enum("lang", ["en", "fr", "de"], "lang"),
            L.dq_rule("max_chars", "n_chars", F.col("n_chars") > 5000, F.col("n_chars"))]


SQL_DOC_ERRORS = f"""
(SELECT doc_id, 'title' AS path, 'required' AS rule, CAST(NULL AS VARCHAR) AS value, 1 AS ord FROM {SQL_DOCS} d WHERE title = ''
 UNION ALL SELECT doc_id, 'lang', 'enum', lang, 2 FROM documents WHERE lang NOT IN ('en', 'fr', 'de')
 UNION ALL SELECT doc_id, 'n_chars', 'max_chars', CAST(n_chars AS VARCHAR), 3 FROM documents WHERE n_chars > 5000)"""


@query("L14_report_all", f"SELECT doc_id, path, rule, value FROM {SQL_DOC_ERRORS} e")
def q_l14(spark, sf):
    return L.report_all(_docs(spark, sf), "doc_id", _doc_rules())


@query("L15_report_first", f"""
SELECT doc_id, path, rule, value FROM {SQL_DOC_ERRORS} e
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ord) = 1""")
def q_l15(spark, sf):
    return L.report_first(_docs(spark, sf), "doc_id", _doc_rules())


def _version_rules():
    r1 = [L.dq_required("title", "title")]
    r2 = r1 + [L.dq_enum("lang", ["en", "fr", "de"], "lang")]
    r3 = r2 + [L.dq_rule("max_chars", "n_chars", F.col("n_chars") > 5000, F.col("n_chars"))]
    return {1: r1, 2: r2, 3: r3}


@query("L16_best_version", f"""
SELECT doc_id,
  CASE WHEN title = '' THEN 0 WHEN lang NOT IN ('en', 'fr', 'de') THEN 1 WHEN n_chars > 5000 THEN 2 ELSE 3 END AS best_version,
  (title = '' OR lang NOT IN ('en', 'fr', 'de') OR n_chars > 5000) AS top_fails
FROM {SQL_DOCS} d""")
def q_l16(spark, sf):
    return L.best_version(_docs(spark, sf), "doc_id", _version_rules()).select("doc_id", "best_version", "top_fails")


@query("L17_resolve_version", """
SELECT o_custkey, max(year(o_orderdate) - 1994) AS version, arg_max(o_orderkey, (year(o_orderdate), o_orderkey)) AS content
FROM orders WHERE year(o_orderdate) - 1994 <= 4 GROUP BY o_custkey""")
def q_l17(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", (F.year("o_orderdate") - 1994).alias("version"),
                                          F.struct((F.year("o_orderdate") - 1994).alias("v"), "o_orderkey").alias("_vk"),
                                          "o_orderkey")
    # ties inside a version resolve to the highest key: order by (version, key)
    r = (o.filter(F.col("version") <= 4).groupBy("o_custkey")
          .agg(F.max("version").alias("version"), F.max_by("o_orderkey", "_vk").alias("content")))
    return r.select("o_custkey", F.col("version").cast("bigint").alias("version"), "content")


@query("L17_resolve_version_op", """
SELECT o_custkey AS key, max(year(o_orderdate) - 1994) AS version FROM orders
WHERE year(o_orderdate) - 1994 <= 4 GROUP BY o_custkey""")
def q_l17b(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"),
                                          (F.year("o_orderdate") - 1994).cast("bigint").alias("version"),
                                          F.col("o_orderkey").alias("content"))
    return L.resolve_version(o, "key", "version", 4).select("key", "version")


@query("L18_load_failure", """
SELECT event_id, 'load' AS rule, body AS value
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END AS body FROM events)
WHERE NOT json_valid(body) OR json_type(body) <> 'OBJECT'""")
def q_l18(spark, sf):
    e = table(spark, sf, "events")
    body = F.when(F.col("event_type") == "error", F.substr("props", F.lit(2))).otherwise(F.col("props"))
    return L.load_failure(e.select("event_id", body.alias("body")), "event_id", "body")


_RULED_SOURCES = [f"src{i}" for i in range(10)]


@query("L19_missing_rules", f"""
SELECT source, count(*) AS n_docs,
       CASE WHEN source IN ({', '.join(repr(s) for s in _RULED_SOURCES)}) THEN 'checked' ELSE 'unchecked' END AS status
FROM documents GROUP BY source""")
def q_l19(spark, sf):
    d = table(spark, sf, "documents")
    groups = d.groupBy(F.col("source").alias("version")).agg(F.count(F.lit(1)).alias("n_docs"))
    ruled = spark.createDataFrame([(s,) for s in _RULED_SOURCES], "version string")
    return L.missing_rules(groups, ruled).select(F.col("version").alias("source"), "n_docs", "status")


@query("L20_id_matches_key", """
SELECT c_custkey, c_name AS id, 'Customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS key FROM customer
WHERE c_name IS DISTINCT FROM 'Customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0')""")
def q_l20(spark, sf):
    c = table(spark, sf, "customer")
    r = c.select("c_custkey", F.col("c_name").alias("id"),
                 F.concat(F.lit("Customer#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("key"))
    return L.id_matches_key(r)


@query("G1_validation_summary", r"""
WITH d AS (SELECT doc_id, lang, regexp_extract(text, '^([A-Z][^.\n]*)', 1) AS title FROM documents),
l AS (SELECT doc_id, quality FROM labels),
bad AS (SELECT DISTINCT d.doc_id FROM d LEFT JOIN l ON d.doc_id = l.doc_id
        WHERE d.title = '' OR coalesce(l.quality, 1) = 0)
SELECT lang, count(*) AS total, count(bad.doc_id) AS errors, count(*) - count(bad.doc_id) AS success
FROM d LEFT JOIN bad ON d.doc_id = bad.doc_id GROUP BY ROLLUP (lang)""")
def q_g1(spark, sf):
    d = _docs(spark, sf).select("doc_id", "lang", "title")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    items = d.join(lab, "doc_id", "left")
    rules = [L.dq_required("title", "title"),
             L.dq_conditional(F.col("quality").isNotNull(), L.dq_rule("quality", "labels.quality", F.col("quality") == 0))]
    errors = L.check(items, "doc_id", rules)
    return L.validation_summary(items.select("doc_id", "lang"), errors, "doc_id", "lang").select(
        "lang", "total", "errors", "success")


@query("O5_sort_errors", f"SELECT doc_id, path, rule, value FROM {SQL_DOC_ERRORS} e")
def q_o5(spark, sf):
    return L.sort_errors(L.check(_docs(spark, sf), "doc_id", _doc_rules()), "doc_id")


@query("G1_summary_levels", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang, n_chars > 1000 AS bad FROM documents)
SELECT lang, count(*) AS total, count(*) FILTER (WHERE bad) AS errors, count(*) FILTER (WHERE NOT bad) AS success,
       CAST(GROUPING(lang) AS BIGINT) AS level FROM d GROUP BY ROLLUP (lang)""")
def q_g1_levels(spark, sf):
    """Documents without a language are a group of their own beside the overall line."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"), "n_chars")
    errors = L.check(d, "doc_id", [L.dq_rule("long", "n_chars", F.col("n_chars") > 1000, F.col("n_chars"))])
    return L.validation_summary(d.select("doc_id", "lang"), errors, "doc_id", "lang")
