"""Registered queries: field semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise as N
from ..functions.chain import apply_chain
from ..functions.text import s
from ..operators import fields as B
from .registry import query
from .tables import AS_OF, table

SQL_STRIP = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))"


@query("B1_select_field", f"""
SELECT page_id, {SQL_STRIP.format(x="regexp_extract(html, '<h1>.*?</h1>', 0)")} AS title,
       {SQL_STRIP.format(x="regexp_extract(html, '<footer>.*?</footer>', 0)")} AS footer
FROM pages""")
def q_b1(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", B.select_field("html", r"<h1>.*?</h1>").alias("title"),
                    B.select_field("html", r"<footer>.*?</footer>").alias("footer"))


@query("B2_select_attribute", r"""
SELECT page_id, regexp_extract(html, '\blang\s*=\s*["'']([^"'']*)["'']', 1) AS lang,
       regexp_extract(html, '\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS first_href,
       regexp_extract(html, '\bclass\s*=\s*["'']([^"'']*)["'']', 1) AS first_class
FROM pages""")
def q_b2(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", B.select_attribute("html", "lang").alias("lang"),
                    B.select_attribute("html", "href").alias("first_href"),
                    B.select_attribute("html", "class").alias("first_class"))


@query("B3_literal_text", """
SELECT p_partkey, 'parts' AS source, CAST(0 AS BIGINT) AS grabs, p_brand || ':' || p_name AS title FROM part""")
def q_b3(spark, sf):
    p = table(spark, sf, "part", spread=True)
    return p.select("p_partkey", B.literal_text("parts").alias("source"),
                    B.literal_text(F.lit(0).cast("bigint")).alias("grabs"),
                    B.literal_text(F.concat_ws(":", "p_brand", "p_name")).alias("title"))


@query("B4_optional_default", r"""
SELECT doc_id, coalesce(nullif(regexp_extract(text, '(?i)licen[sc]ed? under the ([A-Za-z0-9 .-]+?) License', 1), ''), 'unknown') AS license,
       coalesce(nullif(regexp_extract(text, '[A-Za-z0-9._]+@[A-Za-z0-9.-]+', 0), ''), source) AS contact
FROM documents""")
def q_b4(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    lic = F.regexp_extract("text", r"(?i)licen[sc]ed? under the ([A-Za-z0-9 .-]+?) License", 1)
    mail = F.regexp_extract("text", r"[A-Za-z0-9._]+@[A-Za-z0-9.-]+", 0)
    return d.select("doc_id", B.optional_default(lic, "unknown").alias("license"),
                    B.optional_default(mail, F.col("source")).alias("contact"))


@query("B5_required_field", r"""
WITH f AS (SELECT doc_id, regexp_extract(text, '^([A-Z][^.\n]*)', 1) AS title,
                  regexp_extract(text, '[A-Fa-f0-9]{40}', 0) AS infohash FROM documents)
SELECT doc_id, title,
  CASE WHEN title = '' AND infohash = '' THEN 'missing: title,infohash'
       WHEN title = '' THEN 'missing: title'
       WHEN infohash = '' THEN 'missing: infohash' END AS reject_reason
FROM f""")
def q_b5(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    f = d.select("doc_id", F.regexp_extract("text", r"^([A-Z][^.\n]*)", 1).alias("title"),
                 F.regexp_extract("text", r"[A-Fa-f0-9]{40}", 0).alias("infohash"))
    return B.tag_required(f, ["title", "infohash"]).select("doc_id", "title", "reject_reason")


_PRIORITY_CODES = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}


@query("B6_case_value", """
SELECT o_orderkey, CASE lower(o_orderstatus) WHEN 'f' THEN 'finished' WHEN 'o' THEN 'open' ELSE 'pending' END AS status,
       CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority
FROM orders""")
def q_b6(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    return o.select("o_orderkey", B.case_value("o_orderstatus", {"F": "finished", "O": "open", "*": "pending"})
                    .alias("status"),
                    B.case_value("o_orderpriority", _PRIORITY_CODES).cast("bigint").alias("priority"))


@query("B7_case_predicate", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_discount >= 0.08 THEN 'deep' WHEN l_returnflag = 'R' THEN 'returned'
       WHEN l_quantity > 40 THEN 'bulk' ELSE 'normal' END AS kind
FROM lineitem""")
def q_b7(spark, sf):
    li = table(spark, sf, "lineitem", spread=True)
    k = B.case_predicate([(F.col("l_discount") >= 0.08, "deep"), (F.col("l_returnflag") == "R", "returned"),
                          (F.col("l_quantity") > 40, "bulk")], "normal")
    return li.select("l_orderkey", "l_linenumber", k.alias("kind"))


def _remove_sql(x, tag):
    x = f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', '', 'g')"
    return f"regexp_replace({x}, '(?i)<{tag}\\b[^>]*>', '', 'g')"


@query("B8_remove_elements", f"""
SELECT page_id, {SQL_STRIP.format(x=_remove_sql(_remove_sql("html", "script"), "b"))} AS body_text FROM pages""")
def q_b8(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", B.select_field(B.remove_elements("html", ["script", "b"])).alias("body_text"))


@query("B9_private_fields", """
SELECT p_partkey, p_name || ' [' || p_brand || ']' AS title, CAST(p_size AS BIGINT) * 1048576 AS size FROM part""")
def q_b9(spark, sf):
    p = table(spark, sf, "part", spread=True)
    f = p.select("p_partkey", F.col("p_name").alias("_name"), F.col("p_brand").alias("_brand"),
                 F.concat(F.col("p_size").cast("string"), F.lit(" MB")).alias("_size"))
    f = f.withColumns({"title": F.concat(F.col("_name"), F.lit(" ["), F.col("_brand"), F.lit("]")),
                       "size": N.to_bytes(F.col("_size"))})
    return B.private_fields(f)


@query("B10_field_chain", """
SELECT p_partkey, upper(p_type) AS _kind, lower(p_type) || '-' || p_name AS slug,
       'https://parts.example/' || lower(p_type) || '-' || p_name AS details,
       CASE WHEN p_size > 25 THEN 'https://parts.example/' || lower(p_type) || '-' || p_name || '/big' END AS download
FROM part""")
def q_b10(spark, sf):
    p = table(spark, sf, "part", spread=True)
    chain = {
        "_kind": lambda f: F.upper(f["p_type"]),
        "slug": lambda f: F.concat(F.lower(f["_kind"]), F.lit("-"), f["p_name"]),
        "details": lambda f: apply_chain(f["slug"], [("prepend", "https://parts.example/")]),
        "download": lambda f: F.when(f["p_size"] > 25, F.concat(f["details"], F.lit("/big"))),
    }
    return B.field_chain(p, chain).select("p_partkey", "_kind", "slug", "details", "download")


@query("B11_variant_coalesce", f"""
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate
       WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 12 HOUR
       ELSE TIMESTAMP '{AS_OF}' END AS date
FROM orders""")
def q_b11(spark, sf):
    from ..functions.dates import as_of_col, f_dateparse
    o = table(spark, sf, "orders", spread=True)
    ts = F.col("o_orderdate").cast("timestamp")
    v1 = F.when(F.col("o_orderstatus") == "F", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    v2 = F.when(F.col("o_orderstatus") == "O", F.date_format(ts + F.expr("INTERVAL 12 HOURS"), "dd.MM.yyyy HH:mm"))
    d = B.variant_coalesce(f_dateparse(s(v1), "yyyy-MM-dd HH:mm:ss").cast("string"),
                           f_dateparse(s(v2), "dd.MM.yyyy HH:mm").cast("string"))
    out = F.coalesce(d.cast("timestamp"), as_of_col(AS_OF))
    return o.select("o_orderkey", out.cast("timestamp_ntz").alias("date"))


@query("B12_append_modifier", """
SELECT event_id,
  CASE WHEN event_type = 'k' || json_extract_string(props, '$.k') THEN event_type
       ELSE event_type || '|k' || json_extract_string(props, '$.k') END AS tags,
  event_type || ' / ' || CAST(user_id AS VARCHAR) AS label,
  'u' || CAST(user_id AS VARCHAR) AS replaced
FROM events""")
def q_b12(spark, sf):
    e = table(spark, sf, "events", spread=True)
    a = F.array(F.col("event_type"))
    b = F.array(F.concat(F.lit("k"), F.get_json_object("props", "$.k")))
    return e.select("event_id",
                    F.array_join(B.append_modifier(a, b, "append"), "|").alias("tags"),
                    B.append_modifier(F.col("event_type"), F.col("user_id").cast("string"), "append", " / ").alias("label"),
                    B.append_modifier(F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
                                      "noappend").alias("replaced"))


@query("B13_canonical_project", """
SELECT p_name AS title, CAST(p_size AS BIGINT) * 1048576 AS size, CAST(p_size AS INTEGER) AS seeders,
       CAST(NULL AS INTEGER) AS leechers, 'parts' AS source, CAST(p_partkey AS INTEGER) AS pos,
       CAST(1.0 AS DOUBLE) AS downloadvolumefactor
FROM part""")
def q_b13(spark, sf):
    p = table(spark, sf, "part", spread=True)
    rec = p.select(F.lit("parts").alias("source"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"),
                   N.to_bytes(F.concat(F.col("p_size").cast("string"), F.lit("MB"))).alias("size"),
                   F.col("p_size").cast("string").alias("seeders"),
                   F.lit("1").alias("downloadvolumefactor"),
                   F.col("p_type").alias("_internal"))
    c = B.canonical_project(rec)
    return c.select("title", "size", "seeders", "leechers", "source", "pos", "downloadvolumefactor")


def _variant_records(spark, sf):
    """Records whose date is written in one of three ways, each in its own suffixed field; some have
    no title or a seeder count that is no number."""
    o, k = table(spark, sf, "orders", spread=True), F.col("o_orderkey")
    ts = F.col("o_orderdate").cast("timestamp")
    return o.select(
        F.lit("orders").alias("source"), k.cast("int").alias("pos"),
        F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("order "), k.cast("string"))).alias("title"),
        F.when(k % 4 != 3, F.concat(F.lit("other "), k.cast("string"))).alias("title_alt"),
        F.when(k % 3 == 0, F.date_format(ts, "yyyy-MM-dd")).alias("date_year"), F.when(k % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).alias("date_iso"),
        F.when(k % 3 == 2, "no date").alias("date_day"), F.when(k % 5 == 0, "many").otherwise((k % 50).cast("string")).alias("seeders"))


@query("B13_suffix_variants", """
SELECT CAST(o_orderkey AS INTEGER) AS pos, CASE WHEN o_orderkey % 4 = 1 THEN 'order ' ELSE 'other ' END || o_orderkey AS title,
       CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate END AS date, CAST(o_orderkey % 50 AS INTEGER) AS seeders
FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 5 <> 0""")
def q_b13_variants(spark, sf):
    good, _ = B.canonical_records(_variant_records(spark, sf))
    return good.select("pos", "title", F.col("date").cast("timestamp_ntz").alias("date"), "seeders")


@query("B13_quarantine", """
SELECT CAST(o_orderkey AS INTEGER) AS pos, 'missing: ' || concat_ws(',', CASE WHEN o_orderkey % 4 = 3 THEN 'title' END,
       CASE WHEN o_orderkey % 5 = 0 THEN 'seeders' END) AS reject_reason FROM orders WHERE o_orderkey % 4 = 3 OR o_orderkey % 5 = 0""")
def q_b13_quarantine(spark, sf):
    _, bad = B.canonical_records(_variant_records(spark, sf))
    return bad.select("pos", "reject_reason")
