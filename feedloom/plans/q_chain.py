"""Registered queries: filter chain (F1-F24) and template functions.

Round trips where a parse is tested: a known column is rendered to text in Spark and
parsed back by the operator; the oracle selects the original column.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chain as C
from ..functions import dates as D
from ..functions import template as TP
from .registry import query
from .tables import AS_OF, table

# ----------------------------------------------------------------------------- F1-F9


@query("F1_re_replace", r"""
SELECT doc_id, regexp_replace(regexp_replace(text, '([0-9]+)', '<\1>', 'g'),
                              '([A-Za-z]+)@([A-Za-z]+)', '\2 at \1', 'g') AS out
FROM documents""")
def q_f1(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    out = C.apply_chain("text", [("re_replace", r"([0-9]+)", "<$1>"),
                                 ("re_replace", r"([A-Za-z]+)@([A-Za-z]+)", "$2 at $1")])
    return d.select("doc_id", out.alias("out"))


@query("F2_regexp", r"""
SELECT doc_id, regexp_extract(text, '([A-Z][a-z]+) ([a-z]+)', 1) AS first_word,
       regexp_extract(text, '[0-9]{3,}', 0) AS digits
FROM documents""")
def q_f2(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.f_regexp("text", r"([A-Z][a-z]+) ([a-z]+)").alias("first_word"),
                    C.f_regexp("text", r"[0-9]{3,}").alias("digits"))


@query("F3_replace", """
SELECT doc_id, replace(replace(text, 'the', 'THE'), '\n', ' | ') AS out FROM documents""")
def q_f3(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.apply_chain("text", [("replace", "the", "THE"),
                                                     ("replace", "\n", " | ")]).alias("out"))


@query("F4_append", """
SELECT p_partkey, p_name || ' / ' || p_brand || '.torrent' AS out FROM part""")
def q_f4(spark, sf):
    p = table(spark, sf, "part", spread=True)
    return p.select("p_partkey", C.apply_chain("p_name", [("append", " / "), ("append", F.col("p_brand")),
                                                           ("append", ".torrent")]).alias("out"))


@query("F5_prepend", """
SELECT p_partkey, 'https://parts.example/' || p_type || '/' || p_name AS out FROM part""")
def q_f5(spark, sf):
    p = table(spark, sf, "part", spread=True)
    return p.select("p_partkey", C.apply_chain("p_name", [("prepend", "/"), ("prepend", F.col("p_type")),
                                                           ("prepend", "https://parts.example/")]).alias("out"))


@query("F6_split", """
SELECT page_id, split_part(url, '/', 3) AS host, split_part(url, '/', -1) AS last_part,
       split_part(url, '/', 9) AS missing, split_part(split_part(url, '?', 1), '.', -2) AS domain_word
FROM pages""")
def q_f6(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", C.f_split("url", "/", 2).alias("host"),
                    C.f_split("url", "/", -1).alias("last_part"),
                    C.f_split("url", "/", 8).alias("missing"),
                    C.apply_chain("url", [("split", "?", 0), ("split", ".", -2)]).alias("domain_word"))


@query("F7_trim", """
SELECT doc_id, trim(text) AS blank_trim, trim(text, '.!?, ' || chr(10)) AS char_trim FROM documents""")
def q_f7(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.f_trim("text").alias("blank_trim"),
                    C.f_trim("text", ".!?, \n").alias("char_trim"))


@query("F8_tolower", "SELECT doc_id, lower(text) AS out FROM documents")
def q_f8(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", C.f_tolower("text").alias("out"))


# DuckDB's upper keeps the single-character capital sharp s where Java writes "SS"
@query("F9_toupper", "SELECT doc_id, replace(upper(text), 'ẞ', 'SS') AS out FROM documents")
def q_f9(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", C.f_toupper("text").alias("out"))


# ----------------------------------------------------------------------------- F10-F17


@query("F10_querystring", r"""
SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
       regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) AS utm_source,
       regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref
FROM pages""")
def q_f10(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    return p.select("page_id", C.f_querystring("url", "page").alias("page"),
                    C.f_querystring("url", "utm_source").alias("utm_source"),
                    C.f_querystring("url", "ref").alias("ref"))


@query("F11_urldecode", "SELECT doc_id, text AS out FROM documents")
def q_f11(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.f_urldecode(F.url_encode("text")).alias("out"))


@query("F12_urlencode", "SELECT doc_id, url_encode(text) AS out FROM documents")
def q_f12(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.f_urlencode("text").alias("out"))


_ENT_SQL = "html_title"
for _ent, _ch in C.HTML_ENTITIES:
    _ENT_SQL = f"replace({_ENT_SQL}, '{_ent}', '{_ch.replace(chr(39), chr(39) * 2)}')"


@query("F13_htmldecode", f"""
WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS html_title FROM pages)
SELECT page_id, {_ENT_SQL} AS once, {_ENT_SQL.replace('html_title', '(' + _ENT_SQL + ')', 1)} AS twice FROM t""")
def q_f13(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    t = p.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("html_title"))
    return t.select("page_id", C.f_htmldecode("html_title").alias("once"),
                    C.apply_chain("html_title", [("htmldecode",), ("htmldecode",)]).alias("twice"))


@query("F13_htmldecode_full", """
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', chr(169)),
       '&middot;', chr(183)), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&#39;', chr(39)), '&amp;', '&') AS out FROM pages""")
def q_f13_full(spark, sf):
    """The whole page, every entity in one pass; the SQL has those that the pages hold."""
    return table(spark, sf, "pages", spread=True).select("page_id", C.f_htmldecode("html", full=True).alias("out"))


#: Characters and entities of the round trip, in an order in which no entity is encoded again.
ROUND_TRIP_ENTITIES = [("&", "&amp;"), ("#", "&num;"), ("o", "&#111;"), ("T", "&#x54;"), ("ü", "&#XFC;"), ("è", "&#0232;"),
                       ("é", "&eacute;"), ("ñ", "&ntilde;"), ("ß", "&szlig;"), ("$", "&dollar;"), ("%", "&percnt;"), (".", "&period;")]


@query("F13_htmldecode_round_trip", "SELECT doc_id, text AS out FROM documents")
def q_f13_round_trip(spark, sf):
    """Whole texts with named, decimal and hexadecimal entities, decoded again."""
    d = table(spark, sf, "documents", spread=True)
    encoded = F.col("text")
    for char, entity in ROUND_TRIP_ENTITIES:
        encoded = F.replace(encoded, F.lit(char), F.lit(entity))
    return d.select("doc_id", C.f_htmldecode(encoded, full=True).alias("out"))


@query("F14_htmlencode", """
SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
       '"', '&quot;'), '''', '&#39;') AS out FROM documents""")
def q_f14(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", C.f_htmlencode("text").alias("out"))


@query("F15_diacritics", "SELECT doc_id, strip_accents(text) AS out FROM documents")
def q_f15(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", C.f_diacritics("text").alias("out"))


VALID_WORDS = ["the", "and", "of", "la", "le", "der", "die", "el", "de", "los"]


@query("F16_validate", f"""
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '[,;/|\\s]+'),
       lambda w: lower(w) IN ({', '.join(repr(w) for w in VALID_WORDS)})), ',') AS out
FROM documents""")
def q_f16(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", C.f_validate("text", VALID_WORDS).alias("out"))


@query("F17_validfilename", """
SELECT doc_id, translate(text, '<>:"/\\|?*', '_________') AS out FROM documents""")
def q_f17(spark, sf):
    return table(spark, sf, "documents", spread=True).select("doc_id", C.f_validfilename("text").alias("out"))


# ----------------------------------------------------------------------------- F18-F22

# .NET-style formats exercised by the round trip, with the Spark pattern that renders them
ROUND_TRIP_FORMATS = [
    ("yyyy-MM-dd HH:mm:ss zzz", "yyyy-MM-dd HH:mm:ss", " +03:00"),
    ("ddd, dd MMM yyyy HH:mm:ss zzz", "EEE, dd MMM yyyy HH:mm:ss", " +0000"),
    ("MM/dd/yyyy HH:mm:ss zzz", "MM/dd/yyyy HH:mm:ss", " -05:00"),
    ("MMM d yyyy hh:mm tt", "MMM d yyyy hh:mm a", ""),
    ("dd.MM.yyyy HH:mm", "dd.MM.yyyy HH:mm", ""),
    ("yyyy-MM-ddHH:mm:ss", "yyyy-MM-ddHH:mm:ss", ""),
    ("MMM d yyyyh:mm tt", "MMM d yyyyh:mm a", ""),
    ("dddd, d. MMM, yyyy zzz", "EEEE, d. MMM, yyyy", " +01:00"),
]


def _offset_hours(off: str) -> int:
    off = off.strip()
    if not off:
        return 0
    sign = -1 if off[0] == "-" else 1
    return sign * int(off[1:3])


def _f18_sql():
    cols = []
    for i, (fmt, _, off) in enumerate(ROUND_TRIP_FORMATS, 1):
        h = _offset_hours(off)
        base = "o_orderdate" if "HH" in fmt or "hh" in fmt or "h:" in fmt else "date_trunc('day', o_orderdate)"
        cols.append(f"{base} - INTERVAL ({h}) HOUR AS p{i}")
    return "SELECT o_orderkey, " + ", ".join(cols) + " FROM orders"


@query("F18_dateparse", _f18_sql())
def q_f18(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    ts = F.col("o_orderdate").cast("timestamp")
    cols = []
    for i, (fmt, render, off) in enumerate(ROUND_TRIP_FORMATS, 1):
        txt = F.concat(F.date_format(ts, render), F.lit(off))
        cols.append(D.f_dateparse(txt, fmt).cast("timestamp_ntz").alias(f"p{i}"))
    return o.select("o_orderkey", *cols)


@query("F19_timeparse", f"""
SELECT event_id, TIMESTAMP '{AS_OF[:10]} 00:00:00' + to_hours(hour(ts)) + to_minutes(minute(ts)) AS at_time
FROM events""")
def q_f19(spark, sf):
    e = table(spark, sf, "events", spread=True)
    txt = F.date_format("ts", "HH:mm")
    return e.select("event_id", D.f_timeparse(txt, "HH:mm", AS_OF).cast("timestamp_ntz").alias("at_time"))


@query("F20_timeago", f"""
SELECT event_id, TIMESTAMP '{AS_OF}' - to_days(CAST(user_id % 30 AS INTEGER)) - to_hours(hour(ts))
       - to_minutes(minute(ts)) AS posted
FROM events""")
def q_f20(spark, sf):
    e = table(spark, sf, "events", spread=True)
    txt = F.concat((F.col("user_id") % 30).cast("string"), F.lit(" days, "),
                   F.hour("ts").cast("string"), F.lit(" hours and "),
                   F.minute("ts").cast("string"), F.lit(" mins ago"))
    e = e.select("event_id", txt.alias("txt"))
    return e.select("event_id", D.f_timeago("txt", AS_OF).cast("timestamp_ntz").alias("posted"))


@query("F21_reltime", f"""
SELECT event_id, TIMESTAMP '{AS_OF}' - to_weeks(CAST(user_id % 5 AS INTEGER)) - to_seconds(CAST(second(ts) AS BIGINT)) AS posted
FROM events""")
def q_f21(spark, sf):
    e = table(spark, sf, "events", spread=True)
    txt = F.concat((F.col("user_id") % 5).cast("string"), F.lit("w "),
                   F.second("ts").cast("string"), F.lit("s"))
    e = e.select("event_id", txt.alias("txt"))
    return e.select("event_id", D.f_reltime("txt", AS_OF).cast("timestamp_ntz").alias("posted"))


def _fuzzy_text():
    ts = F.col("ts")
    k = F.col("event_id") % 5
    return (F.when(k == 0, F.concat(F.lit("Today "), F.date_format(ts, "HH:mm")))
            .when(k == 1, F.concat(F.lit("Yesterday "), F.date_format(ts, "h:mm a")))
            .when(k == 2, F.concat(F.lit("last "), F.date_format(ts, "EEEE"), F.lit(" "),
                                   F.date_format(ts, "HH:mm")))
            .when(k == 3, F.concat(F.hour(ts).cast("string"), F.lit(" hours ago")))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))


@query("F22_fuzzytime", f"""
WITH e AS (SELECT event_id, ts, event_id % 5 AS k, DATE '{AS_OF[:10]}' AS d FROM events)
SELECT event_id,
  CASE k
    WHEN 0 THEN CAST(d AS TIMESTAMP) + to_hours(hour(ts)) + to_minutes(minute(ts))
    WHEN 1 THEN CAST(d AS TIMESTAMP) - to_days(1) + to_hours(hour(ts)) + to_minutes(minute(ts))
    WHEN 2 THEN CAST(d AS TIMESTAMP) - to_days(CAST(((dayofweek(d) - dayofweek(ts) + 6) % 7) + 1 AS INTEGER))
                + to_hours(hour(ts)) + to_minutes(minute(ts))
    WHEN 3 THEN TIMESTAMP '{AS_OF}' - to_hours(hour(ts))
    ELSE date_trunc('second', ts)
  END AS posted
FROM e""")
def q_f22(spark, sf):
    e = table(spark, sf, "events", spread=True).select("event_id", _fuzzy_text().alias("txt"))
    return e.select("event_id", D.f_fuzzytime("txt", AS_OF).cast("timestamp_ntz").alias("posted"))


# ----------------------------------------------------------------------------- F23-F24


@query("F23_jsonjoinarray", """
SELECT event_id, event_type || '|u' || CAST(user_id AS VARCHAR) || '|' || json_extract_string(props, '$.k') AS out
FROM events""")
def q_f23(spark, sf):
    e = table(spark, sf, "events", spread=True)
    doc = F.to_json(F.struct(F.array(F.col("event_type"), F.concat(F.lit("u"), F.col("user_id").cast("string")),
                                     F.get_json_object("props", "$.k")).alias("tags")))
    return e.select("event_id", C.f_jsonjoinarray(doc, "$.tags", "|").alias("out"))


# Our own rules, ordered; later ones see the earlier ones' output
TITLE_RULES = [
    (r"(?i)\bvolume no\. (\d+)\b", "v$1"),
    (r"(?i)\bchapter no\. (\d+)\b", "c$1"),
    (r"\bv(\d+) c(\d+)\b", "v$1.$2"),
]


@query("F24_cleanup_titles", """
SELECT o_orderkey, 'Show v' || (o_orderkey % 20) || '.' || (o_custkey % 30) || ' ' || o_orderpriority AS title
FROM orders""")
def q_f24(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    raw = F.concat(F.lit("Show Volume no. "), (F.col("o_orderkey") % 20).cast("string"), F.lit(" CHAPTER no. "),
                   (F.col("o_custkey") % 30).cast("string"), F.lit(" "), F.col("o_orderpriority"))
    return o.select("o_orderkey", C.f_cleanup_titles(raw, TITLE_RULES).alias("title"))


# ----------------------------------------------------------------------------- T1-T9


def _events_fields(spark, sf):
    e = table(spark, sf, "events", spread=True)
    return e.select("event_id", "user_id", "event_type",
                    F.when(F.col("event_type") == "purchase", F.lit("yes")).alias("_paid"),
                    F.when(F.col("value") > 50, F.col("value").cast("string")).alias("_big"),
                    F.get_json_object("props", "$.k").alias("_k"))


@query("T1_if", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'paid' ELSE 'free' END AS kind FROM events""")
def q_t1(spark, sf):
    e = _events_fields(spark, sf)
    return e.select("event_id", TP.tpl_if(F.col("_paid"), "paid", "free").alias("kind"))


@query("T2_and", """
SELECT event_id, (event_type = 'purchase' AND value > 50) AS paid_and_big FROM events""")
def q_t2(spark, sf):
    e = _events_fields(spark, sf)
    return e.select("event_id", TP.tpl_and(F.col("_paid"), F.col("_big")).alias("paid_and_big"))


@query("T3_or", """
SELECT event_id, (event_type = 'purchase' OR value > 50) AS paid_or_big,
       coalesce(CASE WHEN event_type = 'purchase' THEN 'yes' END,
                CASE WHEN value > 50 THEN CAST(value AS VARCHAR) END, '') AS first_set
FROM events""")
def q_t3(spark, sf):
    e = _events_fields(spark, sf)
    return e.select("event_id", TP.tpl_or(F.col("_paid"), F.col("_big")).alias("paid_or_big"),
                    TP.tpl_or(F.col("_paid"), F.col("_big"), as_value=True).alias("first_set"))


@query("T4_eq_ne", """
SELECT event_id, (event_type = 'click') AS is_click, (json_extract_string(props, '$.k') <> '7') AS k_not_7
FROM events""")
def q_t4(spark, sf):
    e = _events_fields(spark, sf)
    return e.select("event_id", TP.tpl_eq(F.col("event_type"), "click").alias("is_click"),
                    TP.tpl_ne(F.col("_k"), "7").alias("k_not_7"))


@query("T5_join", """
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS types
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""")
def q_t5(spark, sf):
    e = table(spark, sf, "events", spread=True)
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return g.select("user_id", TP.tpl_join("types", ",").alias("types"))


@query("T6_range", """
SELECT user_id, string_agg('[' || event_type || ']', '' ORDER BY event_type) AS rendered
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id""")
def q_t6(spark, sf):
    e = table(spark, sf, "events", spread=True)
    g = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    return g.select("user_id", TP.tpl_range("types", lambda x: F.concat(F.lit("["), x, F.lit("]")))
                    .alias("rendered"))


@query("T7_re_replace", r"""
SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9]+', '.', 'g') AS slug FROM documents""")
def q_t7(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", TP.tpl_re_replace(F.col("text"), r"[^A-Za-z0-9]+", ".").alias("slug"))


@query("T8_vars", f"""
SELECT p_partkey, 'widget' AS param_q, CAST(year(TIMESTAMP '{AS_OF}') AS INTEGER) AS param_today_year,
       'True' AS param_true, '' AS param_false,
       contains(p_name, 'widget') AS matches
FROM part""")
def q_t8(spark, sf):
    p = table(spark, sf, "part", spread=True).select("p_partkey", "p_name")
    v = TP.tpl_vars(p, {"q": "widget"}, as_of=AS_OF)
    return v.select("p_partkey", "param_q", "param_today_year", "param_true", "param_false",
                    F.col("p_name").contains(F.col("param_q")).alias("matches"))


@query("T9_concat", """
SELECT p_partkey, 'Part ' || p_name || ' (' || coalesce(CASE WHEN p_size > 25 THEN 'big' END, '') || ')' AS label
FROM part""")
def q_t9(spark, sf):
    p = table(spark, sf, "part", spread=True)
    big = F.when(F.col("p_size") > 25, F.lit("big"))
    return p.select("p_partkey", TP.tpl_concat("Part ", F.col("p_name"), " (", big, ")").alias("label"))


# Our per-source rule table for F24 (definition-sized: a handful of rules per source)
SOURCE_RULES = [("src0", 1, r"(?i)\btoken\b", "TOKEN"), ("src0", 2, r"TOKEN = ", "TOKEN: "),
                ("src1", 1, r"[0-9]+", "#")]


@query("F24_cleanup_by_source", r"""
SELECT doc_id, CASE source
    WHEN 'src0' THEN regexp_replace(regexp_replace(text, '(?i)\btoken\b', 'TOKEN', 'g'), 'TOKEN = ', 'TOKEN: ', 'g')
    WHEN 'src1' THEN regexp_replace(text, '[0-9]+', '#', 'g')
    ELSE text END AS out
FROM documents""")
def q_f24_by_source(spark, sf):
    d = table(spark, sf, "documents", spread=True).select("doc_id", "source", "text")
    rules = spark.createDataFrame(SOURCE_RULES, "source string, seq int, pattern string, replacement string")
    return C.cleanup_titles_by_source(d, "text", rules, out="out").select("doc_id", "out")


# (format, how Spark renders it, zone, language, unit the text is exact to); our own fixture, one source each
SOURCE_FORMATS = [
    ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss", None, None, "second"),
    ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "+03:00", None, "second"),
    ("dd.MM.yyyy HH:mm", "dd.MM.yyyy HH:mm", None, None, "minute"),
    ("dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "-05:00", None, "second"),
    ("MM/dd/yyyy HH:mm", "MM/dd/yyyy HH:mm", None, None, "minute"),
    ("dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy HH:mm:ss", None, None, "second"),
    ("yyyy/MM/dd HH:mm", "yyyy/MM/dd HH:mm", None, None, "minute"),
    ("yyyy.MM.dd HH:mm:ss", "yyyy.MM.dd HH:mm:ss", "+08:00", None, "second"),
    ("MMM d yyyy hh:mm tt", "MMM d yyyy hh:mm a", None, None, "minute"),
    ("d MMM yyyy HH:mm", "d MMM yyyy HH:mm", None, None, "minute"),
    ("dd MMM yyyy HH:mm:ss", "dd MMM yyyy HH:mm:ss", "+02:00", None, "second"),
    ("MMM dd, yyyy HH:mm", "MMM dd, yyyy HH:mm", None, None, "minute"),
    ("ddd, dd MMM yyyy HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss", None, None, "second"),
    ("dddd, d MMMM yyyy", "EEEE, d MMMM yyyy", None, None, "day"),
    ("yyyyMMddHHmmss", "yyyyMMddHHmmss", None, None, "second"),
    ("yyyyMMdd HH:mm", "yyyyMMdd HH:mm", "-02:00", None, "minute"),
    ("HH:mm dd.MM.yyyy", "HH:mm dd.MM.yyyy", None, None, "minute"),
    ("HH:mm:ss dd/MM/yyyy", "HH:mm:ss dd/MM/yyyy", "+01:00", None, "second"),
    ("dd/MM/yy HH:mm", "dd/MM/yy HH:mm", None, None, "minute"),
    ("yyyy-MM-ddTHH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", None, None, "second"),
    ("MMMM d, yyyy h:mm tt", "MMMM d, yyyy h:mm a", None, None, "minute"),
    ("d MMM yyyy HH:mm", "d '%' yyyy HH:mm", None, "fr", "minute"),
    ("d MMM yyyy, HH:mm", "d '%' yyyy, HH:mm", None, "de", "minute"),
    ("d MMM yyyy HH:mm:ss", "d '%' yyyy HH:mm:ss", None, "es", "second"),
    ("d MMM yyyy, HH:mm", "d '%' yyyy, HH:mm", "+03:00", "ru", "minute"),
]


def _formats_sql():
    cases = " ".join(f"WHEN {i} THEN date_trunc('{unit}', ts) - INTERVAL ({_offset_hours(zone or '')}) HOUR"
                     for i, (_, _, zone, _, unit) in enumerate(SOURCE_FORMATS))
    n = len(SOURCE_FORMATS) + 1  # the last source declares no format
    return f"SELECT event_id, 's' || CAST(event_id % {n} AS VARCHAR) AS source, CASE event_id % {n} {cases} END AS parsed FROM events"


@query("F18_formats_by_source", _formats_sql())
def q_f18_sources(spark, sf):
    """One table of many sources, each with its own format, zone and month language; a format
    that fits nothing is tried first for every other source."""
    ts, n = F.col("ts").cast("timestamp"), len(SOURCE_FORMATS) + 1
    k = F.col("event_id") % n
    text = F.lit("2020-01-02 03:04:05")
    for i, (_, render, _, lang, _) in enumerate(SOURCE_FORMATS):
        t = F.date_format(ts, render)
        if lang:
            months = F.array(*[F.lit(m) for m in D.MONTH_NAMES["ru_gen" if lang == "ru" else lang]])
            t = F.replace(t, F.lit("%"), F.element_at(months, F.month(ts)))
        text = F.when(k == i, t) if i == 0 else text.when(k == i, t)
    e = table(spark, sf, "events", spread=True).select(
        "event_id", F.concat(F.lit("s"), k.cast("string")).alias("source"), text.otherwise("2020-01-02 03:04:05").alias("txt"))
    specs = [(f"s{i}", 2, fmt, zone, lang) for i, (fmt, _, zone, lang, _) in enumerate(SOURCE_FORMATS)]
    specs += [(f"s{i}", 1, "yyyy|MM", None, None) for i in range(0, len(SOURCE_FORMATS), 2)]
    dim = spark.createDataFrame(specs, "source string, seq int, format string, zone string, lang string")
    return D.parse_by_source(e, "txt", dim).select("event_id", "source", F.col("parsed").cast("timestamp_ntz").alias("parsed"))


@query("F20_decimal_amounts", f"""
SELECT event_id, TIMESTAMP '{AS_OF}' - to_minutes(CAST(user_id % 30 * 60 + 30 AS INTEGER)) AS posted,
       TIMESTAMP '{AS_OF}' - to_minutes(CAST(1000 + user_id % 30 AS INTEGER)) AS thousands FROM events""")
def q_f20_decimal(spark, sf):
    n = F.col("user_id") % 30
    e = table(spark, sf, "events", spread=True).select(
        "event_id", F.concat(n.cast("string"), F.lit(",5 hours ago")).alias("a"),
        F.concat(F.lit("1,0"), F.lpad(n.cast("string"), 2, "0"), F.lit(" mins ago")).alias("b"))
    return e.select("event_id", D.f_timeago("a", AS_OF).cast("timestamp_ntz").alias("posted"),
                    D.f_timeago("b", AS_OF).cast("timestamp_ntz").alias("thousands"))


@query("F22_weekday_dates", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('minute', ts) END AS posted FROM events""")
def q_f22_dates(spark, sf):
    """A weekday before a full date belongs to the date; 'yesterdays ...' is no day."""
    ts, k = F.col("ts").cast("timestamp"), F.col("event_id") % 3
    e = table(spark, sf, "events", spread=True).select("event_id", F.when(k == 0, F.date_format(ts, "EEEE, d MMMM yyyy")).when(
        k == 1, F.date_format(ts, "EEEE d MMM yyyy HH:mm")).otherwise(F.concat(F.lit("yesterdays news "), F.date_format(ts, "HH:mm"))).alias("txt"))
    return e.select("event_id", D.f_fuzzytime("txt", AS_OF, ["dddd, d MMMM yyyy", "dddd d MMM yyyy HH:mm"]).cast("timestamp_ntz").alias("posted"))
