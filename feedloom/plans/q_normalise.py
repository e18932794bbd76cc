"""Registered queries: typed normalisation (N1-N13) and the date helpers behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import normalise as N

from ..operators.catalog import source_dimension
from ..operators.fields import select_attribute
from ..sources.extract import html_rows
from .registry import query
from .tables import AS_OF, dealt, table

# ----------------------------------------------------------------------------- N1


@query("N1_to_bytes", """
SELECT p_partkey,
  CAST(p_size AS BIGINT) * CAST(pow(1024, (p_partkey % 5) + 1) AS BIGINT) AS size_bytes,
  CAST(round(round(p_retailprice, 2) * 1024) AS BIGINT) AS price_kib_bytes,
  CAST(p_size AS BIGINT) * 1073741824 AS local_unit_bytes
FROM part""")
def q_n1(spark, sf):
    p = dealt(table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"))
    unit = F.element_at(F.array(*[F.lit(u) for u in ("KB", "MB", "GB", "TB", "PB")]),
                        (F.col("p_partkey") % 5 + 1).cast("int"))
    t1 = F.concat(F.col("p_size").cast("string"), F.lit(" "), unit)
    t2 = F.concat(F.format_number("p_retailprice", 2), F.lit(" KiB"))
    t3 = F.concat(F.col("p_size").cast("string"), F.lit(" ГБ"))
    p = p.select("p_partkey", t1.alias("t1"), t2.alias("t2"), t3.alias("t3"))
    return p.select("p_partkey", N.to_bytes("t1").alias("size_bytes"),
                    N.to_bytes("t2").alias("price_kib_bytes"), N.to_bytes("t3").alias("local_unit_bytes"))


# ----------------------------------------------------------------------------- N2-N5


def _any_text():
    ts = F.col("ts")
    k = F.col("event_id") % 4
    return (F.when(k == 0, F.unix_timestamp(ts).cast("string"))
            .when(k == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 2, F.date_format(ts, "dd.MM.yyyy HH:mm"))
            .otherwise(F.concat(F.minute(ts).cast("string"), F.lit(" minutes ago"))))


@query("N2_to_timestamp_any", f"""
SELECT event_id,
  CASE event_id % 4
    WHEN 0 THEN date_trunc('second', ts)
    WHEN 1 THEN date_trunc('second', ts)
    WHEN 2 THEN date_trunc('minute', ts)
    ELSE TIMESTAMP '{AS_OF}' - to_minutes(minute(ts))
  END AS parsed
FROM events""")
def q_n2(spark, sf):
    e = table(spark, sf, "events", spread=True).select("event_id", _any_text().alias("txt"))
    return e.select("event_id", D.to_timestamp_any("txt", ["dd.MM.yyyy HH:mm"], AS_OF)
                    .cast("timestamp_ntz").alias("parsed"))


@query("N3_attach_zone", """
SELECT o_orderkey, o_orderdate - INTERVAL 8 HOUR AS utc_date FROM orders""")
def q_n3(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    txt = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm")
    zoned = D.attach_zone(txt, "+08:00")
    return o.select("o_orderkey", D.f_dateparse(zoned, "yyyy-MM-dd HH:mm zzz")
                    .cast("timestamp_ntz").alias("utc_date"))


@query("N4_partial_dates", f"""
WITH o AS (SELECT o_orderkey, o_orderdate,
             try_strptime(CAST(year(TIMESTAMP '{AS_OF}') AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR)
                          || '-' || CAST(day(o_orderdate) AS VARCHAR), '%Y-%m-%d') AS this_year
           FROM orders)
SELECT o_orderkey,
  CASE WHEN this_year > TIMESTAMP '{AS_OF}' THEN this_year - INTERVAL 1 YEAR ELSE this_year END AS no_year,
  o_orderdate AS two_digit
FROM o""")
def q_n4(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    ts = F.col("o_orderdate").cast("timestamp")
    no_year = D.two_digit_and_partial_dates(F.date_format(ts, "MMM d"), "MMM d", AS_OF)
    two = D.two_digit_and_partial_dates(F.date_format(ts, "dd/MM/yy"), "dd/MM/yy", AS_OF)
    return o.select("o_orderkey", no_year.cast("timestamp_ntz").alias("no_year"),
                    two.cast("timestamp_ntz").alias("two_digit"))


_LANGS = ["fr", "de", "es", "ru"]


@query("N5_localised_months", """
SELECT o_orderkey, o_orderdate AS parsed FROM orders""")
def q_n5(spark, sf):
    o = table(spark, sf, "orders", spread=True)
    ts = F.col("o_orderdate").cast("timestamp")
    k = (F.col("o_orderkey") % 4).cast("int")
    forms = {"fr": "fr", "de": "de", "es": "es", "ru": "ru_gen"}
    name = None
    for i, lang in enumerate(_LANGS):
        arr = F.array(*[F.lit(m) for m in D.MONTH_NAMES[forms[lang]]])
        v = F.element_at(arr, F.month(ts))
        name = F.when(k == i, v) if name is None else name.when(k == i, v)
    txt = F.concat(F.dayofmonth(ts).cast("string"), F.lit(" "), name, F.lit(" "), F.year(ts).cast("string"))
    # render once, then parse the column (the parser reads its input several times)
    o = o.select("o_orderkey", txt.alias("txt"))
    parsed = D.f_dateparse(D.localised_months("txt", _LANGS), "d MMM yyyy")
    return o.select("o_orderkey", parsed.cast("timestamp_ntz").alias("parsed"))


# ----------------------------------------------------------------------------- N6-N13


@query("N6_to_count", """
SELECT p_partkey, CAST(round(p_retailprice * 1000) AS BIGINT) AS grabs, CAST(0 AS BIGINT) AS junk
FROM part""")
def q_n6(spark, sf):
    p = table(spark, sf, "part", spread=True)
    return p.select("p_partkey", N.to_count(F.format_number(F.col("p_retailprice") * 1000, 0)).alias("grabs"),
                    N.to_count(F.lit("n/a")).alias("junk"))


@query("N7_external_ids", r"""
SELECT page_id, page_id AS imdbid, CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS path_id
FROM pages""")
def q_n7(spark, sf):
    p = table(spark, sf, "pages", spread=True)
    link = F.concat(F.lit("https://www.imdb.com/title/tt"), F.lpad(F.col("page_id").cast("string"), 7, "0"), F.lit("/"))
    return p.select("page_id", N.external_ids(link, "imdb").alias("imdbid"),
                    N.external_ids(F.regexp_extract("url", r"/([0-9]+)", 0), "any").alias("path_id"))


@query("N8_infohash_or_magnet", r"""
SELECT doc_id, lower(regexp_extract(text, '([A-Fa-f0-9]{40})', 1)) AS infohash FROM documents""")
def q_n8(spark, sf):
    d = table(spark, sf, "documents", spread=True)
    return d.select("doc_id", N.infohash_or_magnet("text").alias("infohash"))


@query("N8_magnet_name", """
SELECT p_partkey, sha1(p_name) AS infohash, p_name AS name FROM part""")
def q_n8b(spark, sf):
    p = table(spark, sf, "part", spread=True)
    mag = F.concat(F.lit("magnet:?xt=urn:btih:"), F.upper(F.sha1("p_name")), F.lit("&dn="), F.url_encode("p_name"),
                   F.lit("&tr=udp%3A%2F%2Ftracker.example%3A80"))
    return p.select("p_partkey", N.infohash_or_magnet(mag).alias("infohash"), N.magnet_name(mag).alias("name"))


@query("N9_volume_factors", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE round(1.0 - CAST(round(l_discount * 100) AS INTEGER) / 100.0, 4) END AS downloadvolumefactor,
  CAST(l_linenumber AS DOUBLE) AS uploadvolumefactor
FROM lineitem""")
def q_n9(spark, sf):
    li = table(spark, sf, "lineitem", spread=True)
    pct = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))
    mult = F.concat(F.col("l_linenumber").cast("string"), F.lit("x"))
    dvf = N.volume_factors(pct, flags=F.col("l_returnflag") == "R")
    return li.select("l_orderkey", "l_linenumber", F.round(dvf, 4).alias("downloadvolumefactor"),
                     N.volume_factors(mult).alias("uploadvolumefactor"))


@query("N10_min_policy", """
SELECT s_suppkey, CAST(0.5 + n_regionkey * 0.25 AS DOUBLE) AS minimumratio, CAST(86400 * (n_regionkey + 1) AS BIGINT) AS minimumseedtime
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def q_n10(spark, sf):
    s = table(spark, sf, "supplier", spread=True).select("s_suppkey", F.col("s_nationkey").alias("source"))
    # nation is a fixed 25-row dimension: its size does not grow with the scale factor
    pol = table(spark, sf, "nation", spread=True).select(
        F.col("n_nationkey").alias("source"),
        (F.lit(0.5) + F.col("n_regionkey") * 0.25).alias("minimumratio"),
        (F.lit(86400) * (F.col("n_regionkey") + 1)).cast("bigint").alias("minimumseedtime"))
    return source_dimension(s, pol, "source").select("s_suppkey", "minimumratio", "minimumseedtime")


@query("N11_genre_array", """
SELECT p_partkey, replace(p_name, ' ', '_') || '|' || p_type AS genres FROM part""")
def q_n11(spark, sf):
    p = table(spark, sf, "part", spread=True)
    txt = F.concat_ws(", ", "p_name", "p_type", "p_name")
    return p.select("p_partkey", F.array_join(N.genre_array(txt), "|").alias("genres"))


@query("N12_to_boolean", """
SELECT event_id, CASE event_type WHEN 'click' THEN TRUE WHEN 'view' THEN FALSE WHEN 'signup' THEN TRUE
                                 WHEN 'purchase' THEN FALSE END AS flag
FROM events""")
def q_n12(spark, sf):
    e = table(spark, sf, "events", spread=True)
    txt = (F.when(F.col("event_type") == "click", "True").when(F.col("event_type") == "view", "false")
           .when(F.col("event_type") == "signup", "1").when(F.col("event_type") == "purchase", "off")
           .otherwise("maybe"))
    return e.select("event_id", N.to_boolean(txt).alias("flag"))


@query("N13_resolve_url", r"""
WITH r AS (
  SELECT page_id, url, unnest(m) AS element, unnest(range(1, len(m) + 1)) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS m FROM pages))
SELECT page_id, CAST(pos AS BIGINT) AS pos,
  regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/' || ltrim(regexp_extract(element, 'href="([^"]*)"', 1), '/') AS link
FROM r""")
def q_n13(spark, sf):
    p = table(spark, sf, "pages", spread=True).select("page_id", "url", "html")
    rows = html_rows(p, "html", r'<li><a href="[^"]*">[^<]*</a></li>', keep=["page_id", "url"])
    base = F.regexp_extract("url", r"^([a-z]+://[^/?#]+)", 1)
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                       N.resolve_url(select_attribute("element", "href"), base).alias("link"))





@query("N1_sizes_in_text", """
SELECT p_partkey, CAST(p_size AS BIGINT) * 1048576 AS after_codec, CAST(round((p_size + 0.5) * 1073741824) AS BIGINT) AS after_season,
       CAST(p_size + 1 AS BIGINT) * 1000 * 1048576 AS blank_thousands, CAST(NULL AS BIGINT) AS negative FROM part""")
def q_n1_text(spark, sf):
    """The number with a unit is the size, not the first number of the text."""
    n = F.col("p_size").cast("string")
    p = dealt(table(spark, sf, "part").select("p_partkey", "p_size")).select(
        "p_partkey", F.concat(F.lit("Show x264 "), n, F.lit(" MB [1080p]")).alias("a"), F.concat(F.lit("S01E02 "), n, F.lit(".5 GB")).alias("b"),
        F.concat((F.col("p_size") + 1).cast("string"), F.lit(" 000 MB")).alias("c"), F.concat(F.lit("-"), n, F.lit(" MB")).alias("d"))
    return p.select("p_partkey", N.to_bytes("a").alias("after_codec"), N.to_bytes("b").alias("after_season"),
                    N.to_bytes("c").alias("blank_thousands"), N.to_bytes("d").alias("negative"))


@query("N6_counts_in_text", """
SELECT p_partkey, CAST(p_size * 1000 + 500 AS BIGINT) AS thousands, CAST(p_size AS BIGINT) AS first_of_two, CAST(-p_size AS BIGINT) AS negative,
       CAST(NULL AS BIGINT) AS too_large FROM part""")
def q_n6_text(spark, sf):
    n = F.col("p_size").cast("string")
    p = table(spark, sf, "part", spread=True).select("p_partkey", F.concat(n, F.lit(".5k")).alias("a"), F.concat(n, F.lit(" of 9999")).alias("b"),
                                                     F.concat(F.lit("-"), n).alias("c"), F.concat(n, F.lit("9" * 20)).alias("d"))
    return p.select("p_partkey", N.to_count("a").alias("thousands"), N.to_count("b").alias("first_of_two"), N.to_count("c").alias("negative"),
                    N.to_count("d").alias("too_large"))


# The examples of RFC 3986, 5.4, against http://a/b/c/d;p?q; here "@" stands for http://a
REFERENCES = [
    ("g:h", "g:h"), ("g", "@/b/c/g"), ("./g", "@/b/c/g"), ("g/", "@/b/c/g/"), ("/g", "@/g"), ("//g", "http://g"), ("?y", "@/b/c/d;p?y"),
    ("g?y", "@/b/c/g?y"), ("#s", "@/b/c/d;p?q#s"), ("g#s", "@/b/c/g#s"), ("g?y#s", "@/b/c/g?y#s"), (";x", "@/b/c/;x"), ("g;x", "@/b/c/g;x"),
    ("g;x?y#s", "@/b/c/g;x?y#s"), ("", "@/b/c/d;p?q"), (".", "@/b/c/"), ("./", "@/b/c/"), ("..", "@/b/"), ("../", "@/b/"), ("../g", "@/b/g"),
    ("../..", "@/"), ("../../", "@/"), ("../../g", "@/g"), ("../../../g", "@/g"), ("../../../../g", "@/g"), ("/./g", "@/g"), ("/../g", "@/g"),
    ("g.", "@/b/c/g."), (".g", "@/b/c/.g"), ("g..", "@/b/c/g.."), ("..g", "@/b/c/..g"), ("./../g", "@/b/g"), ("./g/.", "@/b/c/g/"),
    ("g/./h", "@/b/c/g/h"), ("g/../h", "@/b/c/h"), ("g;x=1/./y", "@/b/c/g;x=1/y"), ("g;x=1/../y", "@/b/c/y"), ("g?y/./x", "@/b/c/g?y/./x"),
    ("g?y/../x", "@/b/c/g?y/../x"), ("g#s/./x", "@/b/c/g#s/./x"), ("g#s/../x", "@/b/c/g#s/../x"), ("http:g", "http:g"),
]


@query("N13_references", f"""
WITH r AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(REFERENCES))}) AS t(k, ref, want))
SELECT page_id, ref, replace(want, '@', 'http://' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) AS link
FROM pages JOIN r ON page_id % {len(REFERENCES)} = k""")
def q_n13_references(spark, sf):
    """Every page's host takes the place of the examples' one; the references rotate over the pages."""
    refs = F.array(*[F.lit(a) for a, _ in REFERENCES])
    p = table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("http://"), F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1), F.lit("/b/c/d;p?q")).alias("base"),
        F.element_at(refs, (F.col("page_id") % len(REFERENCES) + 1).cast("int")).alias("ref"))
    return p.select("page_id", "ref", N.resolve_reference("ref", F.col("base")).alias("link"))
