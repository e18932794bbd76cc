"""Registered queries: category mapping and source dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as C
from .fixtures import CATEGORY_SQL, PART_TYPE_MAP_SQL, category_df, part_type_map_df
from .registry import query
from .tables import table


def _part_ids(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lit("parts").alias("source"),
                                           F.col("p_type").alias("site_id"), "p_size")


@query("C1_map_category", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, p_type AS site_id, m.cat_code FROM part LEFT JOIN m ON p_type = m.site_id""")
def q_c1(spark, sf):
    r = C.map_category(_part_ids(spark, sf), part_type_map_df(spark))
    return r.select("p_partkey", "site_id", "cat_code")


@query("C2_map_category_multi", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, coalesce(array_to_string(list_sort(list(DISTINCT m.cat_code) FILTER (WHERE m.cat_code IS NOT NULL)), ','), '') AS categories
FROM part LEFT JOIN m ON p_type = m.site_id GROUP BY p_partkey""")
def q_c2(spark, sf):
    r = C.map_category_multi(_part_ids(spark, sf), part_type_map_df(spark))
    return r.select("p_partkey", F.coalesce(F.array_join("categories", ","), F.lit("")).alias("categories"))


@query("C3_map_by_description", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, m.cat_code FROM part LEFT JOIN m ON lower(trim(p_type)) = lower(trim(m.descr))""")
def q_c3(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    m = part_type_map_df(spark).select("descr", "cat_code")
    return C.map_by_description(p, "p_type", m).select("p_partkey", "cat_code")


def _region_nation_categories(spark, sf):
    """A two-level category tree derived from the data: regions are parents
    ((r+1)*1000), nations their children."""
    r = table(spark, sf, "region")
    n = table(spark, sf, "nation")
    parents = r.select(((F.col("r_regionkey") + 1) * 1000).cast("bigint").alias("cat_code"),
                       F.col("r_name").alias("cat_name"))
    kids = n.join(r, n.n_regionkey == r.r_regionkey).select(
        ((F.col("n_regionkey") + 1) * 1000 + 10 + F.col("n_nationkey")).cast("bigint").alias("cat_code"),
        F.concat_ws("/", "r_name", "n_name").alias("cat_name"))
    return parents.unionByName(kids)


@query("C4_category_closure", """
WITH c AS (SELECT CAST((r_regionkey + 1) * 1000 AS BIGINT) AS cat_code, r_name AS cat_name FROM region
           UNION ALL
           SELECT CAST((n_regionkey + 1) * 1000 + 10 + n_nationkey AS BIGINT), r_name || '/' || n_name
           FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT p.cat_code AS parent_code, p.cat_name AS parent_name, c.cat_code AS child_code, c.cat_name AS child_name
FROM c JOIN c p ON p.cat_code = c.cat_code // 1000 * 1000""")
def q_c4(spark, sf):
    return C.category_closure(_region_nation_categories(spark, sf)).select(
        "parent_code", "parent_name", "child_code", "child_name")


@query("C5_reverse_category", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL}),
r AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 5040 WHEN 1 THEN 2045 ELSE 5030 END AS req_code FROM part)
SELECT p_partkey, array_to_string(list_sort(list(DISTINCT m.site_id)), ',') AS site_ids
FROM r JOIN m ON r.req_code = m.cat_code GROUP BY p_partkey""")
def q_c5(spark, sf):
    p = table(spark, sf, "part")
    req = p.select("p_partkey", F.element_at(F.array(F.lit(5040), F.lit(2045), F.lit(5030)),
                                             (F.col("p_size") % 3 + 1).cast("int")).cast("bigint").alias("req_code"))
    r = C.reverse_category(req, part_type_map_df(spark), on=["p_partkey"])
    return r.select("p_partkey", F.array_join("site_ids", ",").alias("site_ids"))


@query("C6_default_categories", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, CASE WHEN p_size % 2 = 1 THEN p_type
                       ELSE (SELECT array_to_string(list_sort(list(DISTINCT site_id)), ',') FROM m WHERE is_default) END
       AS site_ids
FROM part""")
def q_c6(spark, sf):
    p = table(spark, sf, "part")
    req = p.select("p_partkey", F.lit("parts").alias("source"),
                   F.when(F.col("p_size") % 2 == 1, F.array("p_type")).alias("site_ids"))
    r = C.default_categories(req, part_type_map_df(spark))
    return r.select("p_partkey", F.array_join("site_ids", ",").alias("site_ids"))


@query("C7_simple_categories", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, p_type AS site_id, 'cat-' || CAST(p_size % 5 AS VARCHAR) AS cat, m.cat_code
FROM part LEFT JOIN m ON p_type = m.site_id""")
def q_c7(spark, sf):
    p = table(spark, sf, "part")
    legacy = p.select("p_partkey", F.create_map(F.col("p_type"),
                                                F.concat(F.lit("cat-"), (F.col("p_size") % 5).cast("string"))).alias("cats"))
    rows = C.simple_categories(legacy, "cats", keep=["p_partkey"]).withColumn("source", F.lit("parts"))
    return C.map_category(rows, part_type_map_df(spark)).select("p_partkey", "site_id", "cat", "cat_code")


@query("C8_unmapped_ids", f"""
WITH m AS (SELECT * FROM {PART_TYPE_MAP_SQL})
SELECT p_partkey, p_type AS site_id FROM part WHERE p_type NOT IN (SELECT site_id FROM m)""")
def q_c8(spark, sf):
    r = C.unmapped_ids(_part_ids(spark, sf), part_type_map_df(spark))
    return r.select("p_partkey", "site_id")


_RAW_NAMES = ["console/xbox", "books/ebook", "Console/WiiWare/VC", "Pc/Mac", "Console/XBOX One"]


@query("C9_category_rename", f"""
WITH r AS (SELECT p_partkey,
             regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
               (['console/xbox', 'books/ebook', 'Console/WiiWare/VC', 'Pc/Mac', 'Console/XBOX One'])[p_partkey % 5 + 1],
               '(?i)xbox', 'XBox', 'g'), '(?i)ebook', 'EBook', 'g'), '(?i)XBox One', 'XBox One', 'g'),
               '(?i)WiiWare/VC', 'Wiiware', 'g'), '(?i)Pc', 'PC', 'g') AS name FROM part),
c AS (SELECT * FROM {CATEGORY_SQL})
SELECT r.p_partkey, r.name, c.cat_code FROM r LEFT JOIN c ON lower(r.name) = lower(c.cat_name)""")
def q_c9(spark, sf):
    p = table(spark, sf, "part")
    raw = F.element_at(F.array(*[F.lit(x) for x in _RAW_NAMES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    r = p.select("p_partkey", C.category_rename(raw).alias("name"))
    cats = category_df(spark).select(F.lower("cat_name").alias("_k"), "cat_code")
    return (r.withColumn("_k", F.lower("name")).join(F.broadcast(cats), "_k", "left")
             .select("p_partkey", "name", "cat_code"))


CAPS_SCHEMA = ("categories STRUCT<category: ARRAY<STRUCT<_id: BIGINT, _name: STRING, "
               "subcat: ARRAY<STRUCT<_id: BIGINT, _name: STRING>>>>>")


@query("C10_caps_convert", """
SELECT CAST((n_regionkey + 1) * 1000 + 10 + n_nationkey AS BIGINT) AS sub_code, n_name AS sub_name,
       CAST((r_regionkey + 1) * 1000 AS BIGINT) AS cat_code, r_name AS cat_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_c10(spark, sf):
    r = table(spark, sf, "region")
    n = table(spark, sf, "nation")
    sub = n.select("n_regionkey", F.concat(
        F.lit('<subcat id="'), ((F.col("n_regionkey") + 1) * 1000 + 10 + F.col("n_nationkey")).cast("string"),
        F.lit('" name="'), F.col("n_name"), F.lit('"/>')).alias("x"), "n_nationkey")
    subs = sub.groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("n_nationkey", "x"))), lambda s: s["x"]), "").alias("subs"))
    cat = r.join(subs, r.r_regionkey == subs.n_regionkey, "left").select(
        "r_regionkey", F.concat(F.lit('<category id="'), ((F.col("r_regionkey") + 1) * 1000).cast("string"),
                                F.lit('" name="'), F.col("r_name"), F.lit('">'), F.coalesce("subs", F.lit("")),
                                F.lit("</category>")).alias("x"))
    # one capability document per region, as each source answers with its own
    caps = cat.select("r_regionkey", F.concat(F.lit("<caps><categories>"), F.col("x"),
                                              F.lit("</categories></caps>")).alias("body"))
    parsed = caps.select(F.explode(F.from_xml("body", CAPS_SCHEMA)["categories"]["category"]).alias("c"))
    cats = parsed.select(F.col("c._id").alias("cat_code"), F.col("c._name").alias("cat_name"))
    subcats = parsed.select(F.explode("c.subcat").alias("s")).select(
        F.col("s._id").alias("sub_code"), F.col("s._name").alias("sub_name"))
    return C.caps_convert(cats, subcats).select("sub_code", "sub_name", "cat_code", "cat_name")


@query("C11_source_dimension", """
SELECT s_suppkey, n_name AS language, r_name AS access
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_c11(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("source"))
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    # nation and region are fixed-size dimensions (25 and 5 rows at every scale)
    dim = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("source"), F.col("n_name").alias("language"), F.col("r_name").alias("access"))
    return C.source_dimension(s, dim).select("s_suppkey", "language", "access")


@query("C12_filtered_settings", """
WITH u AS (SELECT event_type AS source,
             CASE WHEN max(value) > 99.9 THEN 'size' WHEN max(value) > 99 THEN 'seeders' ELSE 'bogus' END AS user_value
           FROM events GROUP BY event_type)
SELECT source, 'sort' AS name, 'time' AS default, user_value,
       CASE WHEN user_value IN ('time', 'size', 'seeders') THEN user_value ELSE 'time' END AS value
FROM u""")
def q_c12(spark, sf):
    e = table(spark, sf, "events")
    mx = F.max("value")
    user = e.groupBy(F.col("event_type").alias("source")).agg(
        F.when(mx > 99.9, "size").when(mx > 99, "seeders").otherwise("bogus").alias("user_value"))
    user = user.withColumn("name", F.lit("sort"))
    defaults = user.select("source").withColumn("name", F.lit("sort")).withColumn("default", F.lit("time"))
    opts = defaults.select("source", "name",
                           F.explode(F.array(F.lit("time"), F.lit("size"), F.lit("seeders"))).alias("opt_key"))
    r = C.filtered_settings(defaults, user, options=opts)
    return r.select("source", "name", "default", "user_value", "value")


ALIASES = [("spam-farm.example.org", "archive.example.org"), ("m.ththth.example.net", "ththth.example.net")]


@query("C13_alias_hosts", r"""
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS host FROM pages)
SELECT page_id, CASE host WHEN 'spam-farm.example.org' THEN regexp_replace(url, '^([a-zA-Z]+://)[^/:?#]+', '\1archive.example.org')
                          WHEN 'm.ththth.example.net' THEN regexp_replace(url, '^([a-zA-Z]+://)[^/:?#]+', '\1ththth.example.net')
                          ELSE url END AS resolved_url
FROM p""")
def q_c13(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    aliases = spark.createDataFrame(ALIASES, "old_host string, new_host string")
    return C.alias_hosts(p, "url", aliases).select("page_id", "resolved_url")


@query("G6_source_profile", """
SELECT lang, source, count(*) AS n FROM documents GROUP BY CUBE (lang, source)""")
def q_g6(spark, sf):
    d = table(spark, sf, "documents")
    return C.source_profile(d, ["lang", "source"]).select("lang", "source", "n")


@query("C12_settings_kinds", """
SELECT c_custkey, name, CASE WHEN name = 'sort' THEN CASE WHEN c_custkey % 3 = 0 THEN 'size' ELSE 'time' END
                             WHEN name = 'user' THEN c_name WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'off' END AS value
FROM customer, (VALUES ('sort'), ('user'), ('freeleech')) AS s(name)
WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey, name, CASE name WHEN 'sort' THEN 'time' WHEN 'user' THEN '' ELSE 'off' END
FROM customer, (VALUES ('sort'), ('user'), ('freeleech')) AS s(name) WHERE c_custkey % 5 = 0""")
def q_c12_kinds(spark, sf):
    """A select setting with options, a text and a checkbox setting without; every fifth
    customer has set nothing."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("source"), "c_name")
    defaults = c.select("source", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(d).alias("default")) for n, d in (
        ("sort", "time"), ("user", ""), ("freeleech", "off"))])).alias("s")).select("source", "s.*")
    k = F.col("source")
    user = c.where(k % 5 != 0).select("source", F.explode(F.array(
        F.struct(F.lit("sort").alias("name"), F.when(k % 3 == 0, "size").otherwise("bogus").alias("user_value")),
        F.struct(F.lit("user").alias("name"), F.col("c_name").alias("user_value")),
        F.struct(F.lit("freeleech").alias("name"), F.when(k % 2 == 0, "true").alias("user_value")))).alias("s")).select("source", "s.*")
    options = defaults.where("name = 'sort'").select("source", "name", F.explode(F.array(F.lit("time"), F.lit("size"))).alias("opt_key"))
    return C.filtered_settings(defaults, user, options=options).select(F.col("source").alias("c_custkey"), "name", "value")


@query("G6_profile_levels", """
SELECT lang, site, count(*) AS n, CAST(GROUPING(lang, site) AS BIGINT) AS level
FROM (SELECT CASE WHEN doc_id % 7 <> 0 THEN lang END AS lang, CASE WHEN doc_id % 5 <> 0 THEN source END AS site FROM documents) GROUP BY CUBE (lang, site)""")
def q_g6_levels(spark, sf):
    """Null values of a dimension beside its subtotals."""
    d = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"),
                                             F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("site"))
    return C.source_profile(d, ["lang", "site"])
