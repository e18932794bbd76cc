"""Registered queries: snapshot sync (M1-M16), key sets and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as L
from ..operators import sync as M
from ..operators import sync_flow
from ..sources import catalogue as store
from .fixtures import BLOCKLIST_SQL, blocklist_df
from .registry import query
from .tables import table

# --------------------------------------------------------------------------- fixtures
# Two catalogue snapshots from orders: the new one drops keys % 97, changes keys % 89,
# renames keys % 83 (same content, key 'r..') and adds keys % 71 (key 'n..').


def snapshots(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    content = F.concat_ws("|", "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string"), k.cast("string"))
    base = o.select(k.alias("k"), content.alias("content"))
    old = base.select(F.lit(11).alias("version"), F.concat(F.lit("o"), F.col("k").cast("string")).alias("key"), "content")
    kept = base.filter(F.col("k") % 97 != 0).select(
        F.lit(11).alias("version"),
        F.concat(F.when(F.col("k") % 83 == 0, F.lit("r")).otherwise(F.lit("o")), F.col("k").cast("string")).alias("key"),
        F.when(F.col("k") % 89 == 0, F.concat(F.col("content"), F.lit("|changed"))).otherwise(F.col("content"))
        .alias("content"))
    added = base.filter(F.col("k") % 71 == 0).select(
        F.lit(11).alias("version"), F.concat(F.lit("n"), F.col("k").cast("string")).alias("key"),
        F.concat(F.lit("new|"), F.col("content")).alias("content"))
    new = kept.unionByName(added)
    h = M.content_hash(F.col("content"))
    return old.withColumn("content_hash", h), new.withColumn("content_hash", h)


SQL_SNAP = """
o AS (SELECT o_orderkey AS k, o_orderstatus || '|' || o_orderpriority || '|' || CAST(o_custkey AS VARCHAR) || '|'
             || CAST(o_orderkey AS VARCHAR) AS content FROM orders),
old AS (SELECT 'o' || CAST(k AS VARCHAR) AS key, content, sha256(content) AS h FROM o),
new0 AS (SELECT CASE WHEN k % 83 = 0 THEN 'r' ELSE 'o' END || CAST(k AS VARCHAR) AS key,
                CASE WHEN k % 89 = 0 THEN content || '|changed' ELSE content END AS content FROM o WHERE k % 97 <> 0
         UNION ALL SELECT 'n' || CAST(k AS VARCHAR), 'new|' || content FROM o WHERE k % 71 = 0),
new AS (SELECT key, content, sha256(content) AS h FROM new0),
diff AS (SELECT coalesce(old.key, new.key) AS key,
                CASE WHEN old.key IS NULL THEN 'A' WHEN new.key IS NULL THEN 'D' WHEN old.h <> new.h THEN 'M' END AS status,
                old.h AS old_hash, new.h AS new_hash
         FROM old FULL OUTER JOIN new ON old.key = new.key),
d AS (SELECT * FROM diff WHERE status IS NOT NULL),
ren AS (SELECT x.key AS old_key, y.key AS new_key, x.old_hash AS content_hash
        FROM d x JOIN d y ON x.status = 'D' AND y.status = 'A' AND x.old_hash = y.new_hash),
full_status AS (SELECT key, status, CAST(NULL AS VARCHAR) AS renamed_from FROM d
                WHERE key NOT IN (SELECT old_key FROM ren) AND key NOT IN (SELECT new_key FROM ren)
                UNION ALL SELECT new_key, 'R', old_key FROM ren)
"""


def _diff(spark, sf):
    """The change set, computed once (it feeds several steps of each sync query): keys, status and
    hashes, which is what those steps read; contents stay where they are."""
    old, new = snapshots(spark, sf)
    return M.materialize(M.snapshot_diff(old, new).select("key", "status", "old_hash", "new_hash"))


@query("M1_snapshot_diff", f"WITH {SQL_SNAP} SELECT key, status, old_hash, new_hash FROM d")
def q_m1(spark, sf):
    return _diff(spark, sf).select("key", "status", "old_hash", "new_hash")


@query("M2_rename_detect", f"WITH {SQL_SNAP} SELECT old_key, new_key, content_hash FROM ren")
def q_m2(spark, sf):
    return M.rename_detect(_diff(spark, sf))


@query("M3_incremental_range", """
SELECT event_id, ts FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15 00:00:00')""")
def q_m3(spark, sf):
    e = table(spark, sf, "events")
    mark = (e.filter((F.col("event_type") == "signup") & (F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
             .agg(F.max("event_id")).scalar())
    return M.incremental_range(e.select("event_id", "ts"), "event_id", mark)


def _changes(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"),
                    (F.col("event_id") + 1).alias("seq"),
                    F.when(F.col("event_type") == "signup", "A").when(F.col("event_type") == "error", "D")
                    .otherwise("M").alias("op"),
                    F.concat_ws(":", "event_type", F.col("event_id").cast("string")).alias("content"))


@query("M4_apply_changes", """
WITH u AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS key, CAST(0 AS BIGINT) AS seq, 'A' AS op, c_name AS content FROM customer
           UNION ALL
           SELECT 'u' || CAST(user_id AS VARCHAR), event_id + 1,
                  CASE event_type WHEN 'signup' THEN 'A' WHEN 'error' THEN 'D' ELSE 'M' END,
                  event_type || ':' || CAST(event_id AS VARCHAR) FROM events),
l AS (SELECT key, arg_max(op, seq) AS op, arg_max(content, seq) AS content, max(seq) AS seq FROM u GROUP BY key)
SELECT key, content, seq FROM l WHERE op <> 'D'""")
def q_m4(spark, sf):
    c = table(spark, sf, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("key"),
                                            F.col("c_name").alias("content"))
    return M.apply_changes(c, _changes(spark, sf))


CLASSES = {"workflows": r"^\.github/", "docs": r"\.md$", "schemas": r"schema\.json$",
           "definitions": r"^definitions/v[0-9]+/[^/]+\.yml$"}


def _with_path(df):
    k = F.regexp_extract("key", r"([0-9]+)$", 1).cast("bigint")
    path = (F.when(k % 4 == 0, F.concat(F.lit("definitions/v11/"), F.col("key"), F.lit(".yml")))
            .when(k % 4 == 1, F.concat(F.lit("docs/"), F.col("key"), F.lit(".md")))
            .when(k % 4 == 2, F.concat(F.lit(".github/workflows/"), F.col("key"), F.lit(".yml")))
            .otherwise(F.concat(F.lit("definitions/v"), F.col("key"), F.lit("/schema.json"))))
    return df.withColumn("path", path)


@query("M5_conflict_policy", f"""
WITH {SQL_SNAP},
j AS (SELECT old.key, old.content AS ours, new.content AS theirs, CAST(regexp_extract(old.key, '([0-9]+)$', 1) AS BIGINT) AS k
      FROM old JOIN new ON old.key = new.key WHERE old.content <> new.content),
p AS (SELECT *, CASE k % 4 WHEN 0 THEN 'definitions' WHEN 1 THEN 'docs' WHEN 2 THEN 'workflows' ELSE 'schemas' END AS path_class FROM j)
SELECT key, path_class, CASE WHEN path_class = 'definitions' THEN 'theirs' ELSE 'ours' END AS winner,
       CASE WHEN path_class = 'definitions' THEN theirs ELSE ours END AS content
FROM p""")
def q_m5(spark, sf):
    old, new = snapshots(spark, sf)
    r = M.conflict_policy(_with_path(old), new, CLASSES)
    return r.select("key", "path_class", "winner", "content")


def _keysets(spark, sf):
    e = table(spark, sf, "events")
    key = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.col("event_type"))
    cut = F.col("ts") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    base = e.filter(cut).select(key.alias("key")).distinct()
    later = e.filter(~cut).select(key.alias("key"), "event_type")
    ours = base.unionByName(later.filter(F.col("event_type").isin("click", "view")).select("key")).distinct() \
        .withColumn("content", F.concat(F.lit("ours:"), F.col("key")))
    theirs = base.unionByName(later.filter(F.col("event_type").isin("view", "purchase")).select("key")).distinct() \
        .withColumn("content", F.concat(F.lit("theirs:"), F.col("key")))
    return base, ours, theirs


@query("M6_both_added", """
WITH e AS (SELECT 'u' || CAST(user_id AS VARCHAR) || '-' || event_type AS key, event_type, ts < TIMESTAMP '2024-01-10 00:00:00' AS early FROM events),
base AS (SELECT DISTINCT key FROM e WHERE early),
ours AS (SELECT DISTINCT key FROM e WHERE NOT early AND event_type IN ('click', 'view')),
theirs AS (SELECT DISTINCT key FROM e WHERE NOT early AND event_type IN ('view', 'purchase'))
SELECT key, 'theirs:' || key AS content FROM theirs
WHERE key IN (SELECT key FROM ours) AND key NOT IN (SELECT key FROM base)""")
def q_m6(spark, sf):
    base, ours, theirs = _keysets(spark, sf)
    return M.both_added(base, ours, theirs).select("key", "content")


@query("M7_path_class_filter", r"""
SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '\.html$|#') AND regexp_matches(url, '^https://')""")
def q_m7(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return M.path_class_filter(p, "url", drop=r"\.html$|#", keep=r"^https://")


@query("M8_blocklist", f"""
WITH n AS (SELECT c_name AS key, c_acctbal >= 0 AS existed, c_mktsegment FROM customer),
b AS (SELECT key FROM {BLOCKLIST_SQL} UNION SELECT c_name FROM customer WHERE c_mktsegment = 'HOUSEHOLD')
SELECT key, 'A' AS status FROM n WHERE NOT existed AND key NOT IN (SELECT key FROM b)""")
def q_m8(spark, sf):
    c = table(spark, sf, "customer")
    content = F.concat_ws("|", "c_name", "c_mktsegment")
    new = c.select(F.col("c_name").alias("key"), content.alias("content")).withColumn("content_hash", M.content_hash("content"))
    old = c.filter(F.col("c_acctbal") >= 0).select(F.col("c_name").alias("key"), content.alias("content")) \
        .withColumn("content_hash", M.content_hash("content"))
    diff = M.snapshot_diff(old, new)
    blocked = blocklist_df(spark).unionByName(
        c.filter(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_name").alias("key")))
    return M.blocklist(diff, blocked).select("key", "status")


@query("M9_replaces", """
WITH v AS (SELECT 'p' || CAST(p_partkey AS VARCHAR) AS key, 10 + CAST(p_size % 2 AS INTEGER) AS version FROM part
           UNION ALL SELECT 'p' || CAST(p_partkey AS VARCHAR), 12 FROM part),
r AS (SELECT 'p' || CAST(p_partkey + 1 AS VARCHAR) AS replaced FROM part WHERE p_partkey % 50 = 0
      UNION ALL SELECT 'p' || CAST(p_partkey + 2 AS VARCHAR) FROM part WHERE p_partkey % 50 = 0)
SELECT key, version FROM v WHERE key NOT IN (SELECT replaced FROM r)""")
def q_m9(spark, sf):
    p = table(spark, sf, "part")
    key = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    v = p.select(key.alias("key"), (F.lit(10) + (F.col("p_size") % 2)).cast("int").alias("version")) \
        .unionByName(p.select(key.alias("key"), F.lit(12).alias("version")))
    src = p.filter(F.col("p_partkey") % 50 == 0)
    pairs = src.select(key.alias("key"), F.concat(F.lit("p"), (F.col("p_partkey") + 1).cast("string")).alias("replaced")) \
        .unionByName(src.select(key.alias("key"), F.concat(F.lit("p"), (F.col("p_partkey") + 2).cast("string")).alias("replaced")))
    return M.replaces(v, pairs)


def _doc_versions():
    r9 = [L.dq_required("title", "title")]
    r10 = r9 + [L.dq_enum("lang", ["en", "fr", "de"], "lang")]
    r11 = r10 + [L.dq_rule("max_chars", "n_chars", F.col("n_chars") > 5000, F.col("n_chars"))]
    return {9: r9, 10: r10, 11: r11}


def _docs_v(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("key"), F.lit(11).alias("version"),
                    F.regexp_extract("text", r"^([A-Z][^.\n]*)", 1).alias("title"), "lang", "n_chars")


SQL_MOVES = r"""
moves AS (SELECT doc_id AS key, 11 AS from_version,
            CASE WHEN NOT (title = '' OR lang NOT IN ('en','fr','de') OR n_chars > 5000) THEN 11
                 WHEN NOT (title = '' OR lang NOT IN ('en','fr','de')) THEN 10
                 WHEN title <> '' THEN 9 ELSE 12 END AS to_version,
            title = '' AS flagged
          FROM (SELECT doc_id, regexp_extract(text, '^([A-Z][^.\n]*)', 1) AS title, lang, n_chars FROM documents))"""


@query("M10_relocate_version", f"WITH {SQL_MOVES} SELECT key, from_version, to_version, flagged FROM moves")
def q_m10(spark, sf):
    return M.relocate_version(_docs_v(spark, sf), "key", "version", _doc_versions(), 12)


@query("M11_bump_keeps_old", f"""
WITH {SQL_MOVES},
s AS (SELECT m.*, CASE WHEN l.doc_id IS NULL THEN 'A' ELSE 'M' END AS status FROM moves m LEFT JOIN labels l ON m.key = l.doc_id)
SELECT key, to_version AS version FROM s
UNION ALL SELECT key, from_version FROM s WHERE status = 'M' AND to_version <> from_version""")
def q_m11(spark, sf):
    moves = M.relocate_version(_docs_v(spark, sf), "key", "version", _doc_versions(), 12)
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("key")).distinct().withColumn("status", F.lit("M"))
    moves = moves.join(lab, "key", "left").withColumn("status", F.coalesce("status", F.lit("A")))
    return M.bump_keeps_old(moves)


def _versions(spark, sf):
    o = table(spark, sf, "orders")
    key = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    return o.select(key.alias("key"), F.lit(11).alias("version")).unionByName(
        o.filter(F.col("o_orderstatus") == "F").select(key.alias("key"), F.lit(10).alias("version")))


@query("M12_backport_candidates", f"""
WITH {SQL_SNAP}
SELECT d.key, 10 AS other_version FROM d JOIN orders ON d.key = 'o' || CAST(o_orderkey AS VARCHAR)
WHERE d.status = 'M' AND o_orderstatus = 'F'""")
def q_m12(spark, sf):
    changed = _diff(spark, sf).filter(F.col("status") == "M")
    return M.backport_candidates(_versions(spark, sf), changed, 11).select("key", "other_version")


@query("M13_cascade_remove", f"""
WITH {SQL_SNAP},
v AS (SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS key, 11 AS version FROM orders
      UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), 10 FROM orders WHERE o_orderstatus = 'F')
SELECT key, version FROM v WHERE key NOT IN (SELECT key FROM d WHERE status = 'D')""")
def q_m13(spark, sf):
    removed = _diff(spark, sf).filter(F.col("status") == "D")
    return M.cascade_remove(_versions(spark, sf), removed).select("key", "version")


@query("M14_change_report", f"WITH {SQL_SNAP} SELECT status, count(*) AS n FROM full_status GROUP BY status")
def q_m14(spark, sf):
    return M.change_report(M.with_renames(_diff(spark, sf)))


@query("M14_change_list", f"WITH {SQL_SNAP} SELECT status, key FROM full_status")
def q_m14_list(spark, sf):
    return M.change_list(M.with_renames(_diff(spark, sf)))


@query("M15_nothing_to_do", f"WITH {SQL_SNAP} SELECT count(*) = 0 AS nothing_to_do FROM d")
def q_m15(spark, sf):
    empty = M.nothing_to_do(M.snapshot_diff(*snapshots(spark, sf)))  # stops at the first change
    return spark.createDataFrame([(empty,)], "nothing_to_do boolean")


@query("M16_unresolved_guard", f"""
WITH {SQL_SNAP}
SELECT 'resolved' AS state, count(*) AS conflicts_resolved FROM old JOIN new ON old.key = new.key WHERE old.content <> new.content""")
def q_m16(spark, sf):
    old, new = snapshots(spark, sf)
    res = M.conflict_policy(_with_path(old), new, CLASSES)
    M.unresolved_guard(res.filter(F.col("winner").isNull()))
    return res.agg(F.lit("resolved").alias("state"), F.count(F.lit(1)).alias("conflicts_resolved"))


# ----------------------------------------------------------------------------- G2-G5, U3-U4


@query("G2_distinct_sorted", "SELECT DISTINCT user_id FROM events ORDER BY user_id")
def q_g2(spark, sf):
    return M.distinct_sorted(table(spark, sf, "events"), "user_id")


@query("G3_unique_items", """
SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1""")
def q_g3(spark, sf):
    return M.unique_items(table(spark, sf, "events"), ["user_id"], "event_type")


@query("G4_count_range", """
SELECT count(*) AS n FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15 00:00:00')""")
def q_g4(spark, sf):
    e = table(spark, sf, "events")
    mark = (e.filter((F.col("event_type") == "signup") & (F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
             .agg(F.max("event_id")).scalar())
    return M.count_range(e, "event_id", mark)


@query("G5_collect_summary", f"""
WITH {SQL_SNAP} SELECT status, count(*) AS n, min(key) AS first_key, max(key) AS last_key FROM full_status GROUP BY status""")
def q_g5(spark, sf):
    return M.collect_summary(M.with_renames(_diff(spark, sf)))


@query("U3_keys_intersect", """
SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'view'""")
def q_u3(spark, sf):
    e = table(spark, sf, "events")
    return M.keys_intersect(e.filter(F.col("event_type") == "click").select("user_id"),
                            e.filter(F.col("event_type") == "view").select("user_id"))


@query("U4_keys_except", """
SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'error'""")
def q_u4(spark, sf):
    e = table(spark, sf, "events")
    return M.keys_except(e.filter(F.col("event_type") == "click").select("user_id"),
                         e.filter(F.col("event_type") == "error").select("user_id"))


@query("M2_rename_pairs_with_copies", """
WITH o AS (SELECT o_orderkey AS k, o_orderstatus || '|' || o_orderpriority AS content FROM orders),
d AS (SELECT sha256(content) AS h, count(*) AS nd FROM o WHERE k % 3 = 0 GROUP BY 1),
a AS (SELECT sha256(content) AS h, count(*) AS na FROM o WHERE k % 3 = 1 GROUP BY 1)
SELECT d.h AS content_hash, least(nd, na) AS pairs, least(nd, na) AS old_keys, least(nd, na) AS new_keys
FROM d JOIN a ON d.h = a.h""")
def q_m2_copies(spark, sf):
    """Rename pairing when one content has thousands of copies on both sides (content is
    only status and priority): every removed key pairs with at most one added key, so a
    hash yields min(removed, added) pairs, never all pairs."""
    o = table(spark, sf, "orders")
    content = F.concat_ws("|", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    rows = o.select(F.concat(F.lit("o"), k.cast("string")).alias("key"), M.content_hash(content).alias("h"),
                    (k % 3).alias("side")).filter(F.col("side") < 2)
    diff = rows.select("key", F.when(F.col("side") == 0, "D").otherwise("A").alias("status"),
                       F.when(F.col("side") == 0, F.col("h")).alias("old_hash"),
                       F.when(F.col("side") == 1, F.col("h")).alias("new_hash"))
    r = M.rename_detect(diff)
    return r.groupBy("content_hash").agg(F.count(F.lit(1)).alias("pairs"),
                                         F.countDistinct("old_key").alias("old_keys"),
                                         F.countDistinct("new_key").alias("new_keys"))


@query("M_sync_run", f"""
WITH {SQL_SNAP},
blocked AS (SELECT 'n' || CAST(k AS VARCHAR) AS key FROM o WHERE k % 142 = 0),
replaced AS (SELECT 'o' || CAST(k + 1 AS VARCHAR) AS key FROM o WHERE k % 71 = 0 AND k % 142 <> 0),
kept AS (SELECT new.key, new.content FROM new
         WHERE new.key NOT IN (SELECT key FROM d WHERE status = 'A' AND key IN (SELECT key FROM blocked))
           AND new.key NOT IN (SELECT key FROM replaced)),
placed AS (SELECT key, content, CASE WHEN contains(content, 'changed') THEN 10 ELSE 11 END AS version FROM kept)
SELECT key, CAST(version AS INTEGER) AS version, content FROM placed
UNION ALL
SELECT old.key, 11, old.content FROM old JOIN placed ON old.key = placed.key
WHERE placed.version <> 11 AND old.key IN (SELECT key FROM d WHERE status = 'M')""")
def q_m_sync_run(spark, sf):
    """The whole sync run on the order snapshots. Block list: added keys 'n' with k % 142 = 0.
    Replaces: every other added item replaces the next order key. Rules: v10 needs content,
    v11 also refuses changed content. Returns the written catalogue, read back."""
    import uuid

    from ..session import scratch_path
    old, new = snapshots(spark, sf)
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    blocked = o.filter(F.col("k") % 142 == 0).select(F.concat(F.lit("n"), F.col("k").cast("string")).alias("key"))
    src = o.filter((F.col("k") % 71 == 0) & (F.col("k") % 142 != 0))
    pairs = src.select(F.concat(F.lit("n"), F.col("k").cast("string")).alias("key"),
                       F.concat(F.lit("o"), (F.col("k") + 1).cast("string")).alias("replaced"))
    rules = {10: [L.dq_required("content", "content")],
             11: [L.dq_required("content", "content"),
                  L.dq_value_pattern("content", "changed", negate=True, path="content")]}
    out = scratch_path(spark, f"sync_run/{uuid.uuid4().hex}")
    report = M.run_sync(old, new, out, rules, 12, blocked=blocked, pairs=pairs)
    assert report is not None
    return spark.read.parquet(out).select("key", F.col("version").cast("int").alias("version"), "content")


@query("M_sync_run_versions", """
WITH o AS (SELECT o_orderkey AS k, 'o' || CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus || '|' || CAST(o_custkey AS VARCHAR) AS c,
                  o_orderstatus = 'F' AS f FROM orders),
old AS (SELECT 11 AS version, key, c AS content FROM o UNION ALL SELECT 10, key, c || '|ten' FROM o WHERE f),
new AS (SELECT 11 AS version, key, CASE WHEN k % 89 = 0 THEN c || '|changed' WHEN k % 53 = 0 THEN c || '|more' ELSE c END AS content
        FROM o WHERE k % 97 <> 0 UNION ALL SELECT 10, key, c || '|ten' FROM o WHERE f AND k % 101 <> 0),
d AS (SELECT coalesce(a.version, b.version) AS version, coalesce(a.key, b.key) AS key, b.content AS content,
             CASE WHEN b.key IS NULL THEN 'D' WHEN a.key IS NULL THEN 'A' WHEN a.content <> b.content THEN 'M' END AS status
      FROM old a FULL OUTER JOIN new b ON a.version = b.version AND a.key = b.key),
placed AS (SELECT CASE WHEN version = 11 AND contains(content, 'changed') THEN 10 ELSE version END AS to_version, * FROM d WHERE status IN ('A', 'M')),
gone AS (SELECT key FROM d WHERE status = 'D' AND key NOT IN (SELECT key FROM placed)),
stays AS (SELECT version, key, content FROM d WHERE status IS NULL AND key NOT IN (SELECT key FROM gone)
          UNION ALL SELECT old.version, old.key, old.content FROM old JOIN placed p ON p.version = old.version AND p.key = old.key
          WHERE p.status = 'M' AND p.to_version <> p.version)
SELECT CAST(version AS INTEGER) AS version, key, content FROM stays s
WHERE NOT EXISTS (SELECT 1 FROM placed p WHERE p.to_version = s.version AND p.key = s.key)
UNION ALL SELECT CAST(to_version AS INTEGER), key, content FROM placed""")
def q_m_sync_versions(spark, sf):
    """run_sync where a third of the keys stand in two versions: one changed version leaves the
    other alone, a moved one takes the other's place, one removed from a version only leaves both."""
    import uuid

    from ..session import scratch_path
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.alias("k"), F.concat(F.lit("o"), k.cast("string")).alias("key"),
                                          F.concat_ws("|", "o_orderstatus", F.col("o_custkey").cast("string")).alias("c"),
                                          (F.col("o_orderstatus") == "F").alias("f"))
    ten = o.where("f").select("k", F.lit(10).alias("version"), "key", F.concat("c", F.lit("|ten")).alias("content"))
    old = o.select("k", F.lit(11).alias("version"), "key", F.col("c").alias("content")).unionByName(ten)
    eleven = o.where("k % 97 <> 0").select("k", F.lit(11).alias("version"), "key", F.concat("c", F.when(F.col("k") % 89 == 0, "|changed").when(
        F.col("k") % 53 == 0, "|more").otherwise("")).alias("content"))
    new = eleven.unionByName(ten.where("k % 101 <> 0"))
    out = scratch_path(spark, f"sync_run/{uuid.uuid4().hex}")
    M.run_sync(*(x.drop("k").withColumn("content_hash", M.content_hash("content")) for x in (old, new)), out, _content_rules("changed"), 12)
    return spark.read.parquet(out).select(F.col("version").cast("int").alias("version"), "key", "content")


def _content_rules(word):
    required = L.dq_required("content", "content")
    return {10: [required], 11: [required, L.dq_value_pattern("content", word, negate=True, path="content")]}


def _batch_sql(i: int) -> str:
    """One batch of the replay: the catalogue c{i} from c{i - 1} and the log rows of its range."""
    return f"""
last{i} AS (SELECT version, key, arg_max(op, seq) AS op, arg_max(content, seq) AS content FROM log
            WHERE seq > top * {i - 1} // 3 AND seq <= top * {i} // 3 GROUP BY version, key),
ch{i} AS (SELECT l.version, l.key, l.content, CASE WHEN op = 'D' THEN 'D' WHEN c.key IS NULL THEN 'A' ELSE 'M' END AS status
          FROM last{i} l LEFT JOIN c{i - 1} c ON c.version = l.version AND c.key = l.key
          WHERE CASE WHEN op = 'D' THEN c.key IS NOT NULL ELSE c.key IS NULL OR c.content <> l.content END),
ok{i} AS (SELECT * FROM ch{i} WHERE NOT (status = 'A' AND key IN (SELECT key FROM blocked))),
out{i} AS (SELECT DISTINCT replaced AS key FROM pairs WHERE key IN (SELECT key FROM ok{i} WHERE status = 'A')),
gone{i} AS (SELECT key FROM ok{i} WHERE status = 'D' AND key NOT IN (SELECT key FROM ok{i} WHERE status <> 'D') UNION SELECT key FROM out{i}),
to{i} AS (SELECT CASE WHEN version = 11 AND contains(content, 'odd') THEN 10 ELSE version END AS to_version, * FROM ok{i}
          WHERE status <> 'D' AND key NOT IN (SELECT key FROM out{i})),
up{i} AS (SELECT to_version AS version, key, arg_max(content, CASE WHEN version = to_version THEN 100 ELSE version END) AS content
          FROM to{i} GROUP BY to_version, key),
c{i} AS MATERIALIZED (SELECT version, key, content FROM c{i - 1} c WHERE key NOT IN (SELECT key FROM gone{i})
          AND NOT EXISTS (SELECT 1 FROM ok{i} o WHERE o.status = 'D' AND o.version = c.version AND o.key = c.key)
          AND NOT EXISTS (SELECT 1 FROM up{i} u WHERE u.version = c.version AND u.key = c.key)
          UNION ALL SELECT version, key, content FROM up{i})"""


@query("M_sync_catalogue", f"""
WITH m AS (SELECT max(event_id) + 1 AS top FROM events),
log AS (SELECT event_id + 1 AS seq, 10 + event_id % 2 AS version, 'u' || CAST(user_id AS VARCHAR) AS key,
               CASE event_type WHEN 'signup' THEN 'A' WHEN 'error' THEN 'D' ELSE 'M' END AS op,
               event_type || ':' || CAST(event_id AS VARCHAR) || CASE WHEN event_id % 11 = 0 THEN '|odd' ELSE '' END AS content, top
        FROM events, m WHERE NOT (event_type = 'view' AND event_id % 5 = 0)),
blocked AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE c_custkey % 50 = 7),
pairs AS (SELECT 'u' || CAST(c_custkey AS VARCHAR) AS key, 'u' || CAST(c_custkey + 1 AS VARCHAR) AS replaced FROM customer WHERE c_custkey % 40 = 0),
c0 AS (SELECT 11 AS version, 'u' || CAST(c_custkey AS VARCHAR) AS key, c_name AS content FROM customer WHERE c_custkey % 3 <> 0
       UNION ALL SELECT 10, 'u' || CAST(c_custkey AS VARCHAR), c_name FROM customer WHERE c_mktsegment = 'BUILDING'),
{",".join(_batch_sql(i) for i in (1, 2, 3))}
SELECT CAST(version AS INTEGER) AS version, key, content FROM c3""")
def q_m_sync_catalogue(spark, sf):
    """The whole flow: a catalogue of customers in two versions, the events as an ordered log of
    changes to it, applied in three batches (each its own commit), the last one twice.
    Returns the current snapshot; the repeated batch must be a no-op."""
    import uuid

    from ..session import scratch_path
    c = table(spark, sf, "customer")
    key = lambda k: F.concat(F.lit("u"), k.cast("string"))
    start = c.where("c_custkey % 3 <> 0").select(F.lit(11).alias("version"), key(F.col("c_custkey")).alias("key"), F.col("c_name").alias("content")) \
        .unionByName(c.where("c_mktsegment = 'BUILDING'").select(F.lit(10).alias("version"), key(F.col("c_custkey")).alias("key"),
                                                                 F.col("c_name").alias("content")))
    blocked = c.where("c_custkey % 50 = 7").select(key(F.col("c_custkey")).alias("key"))
    pairs = c.where("c_custkey % 40 = 0").select(key(F.col("c_custkey")).alias("key"), key(F.col("c_custkey") + 1).alias("replaced"))
    e, n = table(spark, sf, "events"), F.col("event_id")
    path = F.when((F.col("event_type") == "view") & (n % 5 == 0), F.concat(F.lit("docs/"), key(F.col("user_id")), F.lit(".md"))) \
        .otherwise(F.concat(F.lit("definitions/v"), (n % 2 + 10).cast("string"), F.lit("/"), key(F.col("user_id")), F.lit(".yml")))
    log = e.select((n + 1).alias("seq"), path.alias("path"),
                   F.when(F.col("event_type") == "signup", "A").when(F.col("event_type") == "error", "D").otherwise("M").alias("op"),
                   F.concat("event_type", F.lit(":"), n.cast("string"), F.when(n % 11 == 0, "|odd").otherwise("")).alias("content"),
                   F.lit(None).cast("string").alias("old_path"))
    top = log.agg(F.max("seq")).first()[0] or 0
    root = scratch_path(spark, f"catalogue/{uuid.uuid4().hex}")
    store.commit(spark, root, start, buckets=4)
    for i in (1, 2, 3, 3):
        last, before = sync_flow.replay(spark, root, log.where(F.col("seq") <= top * i // 3), "events", _content_rules("odd"), 12, blocked, pairs), \
            store.read_manifest(spark, root).number
    if last is not None or before > 4:
        raise RuntimeError("a repeated batch was applied again")
    return store.read_catalogue(spark, root).select("version", "key", "content")
