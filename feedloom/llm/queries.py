"""Registered queries of the operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bit_sliced, bpe, html_extract, line_dedup, mixing, near_dedup, order_minhash, packing, prefix_trie, quality,
               url_filter, warc, whitening)
from .common import table

#: (host, path, verdict); fixed by the query's contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
MIN_SITES = 10


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rules_frame(spark, URL_RULES)
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict")


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_neighbours(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents")).select("doc_id", "quality_score", "rejected")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_history(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), min_sites=MIN_SITES)
    return out.select("doc_id", "n_lines", "removed_lines", "only_boilerplate", F.sha2("text", 256).alias("text_sha256"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.decide(sized, mixing.mix(docs)).select(
        "doc_id", "size", "source_size", "target", (F.col("n") * F.col("size")).alias("taken"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuild(prefix_trie.records(table(spark, sf_dir, "conversations"))))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, pattern, keep=["doc_id"])
    digests = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                             F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), "ids")
    return bpe.decode(digests, path, pattern, keep=["doc_id", "n_tokens", "ids_sha256"]).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_order_minhash, op3_near_dedup, op4_quality, op5_warc, op6_line_dedup,
                            op7_html_text, op8_bit_sliced_topk, op9_packing, op10_mixing, op11_prefix_trie, op12_whitening,
                            op13_byte_bpe)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

SQL: dict[str, str] = {
    "op1_url_filter": f"""
WITH rules(rh, rp, rv) AS (VALUES {_VALUES}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
keys AS (SELECT DISTINCT host, path FROM parts),
best AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
         FROM keys, rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(rv, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path""",
    "op3_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
rare AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN rare USING (s) JOIN sh b USING (s)
           WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.r),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT comp.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, comp.doc_id = component_id AS kept
FROM comp LEFT JOIN n ON n.doc_id = comp.doc_id""",
    "op6_line_dedup": f"""
WITH l AS (SELECT doc_id, coalesce(source, chr(0)) AS site, unnest(string_split(text, chr(10))) AS line FROM documents),
bad AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
d AS (SELECT doc_id, text, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines,
             list_filter(string_split(text, chr(10)), lambda x: list_contains(b, x)) AS gone
      FROM documents, (SELECT coalesce(list(line), []) AS b FROM bad)),
w AS (SELECT *, len(gone) > 0 AND len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x09-\\x0D\\x20]')
             AND NOT list_contains(gone, x))) = 0 AS whole FROM d)
SELECT doc_id, n_lines, CASE WHEN NOT whole THEN len(gone) ELSE 0 END AS removed_lines, coalesce(whole, FALSE) AS only_boilerplate,
       sha256(CASE WHEN len(gone) > 0 AND NOT whole THEN array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(gone, x)), chr(10))
                   ELSE text END) AS text_sha256 FROM w""",
    "op8_bit_sliced_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    # the CRC-32 is folded over the digits of the id, eight shifts each
    "op11_prefix_trie": """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
                  {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY k) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, turns, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
            lambda c: CAST(ascii(c) AS BIGINT))),
          lambda acc, byte: list_reduce([xor(acc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                        lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 6 AS h FROM own),
built AS (SELECT c.conv_id, list_concat(coalesce(own.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
          FROM crc c LEFT JOIN own ON own.conv_id = c.conv_id - c.conv_id % 100),
steps AS (SELECT conv_id, len(turns) AS size, unnest(range(0, len(turns) + 1)) AS depth, turns FROM built),
prefixes AS (SELECT conv_id, size, depth, turns[1:depth] AS p FROM steps),
nodes AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) = depth AS leaf,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256,
                 (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(p[-1].text) END AS saved FROM prefixes GROUP BY p, depth),
below AS (SELECT a.p, a.depth, sum(CAST(b.leaf AS BIGINT)) AS n_leaves, sum(b.saved) AS saved_tokens,
                 sum(CAST(b.depth = a.depth + 1 AS BIGINT)) AS n_children
          FROM (SELECT p AS q, depth AS d, leaf, saved, unnest(range(0, depth + 1)) AS up FROM nodes) e
          JOIN nodes a ON a.depth = e.up AND a.p = e.q[1:e.up], LATERAL (SELECT e.leaf AS leaf, e.saved AS saved, e.d AS depth) b
          GROUP BY a.p, a.depth)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(b.n_children AS BIGINT) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.p = n.p AND b.depth = n.depth LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.p = n.p[1:n.depth - 1]""",
}
