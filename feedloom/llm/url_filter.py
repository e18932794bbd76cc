"""URL filters: pattern rules indexed by their rarest literal token (Spark functions only).

A rule is (host, path, verdict). It fits its host and every subdomain when the URL's path
starts with the rule's path; ``*`` in a rule's path stands for any characters. An empty rule
host fits every host. Each rule is filed under the one of its literal tokens (host labels,
complete path segments) that the fewest URLs hold. URL tokens fetch candidate rules from
that index, and only the candidates run their regular expression.

Defined results: a null URL, or one without ``://``, has an empty host and path and takes no
rule unless a rule fits everything; an empty table gives an empty result; repeated rows each
keep a row; of fitting rules the longest wins, then the longer host, then the smaller string.
Ports and user names stay part of the host.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

#: Rule index and rule tokens are broadcast up to this many rows; beyond it they are joined.
BROADCAST_RULES = 100_000


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1),
                       string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def _tokens(host: Column, path: Column) -> Column:
    """Host labels and the path segments that a slash ends."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    closed = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    segments = F.transform(closed, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, segments), lambda x: F.length(x) > 2))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules written in code as a frame of (host, path, verdict)."""
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("host", "path", "verdict")))
    rows = F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
                     for h, p, v in rules))
    return spark.range(1).select(F.inline(rows))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, pattern, rule, rule_host, rule_verdict): each rule under its rarest token, by
    the number of rows of ``urls`` (host, path) that hold the token. A rule without a literal
    token is filed under the empty token, which every URL fetches."""
    quoted = lambda c: F.regexp_replace(c, r"([^A-Za-z0-9/])", r"\\$1")
    host = F.when(F.col("host") == "", F.lit("[^/]*")).otherwise(
        F.concat(F.lit(r"(?:[^/]*\.)?"), quoted(F.col("host"))))
    path = F.replace(quoted(F.col("path")), F.lit(r"\*"), F.lit(".*"))
    r = rules.select(F.concat("host", "path").alias("rule"), F.col("host").alias("rule_host"),
                     F.concat(F.lit("(?s)^"), host, path).alias("pattern"),
                     F.col("verdict").alias("rule_verdict"),
                     F.filter(_tokens(F.col("host"), F.col("path")),
                              lambda x: ~F.contains(x, F.lit("*"))).alias("tokens")).distinct()
    wanted = r.select(F.explode("tokens").alias("token")).distinct()
    held = (urls.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
                .join(small(wanted, BROADCAST_RULES), "token", "left_semi")
                .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    return (r.withColumn("token", F.explode_outer("tokens"))
             .join(small(held, BROADCAST_RULES), "token", "left")
             .groupBy("rule", "rule_host", "pattern", "rule_verdict")
             .agg(F.coalesce(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")), F.lit("")).alias("token")))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with columns host, path, rule (null: none fits) and verdict (else ``default``).

    Existing columns of those names are replaced. Verdicts are found once per distinct
    (host, path), pre-aggregated before the shuffle, and joined back; a hot URL's rows are
    split by the skew join."""
    new = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c.lower() not in new or c == url]
    # the row is one struct, so no column of it can clash with those of the work
    keyed = df.select(F.struct(*kept).alias("row"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    urls = keyed.select("host", "path")
    index = small(rule_index(urls, rules), BROADCAST_RULES)
    found = (urls.withColumn("token", F.explode(F.concat(_tokens(F.col("host"), F.col("path")), F.array(F.lit("")))))
                 .join(index, "token")
                 .where(F.expr("concat(host, path) rlike pattern"))
                 .groupBy("host", "path")
                 .agg(F.max_by(F.struct("rule", "rule_verdict"),
                               F.struct(F.length("rule"), F.length("rule_host"), "rule", "rule_verdict")).alias("best")))
    return keyed.join(found, ["host", "path"], "left").select(
        *[F.col("row").getField(c).alias(c) for c in kept], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))
