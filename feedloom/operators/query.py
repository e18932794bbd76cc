"""Query predicates, ordering and result shaping.

Search parameters are Python values, so predicates become literal Columns that Catalyst
can push into the scan. Per-group operators (first/top-k/dedupe) are written as
aggregations with partial (map-side) aggregation or as salted two-phase windows, so a
group holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.chain import apply_chain, f_diacritics
from ..functions.text import col_of, s

# ----------------------------------------------------------------------------- Q1-Q7


def keyword_tokens(q: str | None) -> list[str]:
    return [t for t in re.split(r"\s+", (q or "").strip().lower()) if t]


def search_q(df: DataFrame, q: str | None, title: str = "title") -> DataFrame:
    """Q1: every keyword token is contained in the lower-cased title; no keywords -> all."""
    cond = F.lit(True)
    low = F.lower(col_of(title))
    for t in keyword_tokens(q):
        cond = cond & low.contains(t)
    return df.filter(cond)


SEASON_EP = r"(?i)\bS(\d{1,4})(?:E(\d{1,4}))?\b"


def season_of(title) -> Column:
    return F.regexp_extract(col_of(title), SEASON_EP, 1).try_cast("int")


def episode_of(title) -> Column:
    return F.regexp_extract(col_of(title), SEASON_EP, 2).try_cast("int")


def search_episode(df: DataFrame, season: int | None, ep: int | None, title: str = "title",
                   season_col: str | None = None, ep_col: str | None = None) -> DataFrame:
    """Q2: season / episode predicate, read from columns or parsed out of the title."""
    sc = col_of(season_col) if season_col else season_of(title)
    ec = col_of(ep_col) if ep_col else episode_of(title)
    cond = F.lit(True)
    if season is not None:
        cond = cond & (sc == F.lit(season))
    if ep is not None:
        cond = cond & (ec == F.lit(ep))
    return df.filter(cond)


def search_by_id(df: DataFrame, params: Mapping, title: str = "title") -> DataFrame:
    """Q3: imdb id wins, then douban, then tmdb/tvdb, else keywords."""
    for k in ("imdbid", "doubanid", "tmdbid", "tvdbid"):
        if params.get(k) is not None:
            return df.filter(col_of(k) == F.lit(params[k]))
    return search_q(df, params.get("q"), title)


def search_music(df: DataFrame, params: Mapping, title: str = "title") -> DataFrame:
    """Q4: artist / album conjunctive filters; neither given -> keywords."""
    given = [(k, params[k]) for k in ("artist", "album") if params.get(k)]
    if not given:
        return search_q(df, params.get("q"), title)
    cond = F.lit(True)
    for k, v in given:
        cond = cond & (F.lower(col_of(k)) == F.lit(str(v).lower()))
    return df.filter(cond)


def search_book(df: DataFrame, params: Mapping, title: str = "title") -> DataFrame:
    """Q5: title / author filters; neither given -> keywords."""
    cond, any_ = F.lit(True), False
    if params.get("title"):
        cond, any_ = cond & F.lower(col_of(title)).contains(str(params["title"]).lower()), True
    if params.get("author"):
        cond, any_ = cond & (F.lower(col_of("author")) == F.lit(str(params["author"]).lower())), True
    return df.filter(cond) if any_ else search_q(df, params.get("q"), title)


def search_genre_year(df: DataFrame, genre: str | None, year: int | None,
                      genre_col: str = "genre", year_col: str = "year") -> DataFrame:
    """Q6: genre (array contains, case-insensitive) and year."""
    cond = F.lit(True)
    if genre:
        cond = cond & F.exists(col_of(genre_col), lambda g: F.lower(g) == F.lit(genre.lower()))
    if year is not None:
        cond = cond & (col_of(year_col) == F.lit(year))
    return df.filter(cond)


def latest_when_empty(df: DataFrame, q: str | None, date: str, key: str, n: int,
                      title: str = "title") -> DataFrame:
    """Q7: no keywords -> the latest ``n`` records (not an error); else the keyword search."""
    if keyword_tokens(q):
        return search_q(df, q, title)
    return df.orderBy(F.col(date).desc(), F.col(key).asc()).limit(n)


def empty_inputs(m, allow: bool = False) -> Column:
    """Q8: drop empty parameters from a map unless empty inputs are allowed."""
    return col_of(m) if allow else F.map_filter(col_of(m), lambda k, v: s(v) != F.lit(""))


def keyword_rewrite(queries: DataFrame, col: str, steps, out: str = "keywords") -> DataFrame:
    """Q9: rewrite the query text by a filter chain before matching."""
    return queries.withColumn(out, apply_chain(col_of(col), steps))


# ----------------------------------------------------------------------------- Q10-Q18


def filter_category(df: DataFrame, codes: Iterable[int], cat_col: str = "categories") -> DataFrame:
    """Q10: keep records in any requested category; a parent code includes its children
    (code // 1000 equal and requested code a thousand)."""
    codes = list(codes)
    parents = [c for c in codes if c % 1000 == 0 and c < 100000]
    exact = F.array(*[F.lit(c).cast("bigint") for c in codes])
    cond = F.arrays_overlap(col_of(cat_col), exact)
    if parents:
        par = F.array(*[F.lit(p).cast("bigint") for p in parents])
        cond = cond | F.exists(col_of(cat_col), lambda c: F.array_contains(
            par, F.when(c < 100000, (F.floor(c / 1000) * 1000).cast("bigint"))))
    return df.filter(F.coalesce(cond, F.lit(False)))


def filter_freeleech(df: DataFrame, enabled: bool, dvf: str = "downloadvolumefactor") -> DataFrame:
    """Q11: setting-driven: only free (factor 0) records when the flag is set."""
    return df.filter(col_of(dvf) == F.lit(0.0)) if enabled else df


def filter_contains(df: DataFrame, col: str, x: str) -> DataFrame:
    """Q12: case-sensitive substring filter."""
    return df.filter(col_of(col).contains(x))


def filter_row_shape(df: DataFrame, col: str, has: Sequence[str] = (), has_not: Sequence[str] = (),
                     prefix: str | None = None, suffix: str | None = None) -> DataFrame:
    """Q13: the row must have (``has``, regex) / not have (``has_not``) an element, and may
    need a prefix / suffix."""
    c = col_of(col)
    cond = F.lit(True)
    for p in has:
        cond = cond & c.rlike(p)
    for p in has_not:
        cond = cond & ~c.rlike(p)
    if prefix is not None:
        cond = cond & c.startswith(prefix)
    if suffix is not None:
        cond = cond & c.endswith(suffix)
    return df.filter(cond)


def fold(c) -> Column:
    """Case- and accent-insensitive form used by ``andmatch``."""
    return F.lower(f_diacritics(col_of(c)))


def andmatch(df: DataFrame, title: str, kw: str | None) -> DataFrame:
    """Q14: keep rows whose title holds every keyword token (tokens split on non-word
    characters), ignoring case and accents."""
    toks = [t for t in re.split(r"\W+", kw or "") if t]
    cond = F.lit(True)
    ft = fold(title)
    for t in toks:
        cond = cond & ft.contains(fold(F.lit(t)))
    return df.filter(cond)


def andmatch_prefix(df: DataFrame, title: str, kw: str | None, n: int) -> DataFrame:
    """Q15: as Q14 using only the first ``n`` characters of the keywords."""
    return andmatch(df, title, (kw or "")[:n])


def capability_filter(caps: DataFrame, mode: str, params: Sequence[str]) -> DataFrame:
    """Q16: sources whose ``mode`` accepts every requested parameter."""
    need = F.array(*[F.lit(p) for p in params]) if params else F.array().cast("array<string>")
    return (caps.filter(F.col("mode") == mode)
                .filter(F.size(F.array_except(need, F.col("params"))) == 0)
                .select("source").distinct())


def required_params(caps: DataFrame, mode: str, params: Mapping[str, object],
                    sources: DataFrame) -> DataFrame:
    """Q17: per source: which requested parameters it supports (used) and which it ignores;
    a source without the mode is skipped (``skip`` true). Other columns of ``sources`` stay."""
    req = [k for k, v in params.items() if v not in (None, "")]
    need = F.array(*[F.lit(p) for p in req]) if req else F.array().cast("array<string>")
    m = caps.filter(F.col("mode") == mode).select("source", "params")
    j = sources.join(F.broadcast(m), "source", "left")
    return j.select(
        "source",
        F.col("params").isNull().alias("skip"),
        F.array_join(F.array_sort(F.array_intersect(need, F.coalesce("params", F.array().cast("array<string>")))), ",").alias("used"),
        F.array_join(F.array_sort(F.array_except(need, F.coalesce("params", F.array().cast("array<string>")))), ",").alias("ignored"),
        *[sources[c] for c in sources.columns if c not in ("source", "skip", "used", "ignored")])


def tag_errors(df: DataFrame, preds: Sequence[tuple[str, Column]], message: Column | None = None) -> DataFrame:
    """Q18 in one pass: every payload with ``error_rule``, the first matching rule, or null, and
    ``error_message`` if asked for."""
    rule = F.coalesce(*[F.when(p, F.lit(name)) for name, p in preds]) if preds else F.lit(None).cast("string")
    tagged = df.withColumn("error_rule", rule)
    return tagged if message is None else tagged.withColumn("error_message", message)


def error_rows(df: DataFrame, preds: Sequence[tuple[str, Column]],
               message: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Q18: split payloads into good rows and error pages (first matching rule named). A job
    that needs both halves at once reads ``tag_errors``, which scans once."""
    tagged = tag_errors(df, preds, message)
    good = tagged.filter(F.col("error_rule").isNull()).drop("error_rule", "error_message")
    bad = tagged.filter(F.col("error_rule").isNotNull())
    return good, bad


# ----------------------------------------------------------------------------- O, U, W


def sort_requested(df: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """O1: order by requested keys (asc/desc, nulls last); callers add a unique key last
    so ties are deterministic."""
    cols = [F.col(k).desc_nulls_last() if d.lower() == "desc" else F.col(k).asc_nulls_last()
            for k, d in keys]
    return df.orderBy(*cols)


def limit_top(df: DataFrame, n: int) -> DataFrame:
    """O2: first ``n`` of the order (planned as TakeOrderedAndProject: each task keeps its
    own top ``n``, only those reach the final merge)."""
    return df.limit(n)


def page_offset(df: DataFrame, page: int, size: int) -> DataFrame:
    """O3: page ``page`` (0-based) of size ``size`` on a total order."""
    return df.offset(page * size).limit(size) if page else df.limit(size)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                  salt_cols: Sequence[str] | None = None, salt_buckets: int = 32,
                  rank: str = "rank", two_phase: bool | None = None) -> DataFrame:
    """The first ``k`` rows of every group by ``order``.

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit`` before the shuffle,
    so every map task forwards at most ``k`` rows per group and a group holding a third of
    all rows is cut down map-side. Above the planner's threshold
    (``spark.sql.optimizer.windowGroupLimitThreshold``), the same thing is done by hand in
    two phases: salted sub-groups (hash of ``salt_cols``) keep their own top ``k``, then the
    final ranking per group sees at most ``k * salt_buckets`` candidates.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    w = Window.partitionBy(*by).orderBy(*order)
    if not two_phase and (two_phase is not None or k <= limit):
        return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
    salt_cols = list(salt_cols or df.columns)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*by, "_salt").orderBy(*order)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    return (cand.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
                .drop("_salt", "_r1"))


def first_per_group(df: DataFrame, by: Sequence[str], order: str, asc: bool = True) -> DataFrame:
    """The first row of each group by ``order`` (ties: the full row decides).
    ``min_by``/``max_by`` over a struct aggregate partially on the map side."""
    others = [c for c in df.columns if c not in by]
    packed = F.struct(*[F.col(c) for c in others])
    by_row = F.struct(F.col(order), packed)
    pick = F.min_by(packed, by_row) if asc else F.max_by(packed, by_row)
    return df.groupBy(*by).agg(pick.alias("_r")).select(*by, "_r.*")


def nth_position(cells, n: int) -> Column:
    """Nth (1-based) / nth-last (negative) cell; out of range -> null."""
    return F.try_element_at(col_of(cells), F.lit(n))


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Every source in one relation (missing columns null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def dedupe_records(df: DataFrame, keys: Sequence[str], prefer: str | None = None) -> DataFrame:
    """One row per key: the largest row, or with ``prefer`` the one with the largest
    ``prefer`` value, ties by the row
    (``max_by`` over the row: a hash aggregate with map-side combine, skew-safe)."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    row = F.struct(*[F.col(c) for c in others])
    return (df.groupBy(*keys)
              .agg(F.max_by(row, F.struct(F.col(prefer), row) if prefer else row).alias("_r"))
              .select(*keys, "_r.*"))


def cap_guard(df: DataFrame, n: int, what: str = "changes") -> int:
    """Refuse a batch larger than ``n`` before anything is written.
    Counts at most ``n + 1`` rows, so the check itself stays cheap."""
    c = df.limit(n + 1).count()
    if c > n:
        raise RuntimeError(f"{what}: more than {n} in this batch; refusing")
    return c

