"""Category mapping and source dimensions.

Mapping tables come from definitions (tens of thousands of rows in total, bounded by the
number of definitions, not by captured data), so joins against them broadcast. Where a
dimension is derived from data instead, pass ``bounded=False``: no hint is given and
AQE decides at run time from the measured size of the built side
(``spark.sql.adaptive.autoBroadcastJoinThreshold``), falling back to a shuffle join.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of


def dim(df: DataFrame, bounded: bool = True) -> DataFrame:
    """Broadcast a dimension only when its size is bounded by construction."""
    return F.broadcast(df) if bounded else df


def map_category(df: DataFrame, cmap: DataFrame, on: Sequence[str] = ("source", "site_id"),
                 how: str = "left", bounded: bool = True) -> DataFrame:
    """Site id -> canonical category code (equi join on ``(source, site_id)``).
    With duplicate ids in the map this multiplies rows; use C2 for those maps."""
    return df.join(dim(cmap, bounded), list(on), how)


def map_category_multi(df: DataFrame, cmap: DataFrame, on: Sequence[str] = ("source", "site_id"),
                       code: str = "cat_code", bounded: bool = True) -> DataFrame:
    """One id, several categories -> one sorted array per record.

    The map is pre-aggregated to one row per key first, so the join is 1:1 and can
    never multiply records."""
    agg = cmap.groupBy(*on).agg(F.array_sort(F.collect_set(code)).alias("categories"))
    return df.join(dim(agg, bounded), list(on), "left")


def desc_key(c) -> Column:
    return F.lower(F.trim(col_of(c)))


def map_by_description(df: DataFrame, desc_col: str, cmap: DataFrame, map_desc: str = "descr",
                       bounded: bool = True) -> DataFrame:
    """Match by description (case/blank-insensitive) instead of id."""
    m = cmap.withColumn("_dk", desc_key(map_desc)).drop(map_desc)
    return (df.withColumn("_dk", desc_key(desc_col))
              .join(dim(m, bounded), "_dk", "left").drop("_dk"))


def parent_code(code) -> Column:
    """C4: 5040 -> 5000 (custom codes >= 100000 are their own parents)."""
    c = col_of(code)
    return F.when(c >= 100000, c).otherwise((F.floor(c / 1000) * 1000).cast("bigint"))


def category_closure(cats: DataFrame, code: str = "cat_code", name: str = "cat_name") -> DataFrame:
    """C4: (parent_code, parent_name, child_code, child_name) for every code including the
    parent itself, so a request for a parent reaches all its children."""
    p = cats.filter(F.col(code) % 1000 == 0).select(
        F.col(code).alias("parent_code"), F.col(name).alias("parent_name"))
    c = cats.select(F.col(code).alias("child_code"), F.col(name).alias("child_name"),
                    parent_code(code).alias("parent_code"))
    return c.join(F.broadcast(p), "parent_code", "inner")


def reverse_category(request: DataFrame, cmap: DataFrame, req_code: str = "req_code",
                     code: str = "cat_code", on: Sequence[str] = ("source",)) -> DataFrame:
    """Requested canonical codes -> site ids per source (sorted, distinct)."""
    j = request.join(F.broadcast(cmap), request[req_code] == cmap[code], "inner")
    return j.groupBy(*on).agg(F.array_sort(F.collect_set("site_id")).alias("site_ids"))


def default_categories(request: DataFrame, cmap: DataFrame, source: str = "source") -> DataFrame:
    """A request without categories uses the source's default ids. The defaults, one entry
    per source of the definitions, are one map that each request looks up: no join."""
    per_source = cmap.filter(F.col("is_default") & F.col(source).isNotNull()).groupBy(source).agg(
        F.array_sort(F.collect_set("site_id")).alias("ids"))
    defaults = per_source.agg(F.map_from_entries(F.collect_list(F.struct(source, "ids")))).scalar()
    return request.withColumn("site_ids", F.coalesce(F.col("site_ids"), F.try_element_at(defaults, F.col(source))))


def simple_categories(df: DataFrame, map_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Legacy ``{id: category}`` map form -> mapping rows (then C1)."""
    return df.select(*keep, F.explode(map_col).alias("site_id", "cat"))


def unmapped_ids(df: DataFrame, cmap: DataFrame, on: Sequence[str] = ("source", "site_id"),
                 bounded: bool = True) -> DataFrame:
    """Records whose id has no mapping (left anti join)."""
    return df.join(dim(cmap.select(*on).distinct(), bounded), list(on), "left_anti")


def custom_code(site_id) -> Column:
    """C8 [choice]: a stable custom code for an unmapped id, at or above 100000."""
    return (F.lit(100000) + F.pmod(F.xxhash64(col_of(site_id)), F.lit(900000))).cast("bigint")


# Category-name clean-up applied before lookup, in order; each pattern
# matches case-insensitively anywhere in the name (pattern, replacement).
CATEGORY_RENAMES = [("xbox", "XBox"), ("ebook", "EBook"), ("XBox One", "XBox One"),
                    ("WiiWare/VC", "Wiiware"), ("Pc", "PC")]


def category_rename(c, renames: Sequence[tuple[str, str]] = tuple(CATEGORY_RENAMES)) -> Column:
    """Fix spelling variants of category names (ordered, case-insensitive)."""
    out = col_of(c)
    for a, b in renames:
        out = F.regexp_replace(out, "(?i)" + re.escape(a), b.replace("$", "\\$"))
    return out


def caps_convert(cats: DataFrame, subcats: DataFrame) -> DataFrame:
    """Capability response (parent categories + subcategory list) -> mapping rows with
    each child joined to its parent (``code`` prefix rule of C4)."""
    return subcats.join(F.broadcast(cats), parent_code("sub_code") == cats["cat_code"], "left")


def source_dimension(df: DataFrame, sources: DataFrame, on: str = "source") -> DataFrame:
    """Attach per-source constants (language, type, policy) by broadcast join."""
    return df.join(F.broadcast(sources), on, "left")


min_policy = source_dimension


def filtered_settings(defaults: DataFrame, user: DataFrame, on: Sequence[str] = ("source", "name"),
                      options: DataFrame | None = None) -> DataFrame:
    """User settings over defaults. Of a setting that ``options`` (source, name, opt_key)
    lists, a value outside its options is rejected and the default stands; settings without
    options (text, checkbox, password) keep the user's value. Rows are kept one by one."""
    j = defaults.join(user, list(on), "left")
    columns, val = j.columns, F.coalesce(F.col("user_value"), F.col("default"))
    if options is not None:
        listed = options.select(*on, F.col("opt_key").alias("user_value")).distinct()
        j = (j.join(listed.select(*on).distinct().withColumn("_listed", F.lit(True)), list(on), "left")
              .join(listed.withColumn("_valid", F.lit(True)), [*on, "user_value"], "left"))
        val = F.when(F.col("_listed") & F.col("_valid").isNull(), F.col("default")).otherwise(val)
    return j.withColumn("value", val).select(*columns, "value")


def alias_hosts(df: DataFrame, url: str, aliases: DataFrame) -> DataFrame:
    """An old/mirror host -> the source's current host, path kept.
    ``aliases`` has (old_host, new_host); host is read with ``try_parse_url``."""
    host = F.lower(F.try_parse_url(F.col(url), F.lit("HOST")))
    j = df.withColumn("_host", host).join(F.broadcast(aliases), F.col("_host") == aliases["old_host"], "left")
    new_url = F.when(F.col("new_host").isNotNull(),
                     F.regexp_replace(F.col(url), F.lit(r"^([a-zA-Z]+://)[^/:?#]+"),
                                       F.concat(F.lit("$1"), F.col("new_host"))))
    return j.withColumn("resolved_url", F.coalesce(new_url, F.col(url))).drop("_host", "old_host")


def source_profile(df: DataFrame, dims: Sequence[str], cube: bool = True) -> DataFrame:
    """Record counts per dimension combination (``cube``, or plain group). ``level`` has a bit
    per dimension, the first one highest, that is set where the row sums over it, so a null
    value (bit 0) and a subtotal (bit 1) are told apart."""
    if not cube:
        return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n")).withColumn("level", F.lit(0).cast("long"))
    return df.cube(*dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))
