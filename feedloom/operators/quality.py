"""Data-quality rules (L1-L20, G1, O5): the schema language re-aimed as table constraints.

A rule is a Column that is true when a row violates it. ``check`` evaluates every rule in
one projection (an array of failure structs per row, filtered, exploded), so a rule set of
any length costs one pass over the table and no shuffle; only the report order (O5) and the
summary (G1) shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col_of

FAIL_TYPE = "struct<path:string,rule:string,value:string>"


@dataclass
class Rule:
    """``failures`` is an ``array<struct<path, rule, value>>`` Column (empty when fine)."""

    name: str
    failures: Column


def _one(name: str, path, violated: Column, value: Column | None) -> Rule:
    p = path if isinstance(path, Column) else F.lit(path)
    v = (value if value is not None else F.lit(None)).cast("string")
    item = F.struct(p.alias("path"), F.lit(name).alias("rule"), v.alias("value"))
    return Rule(name, F.when(F.coalesce(violated, F.lit(False)), F.array(item))
                .otherwise(F.array().cast(f"array<{FAIL_TYPE}>")))


def dq_rule(name: str, path, violated: Column, value: Column | None = None) -> Rule:
    """Any boolean condition as a rule (``violated`` true = failure)."""
    return _one(name, path, violated, value)


# ----------------------------------------------------------------------------- L1-L12


def dq_required(col, path: str | None = None) -> Rule:
    """L1: value present (not null; text not empty)."""
    c = col_of(col)
    return _one("required", path or str(col), c.isNull() | (c.cast("string") == ""), None)


def dq_type(col, type_: str, path: str | None = None) -> Rule:
    """L2: value castable to ``type_`` ('a|b' unions pass if any cast works)."""
    c = col_of(col)
    ok = None
    for t in type_.split("|"):
        t_ok = c.cast("string").try_cast(t).isNotNull() if t != "string" else F.lit(True)
        ok = t_ok if ok is None else (ok | t_ok)
    return _one("type", path or str(col), c.isNotNull() & ~ok, c)


def dq_enum(col, values: Sequence, path: str | None = None) -> Rule:
    """L3: value in a fixed set."""
    c = col_of(col)
    return _one("enum", path or str(col), c.isNotNull() & ~c.isin(list(values)), c)


def dq_unknown_keys(map_col, allowed: Sequence[str], path: str | None = None) -> Rule:
    """L4: no keys outside ``allowed`` (additionalProperties: false)."""
    extra = F.array_except(F.map_keys(col_of(map_col)), F.array(*[F.lit(a) for a in allowed]))
    return _one("unknown_keys", path or str(map_col), F.size(extra) > 0, F.array_join(F.array_sort(extra), ","))


def dq_key_pattern(map_col, patterns: Sequence[str], path: str | None = None) -> Rule:
    """Every key matches one of ``patterns``."""
    def ok(k):
        out = F.lit(False)
        for p in patterns:
            out = out | k.rlike(p)
        return out
    bad = F.filter(F.map_keys(col_of(map_col)), lambda k: ~ok(k))
    return _one("key_pattern", path or str(map_col), F.size(bad) > 0, F.array_join(F.array_sort(bad), ","))


def dq_unique_items(arr_col, path: str | None = None) -> Rule:
    """The list has no duplicates."""
    a = col_of(arr_col)
    return _one("unique_items", path or str(arr_col), F.size(a) != F.size(F.array_distinct(a)), F.size(a))


def dq_one_of(*cols, path: str = "one_of") -> Rule:
    """Exactly one of several groups present."""
    n = sum((col_of(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return _one("one_of", path, n != 1, n)


def dq_conditional(cond: Column, rule: Rule) -> Rule:
    """``rule`` applies only where ``cond`` holds."""
    return Rule(rule.name, F.when(F.coalesce(cond, F.lit(False)), rule.failures)
                .otherwise(F.array().cast(f"array<{FAIL_TYPE}>")))


def dq_value_pattern(col, pattern: str, negate: bool = False, path: str | None = None) -> Rule:
    """Text must match (or, with ``negate``, must not match) ``pattern``."""
    c = col_of(col)
    m = c.rlike(pattern)
    return _one("not_pattern" if negate else "pattern", path or str(col), c.isNotNull() & (m if negate else ~m), c)


def dq_uri(col, path: str | None = None) -> Rule:
    """An absolute URI with a host."""
    c = col_of(col)
    bad = F.try_parse_url(c, F.lit("HOST")).isNull() | ~c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    return _one("uri", path or str(col), c.isNotNull() & bad, c)


def dq_nested(arr_col, name: str, path_prefix: str, violated: Callable[[Column], Column],
              value: Callable[[Column], Column] | None = None) -> Rule:
    """A rule on each element of an array; the failure path carries the 1-based index
    (``mappings/3``)."""
    a = col_of(arr_col)
    idx = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(0)))
    items = F.transform(
        F.filter(F.arrays_zip(idx.alias("i"), a.alias("x")),
                 lambda z: F.coalesce(violated(z["x"]), F.lit(False))),
        lambda z: F.struct(F.concat_ws("/", F.lit(path_prefix), z["i"].cast("string")).alias("path"),
                           F.lit(name).alias("rule"),
                           (value(z["x"]) if value else F.lit(None)).cast("string").alias("value")))
    return Rule(name, F.coalesce(items, F.array().cast(f"array<{FAIL_TYPE}>")))


def dq_map_values(map_col, type_: str, path: str | None = None) -> Rule:
    """Every map value castable to ``type_``."""
    bad = F.filter(F.map_entries(col_of(map_col)),
                   lambda e: e["value"].isNotNull() & e["value"].cast("string").try_cast(type_).isNull())
    return _one("map_values", path or str(map_col), F.size(bad) > 0,
                F.array_join(F.array_sort(F.transform(bad, lambda e: e["key"])), ","))


def normalise_keys(m, lower_bool_values: bool = False) -> Column:
    """Boolean keys (``True``/``False``) become lower-case text; with
    ``lower_bool_values`` (options and case maps) boolean values do too; numbers stay.
    Of keys that become equal the one smallest before counts."""
    def fix(x):
        return F.when(x.isin("True", "False"), F.lower(x)).otherwise(x)
    entries = F.map_entries(col_of(m))
    keys = F.array_distinct(F.transform(entries, lambda e: fix(e["key"].cast("string"))))
    out = F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_min(
        F.filter(entries, lambda e: fix(e["key"].cast("string")) == k))["value"]))
    if lower_bool_values:
        out = F.transform_values(out, lambda k, v: fix(v.cast("string")))
    return out


# ----------------------------------------------------------------------------- check / reports


def failures(rules: Sequence[Rule]) -> Column:
    """All failures of a row, in declared rule order."""
    return F.flatten(F.array(*[r.failures for r in rules]))


def check(df: DataFrame, key: str | Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """L14 core: ``(key, path, rule, value)`` for every violation, all rules in one pass."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.select(*keys, F.explode(failures(rules)).alias("f"))
              .select(*keys, "f.path", "f.rule", "f.value"))


def sort_errors(errors: DataFrame, key: str | Sequence[str] = "key") -> DataFrame:
    """Deterministic order of errors (key, path, rule, value)."""
    keys = [key] if isinstance(key, str) else list(key)
    return errors.orderBy(*keys, "path", "rule", "value")


def report_all(df: DataFrame, key, rules: Sequence[Rule]) -> DataFrame:
    """Every error, sorted, with rule and path."""
    return sort_errors(check(df, key, rules), key)


def report_first(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """Only the first error of each item, by declared rule order (no shuffle)."""
    first = F.try_element_at(failures(rules), F.lit(1))
    return (df.select(key, first.alias("f")).filter(F.col("f").isNotNull())
              .select(key, "f.path", "f.rule", "f.value"))


def validation_summary(items: DataFrame, errors: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """G1: total / errors / success per group, with an overall line (``rollup``).
    Errors are reduced to one row per key before the join, so the join is 1:1. ``level`` is 1
    on the overall line and 0 on a group's, also where the group is null."""
    bad = errors.select(key).distinct().withColumn("_bad", F.lit(1))
    j = items.join(bad, key, "left")
    g = j.rollup(by) if by else j.groupBy()
    level = F.grouping_id() if by else F.lit(1).cast("long")
    out = g.agg(F.count(F.lit(1)).alias("total"), F.count("_bad").alias("errors"), level.alias("level"))
    return out.withColumn("success", F.col("total") - F.col("errors"))


def best_version(df: DataFrame, key: str, rule_sets: Mapping[int, Sequence[Rule]],
                 declared: str | None = None) -> DataFrame:
    """Check each item against every version's rule set in the same pass; the best
    version is the highest that passes (0 if none). ``top_fails`` flags items whose declared
    (or highest) version fails."""
    passes = {v: F.size(failures(rs)) == 0 for v, rs in rule_sets.items()}
    best = F.greatest(*[F.when(p, F.lit(v)) for v, p in passes.items()], F.lit(0)) if len(passes) > 1 else \
        F.coalesce(*[F.when(p, F.lit(v)) for v, p in passes.items()], F.lit(0))
    top = max(rule_sets)
    cols = [key, best.alias("best_version")]
    if declared:
        top_ok = F.lit(None).cast("boolean")
        for v, p in passes.items():
            top_ok = F.when(F.col(declared) == v, p).otherwise(top_ok)
        cols.append((~F.coalesce(top_ok, F.lit(False))).alias("top_fails"))
    else:
        cols.append((~passes[top]).alias("top_fails"))
    return df.select(*cols, *[c for c in df.columns if c != key])


def resolve_version(df: DataFrame, key: str, version: str, current: int, content: str = "content") -> DataFrame:
    """Per key, the highest version at or below ``current`` (partial aggregation); of
    several contents of that version the largest."""
    return (df.filter(F.col(version) <= current)
              .groupBy(key).agg(F.max(version).alias(version), F.max_by(content, F.struct(version, content)).alias(content)))


def load_failure(df: DataFrame, key: str, body: str) -> DataFrame:
    """An unreadable item is an error row, not a crash. A document must be one JSON
    object: it must parse as an object and nothing may follow it (Spark's JSON readers
    stop after the first value, so trailing text is checked separately)."""
    b = col_of(body)
    obj = F.from_json(b, "map<string,string>")
    bad = obj.isNull() | ~F.rtrim(b).endswith("}") | F.try_parse_json(b).isNull()
    return (df.select(key, F.when(bad, F.lit("load")).alias("rule"),
                      F.when(bad, b).alias("value"))
              .filter("rule IS NOT NULL"))


def missing_rules(groups: DataFrame, versions_with_rules: DataFrame, version: str = "version") -> DataFrame:
    """Groups without any rule set are reported ``unchecked`` (never passed silently)."""
    has = versions_with_rules.select(version).distinct().withColumn("_has", F.lit(True))
    return (groups.join(F.broadcast(has), version, "left")
                  .withColumn("status", F.when(F.col("_has"), F.lit("checked")).otherwise(F.lit("unchecked")))
                  .drop("_has"))


def id_matches_key(df: DataFrame, id_col: str = "id", key: str = "key") -> DataFrame:
    """Declared id differs from the item key."""
    return df.filter(~F.col(id_col).eqNullSafe(F.col(key)))



