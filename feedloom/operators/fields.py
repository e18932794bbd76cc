"""Field semantics (B1-B13): selectors, attributes, case maps, staged field chains and
projection to the canonical release record."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col_of, lit_str, nz

# ----------------------------------------------------------------------------- B1-B4


def strip_tags(c) -> Column:
    """Element markup -> text (tags removed, blanks collapsed)."""
    t = F.regexp_replace(col_of(c), r"<[^>]*>", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def select_field(el, pattern: str | None = None) -> Column:
    """B1: text of the element (or of the first sub-element matching ``pattern``)."""
    x = col_of(el)
    if pattern:
        x = F.regexp_extract(x, pattern, 0)
    return strip_tags(x)


def select_attribute(el, name: str) -> Column:
    """B2: value of attribute ``name`` on the first tag carrying it ('' when absent)."""
    return F.regexp_extract(col_of(el), r"\b" + re.escape(name) + r"""\s*=\s*["']([^"']*)["']""", 1)


def literal_text(x) -> Column:
    """A constant (folded by Catalyst) or a computed Column."""
    return lit_str(x)


def optional_default(c, default=None) -> Column:
    """An optional field that is missing or empty becomes ``default`` (may be another
    field's Column) or null."""
    d = F.lit(None).cast("string") if default is None else lit_str(default)
    return F.coalesce(nz(col_of(c)), d)


def tag_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """B5 in one pass: every row with ``reject_reason``, the missing required fields, or null."""
    missing = F.array_compact(F.array(*[F.when(nz(col_of(n).cast("string")).isNull(), F.lit(n)) for n in names]))
    return df.withColumn("reject_reason", F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))))


def required_field(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows missing a required field go to a quarantine frame (with the reason)
    instead of failing the job. ``good + rejected`` = input, row for row. A job that needs both
    halves at once reads ``tag_required``, which scans once."""
    tagged = tag_required(df, names)
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"), tagged.filter(F.col("reject_reason").isNotNull())


# ----------------------------------------------------------------------------- B6-B8


def case_value(c, mapping: Mapping[str, object], otherwise=None) -> Column:
    """Value -> value; key ``*`` is the else branch. Keys compare case-folded (payloads
    write ``True`` where rule files hold ``true``); of keys equal so, the first counts. A key may
    map to null."""
    m = dict(mapping)
    if "*" in m:
        otherwise = m.pop("*")
    key = F.lower(col_of(c).cast("string"))
    folded: dict[str, object] = {}
    for k, v in m.items():
        folded.setdefault(str(k).lower(), v)
    if not folded:
        return F.lit(otherwise)
    cmap = F.create_map(*[x for k, v in folded.items() for x in (F.lit(k), F.lit(v))])
    return F.when(F.map_contains_key(cmap, key), F.element_at(cmap, key)).otherwise(F.lit(otherwise))


def case_predicate(cases: Sequence[tuple[Column, object]], otherwise=None) -> Column:
    """Ordered predicates on the row, first hit wins."""
    out = None
    for pred, v in cases:
        out = F.when(pred, lit_str(v)) if out is None else out.when(pred, lit_str(v))
    return out.otherwise(lit_str(otherwise)) if otherwise is not None else out


def remove_elements(el, tags: Sequence[str]) -> Column:
    """Drop whole sub-elements (``<b>..</b>``, ``<span>..</span>``) before taking the text.
    An unclosed tag removes only the tag itself."""
    x = col_of(el)
    for t in tags:
        x = F.regexp_replace(x, rf"(?is)<{t}\b[^>]*>.*?</{t}>", "")
        x = F.regexp_replace(x, rf"(?i)<{t}\b[^>]*>", "")
    return x


# ----------------------------------------------------------------------------- B9-B12


def private_fields(df: DataFrame) -> DataFrame:
    """``_x`` intermediates may be read by later fields but are not output."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def field_chain(df: DataFrame, ordered: Mapping[str, Callable[[dict], Column] | Column]) -> DataFrame:
    """Fields evaluate in declared order; a field may read earlier ones.

    Each callable receives a dict of the Columns defined so far (by name). Fields are
    added in one ``withColumns`` per dependency level: a field that reads an earlier field
    refers to it *by name* (``F.col``), so the earlier expression is computed once, not
    pasted into every reader.
    """
    stage: dict[str, Column] = {}
    defined = set(df.columns)
    out = df
    for name, fn in ordered.items():
        refs = {k: F.col(k) for k in defined | set(stage)}
        expr = fn(refs) if callable(fn) else fn
        reads_stage = any(_mentions(expr, k) for k in stage)
        if reads_stage or name in stage:
            out = out.withColumns(stage)
            defined |= set(stage)
            stage = {}
        stage[name] = expr
    if stage:
        out = out.withColumns(stage)
    return out


def _mentions(c: Column, name: str) -> bool:
    return re.search(r"(?<![\w.])`?" + re.escape(name) + r"`?(?![\w])", str(c)) is not None


def variant_coalesce(*cols, fallback=None) -> Column:
    """First non-empty of several text variants (``date_year``, ``date_day``, ...),
    then ``fallback`` (any type, e.g. the ``as_of`` timestamp)."""
    xs = [nz(col_of(c)) for c in cols]
    if fallback is not None:
        xs.append(lit_str(fallback))
    return F.coalesce(*xs)


def append_modifier(old, new, mode: str = "append", sep: str | None = None) -> Column:
    """``field|append`` adds to an earlier value, ``|noappend`` replaces it.
    Arrays: distinct union; text: joined with ``sep``."""
    o, n = col_of(old), col_of(new)
    if mode == "noappend":
        return n
    if sep is None:  # arrays
        return F.array_distinct(F.concat(F.coalesce(o, F.array()), F.coalesce(n, F.array())))
    return F.concat_ws(sep, nz(o), nz(n))


# ----------------------------------------------------------------------------- B13

CANONICAL_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("path_id", T.IntegerType()),
    T.StructField("pos", T.IntegerType()), T.StructField("captured_at", T.TimestampType()),
    T.StructField("title", T.StringType(), False), T.StructField("description", T.StringType()),
    T.StructField("details", T.StringType()), T.StructField("download", T.StringType()),
    T.StructField("magnet", T.StringType()), T.StructField("infohash", T.StringType()),
    T.StructField("category", T.ArrayType(T.IntegerType())), T.StructField("categorydesc", T.StringType()),
    T.StructField("date", T.TimestampType()), T.StructField("size", T.LongType()),
    T.StructField("files", T.IntegerType()), T.StructField("grabs", T.IntegerType()),
    T.StructField("seeders", T.IntegerType(), False), T.StructField("leechers", T.IntegerType()),
    T.StructField("downloadvolumefactor", T.DoubleType()), T.StructField("uploadvolumefactor", T.DoubleType()),
    T.StructField("minimumratio", T.DoubleType()), T.StructField("minimumseedtime", T.LongType()),
    T.StructField("imdbid", T.LongType()), T.StructField("tmdbid", T.LongType()),
    T.StructField("tvdbid", T.LongType()), T.StructField("doubanid", T.LongType()),
    T.StructField("rageid", T.LongType()), T.StructField("traktid", T.LongType()),
    T.StructField("genre", T.ArrayType(T.StringType())), T.StructField("year", T.IntegerType()),
    T.StructField("poster", T.StringType()), T.StructField("author", T.StringType()),
    T.StructField("booktitle", T.StringType()), T.StructField("artist", T.StringType()),
    T.StructField("album", T.StringType()), T.StructField("comments", T.StringType()),
])
CANONICAL_NAMES = [f.name for f in CANONICAL_SCHEMA.fields]


def canonical_project(df: DataFrame, strict: bool = True) -> DataFrame:
    """Project to the canonical record: cast every known field, add missing ones as
    null, drop private ``_x`` fields. Suffix variants (``date_year``, ``title_alt``) fold into their
    field: the first of the field itself and its variants, in column order, that is not empty and
    fits the type. Another unknown public name is an error when ``strict``. A value that fits
    no type becomes null; ``canonical_records`` also enforces what must not be null."""
    public = [c for c in df.columns if not c.startswith("_")]
    field_of = {c: c if c in CANONICAL_NAMES else c.split("_", 1)[0] for c in public}
    unknown = [c for c, f in field_of.items() if f not in CANONICAL_NAMES]
    if unknown and strict:
        raise ValueError(f"fields outside the canonical record: {unknown}")
    cols = []
    for f in CANONICAL_SCHEMA.fields:
        given = sorted((c for c in public if field_of[c] == f.name), key=lambda c: c != f.name)
        values = [F.col(c).try_cast(f.dataType) for c in given]
        if f.dataType == T.StringType() and len(values) > 1:
            values = [nz(v) for v in values]
        cols.append((F.coalesce(*values) if values else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def canonical_records(df: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, rejected). Records hold what the schema says is never null; rejected
    rows have the record as far as it could be read and a ``reject_reason``. Every input row is
    in one of the two."""
    record = canonical_project(df, strict)
    needed = [f.name for f in CANONICAL_SCHEMA.fields if not f.nullable]
    return required_field(record, needed)
