"""Payload scans and row extraction.

A captured payload is one row ``(source, path_id, captured_at, content_type, charset,
body)``. Row extraction is narrow work (``posexplode`` inside the partition that holds
the payload): no shuffle until a rule needs neighbouring rows (A8/A9), and those windows
are partitioned by payload, never global.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.chain import apply_chain
from ..functions.text import col_of

PAYLOAD_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("path_id", T.IntegerType()),
    T.StructField("captured_at", T.TimestampType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("charset", T.StringType()),
    T.StructField("body", T.StringType()),
])


# ----------------------------------------------------------------------------- A1


def scan_payloads(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None, **options) -> DataFrame:
    """A1: read captures with a declared schema (no inference in production reads)."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


# ----------------------------------------------------------------------------- A2


def html_rows(df: DataFrame, body: str, item_pattern: str, keep: Sequence[str] = (),
              pos: str = "pos", element: str = "element", cells: str | None = None) -> DataFrame:
    """A2: one row per repeated element (regex over regular markup), position 1-based.
    With ``cells`` (a pattern with one group, e.g. ``<td[^>]*>(.*?)</td>``) each row also
    gets its ``cells`` array, for nth-cell fields (W4)."""
    items = F.regexp_extract_all(col_of(body), F.lit(item_pattern), 0)
    out = (df.select(*keep, F.posexplode(items).alias(pos, element))
             .withColumn(pos, F.col(pos) + 1))
    if cells:
        out = out.withColumn("cells", F.regexp_extract_all(F.col(element), F.lit(cells), 1))
    return out


def html_rows_irregular(df: DataFrame, body: str, tag: str, key_cols: Sequence[str]) -> DataFrame:
    """A2 for irregular markup: ``(*key_cols, pos, text, attrs)`` for each ``tag`` element, with missing
    end tags supplied (see ``elements``); ``attrs`` is a JSON object, text is trimmed."""
    from .elements import page_elements, rows_of, text_of

    rows = rows_of(page_elements(df, body, key_cols), tag, key_cols)
    text = F.regexp_replace(text_of(F.col("e")), r"^\s+|\s+$", "")
    return rows.select(*key_cols, F.col("pos").cast("int").alias("pos"), text.alias("text"), F.to_json("e.attrs").alias("attrs"))


# ----------------------------------------------------------------------------- A3-A7


def json_rows(df: DataFrame, body: str, path: str, schema: T.DataType | str,
              keep: Sequence[str] = (), pos: str = "pos", item: str = "item") -> DataFrame:
    """A3: JSON payload -> one row per element of the array at ``path``.

    ``path`` is dotted (``data``, ``results.items``); ``$`` means the root is the array.
    With a schema, ``from_json`` parses once per payload; rows carry a 1-based position.
    """
    parsed = F.from_json(col_of(body), schema)
    arr = parsed if path in ("$", "") else parsed.getField(path) if "." not in path else \
        _dotted(parsed, path)
    return (df.select(*keep, F.posexplode(arr).alias(pos, item))
              .withColumn(pos, F.col(pos) + 1))


def _dotted(c: Column, path: str) -> Column:
    for p in path.split("."):
        c = c.getField(p)
    return c


def json_rows_variant(df: DataFrame, body: str, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """A3 schema-less form: ``try_parse_json`` + ``try_variant_get`` to an array of variants
    (bad JSON -> no rows); fields are then read with ``variant_get``."""
    jpath = "$" if path in ("$", "") else "$." + path
    arr = F.try_variant_get(F.try_parse_json(col_of(body)), jpath, "array<variant>")
    return (df.select(*keep, F.posexplode(arr).alias("pos", "item"))
              .withColumn("pos", F.col("pos") + 1))


def xml_rows(df: DataFrame, body: str, schema: T.StructType | str, row_path: str,
             keep: Sequence[str] = (), pos: str = "pos", item: str = "item",
             pairs: str | None = None) -> DataFrame:
    """A4: XML payload (one document per row) -> one row per repeated element.

    ``schema`` describes the root element's children (``from_xml``); attributes carry the
    ``_`` prefix (``enclosure._url``), text of an element with attributes is ``_VALUE``.
    With ``pairs`` (the name of a repeated ``<x name=".." value=".."/>`` child), each row
    also gets ``attrs``, a name -> list of values map: feeds repeat an attribute name.
    """
    parsed = F.from_xml(col_of(body), schema)
    out = (df.select(*keep, F.posexplode(_dotted(parsed, row_path)).alias(pos, item))
             .withColumn(pos, F.col(pos) + 1))
    if pairs:
        out = out.withColumn("attrs", xml_pairs(F.col(item).getField(pairs)))
    return out


def xml_pairs(arr: Column, name_field: str = "_name", value_field: str = "_value") -> Column:
    """A4: ``<attr name=".." value=".."/>`` list -> map of name -> values in document order."""
    named = F.filter(arr, lambda a: a.getField(name_field).isNotNull())
    names = F.array_distinct(F.transform(named, lambda a: a.getField(name_field)))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.transform(
        F.filter(named, lambda a: a.getField(name_field) == n), lambda a: a.getField(value_field))))


def nested_rows(df: DataFrame, children: str, parent_cols: Sequence[str],
                keep_empty: bool = False, pos: str = "pos", child: str = "child", start: str | None = None) -> DataFrame:
    """One row per child with the parent's columns; a parent without children gives
    no row (``keep_empty=False``, the guard) or one row with a null child. ``start`` names the
    number of children in earlier parts of a parent that is stored in several."""
    ex = F.posexplode_outer if keep_empty else F.posexplode
    first = [col_of(start).alias("_start")] if start else []
    rows = df.select(*parent_cols, *first, ex(col_of(children)).alias(pos, child))
    return rows.withColumn(pos, F.col(pos) + 1 + (F.col("_start") if start else F.lit(0))).drop("_start")


def nested_rows_guard(df: DataFrame, children: str, parent_cols: Sequence[str],
                      keep_empty: bool, start: str | None = None) -> DataFrame:
    """A6."""
    return nested_rows(df, children, parent_cols, keep_empty=keep_empty, start=start)


def unwrap_attribute(df: DataFrame, struct_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Promote the fields of one nested object to the row."""
    return df.select(*keep, f"{struct_col}.*")


# ----------------------------------------------------------------------------- A8-A10


def merge_following_rows(df: DataFrame, part: Sequence[str], order: str, after: int,
                         text: str, sep: str = " ", out: str = "merged",
                         dense_from: int | None = None, block: int = 65536) -> DataFrame:
    """A record spans ``after + 1`` consecutive rows; join their text in order.

    With ``dense_from`` set, ``order`` is already a dense position starting there (the
    ``pos`` every extractor emits), so the record number is arithmetic and no window runs:
    the shuffle is on ``(payload, record)``, and a payload holding a third of all rows still
    spreads over every task. Without it, rows are numbered first by the two-level exact
    numbering of ``operators.numbering`` (numeric ``order``). Each group holds at most
    ``after + 1`` rows.
    """
    if dense_from is None:
        from ..operators.numbering import number_in_order
        df = number_in_order(df, part, order, out="_rn", block=block)
        idx = F.col("_rn") - 1
    else:
        idx = F.col(order) - F.lit(dense_from)
    g = F.floor(idx / F.lit(after + 1))
    grouped = (df.withColumn("_grp", g)
                 .groupBy(*part, "_grp")
                 .agg(F.min(order).alias(order),
                      F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                           F.col(text).alias("t")))).alias("_xs"),
                      F.count(F.lit(1)).alias("n_rows")))
    return grouped.select(*part, F.col("_grp").alias("record"), order,
                          F.array_join(F.transform("_xs", lambda x: x["t"]), sep).alias(out),
                          "n_rows")


def carry_header(df: DataFrame, part: Sequence[str], order: str, header: Column | str,
                 into: str, block_rows: int = 65536) -> DataFrame:
    """Header rows (where ``header`` is non-null) give their value to the rows after
    them; header rows themselves are dropped.

    Two levels so one huge payload never becomes one task: rows are cut into blocks of
    ``block_rows`` consecutive ``order`` values; inside a block a window (bounded by the
    block) carries the header; the last header of every block is a small per-block table
    whose running value (window over blocks only) seeds the next block.
    """
    h = col_of(header)
    blk = F.floor(F.col(order) / F.lit(block_rows))
    base = df.withColumn("_hdr", h).withColumn("_blk", blk)
    w_in = (Window.partitionBy(*part, "_blk").orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = base.withColumn("_in", F.last("_hdr", ignorenulls=True).over(w_in))
    blocks = (base.groupBy(*part, "_blk")
                  .agg(F.max_by("_hdr", F.when(F.col("_hdr").isNotNull(), F.col(order)))
                        .alias("_blk_last")))
    w_blk = (Window.partitionBy(*part).orderBy("_blk")
             .rowsBetween(Window.unboundedPreceding, -1))
    seeded = blocks.select(*part, "_blk",
                           F.last("_blk_last", ignorenulls=True).over(w_blk).alias("_carry"))
    out = inner.join(seeded, [*part, "_blk"], "left")
    return (out.withColumn(into, F.coalesce(F.col("_in"), F.col("_carry")))
               .filter(F.col("_hdr").isNull())
               .drop("_hdr", "_blk", "_in", "_carry"))


def row_count_guard(df: DataFrame, total: Column | str, marker: Column | None = None) -> DataFrame:
    """A10: payloads that declare a total of 0 (or carry the empty marker) yield no rows.
    Apply before the explode so empty payloads are dropped early."""
    cond = F.coalesce(col_of(total).try_cast("bigint"), F.lit(1)) != 0
    if marker is not None:
        cond = cond & ~F.coalesce(marker, F.lit(False))
    return df.filter(cond)


def preprocess_payload(df: DataFrame, body: str, steps) -> DataFrame:
    """The filter chain over the raw body before row extraction."""
    return df.withColumn(body, apply_chain(col_of(body), steps))


def decode_charset(c, charset) -> Column:
    """Bytes -> text by declared charset: a name, or a column with one name per row
    (legacy charsets such as windows-1251 need ``spark.sql.legacy.javaCharsets``). A malformed
    byte becomes U+FFFD (``spark.sql.legacy.codingErrorAction``; both are set by
    ``build_session``); ``malformed`` finds such rows."""
    return F.call_function("decode", col_of(c), charset if isinstance(charset, Column) else F.lit(charset))


def malformed(text) -> Column:
    """Whether decoding replaced a byte, for a quarantine column."""
    return col_of(text).contains("\ufffd")


def tag_paths(df: DataFrame, column: str, paths: Mapping[str, int]) -> DataFrame:
    """A13 over one table: each row's ``path_id`` by the value of ``column`` in one scan; other
    and null values keep their rows, with a null path."""
    ids = F.create_map(*[x for k, v in paths.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("path_id", F.when(F.col(column).isNotNull(), F.try_element_at(ids, F.col(column))))


def fan_in_paths(dfs: Mapping[int, DataFrame]) -> DataFrame:
    """Several paths of a source form one result; each keeps its ``path_id``."""
    out = None
    for pid, d in dfs.items():
        d = d.withColumn("path_id", F.lit(pid))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def route_paths(requests: DataFrame, paths: DataFrame, on: str = "categories") -> DataFrame:
    """Pair each request with the paths whose category set meets it; a path without
    a set always applies.

    Both sides are exploded to a row per code and joined on it. A pair that meets in several
    codes is kept for the least common one only, so no distinct is needed and repeated rows stay
    repeated. Paths without a set stand under a mark that every request carries as well. The
    size of the path side is left to AQE, which broadcasts it if it is small."""
    req, own = f"req_{on}", f"path_{on}"
    kind = requests.schema[req].dataType.elementType
    mark = lambda any_, code: F.struct(F.lit(any_).alias("any"), code.cast(kind).alias("code"))
    every = F.array(mark(True, F.lit("0")))
    codes = lambda c: F.transform(F.array_distinct(F.filter(c, lambda x: x.isNotNull())), lambda x: mark(False, x))
    left = requests.withColumn("_k", F.explode(F.concat(every, F.coalesce(codes(F.col(req)), F.array().cast(every_type(kind))))))
    right = paths.withColumn("_p", F.explode(F.when(F.col(own).isNull(), every).otherwise(codes(F.col(own)))))
    both = left.join(right, (F.col("_k.any") == F.col("_p.any")) & (F.col("_k.code") == F.col("_p.code")), "inner")
    return both.where(F.col("_k.any") | (F.col("_k.code") == F.array_min(F.array_intersect(F.col(req), F.col(own))))).drop("_k", "_p")


def every_type(kind: T.DataType) -> T.DataType:
    """The type of a list of marked codes in ``route_paths``."""
    return T.ArrayType(T.StructType([T.StructField("any", T.BooleanType(), False), T.StructField("code", kind)]))


def flatten_documents(df: DataFrame, key: str, content: str) -> dict[str, DataFrame]:
    """Nested definition documents -> child tables (links, mappings, modes, settings,
    options, fields, filters). Each child is an explode of the parent row: no shuffle."""
    c = F.col(content)
    one = F.col("pos") + 1  # positions are 1-based like every extractor's
    links = df.select(key, F.posexplode(c["links"]).alias("pos", "link")).withColumn("pos", one)
    mappings = df.select(key, F.posexplode(c["mappings"]).alias("pos", "m")).select(
        key, one.alias("pos"), "m.*")
    modes = df.select(key, F.explode(c["modes"]).alias("mode", "params")).select(
        key, "mode", F.explode("params").alias("param"))
    settings = df.select(key, F.posexplode(c["settings"]).alias("pos", "st")).select(
        key, one.alias("pos"), "st.name", "st.type", "st.label", "st.default", "st.options")
    options = settings.select(key, F.col("name").alias("setting"),
                              F.explode("options").alias("opt_key", "opt_value"))
    fields = df.select(key, F.explode(c["fields"]).alias("field", "f")).select(
        key, "field", "f.selector", "f.attribute", "f.text", "f.optional", "f.default", "f.filters")
    filters = fields.select(key, "field", F.posexplode("filters").alias("pos", "flt")).select(
        key, "field", one.alias("pos"), F.col("flt.name").alias("filter"), F.col("flt.args").alias("args"))
    return {"links": links, "mappings": mappings, "modes": modes,
            "settings": settings.drop("options"), "options": options,
            "fields": fields.drop("filters"), "filters": filters}


def scan_keyvalue(df: DataFrame, text: str, keep: Sequence[str] = (), sep: str = "=") -> DataFrame:
    """``key=value`` lines inside a text column -> (key, value, int_value) rows.

    Comments (``#``) and blanks are dropped, both sides trimmed, the split is on the first
    ``sep``; ``int_value`` is null where the value is not an integer."""
    lines = df.select(*keep, F.posexplode(F.split(col_of(text), "\n")).alias("line_no", "line"))
    lines = lines.withColumn("line", F.trim("line"))
    kv = lines.filter(~F.col("line").startswith("#") & F.col("line").contains(sep))
    k = F.trim(F.substring_index("line", sep, 1))
    v = F.trim(F.expr(f"substr(line, instr(line, '{sep}') + 1)"))
    return (kv.select(*keep, (F.col("line_no") + 1).alias("line_no"), k.alias("key"), v.alias("value"))
              .filter(F.col("key") != "")
              .withColumn("int_value", F.col("value").try_cast("bigint")))
