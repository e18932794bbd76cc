"""Typed normalisation (N1, N6-N13): sizes, counts, ids, hashes, factors, booleans, URLs.

All builders return Columns; N10 (``min_policy``) is a join and lives in
``operators.catalog``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, let, lit_str

# Size unit prefixes (first letter after the number) -> power of 1024.
# Localised units are rewritten to these letters first (see LOCAL_SIZE_UNITS).
SIZE_POWERS = {"b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}
# Cyrillic unit spellings -> Latin.
LOCAL_SIZE_UNITS = [("КБ", "KB"), ("МБ", "MB"), ("ГБ", "GB"), ("ТБ", "TB"), ("Б", "B")]

# a number, perhaps in blocks of three, that no letter or digit stands before
_NUMBER = r"(?<![\p{L}\d.,])([0-9]{1,3}(?:[ \u00a0\u202f][0-9]{3})+(?:[.,][0-9]+)?(?![0-9])|[0-9][0-9.,]*)"
# the number that has a unit, else the first one; a sign makes neither a size
_SIZED = r"(?i)((?<![\p{L}\d])-)?" + _NUMBER + r"\s*([kmgtp]i?b(?:ytes?)?|b(?:ytes?)?(?!\p{L}))"
_UNSIZED = r"((?<![\p{L}\d])-)?([0-9][0-9.,]*)"


def localise_size_units(c) -> Column:
    def latin(x: Column) -> Column:
        out = x
        for loc, lat in LOCAL_SIZE_UNITS:
            out = F.regexp_replace(out, "(?iu)" + loc + r"(?!\p{L})", lat)
        return F.when(x.contains("Б") | x.contains("б"), out).otherwise(x)  # each of the units has this letter
    return let(col_of(c).cast("string"), latin)


def to_bytes(c) -> Column:
    """N1: '1.5 GB' / '512 MB' / '1 ГБ' / '1,024 KiB' / '1,5 GB' -> bytes as BIGINT (1024 base).

    The number that a unit follows counts ('x264 700 MB'), blanks between blocks of three are
    thousands. With both separators the last one is the decimal one. One kind alone is a
    thousands separator if it stands more than once, or is a comma before exactly three digits.
    A size beyond BIGINT and a negative one give null."""
    return let(localise_size_units(c), lambda t: let(F.regexp_extract(t, _SIZED, 0), lambda size: F.when(
        size != "", _bytes(size, _SIZED)).otherwise(let(F.regexp_extract(t, _UNSIZED, 0), lambda x: _bytes(x, _UNSIZED)))))


def _bytes(found: Column, pattern: str) -> Column:
    """The bytes of a size cut out of a text by one of the patterns."""
    unit = F.lower(F.regexp_extract(found, pattern, 3)) if pattern == _SIZED else F.lit("")
    power = F.coalesce(F.element_at(F.create_map(*[x for k, v in SIZE_POWERS.items()
                                                     for x in (F.lit(k), F.lit(v))]),
                                    F.substring(unit, 1, 1)), F.lit(0))
    digits = F.rtrim(F.translate(F.regexp_extract(found, pattern, 2), " \u00a0\u202f", ""), F.lit(".,"))
    val = let(digits, _decimal).try_cast("double") * F.pow(F.lit(1024.0), power)
    return F.when(F.regexp_extract(found, pattern, 1) == "", F.round(val).try_cast("bigint"))


def _decimal(num: Column) -> Column:
    """A number with either separator -> digits and at most a decimal point."""
    comma_last = F.instr(F.reverse(num), ",") < F.instr(F.reverse(num), ".")
    european = F.replace(F.replace(num, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    plain = F.replace(num, F.lit(","), F.lit(""))
    return (F.when(~(num.contains(",") | num.contains(".")), num)
             .when(num.contains(",") & num.contains("."), F.when(comma_last, european).otherwise(plain))
             .when(num.rlike(r"^\d{1,3}(,\d{3})+$"), plain)
             .when(num.rlike(r"^\d+(\.\d{3}){2,}$"), european)
             .otherwise(F.replace(num, F.lit(","), F.lit("."))))


_COUNT = r"(?i)(-?(?:[0-9]{1,3}(?:[,.' \u00a0\u202f][0-9]{3})+(?![0-9])|[0-9]+))([.,][0-9]+)?\s*([km](?!\p{L}))?"


def to_count(c) -> Column:
    """The first number of a text: '1,234' -> 1234, '1.5k' -> 1500, '12 of 30' -> 12, '-5' -> -5.

    A separator before exactly three digits is one of thousands; decimals are cut off. Text
    without digits and null give 0, a number beyond BIGINT null."""
    t = col_of(c).cast("string")
    whole = F.regexp_replace(F.regexp_extract(t, _COUNT, 1), r"[,.' \u00a0\u202f]", "")
    rest = F.replace(F.regexp_extract(t, _COUNT, 2), F.lit(","), F.lit("."))
    suffix = F.lower(F.regexp_extract(t, _COUNT, 3))
    scaled = F.concat(whole, rest).try_cast("decimal(38,9)") * F.when(suffix == "m", F.lit(1_000_000)).otherwise(F.lit(1000))
    number = F.when(suffix == "", whole.try_cast("bigint")).otherwise(scaled.try_cast("bigint"))
    return F.when(t.rlike("[0-9]"), number).otherwise(F.lit(0).cast("bigint"))


# How each external id is written in links.
ID_PATTERNS = {
    "imdb": r"tt(\d+)",
    "tmdb": r"themoviedb\.org/(?:movie|tv)/(\d+)",
    "tvdb": r"thetvdb\.com/.*?id=(\d+)",
    "douban": r"douban\.com/subject/(\d+)",
    "any": r"(\d+)",
}


def external_ids(c, kind: str = "any") -> Column:
    """Numeric id out of a link or ``tt`` code."""
    return F.regexp_extract(col_of(c), ID_PATTERNS[kind], 1).try_cast("bigint")


def infohash_or_magnet(c) -> Column:
    """The 40-hex info hash found in text or a magnet link, lower-cased ('' if none)."""
    return F.lower(F.regexp_extract(col_of(c), r"([A-Fa-f0-9]{40})", 1))


def magnet_name(c) -> Column:
    """Display name (``dn``) of a magnet link, percent-decoded."""
    return F.try_url_decode(F.regexp_extract(col_of(c), r"[?&]dn=([^&]*)", 1))


def volume_factors(c, flags: Column | None = None, default: float = 1.0) -> Column:
    """N9: '75%' off -> 0.25 download factor; '2x' -> 2.0; plain number kept.
    A true ``flags`` Column (freeleech marker) forces 0."""
    t = F.trim(col_of(c).cast("string"))
    pct = F.regexp_extract(t, r"^(\d+(?:\.\d+)?)\s*%$", 1).try_cast("double")
    mult = F.regexp_extract(t, r"^(\d+(?:\.\d+)?)\s*[xX]$", 1).try_cast("double")
    v = (F.when(pct.isNotNull(), F.lit(1.0) - pct / 100.0)
         .when(mult.isNotNull(), mult)
         .otherwise(t.try_cast("double")))
    v = F.coalesce(v, F.lit(default))
    return F.when(flags, F.lit(0.0)).otherwise(v) if flags is not None else v


def genre_array(c) -> Column:
    """N11: 'Science Fiction, Drama' -> ['Science_Fiction', 'Drama'] (distinct, order kept)."""
    parts = F.split(col_of(c), r"\s*[,|/;]\s*")
    cleaned = F.transform(parts, lambda p: F.regexp_replace(F.trim(p), r"\s+", "_"))
    return F.array_distinct(F.filter(cleaned, lambda p: p != ""))


def to_boolean(c) -> Column:
    """N12: 'True'/'false'/'1'/'on'/'yes' -> boolean; other text -> null."""
    t = F.lower(F.trim(col_of(c).cast("string")))
    return (F.when(t.isin("true", "1", "yes", "on", "checked"), F.lit(True))
            .when(t.isin("false", "0", "no", "off", ""), F.lit(False)))


def resolve_url(c, base) -> Column:
    """A link -> absolute, with ``base`` (the source's first link) as a folder."""
    return resolve_reference(c, F.concat(F.rtrim(lit_str(base), F.lit("/")), F.lit("/")))


# The parts of a reference as RFC 3986, appendix B splits them.
_REFERENCE = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def remove_dot_segments(path: Column) -> Column:
    """'/a/b/../c/./d' -> '/a/c/d': a fold over the parts of an absolute path; '..' at the root
    stays at the root, and a final dot segment leaves its folder."""
    parts = F.split(path, "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(
        p == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).when(p == ".", done).otherwise(F.concat(done, F.array(p))))
    last = F.element_at(parts, -1)
    return F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def resolve_reference(c, base) -> Column:
    """A reference against the address of the document that holds it, as RFC 3986, 5.2 has it.
    References with a scheme (``mailto:``, ``magnet:``) are absolute and stay as they are; a null
    reference or base gives null."""
    x, b = col_of(c), lit_str(base)
    of = lambda text, i: F.regexp_extract(text, _REFERENCE, i)
    path, base_path = of(x, 3), of(b, 3)
    origin = F.concat(of(b, 1), F.lit("://"), of(b, 2))
    query = F.regexp_extract(x, r"^[^?#]*(\?[^#]*)", 1)
    fragment = F.regexp_extract(x, r"(#.*)$", 1)
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    merged = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path)
    at = (F.when(path == "", F.concat(base_path, F.when(query == "", F.regexp_extract(b, r"^[^?#]*(\?[^#]*)", 1)).otherwise(query)))
          .when(path.startswith("/"), F.concat(remove_dot_segments(path), query))
          .otherwise(F.concat(remove_dot_segments(merged), query)))
    other_host = F.concat(of(b, 1), F.lit("://"), of(x, 2), F.when(path == "", path).otherwise(remove_dot_segments(path)), query, fragment)
    return (F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), x).when(x.startswith("//"), other_host)
            .otherwise(F.concat(origin, at, fragment)))
