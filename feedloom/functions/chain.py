"""The scalar filter chain (F1-F17, F23, F24) and ``apply_chain``.

Every filter is ``Column -> Column`` and runs inside the JVM (whole-stage codegen);
a chain folds into one expression, so a chain over a whole table is one projection.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of, let, lit_str, s

# --------------------------------------------------------------------------- F1-F3


def f_re_replace(c, pattern, replacement) -> Column:
    """replace every match; ``$n`` names a group (Java regex)."""
    return F.regexp_replace(col_of(c), pattern, replacement)


def _group_count(pattern: str) -> int:
    try:
        return re.compile(pattern).groups
    except re.error:  # Java-only syntax; assume a capture group is present
        return 1


def f_regexp(c, pattern: str) -> Column:
    """first match, group 1 (whole match if the pattern has no group); '' when absent."""
    idx = 1 if _group_count(pattern) >= 1 else 0
    return F.regexp_extract(col_of(c), pattern, idx)


def f_replace(c, old: str, new: str) -> Column:
    """literal replace all."""
    return F.replace(col_of(c), lit_str(old), lit_str(new))


# --------------------------------------------------------------------------- F4-F9


def f_append(c, x) -> Column:
    """suffix; ``x`` may be a Column (another field)."""
    return F.concat(s(c), s(lit_str(x)))


def f_prepend(c, x) -> Column:
    """prefix."""
    return F.concat(s(lit_str(x)), s(c))


def f_split(c, sep: str, index: int) -> Column:
    """split on a literal and take part ``index`` (0-based; negative counts from the end).

    A part that does not exist gives ''. ``split_part`` never throws out of range,
    unlike ``split(..)[i]`` under ANSI mode.
    """
    part = index + 1 if index >= 0 else index
    return F.split_part(col_of(c), F.lit(sep), F.lit(part))


def f_trim(c, chars: str | None = None) -> Column:
    """trim blanks, or the given characters, at both ends."""
    return F.trim(col_of(c)) if chars is None else F.trim(col_of(c), F.lit(chars))


def f_tolower(c) -> Column:
    """F8."""
    return F.lower(col_of(c))


def f_toupper(c) -> Column:
    """F9."""
    return F.upper(col_of(c))


# --------------------------------------------------------------------------- F10-F14


def f_querystring(c, name: str) -> Column:
    """value of query parameter ``name``; works on relative URLs and ``c[]=5`` forms."""
    return F.regexp_extract(col_of(c), r"[?&]" + re.escape(name) + r"=([^&#]*)", 1)


def f_urldecode(c) -> Column:
    """percent-decode; null on malformed escapes."""
    return F.try_url_decode(col_of(c))


def f_urlencode(c) -> Column:
    """percent-encode with the RFC 3986 unreserved set (``A-Za-z0-9-._~`` kept, blank
    as %20). ``url_encode`` is form encoding, so three characters are adjusted."""
    out = F.url_encode(col_of(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


# The core HTML entities and the text they stand for (&amp; decoded last,
# encoded first, so a double-escaped ``&amp;amp;`` needs two decodes).
HTML_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


# Names that the HTML standard also takes without their semicolon; not before a letter, digit or
# "=", where they may be the next parameter of a link.
_BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
_ENTITY = rf"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{_BARE_NAMES})(?![A-Za-z0-9=]))"
# Shards of the name table: a literal map is searched in order.
_NAME_SHARDS = 64


def f_htmldecode(c, full: bool = False) -> Column:
    """decode entities.

    ``full=False``: the core named entities, one after another.
    ``full=True``: every named and numeric entity in one pass over the text, so decoded text is
    not decoded again; unknown names and impossible numbers stay as they are. Numbers may have any
    count of digits, numbers and the old names may lack the semicolon.
    """
    if full:
        return let(c, lambda text: F.when(text.contains("&"), _decode_all(text)).otherwise(text))
    out = col_of(c)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


# Two of Unicode's noncharacters, put around every entity of a text while its kinds are replaced.
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"
# More kinds of entities than this in a text are looked up one by one, not replaced kind by kind.
_MOST_KINDS = 64


def _decode_all(text: Column) -> Column:
    """Every entity of a text, each kind of them read once. A few kinds are marked and replaced kind
    after kind, where the marks keep decoded text apart from entities; texts that hold the marks
    themselves, decoded or not, and those of many kinds are put together from their pieces."""
    marked = lambda t: t.contains(_OPEN) | t.contains(_CLOSE)
    kinds = F.array_distinct(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)))
    pairs = F.transform(kinds, lambda e: F.struct(e.alias("kind"), _entity_text(e).alias("text")))

    def replaced(of: Column) -> Column:
        return F.aggregate(of, F.regexp_replace(text, _ENTITY, f"{_OPEN}$0{_CLOSE}"), lambda done, k: F.replace(
            done, F.concat(F.lit(_OPEN), k["kind"], F.lit(_CLOSE)), k["text"]))

    def pieced(of: Column) -> Column:
        between, found = F.split(text, _ENTITY, -1), F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0))
        return let(F.map_from_entries(of), lambda m: F.array_join(
            F.zip_with(between, found, lambda t, e: F.concat(t, F.coalesce(m[e], F.lit("")))), ""))

    plain = lambda of: (F.size(of) <= _MOST_KINDS) & ~marked(text) & ~F.exists(of, lambda k: marked(k["text"]))
    return let(pairs, lambda of: F.when(plain(of), replaced(of)).otherwise(pieced(of)))


@lru_cache(maxsize=1)
def _entity_names() -> str:
    """The names of the HTML standard's list and their text, as SQL: maps by the checksum of the name."""
    shards: list[list[str]] = [[] for _ in range(_NAME_SHARDS)]
    for name, text in sorted(html5.items()):
        if name.endswith(";"):
            quoted = text.replace("\\", "\\\\").replace("'", "\\'")
            shards[zlib.crc32(name[:-1].encode()) % _NAME_SHARDS].append(f"'{name[:-1]}', '{quoted}'")
    return "array(" + ", ".join(f"map({', '.join(x)})" for x in shards) + ")"


def _entity_text(e: Column) -> Column:
    """The text of one entity: a number's character (0x80-0x9F as in windows-1252, as browsers do), or
    that of a name."""
    inner = F.rtrim(F.substr(e, F.lit(2)), F.lit(";"))
    is_hex, is_number = inner.rlike("^#[xX]"), inner.startswith("#")
    digits = F.ltrim(F.when(is_hex, F.substr(inner, F.lit(3))).otherwise(F.substr(inner, F.lit(2))), F.lit("0"))
    short = F.when(F.length(digits).between(1, 7), digits)  # the longest character number has seven digits
    code = F.when(is_hex, F.conv(short, 16, 10)).otherwise(F.conv(F.when(is_number, short), 10, 10)).cast("long")
    fine = (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    windows = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")
    old = F.nullif(F.substr(F.lit(windows), (code - 0x7F).cast("int"), F.lit(1)), F.lit("\ufffd"))
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    number = F.when(code.between(0x80, 0x9F), F.coalesce(old, plain)).otherwise(plain)
    shard = F.element_at(F.expr(_entity_names()), (F.crc32(inner) % _NAME_SHARDS + 1).cast("int"))
    return F.when(is_number, F.when(F.coalesce(fine, F.lit(False)), number).otherwise(e)).otherwise(
        F.coalesce(F.try_element_at(shard, inner), e))


def f_htmlencode(c) -> Column:
    """encode ``& < > " '`` (``&`` first)."""
    out = col_of(c)
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(ch), F.lit(ent))
    return out


# --------------------------------------------------------------------------- F15-F17


def _accent_table() -> tuple[str, str]:
    """Latin letters U+00C0..U+024F and U+1E00..U+1EFF whose canonical decomposition starts with an ASCII
    letter map to that letter (built from the Unicode data, not written out)."""
    src, dst = [], []
    for cp in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_ACCENT_SRC, _ACCENT_DST = _accent_table()


def f_diacritics(c, mode: str = "replace") -> Column:
    """strip accents (mode ``replace``, the only one in use)."""
    if mode != "replace":
        raise ValueError(f"unsupported diacritics mode {mode!r}")
    # combining accents go, letters with a built-in accent become their base letter; texts of
    # ASCII alone hold neither
    x = col_of(c)
    return F.when(x.rlike(r"[^\x00-\x7F]"), F.translate(F.regexp_replace(x, r"[\u0300-\u036f]", ""), _ACCENT_SRC, _ACCENT_DST)).otherwise(x)


VALIDATE_SPLIT = r"[,;/|\s]+"


def f_validate(c, allowed: Iterable[str] | str) -> Column:
    """F16: keep the words found in ``allowed`` (case-insensitive), joined by ','. One string
    is a comma-separated list. If an allowed entry has several words, values are split at
    marks only, so that such an entry can match."""
    allowed = [a.strip() for a in allowed.split(",")] if isinstance(allowed, str) else list(allowed)
    allowed_l = F.array(*[F.lit(a.lower()) for a in allowed])
    several = any(" " in a for a in allowed)
    words = F.split(F.trim(col_of(c)) if several else col_of(c), r"\s*[,;/|]+\s*" if several else VALIDATE_SPLIT)
    kept = F.filter(words, lambda w: F.array_contains(allowed_l, F.lower(w)))
    return F.array_join(kept, ",")


# Characters not allowed in file names, each replaced by '_'.
INVALID_FILENAME_CHARS = '<>:"/\\|?*'


def f_validfilename(c) -> Column:
    """replace characters illegal in file names with '_'."""
    return F.translate(col_of(c), INVALID_FILENAME_CHARS, "_" * len(INVALID_FILENAME_CHARS))


# --------------------------------------------------------------------------- F23, F24


def f_jsonjoinarray(c, path: str, sep: str) -> Column:
    """JSON text -> array at ``path`` (``$.a.b``) -> joined text."""
    v = F.try_parse_json(col_of(c))
    arr = F.try_variant_get(v, path, "array<string>")
    return F.array_join(arr, sep)


def f_cleanup_titles(c, rules: Sequence[tuple[str, str]]) -> Column:
    """an ordered list of (pattern, replacement) rewrites folded into one Column."""
    out = col_of(c)
    for pat, rep in rules:
        out = F.regexp_replace(out, pat, rep)
    return out


#: What may follow a character and make it optional, and characters that are not themselves in a pattern.
_OPTIONAL, _SPECIAL = "?*{", "\\^$.|?*+()[]{}"


def required_literal(pattern: str | None) -> str | None:
    """The longest lower-cased ASCII text that every match of a regular expression holds, or None.

    Only plain characters outside groups and classes count; alternatives at the top level and
    flags beyond ``(?i)`` give None. This reads a pattern as Java's and Python's rules have in
    common and is never wrong in saying None."""
    p = re.sub(r"^\(\?i\)", "", pattern or "")
    best, run, depth, i = "", "", 0, 0
    while i < len(p):
        c, size = p[i], 1
        plain = None
        if c == "\\":
            if p[i + 1:i + 2] in ("", "Q", "E"):
                return None
            size = 2
            if p[i + 1] in "pPxukNcog0123456789":  # longer escapes: skip their braces as well
                rest = re.match(r"\\(?:[pPxukNog](?:\{[^}]*\}|<[^>]*>)|[pPNX].|x..|u....|c.|\d+|.)", p[i:], re.S)
                size = rest.end()
            elif not p[i + 1].isalnum():
                plain = p[i + 1]
        elif c == "[":
            size, inner = 1, 1
            while i + size < len(p) and inner:
                if p[i + size] == "\\":
                    size += 1
                else:
                    inner += {"[": 1, "]": -1 if size > 1 and not p[i + 1:i + size].strip("^") == "" else 0}.get(p[i + size], 0)
                size += 1
            if inner:
                return None
        elif c == "(":
            if p[i + 1:i + 2] == "?" and p[i + 2:i + 3] not in (":", "=", "!", "<", ">"):
                return None
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            return None
        elif c not in _SPECIAL:
            plain = c
        after = p[i + size:i + size + 1]
        if plain is not None and depth == 0 and plain.isascii() and after not in tuple(_OPTIONAL):
            run += plain
        else:
            best, run = max(best, run, key=len), ""
        if plain is not None and after == "+":
            best, run = max(best, run, key=len), ""
        i += size
    best = max(best, run, key=len).lower()
    return best or None


def cleanup_titles_by_source(df, col: str, rules, source: str = "source", out: str | None = None):
    """F24 with rules that differ per source: ``rules`` is a table
    ``(source, seq, pattern, replacement)``. The rules of a source become one ordered array,
    which is joined to its records and folded over the text; no rule passes the driver.

    Each rule carries the text that all its matches hold (``required_literal``), found once per
    rule. Where the text, as the rules before left it, lacks it, the regular expression is neither
    compiled nor run, so a source may have a thousand rules of which a row meets a few."""
    from pyspark.sql import types as T

    from ..session import ship_package

    ship_package(rules.sparkSession)
    literal = F.udf(lambda p: required_literal(p), T.StringType())  # on the rules, not on the records
    per = (rules.withColumn("literal", literal("pattern")).groupBy(source)
                .agg(F.array_sort(F.collect_list(F.struct("seq", "pattern", "replacement", "literal"))).alias("_rules")))
    joined = df.join(per, source, "left")
    none = F.array().cast(joined.schema["_rules"].dataType)
    folded = F.aggregate(F.coalesce("_rules", none), F.col(col), lambda acc, r: F.when(
        r["literal"].isNull() | F.lower(acc).contains(r["literal"]), F.regexp_replace(acc, r["pattern"], r["replacement"])).otherwise(acc))
    return joined.withColumn(out or col, folded).drop("_rules")


# --------------------------------------------------------------------------- apply_chain

Step = tuple | Callable[[Column], Column]


def _step_fn(name: str):
    from . import dates, normalise  # late: they import this module

    table = {
        "re_replace": f_re_replace, "regexp": f_regexp, "replace": f_replace,
        "append": f_append, "prepend": f_prepend, "split": f_split, "trim": f_trim,
        "tolower": f_tolower, "toupper": f_toupper, "querystring": f_querystring,
        "urldecode": f_urldecode, "urlencode": f_urlencode, "htmldecode": f_htmldecode,
        "htmlencode": f_htmlencode, "diacritics": f_diacritics, "validate": f_validate,
        "validfilename": f_validfilename, "jsonjoinarray": f_jsonjoinarray,
        "dateparse": dates.f_dateparse, "timeparse": dates.f_timeparse,
        "timeago": dates.f_timeago, "reltime": dates.f_reltime, "fuzzytime": dates.f_fuzzytime,
        "cleanup_titles": f_cleanup_titles, "to_bytes": normalise.to_bytes,
    }
    if name not in table:
        raise ValueError(f"unknown filter {name!r}")
    return table[name]


def apply_chain(c, steps: Sequence[Step]) -> Column:
    """Fold an ordered list of steps into a single Column.

    A step is ``(name, *args)`` naming a filter above, or any ``Column -> Column``.
    Steps run strictly in order. Concatenating two step lists equals composing them.
    """
    out = col_of(c)
    for st in steps:
        if callable(st):
            out = st(out)
        else:
            name, *args = st
            out = _step_fn(name)(out, *args)
    return out
