"""Date and time parsing.

Formats arrive in the definitions' .NET style and are mapped to Java patterns once,
on the driver; the parse itself is ``try_to_timestamp`` inside the JVM. ``now`` and
``today`` are always the explicit ``as_of`` argument, never the wall clock, so a
query gives the same answer whenever it runs.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of

# ----------------------------------------------------------------------------- as_of


def as_of_col(as_of) -> Column:
    """``as_of`` as a TIMESTAMP Column (session zone UTC). Accepts Column, datetime, text."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(str(as_of)))


# ----------------------------------------------------------------------------- formats

_WEEKDAY_FMT = re.compile(r"^\s*dddd?,?\s*")


def java_pattern(fmt: str) -> tuple[str, bool]:
    """.NET date format -> (Java pattern, weekday must be stripped from the value).

    Token map: ``tt`` -> ``a``, ``zzz`` -> ``XXX``; a leading ``ddd``/``dddd`` weekday is
    removed (Spark refuses ``E`` when parsing); the rest carries over unchanged.
    """
    strip = bool(_WEEKDAY_FMT.match(fmt))
    f = _WEEKDAY_FMT.sub("", fmt) if strip else fmt
    f = f.replace("tt", "a").replace("zzz", "XXX")
    f = f.replace("yyyyh", "yyyy h")  # glued year/hour; the value gets a blank too
    f = f.replace("T", "'T'") if "T" in f and "'T'" not in f else f
    return f, strip


_WEEKDAY_VALUE = r"^\s*\p{L}+\.?,?\s*"


def _prepare_value(c: Column, fmt: str, strip_weekday: bool) -> Column:
    v = F.trim(c)
    if strip_weekday:
        v = F.regexp_replace(v, _WEEKDAY_VALUE, "")
    if "yyyyh" in fmt:
        v = F.regexp_replace(v, r"(\d{4})(\d{1,2}:)", "$1 $2")
    return v


_TOKEN = re.compile(r"'[^']*'|([A-Za-z])\1*|.", re.S)
_DIGIT_LETTERS = set("yYuMLdDHhKkmsSnNAQqwWeFc")


def shape_regex(jfmt: str) -> str:
    """A loose regex every text that the Java pattern can parse also matches.

    It is a necessary condition only (digit fields take 1-9 digits, text fields any
    non-digit run), used to skip parses that would fail: a failed ``try_to_timestamp``
    costs a JVM exception per row, a failed ``rlike`` costs nothing."""
    out = []
    for m in _TOKEN.finditer(jfmt):
        tok = m.group(0)
        if tok.startswith("'"):
            out.append(re.escape(tok[1:-1] or "'"))
        elif tok[0].isalpha():
            c = tok[0]
            if c in ("X", "x", "Z", "O", "V", "z"):
                out.append(r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?|[A-Za-z/_]+)")
            elif c == "M" and len(tok) >= 3 or c in ("a", "E", "G", "B"):
                out.append(r"[^\s0-9]+")
            elif c in _DIGIT_LETTERS:
                out.append(r"[0-9]{1,9}")
            else:
                out.append(r".+?")
        elif tok.isspace():
            out.append(r"\s+")
        else:
            out.append(re.escape(tok))
    return "^" + "".join(out) + "$"


def _try_parse(v: Column, jfmt: str, guard: bool = False) -> Column:
    """+08:00 and +0800 are different Java tokens: the zone form of the value picks XXX
    or xx (one cheap test instead of a failed parse). With ``guard``, values of the wrong
    shape are not parsed at all: for candidate lists where most formats do not fit."""
    if "XXX" in jfmt:
        colon = v.rlike(r"[+-][0-9]{2}:[0-9]{2}$") | v.endswith("Z")
        parsed = F.when(colon, F.try_to_timestamp(v, F.lit(jfmt))).otherwise(
            F.try_to_timestamp(v, F.lit(jfmt.replace("XXX", "xx"))))
    else:
        parsed = F.try_to_timestamp(v, F.lit(jfmt))
    return F.when(v.rlike(shape_regex(jfmt)), parsed) if guard else parsed


# Two-digit years: 00-29 are 20xx, 30-99 are 19xx (the .NET calendar window).
TWO_DIGIT_YEAR_MAX = 2029


def f_dateparse(c, fmt: str, guard: bool = False) -> Column:
    """parse text with a .NET-style format; null when it does not parse.
    ``guard`` skips values whose shape cannot fit the format (see ``shape_regex``)."""
    jfmt, strip = java_pattern(fmt)
    ts = _try_parse(_prepare_value(col_of(c), fmt, strip), jfmt, guard)
    if "yy" in fmt and "yyyy" not in fmt:
        ts = F.when(F.year(ts) > TWO_DIGIT_YEAR_MAX,
                    ts - F.make_ym_interval(F.lit(100), F.lit(0))).otherwise(ts)
    return ts


def f_timeparse(c, fmt: str, as_of) -> Column:
    """a time of day -> that time on the ``as_of`` date."""
    jfmt, strip = java_pattern(fmt)
    v = F.concat(F.date_format(as_of_col(as_of), "yyyy-MM-dd"), F.lit(" "),
                 _prepare_value(col_of(c), fmt, strip))
    return _try_parse(v, "yyyy-MM-dd " + jfmt)


# ----------------------------------------------------------------------------- relative

_AGO_PAIR = r"([0-9]+(?:\.[0-9]+)?)\s*([^0-9\s.]+)"


def _unit_seconds(u: Column) -> Column:
    """Seconds per unit name; null for an unknown unit (the whole value is then null)."""
    return (F.when(u.contains("sec") | (u == "s"), F.lit(1.0))
            .when(u.contains("min") | (u == "m"), F.lit(60.0))
            .when(u.contains("hour") | u.contains("hr") | (u == "h"), F.lit(3600.0))
            .when(u.contains("day") | (u == "d"), F.lit(86400.0))
            .when(u.contains("week") | u.contains("wk") | (u == "w"), F.lit(604800.0))
            .when(u.contains("month") | (u == "mo"), F.lit(30 * 86400.0))
            .when(u.contains("year") | (u == "y"), F.lit(365 * 86400.0)))


def ago_seconds(c) -> Column:
    """'2 days 4 hours ago' -> 187200.0 (month = 30 days, year = 365 days)."""
    t = F.lower(col_of(c))
    # a comma between digits is a decimal one, or one of thousands if it stands before three digits
    t = F.regexp_replace(F.regexp_replace(t, r"(?<=\d),(?=\d{3}(?!\d))", ""), r"(?<=\d),(?=\d)", ".")
    t = F.regexp_replace(t, r",|\bago\b|\band\b", " ")
    amounts = F.regexp_extract_all(t, F.lit(_AGO_PAIR), 1)
    units = F.regexp_extract_all(t, F.lit(_AGO_PAIR), 2)
    secs = F.zip_with(amounts, units, lambda a, u: a.cast("double") * _unit_seconds(u))
    total = F.aggregate(secs, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(amounts) > 0, total)


def _minus_seconds(as_of: Column, secs: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(as_of) - F.round(secs * 1_000_000).cast("bigint"))


_NOW_RE = r"\bnow\b"


def f_timeago(c, as_of) -> Column:
    """relative text -> ``as_of`` minus the amount; the word ``now`` -> ``as_of``."""
    a = as_of_col(as_of)
    t = F.lower(col_of(c))
    return F.when(t.rlike(_NOW_RE), a).otherwise(_minus_seconds(a, ago_seconds(t)))


def f_reltime(c, as_of) -> Column:
    """legacy name of F20."""
    return f_timeago(c, as_of)


# ----------------------------------------------------------------------------- fuzzy

# English weekday names, Monday first (ISO day numbers 1..7).
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*(am|pm)?"


def time_of_day_seconds(t: Column) -> Column:
    """'6:00 am' -> 21600; no time -> 0. One regex finds the time; its parts are split."""
    tm = F.regexp_extract(t, _TIME, 0)
    parts = F.split(F.regexp_replace(tm, r"\s*[ap]m$", ""), ":")
    h = F.coalesce(F.try_element_at(parts, F.lit(1)).try_cast("int"), F.lit(0))
    m = F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("int"), F.lit(0))
    s = F.coalesce(F.try_element_at(parts, F.lit(3)).try_cast("int"), F.lit(0))
    hh = F.when(tm.endswith("pm"), h % 12 + 12).when(tm.endswith("am"), h % 12).otherwise(h)
    return hh * 3600 + m * 60 + s


def _at_day(as_of: Column, days_back: Column, tod: Column) -> Column:
    midnight = F.to_date(as_of).cast("timestamp")
    return F.timestamp_seconds(F.unix_seconds(midnight) - days_back * 86400 + tod)


# a day word with nothing but a time after it; a weekday before a full date is part of that date
_DAY_REST = r"[\s,.]*(?:(?:at|@)\s*)?(?:\d{1,2}:\d{2}(?::\d{2})?\s*(?:[ap]m)?)?$"
_TODAY_RE, _YESTERDAY_RE = r"^today" + _DAY_REST, r"^yesterday" + _DAY_REST
_WEEKDAY_RE = r"^(?:(?:last|on)\s+)?(" + "|".join(WEEKDAYS) + r")" + _DAY_REST
# a time without a day, and text that starts as an ISO date does
_BARE_TIME_RE = r"^t?\d{1,2}:\d{2}(:\d{2})?\s*([ap]m)?$"
_ISO_RE = r"^\d{4}-\d{1,2}"
_REL_RE = r"\bago\b|^\s*[0-9.]+\s*[a-z]+(\s+[0-9.]+\s*[a-z]+)*\s*$"


def f_fuzzytime(c, as_of, formats: list[str] | None = None) -> Column:
    """today / yesterday / weekday / relative / formatted / ISO text -> timestamp.

    Weekday names resolve to the latest earlier date with that weekday (1-7 days back),
    a [choice]; day words count only where nothing but a time follows. Unparseable text gives null. The input is read by every branch: pass a
    column (by name), not an expression, so the text is computed once per row.
    """
    a = as_of_col(as_of)
    t = F.lower(F.trim(col_of(c)))
    tod = time_of_day_seconds(t)
    # ISO day of week: monday = 1 .. sunday = 7, for the as_of date and the named day
    wd = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.regexp_extract(t, _WEEKDAY_RE, 1))
    dow_asof = (F.dayofweek(a) + 5) % 7 + 1
    back = ((dow_asof - wd + 6) % 7) + 1
    branches = (F.when(t.rlike(_NOW_RE), a)
                .when(t.rlike(_BARE_TIME_RE), _at_day(a, F.lit(0), tod))
                .when(t.rlike(_TODAY_RE), _at_day(a, F.lit(0), tod))
                .when(t.rlike(_YESTERDAY_RE), _at_day(a, F.lit(1), tod))
                .when(wd > 0, _at_day(a, back, tod))
                .when(F.regexp_replace(t, r"\s+", " ").rlike(_REL_RE), _minus_seconds(a, ago_seconds(t))))
    parsed = [f_dateparse(col_of(c), f, guard=True) for f in (formats or [])]
    return F.coalesce(branches, *parsed, _iso(F.trim(col_of(c))))


# ----------------------------------------------------------------------------- N2-N5


def _iso(x: Column) -> Column:
    """ISO text only: other shapes (a bare time, a number) would take the wall clock's day or a year."""
    return F.when(x.rlike(_ISO_RE), F.try_to_timestamp(x))


def to_timestamp_any(c, formats: list[str] | None, as_of) -> Column:
    """Epoch seconds / millis, ISO-8601, formatted, relative, ``now``. Pass a column,
    not an expression: every candidate reads it."""
    x = F.trim(col_of(c))
    epoch = (F.when(x.rlike(r"^\d{1,11}$"), F.timestamp_seconds(x.try_cast("bigint")))
             .when(x.rlike(r"^\d{12,13}$"), F.timestamp_millis(x.try_cast("bigint"))))
    return F.coalesce(epoch, _iso(x),
                      *[f_dateparse(x, f, guard=True) for f in (formats or [])],
                      f_fuzzytime(x, as_of))


def attach_zone(c, offset: str) -> Column:
    """Append a fixed offset (``+08:00``) to zone-less text; parse with ``... zzz``."""
    return F.concat(F.trim(col_of(c)), F.lit(" " + offset))


def two_digit_and_partial_dates(c, fmt: str, as_of) -> Column:
    """Dates without a year get the ``as_of`` year, or the year before when that
    would be later than ``as_of`` [choice]; two-digit years parse in 2000-2099."""
    a = as_of_col(as_of)
    if "y" in fmt:
        return f_dateparse(c, fmt)
    with_year = F.concat(F.year(a).cast("string"), F.lit(" "), F.trim(col_of(c)))
    ts = f_dateparse(with_year, "yyyy " + fmt)
    return F.when(ts > a, ts - F.make_ym_interval(F.lit(1), F.lit(0))).otherwise(ts)


# Month names by language, January first. Russian carries nominative,
# genitive and short forms; each maps to the English short name at the same position.
MONTHS_EN = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
MONTH_NAMES = {
    "fr": ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
           "septembre", "octobre", "novembre", "décembre"],
    "de": ["Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August",
           "September", "Oktober", "November", "Dezember"],
    "es": ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
           "septiembre", "octubre", "noviembre", "diciembre"],
    "ru": ["январь", "февраль", "март", "апрель", "май", "июнь", "июль", "август",
           "сентябрь", "октябрь", "ноябрь", "декабрь"],
    "ru_gen": ["января", "февраля", "марта", "апреля", "мая", "июня", "июля", "августа",
               "сентября", "октября", "ноября", "декабря"],
    "ru_short": ["янв", "фев", "мар", "апр", "май", "июн", "июл", "авг", "сен", "окт", "ноя", "дек"],
}
LANG_FORMS = {"fr": ["fr"], "de": ["de"], "es": ["es"], "ru": ["ru_gen", "ru", "ru_short"]}


def localised_months(c, lang: str | list[str]) -> Column:
    """A month name of ``lang`` (one language or several) -> the English short name
    (whole word, case-insensitive).

    One regex finds the name (longest alternatives first, so a short form never cuts a
    long one), a map lookup gives the English name, and a literal replace puts it in:
    a single pass per row however many names the languages have."""
    langs = [lang] if isinstance(lang, str) else list(lang)
    names: dict[str, str] = {}
    for lg in langs:
        for form in LANG_FORMS[lg]:
            for n, en in zip(MONTH_NAMES[form], MONTHS_EN):
                names.setdefault(n.lower(), en)
    alt = "|".join(re.escape(n) for n in sorted(names, key=lambda n: -len(n)))
    pat = r"(?iu)(?<!\p{L})(?:" + alt + r")\.?(?!\p{L})"
    lookup = F.create_map(*[x for n, en in names.items() for x in (F.lit(n), F.lit(en))])
    x = col_of(c)
    whole = F.regexp_extract(x, pat, 0)
    en = F.element_at(lookup, F.lower(F.rtrim(whole, F.lit("."))))
    return F.when(whole != "", F.replace(x, whole, en)).otherwise(x)


# ----------------------------------------------------------------------------- formats by row

#: Distinct (format, zone, language) combinations that one dispatch holds, at most.
MOST_FORMATS = 1000


def parse_by_source(df: DataFrame, text: str, specs: DataFrame, on: str = "source", out: str = "parsed") -> DataFrame:
    """F18, N3, N5 for a table of many sources: every row's ``text`` is parsed by the formats of
    its source. ``specs`` is (source, seq, format, zone, lang), a definition-sized dimension: formats
    are tried by ``seq``, ``zone`` (``+03:00``, or null) is attached to the text, and ``lang`` (or
    null) names the language of its months. Sources without specs and texts that fit none give
    null; rows are neither lost nor repeated.

    The distinct combinations are read once and become one CASE whose branches have literal
    formats, so no formatter is built per row; the dimension joins the records by source."""
    specs = specs.where(F.col(on).isNotNull() & F.col("format").isNotNull())
    combos = [tuple(r) for r in specs.select("format", "zone", "lang").distinct().limit(MOST_FORMATS + 1).collect()]
    if len(combos) > MOST_FORMATS:
        raise ValueError(f"more than {MOST_FORMATS} date formats")
    combos.sort(key=lambda c: tuple(x or "" for x in c))
    numbers = F.create_map(*[x for i, c in enumerate(combos) for x in (F.lit("\x00".join(x or "" for x in c)), F.lit(i))]) if combos else None
    lists = (specs.select(on, "seq", F.element_at(numbers, F.concat_ws("\x00", "format", F.coalesce("zone", F.lit("")), F.coalesce("lang", F.lit("")))).alias("n"))
                  .groupBy(on).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "n"))), lambda s: s["n"]).alias("_formats"))) if combos else None
    if lists is None:
        return df.withColumn(out, F.lit(None).cast("timestamp"))

    def parse(x: Column, number: Column) -> Column:
        case = F.lit(None).cast("timestamp")
        for i, (fmt, zone, lang) in enumerate(combos):
            v = localised_months(x, lang) if lang else x
            done = f_dateparse(attach_zone(v, zone), f"{fmt} zzz", guard=True) if zone else f_dateparse(v, fmt, guard=True)
            case = F.when(number == i, done) if i == 0 else case.when(number == i, done)
        return case

    most = lists.agg(F.max(F.size("_formats"))).first()[0] or 0
    joined = df.join(lists, on, "left")
    tries = [parse(F.col(text), F.get("_formats", F.lit(k))) for k in range(most)]
    return joined.withColumn(out, F.coalesce(*tries) if tries else F.lit(None).cast("timestamp")).select(
        *[c for c in df.columns if c.lower() != out.lower()], out)
