"""Literal cases written beside the definitions (dates, sizes, filters), one per operator."""

import datetime as dt

from pyspark.sql import functions as F

from feedloom.functions import chain as C
from feedloom.functions import dates as D
from feedloom.functions import normalise as N
from feedloom.operators import fields as B
from tests.conftest import one

AS_OF = "2026-01-20 12:00:00"
X = "x"


def ts(spark, expr, v):
    return one(spark, expr.cast("timestamp_ntz"), value=v)


def test_date_feed_form(spark):
    assert ts(spark, D.f_dateparse(X, "ddd, dd MMM yyyy HH:mm:ss zzz"), "Sun, 18 Jan 2026 04:05:41 +0000") == \
        dt.datetime(2026, 1, 18, 4, 5, 41)


def test_date_text_form_glued_year_hour(spark):
    assert ts(spark, D.f_dateparse(X, "MMM d yyyyh:mm tt"), "Aug 6 20217:25 PM") == dt.datetime(2021, 8, 6, 19, 25)
    assert ts(spark, D.f_dateparse(X, "MMM d yyyy h:mm tt"), "Aug 6 2021 7:25 PM") == dt.datetime(2021, 8, 6, 19, 25)


def test_date_localised_with_zone(spark):
    v = D.attach_zone(D.localised_months(X, "ru"), "+03:00")
    assert ts(spark, D.f_dateparse(v, "d MMM yyyy, HH:mm zzz"), "25 май 2017, 18:41") == dt.datetime(2017, 5, 25, 15, 41)


def test_date_two_digit_year(spark):
    v = C.apply_chain(X, [("replace", "'", ""), ("replace", "th", "")])
    assert ts(spark, D.f_dateparse(v, "MMM. d yy"), "Apr. 18th '11") == dt.datetime(2011, 4, 18)
    assert ts(spark, D.f_dateparse(X, "dd/MM/yy"), "05/06/97") == dt.datetime(1997, 6, 5)


def test_date_no_year(spark):
    got = ts(spark, D.two_digit_and_partial_dates(X, "htt MMM. d", AS_OF), "7am Sep. 14")
    assert got == dt.datetime(2025, 9, 14, 7, 0)  # Sep 14 2026 is after as_of -> previous year
    got = ts(spark, D.two_digit_and_partial_dates(X, "MMM d", AS_OF), "Jan 3")
    assert got == dt.datetime(2026, 1, 3)


def test_date_iso(spark):
    assert ts(spark, D.to_timestamp_any(X, [], AS_OF), "2021-10-25T16:44:43Z") == dt.datetime(2021, 10, 25, 16, 44, 43)


def test_epoch(spark):
    assert ts(spark, D.to_timestamp_any(X, [], AS_OF), "1700000000") == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_fuzzy_yesterday(spark):
    assert ts(spark, D.f_fuzzytime(X, AS_OF), "Yesterday 6:00 AM") == dt.datetime(2026, 1, 19, 6, 0)
    assert ts(spark, D.f_fuzzytime(X, AS_OF), "today 23:15") == dt.datetime(2026, 1, 20, 23, 15)
    # 2026-01-20 is a Tuesday: the latest earlier Monday is the day before, Tuesday a week back
    assert ts(spark, D.f_fuzzytime(X, AS_OF), "Monday 10:00") == dt.datetime(2026, 1, 19, 10, 0)
    assert ts(spark, D.f_fuzzytime(X, AS_OF), "Tuesday") == dt.datetime(2026, 1, 13, 0, 0)


def test_relative(spark):
    assert ts(spark, D.f_timeago(X, AS_OF), "2 days") == dt.datetime(2026, 1, 18, 12, 0)
    assert ts(spark, D.f_timeago(X, AS_OF), "1 week, 3 hours ago") == dt.datetime(2026, 1, 13, 9, 0)
    assert ts(spark, D.f_timeago(X, AS_OF), "just now") == dt.datetime(2026, 1, 20, 12, 0)
    assert ts(spark, D.f_timeago(X, AS_OF), "3 fortnights") is None


def test_sizes(spark):
    assert one(spark, N.to_bytes(X), value="512 MB") == 536870912
    assert one(spark, N.to_bytes(X), value="1 ГБ") == 1073741824
    assert one(spark, N.to_bytes(X), value="1.5 GB") == 1610612736
    assert one(spark, N.to_bytes(X), value="1,024 KiB") == 1048576
    assert one(spark, N.to_bytes(X), value="no size") is None


def test_split(spark):
    assert one(spark, C.f_split(X, "=", -1), value="x=1_2") == "1_2"
    assert one(spark, C.f_split(X, "/", 3), value="abc") == ""
    assert one(spark, C.f_split(X, "/", 0), value="a/b") == "a"


def test_querystring(spark):
    assert one(spark, C.f_querystring(X, "cat"), value="browse.php?cat=5&a=b") == "5"
    assert one(spark, C.f_querystring(X, "cat[]"), value="/x?c=1&cat[]=5") == "5"
    assert one(spark, C.f_querystring(X, "zz"), value="browse.php?cat=5") == ""


def test_regexp_group(spark):
    assert one(spark, C.f_regexp(X, r"\[(\d+)\]"), value="src[12]") == "12"
    assert one(spark, C.f_regexp(X, r"\[(\d+)\]"), value="none") == ""


def test_keyword_rewrite(spark):
    steps = [("re_replace", r"(?i)\bS0?(\d+)E0?(\d+)\b", "сезон $1 сері $2")]
    assert one(spark, C.apply_chain(X, steps), value="Show S01E02") == "Show сезон 1 сері 2"


def test_title_cleanup(spark):
    rules = [(r"(?i)\bSeasons?\s+(\d)-(\d)\b", "S0$1-S0$2")]
    assert one(spark, C.f_cleanup_titles(X, rules), value="Seasons 1-2") == "S01-S02"


def test_case_percent(spark):
    assert one(spark, N.volume_factors(X), value="75%") == 0.25
    assert one(spark, N.volume_factors(X), value="2x") == 2.0
    assert one(spark, N.volume_factors(X), value="") == 1.0
    assert one(spark, B.case_value(X, {"0%": 1.0, "50%": 0.5, "*": 0.0}), value="50%") == 0.5
    assert one(spark, B.case_value(X, {"true": "yes", "*": "no"}), value="True") == "yes"


def test_htmldecode_twice(spark):
    assert one(spark, C.apply_chain(X, [("htmldecode",), ("htmldecode",)]), value="&amp;amp;") == "&"
    assert one(spark, C.f_htmldecode(X), value="&amp;amp;") == "&amp;"


def test_htmldecode_full_udf(spark):
    assert one(spark, C.f_htmldecode(X, full=True), value="caf&eacute; &#233; &#x41;") == "café é A"


def test_validate(spark):
    assert one(spark, C.f_validate(X, ["action", "drama"]), value="Action, Foo, Drama") == "Action,Drama"


def test_diacritics_and_filename(spark):
    assert one(spark, C.f_diacritics(X), value="Ère été Ñandú") == "Ere ete Nandu"
    assert one(spark, C.f_validfilename(X), value='a<b>:c"d/e\\f|g?h*') == "a_b__c_d_e_f_g_h_"


def test_url_codecs(spark):
    assert one(spark, C.f_urlencode(X), value="a b*~") == "a%20b%2A~"
    assert one(spark, C.f_urldecode(X), value="a%20b") == "a b"
    assert one(spark, C.f_urldecode(X), value="100%%") is None


def test_trim_case(spark):
    assert one(spark, C.f_trim(X, "-*"), value="--a*b--") == "a*b"
    assert one(spark, C.f_tolower(X), value="ÀB") == "àb"
    assert one(spark, C.f_toupper(X), value="àb") == "ÀB"


def test_json_join_array(spark):
    assert one(spark, C.f_jsonjoinarray(X, "$.a.b", ", "), value='{"a": {"b": ["x", "y"]}}') == "x, y"


def test_ids_and_hashes(spark):
    assert one(spark, N.external_ids(X, "imdb"), value="https://www.imdb.com/title/tt0133093/") == 133093
    h = "0123456789abcdef0123456789ABCDEF01234567"
    assert one(spark, N.infohash_or_magnet(X), value=f"magnet:?xt=urn:btih:{h}&dn=x") == h.lower()
    assert one(spark, N.magnet_name(X), value=f"magnet:?xt=urn:btih:{h}&dn=Big%20File&tr=x") == "Big File"


def test_counts_booleans_urls(spark):
    assert one(spark, N.to_count(X), value="1,234 seeders") == 1234
    assert one(spark, N.to_count(X), value="-") == 0
    assert one(spark, N.to_boolean(X), value="True") is True
    assert one(spark, N.to_boolean(X), value="maybe") is None
    assert one(spark, N.resolve_url(X, "https://site.example/"), value="/t/1") == "https://site.example/t/1"
    assert one(spark, N.resolve_url(X, "https://site.example/"), value="magnet:?xt=1") == "magnet:?xt=1"
    assert one(spark, F.array_join(N.genre_array(X), "|"), value="Science Fiction, Drama,Drama") == \
        "Science_Fiction|Drama"


def test_chain_concatenation_is_composition(spark):
    a = [("replace", "a", "b"), ("toupper",)]
    b = [("re_replace", r"B+", "x"), ("append", "!")]
    v = "aaBc abc"
    assert one(spark, C.apply_chain(X, a + b), value=v) == one(spark, C.apply_chain(C.apply_chain(X, a), b), value=v)
