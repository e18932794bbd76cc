"""Property tests (hypothesis): chain composition, date round trips, size round trips."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.functions import chain as C
from feedloom.functions import dates as D
from feedloom.functions import normalise as N
from feedloom.plans.q_chain import ROUND_TRIP_FORMATS

STEPS = [("replace", "a", "bb"), ("tolower",), ("toupper",), ("trim",), ("append", "!"), ("prepend", "<"),
         ("re_replace", r"[0-9]+", "#"), ("split", " ", 0), ("split", " ", -1), ("diacritics",),
         ("htmlencode",), ("htmldecode",), ("validfilename",)]
TEXT = st.text(alphabet=st.sampled_from(list("abcAB Éé019&<>/:_ ")), max_size=24)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.sampled_from(STEPS), max_size=4), st.lists(st.sampled_from(STEPS), max_size=4),
       st.lists(TEXT, min_size=1, max_size=20))
def test_chain_concatenation_is_composition(spark, a, b, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(C.apply_chain("x", a + b).alias("l"),
                    C.apply_chain(C.apply_chain("x", a), b).alias("r")).collect()
    assert all(r.l == r.r for r in got)


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2029, 12, 31)),
                min_size=1, max_size=30))
def test_date_render_parse_round_trip(spark, stamps):
    df = spark.createDataFrame([(s.replace(microsecond=0, second=0),) for s in stamps], "ts timestamp_ntz")
    ts = F.col("ts").cast("timestamp")
    cols = []
    for i, (fmt, render, off) in enumerate(ROUND_TRIP_FORMATS):
        if off.strip():
            continue  # zone formats shift the instant; checked by the oracle query F18
        txt = F.concat(F.date_format(ts, render), F.lit(off))
        cols.append((D.f_dateparse(txt, fmt).cast("timestamp_ntz") == F.col("ts")).alias(f"ok{i}"))
    # formats with a time of day keep minutes; date-only ones are compared at day precision
    rows = df.select(*cols).collect()
    assert all(all(v for v in r) for r in rows)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 9999), st.sampled_from(["B", "KB", "MB", "GB", "TB"])),
                min_size=1, max_size=30))
def test_size_round_trip(spark, sizes):
    df = spark.createDataFrame([(n, u) for n, u in sizes], "n long, u string")
    power = {"B": 0, "KB": 1, "MB": 2, "GB": 3, "TB": 4}
    got = df.select(N.to_bytes(F.concat(F.col("n").cast("string"), F.lit(" "), F.col("u"))).alias("b"), "n", "u").collect()
    assert all(r.b == r.n * 1024 ** power[r.u] for r in got)
