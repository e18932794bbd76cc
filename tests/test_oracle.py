"""Every registered query against its DuckDB oracle on the smallest test tables."""

import datetime as dt
import math

import duckdb
import pytest

from feedloom.plans import oracle_sql, queries
from feedloom.plans.tables import TABLES
from tests.conftest import SMOKE


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_key_has_sql_or_is_listed():
    no_sql = set(queries()) - set(oracle_sql())
    assert not no_sql, no_sql


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SMOKE)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(oracle_sql()[key])
    want = _digest([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
