import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import build_session

    s = build_session("local[*]", app="feedloom-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE


def one(spark, expr, schema="x string", value=None):
    """Evaluate a Column built from column ``x`` on a one-row frame."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).collect()[0]["r"]
