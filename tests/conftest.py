import os

import pytest

from tallyspan.session import local_session

DATA = os.environ.get("TALLYSPAN_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4, "tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    return DATA


@pytest.fixture(scope="session")
def one(spark):
    """Values of a column expression over a list of texts."""

    def run(values, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        from pyspark.sql import functions as F

        return [r[0] for r in df.orderBy("i").select(expression(F.col("c")).alias("v")).collect()]

    return run
