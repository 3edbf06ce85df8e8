"""Every query of the subpackage runs, and equals its oracle SQL where it has one."""

import os

import pytest

from tallyspan.llm import bpe, queries
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, data, name):
    compare(spark, data, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, data, name):
    if name[:2] in ("p7", "p8") and not os.path.exists(bpe.RANKS_PATH):
        pytest.skip("no rank file here")
    df = queries.QUERIES[name](spark, data)
    assert df.count() > 0
