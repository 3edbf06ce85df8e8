"""Every query of the core runs, and equals its oracle SQL where it has one."""

import pytest

from tallyspan.plans import registry
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, data, name):
    compare(spark, data, registry.QUERIES[name], registry.SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, data, name):
    df = registry.QUERIES[name](spark, data)
    rows = df.collect()
    assert len(rows) == len(set(map(str, rows))) or name == "p4_unified"


def test_entry_point(spark, data):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    for n in range(1, 7):
        assert any(q.startswith(f"p{n}_") for q in e.queries()) or n in (2, 3)
