"""Every query with SQL gives the rows DuckDB gives."""

import oracle
import pytest

from sigloom.plans import catalog


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, con, name):
    oracle.same(catalog.queries()[name](spark, sf), con, catalog.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["event_type", "nation", "n_signals", "max_severity", "first_ts", "last_ts", "rank", "status"]
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
