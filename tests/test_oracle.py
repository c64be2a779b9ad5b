"""Every core query with an oracle equals DuckDB on the smallest tables; the others run."""

import pytest

from compare import assert_equal
from quern.plans.oracle import SQL
from quern.plans.queries import Q


@pytest.mark.parametrize("name", sorted(Q))
def test_query(spark, sf, name):
    df = Q[name](spark, sf)
    if name in SQL:
        assert_equal(df, SQL[name], sf)
    else:
        df.collect()


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
