from __future__ import annotations

import os

import pytest
from conftest import TINY, same_rows

from tidemark.plans.queries import ORACLE_SQL, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TINY), reason="no test data")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, TINY)
    if name in ORACLE_SQL:
        same_rows(df, oracle, ORACLE_SQL[name])
    else:
        assert len(df.columns) > 1 and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())
