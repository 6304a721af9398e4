"""Every query against its DuckDB SQL on the smallest tables; the others run and give rows."""

import pytest
from conftest import TINY
from oracle import compare

from firmlens.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, name):
    compare(spark, TINY, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, TINY).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
