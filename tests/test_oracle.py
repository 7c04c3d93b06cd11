"""Every registered query of the library's own operators against its SQL."""

import pytest

from oracle import both
from quern.plans import registered

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registered.ORACLE_SQL))
def test_same_rows(spark, name):
    mine, theirs = both(spark, registered.QUERIES[name], registered.ORACLE_SQL[name], SF)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(registered.QUERIES) - set(registered.ORACLE_SQL)))
def test_runs(spark, name):
    assert registered.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
