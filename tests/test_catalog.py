"""Each registered query of the fraud engine against its SQL."""

import os

import pytest

from tests.conftest import SF
from tests.oracle import differences
from vigilake.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert os.path.exists(SF)
    assert differences(catalog.QUERIES[name](spark, SF), SF, catalog.ORACLE_SQL[name]) == ""


def test_all_have_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_forced_score_never_normal(spark):
    rows = catalog.QUERIES["forced_score"](spark, SF)
    assert rows.filter("fraud_score = 0 OR fraud_reason = 'NORMAL'").count() == 0


def test_entry(spark):
    import __spark_entry__

    assert len(__spark_entry__.entry(spark).columns) == 19
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
