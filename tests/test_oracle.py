"""Every registered query against the same query in another engine, on the given tables."""

from pathlib import Path

import pytest
from oracle import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from formtide.plans import checks

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, con, name):
    assert spark_rows(driver.queries()[name](spark, FOLDER)) == duck_rows(con, driver.oracle_sql()[name])


def test_every_own_query_has_an_oracle():
    assert set(checks.QUERIES) == set(checks.ORACLES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["date", "team_name", "last_10_match_day_winshare", "last_10_days_match_count"]
    assert df.count() > 0
