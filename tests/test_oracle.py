"""Every registered query with SQL gives the rows of that SQL on the whole tables."""

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck("/root/testdata/sf0.01")


def test_only_fits_lack_sql():
    assert set(QUERIES) - set(ORACLE) == {"seasonal_fit", "tree_trials", "stacked_forecast"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, connection, sf_dir, name):
    rows, differences = compare(spark, connection, QUERIES[name], ORACLE[name], sf_dir)
    assert rows > 0
    assert differences == []


def test_entry(spark, sf_dir):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
