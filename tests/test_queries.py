"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry
import oracles
from lectern.plans import registry
from tests.compare import difference, duck

SQL = oracles.oracle_sql()


def test_every_query_has_an_expected_result():
    assert set(SQL) == set(registry.queries())


def test_the_entry_registers_them_all():
    assert set(SQL) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(request):
    from tests.conftest import SF_DIR
    return duck(SF_DIR)


@pytest.mark.parametrize("key", list(SQL))
def test_query(spark, con, sf_dir, key):
    assert difference(entry.queries()[key](spark, sf_dir), con, SQL[key]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "student_id"
    assert not df.isEmpty()
