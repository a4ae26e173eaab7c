"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from checks.compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["customer_state", "purchase_month", "total_orders"]
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
