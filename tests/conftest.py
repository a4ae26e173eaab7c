import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from storelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "storelens-tests", "4g")


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


@pytest.fixture
def value(spark):
    """The value of one column expression over literals."""
    return lambda column: spark.range(1).select(column.alias("v")).first()["v"]
