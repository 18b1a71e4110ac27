import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import duck  # noqa: E402
from checks.warehouse import warehouse  # noqa: E402
from switchboard.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8, app="tests", **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def wh(spark):
    return warehouse(spark, FOLDER)


@pytest.fixture(scope="session")
def con():
    return duck(FOLDER)


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
