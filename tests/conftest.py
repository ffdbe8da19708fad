import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from risklake.plans.lakehouse import lake_for  # noqa: E402
from risklake.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        app="tests",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    return lake_for(spark, SMALL)


@pytest.fixture(scope="session")
def medium_lake(spark):
    return lake_for(spark, MEDIUM)


def rows(df, *order):
    """Rows as dicts, sorted by the given columns (all columns by default)."""
    keys = order or df.columns
    return sorted(
        (r.asDict() for r in df.collect()),
        key=lambda r: tuple((r[k] is not None, str(type(r[k])), r[k]) for k in keys),
    )
