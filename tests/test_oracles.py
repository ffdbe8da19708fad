"""Every query with an oracle, compared on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from check import TABLES, compare
from tests.conftest import SMALL

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    yield c
    c.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(name, spark, con):
    outcome = compare(QUERIES[name](spark, SMALL), con, ORACLES[name])
    assert outcome.startswith("ok"), outcome


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() == 3
