"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry
from corral.plans import queries as ingestion
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF, name, QUERIES[name], SQL.get(name), con)
    assert ok, msg


def test_every_ingestion_query_has_an_oracle():
    assert set(ingestion.queries()) - set(SQL) == set()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == [
        "Strategy", "Check", "Column", "Status", "Impacted_Records", "Action_Taken"
    ]
    assert len(rows) == 3
