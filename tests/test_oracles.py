"""Every registered query against its hand-written SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, note = compare(spark, con, SF, name)
    assert ok, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == spark.read.parquet(f"{SF}/part.parquet").count()


def test_oracles_name_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
