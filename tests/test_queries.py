"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as contract
from tests.conftest import DATA
from tools.check import rows_of


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    got = rows_of(df.columns, df.collect())
    found = duck.execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in found.description], found.fetchall())


@pytest.mark.parametrize("name", ["doc_topics", "lsi_fit", "nearest_approx", "chunk_overlap", "vector_classifier", "boosted_regression"])
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, DATA).count() > 0


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
