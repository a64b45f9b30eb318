"""Every registered query that SQL can express against its SQL twin, on the whole small tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect


@pytest.fixture(scope="session")
def con(sf):
    return connect(Path(sf))


def test_queries_have_twins():
    """Only queries of the optional corpus part may do without; its own tests hold those against brute force."""
    queries, twins = contract.queries().keys(), contract.oracle_sql().keys()
    assert twins <= queries
    corpus = (contract.corpus.QUERIES.keys() | {"pipeline"}) if contract.corpus else set()
    assert queries - twins <= corpus


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, con, sf, name):
    assert compare(spark, con, Path(sf), name) is None
