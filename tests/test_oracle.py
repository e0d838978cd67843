"""Every registered query that has an oracle statement against DuckDB at sf0.01 (the driver's gate).

All queries of the catalog have one. Training-data queries that SQL cannot
express are tested in tests/llm against plain versions.
"""

import pytest

import __spark_entry__ as E
from conftest import SF
from oracle_check import compare
from vigil import catalog

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def test_every_catalog_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    status, n, _, info = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF)
    assert status == "ok", info
