"""Every registered query against its SQL, at the smallest scale."""

import pytest

from compare import connect, contract, difference
from loomline.plans import checks, queries as registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert difference(spark, db, name, SF_DIR) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    total = [r for r in rows if r["split"] is None]
    assert len(total) == 1 and total[0]["n_docs"] > 0


def test_every_own_query_has_sql():
    assert {query.__name__ for query in registry.REGISTERED} == set(checks.sql())
    assert {query.__name__ for query in registry.MODELS} <= set(contract.queries()) - set(checks.sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
