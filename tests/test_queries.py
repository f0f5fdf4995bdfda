"""Every registered query that has an oracle gives the oracle's rows on the smallest tables."""

import pytest
from conftest import SMALL
from harness import compare, connect

from varspan.plans import catalog


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, con, name):
    assert compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], SMALL) == []
