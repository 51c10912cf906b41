"""Every registered query against its SQL twin; the others must return rows."""

import pytest
from check import connect, difference

from shelfline.catalog import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, con, name):
    assert difference(spark, folder, name, con) is None
