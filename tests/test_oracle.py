"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from check_oracle import compare, connect

from quillgrid.plans import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    assert compare(spark, FOLDER, name, duck) is None
