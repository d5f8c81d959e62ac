"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from tidemark.plans import ORACLES, QUERIES

from .compare import connection, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0
