"""Registered queries against their SQL at the smallest scale."""

import os

import oracle
import pytest

from grainmill.catalog import REGISTRY

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
KEYS = list(REGISTRY)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, con, key):
    query = REGISTRY[key]
    df = query.run(spark, FOLDER)
    if query.sql is None:
        assert df.take(1)
    else:
        assert oracle.compare(df, con, query.sql) == []


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert not [k for k, q in REGISTRY.items() if q.sql is None]
