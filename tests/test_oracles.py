"""Every query against its SQL oracle on the smallest tables."""

import os

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    assert differences(spark, db, SF_DIR, name) == []
