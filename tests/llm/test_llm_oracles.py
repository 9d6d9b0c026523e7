"""Queries of the training-data operators against their SQL."""

import os

import pytest

from checks.compare import connect, rows_of
from sedimenta.llm.oracles import ORACLES
from sedimenta.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, name):
    cursor = connect(SF_DIR).execute(ORACLES[name])
    titles = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(titles) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(titles, cursor.fetchall())
