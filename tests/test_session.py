import os

import pytest
from pyspark.sql import functions as F

from sedimenta import session


class Conf(dict):
    get = dict.get


class Fake:
    """A session that only knows its settings and its master."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_shared_root_is_the_configured_folder():
    assert session.shared_root(Fake("yarn", **{"spark.checkpoint.dir": "hdfs://n/ck/"})) == "hdfs://n/ck"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_root(Fake("spark://host:7077"))


def test_local_session_gets_one_folder():
    root = session.shared_root(Fake("local[2]"))
    assert root == session.shared_root(Fake("local[2]"))
    assert session.scratch_path(Fake("local[2]"), "x") != session.scratch_path(Fake("local[2]"), "x")


def test_materialize_keeps_rows_and_types(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b, timestamp_ntz'2024-01-01' as c")
    stored, count = session.materialize_counting(df, F.count_if(F.col("a") == 1))
    assert (stored.collect(), stored.dtypes, count) == (df.collect(), df.dtypes, 1)
    assert session.materialize(df.limit(0)).count() == 0


def test_intermediate_tables_go_with_their_scope(spark):
    kept = session.materialize(spark.range(3))
    with pytest.raises(ValueError), session.scratch_scope(spark):
        outer = session.materialize(spark.range(4))
        with session.scratch_scope(spark):
            inner = session.materialize(spark.range(5))
            assert inner.count() == 5
        assert not os.path.exists(inner.inputFiles()[0].removeprefix("file://")) and outer.count() == 4
        raise ValueError
    assert not os.path.exists(outer.inputFiles()[0].removeprefix("file://"))
    assert kept.count() == 3
