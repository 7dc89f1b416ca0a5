import os

import pytest

from doclathe import runtime


def test_materialised_tables_live_in_the_shared_folder(spark):
    df = runtime.materialize(spark.range(10).withColumnRenamed("id", "a b"))
    where = df._scratch.removeprefix("file:")
    assert where.startswith(runtime.shared_dir(spark).removeprefix("file:")) and os.path.isdir(where) and df.count() == 10
    runtime.release(df)
    assert not os.path.exists(where)
    runtime.release(df)


def test_shared_folder_is_read_from_the_session(spark):
    assert runtime.shared_dir(spark) == spark.sparkContext.getCheckpointDir() == runtime.shared_dir(spark)


def test_no_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError):
        runtime.shared_dir(Session())


def test_broadcast_only_what_is_small(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(runtime.small(spark.range(5), 5)).lower() and "broadcast" not in plan(runtime.small(spark.range(6), 5)).lower()


def test_spread_keeps_rows(spark):
    assert sorted(r[0] for r in runtime.spread(spark.range(100)).collect()) == list(range(100))
    big = spark.range(10_000_000)
    assert runtime.spread(big) is big
