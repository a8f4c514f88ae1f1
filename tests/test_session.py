"""The shared folder and tables written to it."""

from __future__ import annotations

import os

import pytest

from epigauge import session


class FakeContext:
    master = "spark://head:7077"

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, named=None):
        self.named, self.sparkContext, self.conf = named, FakeContext(), self

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default


def test_the_named_folder_is_used():
    assert session.shared_dir(FakeSession("hdfs://nn/shared/")) == "hdfs://nn/shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession())


def test_a_local_session_gets_a_folder_that_goes_with_the_process(monkeypatch):
    class Local(FakeContext):
        master = "local[2]"

    monkeypatch.setattr(session, "_local_folders", [])
    local = FakeSession()
    local.sparkContext = Local()
    path = session.shared_dir(local)
    assert session.shared_dir(local) == path and os.path.isdir(path)
    session._local_folders.pop().cleanup()
    assert not os.path.exists(path)


def test_intermediate_tables_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda _: f"{tmp_path}/shared")
    df = session.materialise(spark.range(10).toDF("a"), "test")
    path = session.tables_dir(spark)
    assert df.count() == 10 and session.children(spark, path)
    session.clear_tables(spark)
    assert not os.path.exists(path) and session.children(spark, path) == []
    session.remove(spark, path)


def test_materialise_keeps_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    table = session.materialise(df, "test")
    assert rows(table) == rows(df) and table.dtypes == df.dtypes
    assert "LogicalRDD" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_independent_works_keep_their_order(spark):
    assert session.at_once(spark, [lambda i=i: spark.range(i).count() for i in range(5)]) == [0, 1, 2, 3, 4]
