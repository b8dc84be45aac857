from types import SimpleNamespace

import pytest

from tunesmith.sources import scratch
from tunesmith.sources.scratch import scratch_folder, stored


class Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}", getConf=lambda: Settings())
    return SimpleNamespace(conf=Settings(conf), sparkContext=context)


def test_the_folder_named_by_the_session_is_used():
    assert scratch_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        scratch_folder(session("yarn"))


def test_a_local_session_gets_one_folder():
    assert scratch_folder(session("local[2]")) == scratch_folder(session("local[2]"))


def test_stored_tables_are_fixed(spark):
    once = stored(spark.range(10).selectExpr("id", "rand() AS r"))
    assert once.collect() == once.collect()
    assert "parquet" in once._jdf.queryExecution().executedPlan().toString()


def test_released_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_folder", lambda spark: str(tmp_path))
    kept = stored(spark.range(3))
    with scratch.released(spark):
        assert stored(spark.range(5)).count() == 5
        assert len(list(tmp_path.iterdir())) == 2
    assert len(list(tmp_path.iterdir())) == 1 and kept.count() == 3


def test_a_local_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        scratch_folder(session("local-cluster[2,1,1024]"))


def test_a_layout_is_written_once_until_it_is_gone(spark):
    made = []

    def write(path):
        made.append(path)
        spark.range(3).write.parquet(path)

    with scratch.released(spark):
        first = scratch.written_once(spark, ("three", "here"), write)
        assert scratch.written_once(spark, ("three", "here"), write) == first and len(made) == 1
        assert scratch.written_once(spark, ("three", "there"), write) != first
        files, place = scratch._place(spark, first)
        files.delete(place, True)
        again = scratch.written_once(spark, ("three", "here"), write)
        assert again != first and spark.read.parquet(again).count() == 3
    # Released ones are forgotten.
    with scratch.released(spark):
        assert scratch.written_once(spark, ("three", "here"), write) not in made[:-1]
